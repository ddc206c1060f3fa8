"""Exact top-k by inner product: a dual-tree search over cover trees.

Rows are dealt to blocks of bounded size, queries too; each pair of a block of
rows and a block of queries is one group. There both sides get a cover tree (a
node's children lie further apart than the next covering radius, and each of its
points is within that radius of a child). A pair of nodes is skipped when the
largest inner product that their covering radii allow is below the worst k-th
score in the query node. The groups' best k are merged by a window.

Each vector is compared as integers, so scores and ties are exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cubeguard.llm.common import ship_code

ROW_BLOCK, QUERY_BLOCK = 8192, 4096
#: A node of so few points, or with more children than this, is a leaf.
LEAF, MAX_CHILDREN = 48, 64
#: The covering radius of a child by that of its parent.
SHRINK = 0.75
TOP, EVERY, SCALE = 5, 50, 256


class Node:
    """Points below a node; its centre is one of them."""

    __slots__ = ("points", "centre", "radius", "children")

    def __init__(self, points: np.ndarray, centre: int, radius: float):
        self.points, self.centre, self.radius, self.children = points, centre, radius, []


def cover_tree(x: np.ndarray) -> Node:
    """Built from the top, with a stack: deep trees are no trouble."""
    dist = lambda own, c: np.sqrt(np.maximum(((x[own] - x[c]) ** 2).sum(axis=1), 0.0))
    start = np.arange(len(x))
    root = Node(start, 0, float(dist(start, 0).max()))
    todo = [root]
    while todo:
        node = todo.pop()
        if len(node.points) <= LEAF or node.radius == 0.0:
            continue
        reach = node.radius * SHRINK
        open_, centre, children = node.points, node.centre, []
        while len(open_) and len(children) <= MAX_CHILDREN:
            d = dist(open_, centre)
            near = d <= reach
            children.append(Node(open_[near], centre, float(d[near].max())))
            open_, d = open_[~near], d[~near]
            if len(open_):
                centre = int(open_[0])
        if not len(open_):  # else the points lie further apart than the next radius: a leaf
            node.children = children
            todo += children
    return root


def search(x: np.ndarray, x_ids: np.ndarray, q: np.ndarray, q_ids: np.ndarray, k: int):
    """(query place, row place, score) of each query's k best rows; both int64 arrays.

    Scores must fit 2**53 (see ``_small``), so float products are exact.
    """
    order = np.argsort(x_ids, kind="stable")
    x, x_ids = x[order].astype(np.float64), x_ids[order]
    q = q.astype(np.float64)
    n, none = len(x), np.iinfo(np.int64).min
    best = np.full((len(q), k), none, np.int64)  # score * n + (n - 1 - place): ties to the smaller id
    rows, queries = cover_tree(x), cover_tree(q)
    x_norm, q_norm = np.sqrt((x * x).sum(axis=1)), np.sqrt((q * q).sum(axis=1))

    def bound(a: Node, b: Node) -> float:
        most = float(q[a.centre] @ x[b.centre]) + a.radius * x_norm[b.centre] + b.radius * q_norm[a.centre] + a.radius * b.radius
        return most + 1e-9 * abs(most) + 1e-3

    def worst(a: Node) -> float:
        low = int(best[a.points, k - 1].min())
        return -np.inf if low == none else low // n

    todo = [(bound(queries, rows), queries, rows)]
    while todo:
        most, a, b = todo.pop()
        if most < worst(a):
            continue
        if not a.children and not b.children:
            score = np.rint(q[a.points] @ x[b.points].T).astype(np.int64)
            key = score * n + (n - 1 - b.points)[None, :]
            key[q_ids[a.points][:, None] == x_ids[b.points][None, :]] = none
            both = np.concatenate([best[a.points], key], axis=1)
            if both.shape[1] > k:
                both = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
            best[a.points] = np.sort(both, axis=1)[:, ::-1]
            continue
        if a.children and (not b.children or a.radius >= b.radius):
            nxt = [(bound(c, b), c, b) for c in a.children]
        else:
            nxt = [(bound(a, c), a, c) for c in b.children]
        todo += sorted(nxt, key=lambda t: t[0])  # the most promising on top
    at, col = np.nonzero(best != none)
    key = best[at, col]
    place = n - 1 - key % n
    return at, order[place], key // n


def _small(*sides: np.ndarray) -> bool:
    """Whether all scores, times a block's rows, stay exact."""
    most = [float(np.abs(s.astype(np.float64)).max()) if s.size else 0.0 for s in sides]
    return most[0] * most[1] * sides[0].shape[1] * ROW_BLOCK * 4 < 2 ** 53


def _plain(x, x_ids, q, q_ids, k):
    """For components too large for exact floats: Python's integers."""
    out = []
    for i, (own, qid) in enumerate(zip(q.tolist(), q_ids.tolist(), strict=True)):
        ranked = sorted((-sum(a * b for a, b in zip(own, row, strict=True)), xid, j) for j, (row, xid) in enumerate(zip(x.tolist(), x_ids.tolist(), strict=True)) if xid != qid)
        out += [(i, j, min(max(-s, -2 ** 63), 2 ** 63 - 1)) for s, _, j in ranked[:k]]
    return [np.array(c, np.int64) for c in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 3


def _searcher(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def side(table: pa.Table):
        ids = table.column("vec_id").to_numpy()
        flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(len(ids), -1), ids

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return schema.empty_table()
        (x, x_ids), (q, q_ids) = side(rows), side(queries)
        find = search if _small(x, q) else _plain
        at, place, score = find(x, x_ids, q, q_ids, k)
        return pa.table([pa.array(q_ids[at], pa.int64()), pa.array(x_ids[place], pa.int64()), pa.array(score, pa.int64())], schema=schema)

    return run


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v, dim): floor(SCALE * x) of each component; unusable vectors left out."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("e")).where(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & ~bad & (F.size("e") > 0))
    return rows.select("vec_id", F.transform("e", lambda x: F.floor(x * SCALE)).alias("v"), F.size("e").alias("dim")).dropDuplicates(["vec_id", "v"])


def top_k(vectors: DataFrame, k: int = TOP, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best other rows, ties to smaller vec_id.

    Queries are the rows whose vec_id is divisible by ``every``. Vectors that are null or
    empty or hold null or non-finite components take no part, nor do rows with a null
    vec_id. Vectors of different lengths are not compared. A row that is repeated counts
    once, and no row with the query's own vec_id is its candidate. A query without
    candidates, and an empty table, give no rows. Other columns are not read.
    """
    ship_code(vectors.sparkSession)
    rows = integer_vectors(vectors)
    wanted = rows.where(F.col("vec_id") % every == 0)
    n, m = rows.count(), wanted.count()
    row_blocks, query_blocks = max(1, -(-n // ROW_BLOCK)), max(1, -(-m // QUERY_BLOCK))
    spread = lambda name, count: F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)
    place = lambda count: F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")
    left = rows.select("dim", place(row_blocks).alias("rb"), spread("qb", query_blocks), "vec_id", "v")
    right = wanted.select("dim", spread("rb", row_blocks), place(query_blocks).alias("qb"), "vec_id", "v")
    found = left.groupBy("dim", "rb", "qb").cogroup(right.groupBy("dim", "rb", "qb")).applyInArrow(_searcher(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: DuckDB: all pairs of queries and rows.
ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, r.vec_id, CAST(list_inner_product(q.v, r.v) AS BIGINT) AS score
  FROM v q JOIN v r ON q.vec_id <> r.vec_id AND q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
WHERE rank <= 5
"""

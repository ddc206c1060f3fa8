import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cubeguard.llm import minhash_dedup as M
from cubeguard.llm.common import connected_components
from tests.llm.helpers import frame, rows, words


def shingles(text, size):
    w = (text or "").encode().lower().split()
    return {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def brute(own, size, percent=80):
    ids = sorted({r[0] for r in own if r[0] is not None})
    sets = [(r[0], shingles(r[1], size)) for r in own if r[0] is not None]
    low = {i: i for i in ids}
    links = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k] if x and y and 100 * len(x & y) >= percent * len(x | y)]
    for _ in ids:
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    return sorted(((r[0], len(shingles(r[1], size)), low.get(r[0]), r[0] is None or low[r[0]] == r[0]) for r in own), key=repr)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


@pytest.mark.parametrize("size", [4, 5])
def test_awkward_rows(spark, size):
    assert found(M.near_duplicates(frame(spark), size)) == brute(rows(), size)


def test_copies_at_all_distances(spark):
    rng, own = random.Random(3), []
    for base in range(6):
        text = words(150, 50 + base)
        for k in range(40):
            copy = list(text)
            for _ in range(rng.randint(0, 8)):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
            own.append((base * 100 + k, " ".join(copy), None, None, None, None, None))
    rng.shuffle(own)
    assert found(M.near_duplicates(frame(spark, own), 4)) == brute(own, 4)


def test_blocks_of_one_group(spark, monkeypatch):
    """A group over many blocks gives the same classes."""
    own = [(k, " ".join(words(100, 9)[:-1] + [f"end{k}"]), None, None, None, None, None) for k in range(60)]
    monkeypatch.setattr(M, "BLOCK_ROWS", 7)
    assert found(M.near_duplicates(frame(spark, own), 4)) == brute(own, 4)


def test_words_are_split_at_the_named_spaces_only():
    assert len(M.shingle_set("a b c\x1cd E", 1)) == 3
    assert (M.shingle_set("A b", 4) == M.shingle_set("a\tB", 4)).all()
    assert len(M.shingle_set(None, 4)) == len(M.shingle_set(" \n", 4)) == 0


def test_every_pair_within_the_radius_meets():
    """Pigeonhole: signatures RADIUS slots apart share a key."""
    import pyarrow as pa
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 16, M.SLOTS).astype(np.uint16)
    for _ in range(200):
        b = a.copy()
        b[rng.choice(M.SLOTS, M.RADIUS, replace=False)] ^= 1
        batch = pa.RecordBatch.from_arrays([pa.array([1, 2], pa.int64()), pa.array([a.tobytes(), b.tobytes()])], names=["rep", "sig"])
        out = next(M._keys([batch])).to_pydict()
        mine = {k for r, k in zip(out["rep"], out["key"], strict=True) if r == 1}
        assert mine & {k for r, k in zip(out["rep"], out["key"], strict=True) if r == 2}


def test_components_of_chains_and_hubs(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 180)] + [(500, 500)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 180)}}


def test_empty_table(spark):
    assert M.near_duplicates(frame(spark, [])).count() == 0
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_no_driver_collect_of_documents(spark):
    """The result is a plan over stored tables, not local rows."""
    plan = M.near_duplicates(frame(spark), 4).withColumn("x", F.lit(1))._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in plan

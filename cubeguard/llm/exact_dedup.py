"""Exact duplicates by skew-safe combining: local, salted, then global, on full content.

The digest only deals rows out; each of the three stages groups by the
normalised text itself, so a digest collision never joins different texts:

1. local: map-side combine within each scan partition;
2. salted: the partitions' survivors, dealt by (digest, text, salt). The salt is
   the scan partition modulo ``SALTS``, so a text that half of all rows share is
   merged by several tasks, each from a share of the partitions;
3. global: the salt winners, at most ``SALTS`` rows a text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubeguard.llm.common import SPACES, store

SALTS = 16

# A row's rank in its group: code points first, then the smallest doc_id (a null
# one last). One decimal, so that the aggregates stay hash aggregates.
_STEP = "cast('100000000000000000000' as decimal(21,0))"
_HIGH = "cast('9223372036854775808' as decimal(20,0))"


def _rank(chars: Column, doc_id: Column) -> Column:
    low = F.coalesce(F.expr(_HIGH) - doc_id.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return (chars.cast("decimal(11,0)") * F.expr(_STEP) + low).cast("decimal(38,0)")


def _rank_id(rank: Column) -> Column:
    low = rank % F.expr(_STEP)
    return F.when(low > 0, (F.expr(_HIGH) - low).cast("long"))


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _rows(docs: DataFrame, digest: Callable[[Column], Column], *more: str) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    norm = F.translate(text, SPACES, "")
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.length(text).alias("chars"), norm.alias("norm"), *more)
            .withColumn("digest", digest(F.col("norm"))))


def _winners(rows: DataFrame) -> DataFrame:
    """(digest, norm, rank, group_size): the three stages."""
    salted = rows.select("digest", "norm", F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt"), _rank(F.col("chars"), F.col("doc_id")).alias("rank"))
    merged = salted.groupBy("digest", "norm", "salt").agg(F.max("rank").alias("rank"), F.count(F.lit(1)).alias("n"))
    return merged.groupBy("digest", "norm").agg(F.max("rank").alias("rank"), F.sum("n").alias("group_size"))


def _groups(docs: DataFrame, digest: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame | None]:
    """Groups by digest alone, and by (digest, norm) where texts share a digest."""
    found = (_winners(_rows(docs, digest)).groupBy("digest")
             .agg(F.max("rank").alias("rank"), F.max("group_size").alias("group_size"), F.count(F.lit(1)).alias("texts")))
    found = store(found)
    clashes = found.where("texts > 1").select("digest")
    if clashes.isEmpty():
        return found.select("digest", "rank", "group_size"), None
    again = store(_winners(_rows(docs, digest).join(clashes, "digest", "left_semi")))
    return found.where("texts = 1").select("digest", "rank", "group_size"), again


def exact_duplicates(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without the characters of [\\x20\\x09-\\x0D]; null
    counts as empty, and all empty texts are one group. The row with the most code
    points stays, then the smallest doc_id (a null doc_id comes last; keep_id is null
    if no other is there). Of repeated rows that tie in both, one is kept. An empty
    table gives an empty result. Other columns are not read.
    """
    whole, parted = _groups(docs, digest)

    def members(rows: DataFrame, groups: DataFrame, on: list[str]) -> DataFrame:
        each = rows.groupBy(*on, "doc_id", "chars", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256")).agg(F.count(F.lit(1)).alias("times"))
        return (each.join(groups, on)
                .withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
                .select("doc_id", _rank_id(F.col("rank")).alias("keep_id"), "group_size",
                        ((F.col("nth") == 1) & (_rank(F.col("chars"), F.col("doc_id")) == F.col("rank"))).alias("kept"), "text_sha256"))

    out = members(_rows(docs, digest), whole, ["digest"])
    return out if parted is None else out.union(members(_rows(docs, digest), parted, ["digest", "norm"]))


def keep_first(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """The rows of ``docs`` that stay, with all its columns; cases as above."""
    whole, parted = _groups(docs, digest)
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), "doc_id", "text")

    def kept(groups: DataFrame, on: list[str]) -> DataFrame:
        rows = _rows(packed, digest, "row").withColumn("rank", _rank(F.col("chars"), F.col("doc_id")))
        return rows.join(groups.select(*on, "rank"), [*on, "rank"]).dropDuplicates([*on, "rank"]).select("row.*")

    out = kept(whole, ["digest"])
    return out if parted is None else out.union(kept(parted, ["digest", "norm"]))


#: DuckDB: equal texts are partitions of the normalised text itself.
ORACLE = r"""
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
g AS (
  SELECT doc_id, first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(t) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size, sha256(norm) AS text_sha256
  FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""

"""Mixing sources to target weights: iterative proportional fitting, then sampling.

Documents fall into cells (source, language, topic). The cells' token weights are
raked to the three target marginals in turn until all agree. A document's
probability is its cell's weight for each token, scaled so that the expected
tokens are the budget and no probability exceeds one; a hash of doc_id and seed
decides, so a lost executor's rows come out the same.

All work on documents is one map-side combined aggregate and one join with the
cells; raking touches the cell table only, which is written each sweep. DataFrame
operations only; one number a sweep comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubeguard.llm.common import drop_stored, store

DIMENSIONS = ("source", "lang", "topic")
#: Share of a marginal's value to this power, normalised, is its target by default.
TEMPER = {"source": 0.7, "lang": 0.7, "topic": 1.0}
#: Share of all tokens to keep, on average.
BUDGET = 0.8
SWEEPS, TOLERANCE, SEED = 60, 1e-6, 17
NONE = "(none)"
#: (topic, pattern): the first that occurs in the text names it, else ``prose``.
TOPICS = (("table", r"\s\|\s"), ("shout", r"\p{Lu}!!"), ("noise", r"[#$%&*]{3}"), ("contact", r"[0-9A-Za-z]@[0-9A-Za-z]"))


def topic(text: Column) -> Column:
    out = F.lit("prose")
    for name, pattern in reversed(TOPICS):
        out = F.when(text.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def _labelled(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(NONE))
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        value("source").alias("source"), value("lang").alias("lang"), topic(text).alias("topic"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_tokens"))


def tempered(cells: DataFrame, name: str, power: float) -> DataFrame:
    """(value, target): each value's share of tokens to ``power``, normalised."""
    return cells.groupBy(F.col(name).alias("value")).agg(F.pow(F.sum("n_tokens").cast("double"), F.lit(power)).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """``cells`` with ``w``: the tokens that each should give, of all its tokens.

    ``targets`` has (value, target) by dimension; targets are taken relative to the
    values that occur, and a value without target gets none. Where the empty cells
    leave no solution, it stops after ``SWEEPS`` and the last dimension holds.
    """
    total = cells.agg(F.sum("n_tokens")).first()[0] or 0
    cur = cells.withColumn("w", F.col("n_tokens").cast("double"))
    if not total:
        return cur
    for name in DIMENSIONS:
        present = cells.groupBy(F.col(name).alias("value")).agg(F.sum("n_tokens").alias("there")).where("there > 0").select("value")
        wanted = store(present.join(targets[name].groupBy("value").agg(F.sum("target").alias("target")), "value", "left").na.fill({"target": 0.0}))
        whole = wanted.agg(F.sum("target")).first()[0]
        targets = targets | {name: wanted.select(F.col("value").alias(name), (F.col("target") / F.lit(whole) * F.lit(float(total))).alias("goal"))}
    stored = None
    for _ in range(SWEEPS):
        off = F.lit(0.0)
        for name in DIMENSIONS:
            margin = cur.groupBy(name).agg(F.sum("w").alias("sum")).join(targets[name], name, "left")
            margin = margin.select(name, F.when(F.col("sum") > 0, F.coalesce("goal", F.lit(0.0)) / F.col("sum")).otherwise(0.0).alias("by"), (F.col("sum") > 0).alias("alive"))
            cur = cur.join(margin, name).withColumn("w", F.col("w") * F.col("by"))
            cur = cur.withColumn(f"off_{name}", F.when(F.col("alive") & (F.col("by") > 0), F.abs(F.col("by") - 1)).otherwise(0.0)).drop("by", "alive")
            off = F.greatest(off, F.col(f"off_{name}"))
        cur = store(cur.withColumn("off", off).select(*DIMENSIONS, "n_tokens", "w", "off"))
        if stored is not None:
            drop_stored(stored)
        stored = cur
        if cur.agg(F.max("off")).first()[0] < TOLERANCE:
            break
        cur = cur.drop("off")
    return stored.drop("off")


def _calibrated(cells: DataFrame, budget: float) -> DataFrame:
    """Cells with weight (for each token) and probability: expected tokens are the budget."""
    rated = cells.withColumn("weight", F.when(F.col("n_tokens") > 0, F.col("w") / F.col("n_tokens")).otherwise(1.0))
    total = rated.agg(F.sum("n_tokens")).first()[0] or 0
    scale = budget
    for _ in range(SWEEPS):
        full = F.col("weight") * scale >= 1
        kept, rest = rated.agg(F.sum(F.when(full, F.col("n_tokens")).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("w")))).first()
        if not rest or not total:
            break
        new = max(scale, (budget * total - kept) / rest)
        if abs(new - scale) <= 1e-12 * scale:
            break
        scale = new
    return rated.withColumn("probability", F.least(F.lit(1.0), F.col("weight") * F.lit(float(scale))))


def mixed(docs: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: row (a struct of its columns), doc_id, source, lang,
    topic, n_tokens, weight, probability, kept.

    Null source or lang is the value ``(none)``; a null or empty text has no tokens and
    its cell's weight (1 if the cell has none). A null doc_id is hashed like a value of
    its own; repeated rows are decided alike. An empty table gives an empty result.
    """
    rows = _labelled(docs)
    cells = store(rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("n_tokens")))
    goals = {d: (targets or {}).get(d) if (targets or {}).get(d) is not None else tempered(cells, d, TEMPER[d]) for d in DIMENSIONS}
    rated = store(_calibrated(rake(cells, goals), budget).select(*DIMENSIONS, "weight", "probability"))
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 11).cast("double") * F.lit(2.0 ** -53)
    return rows.join(rated, list(DIMENSIONS)).withColumn("kept", u < F.col("probability"))


def mix_report(docs: DataFrame, **settings) -> DataFrame:
    """``mixed`` without the documents' own columns."""
    return mixed(docs, **settings).select("doc_id", *DIMENSIONS, "n_tokens", "weight", "probability", "kept")


def keep_mixed(docs: DataFrame, **settings) -> DataFrame:
    """The sampled rows of ``docs``, with its columns."""
    return mixed(docs, **settings).where("kept").select("row.*")

"""Exact weighted quantiles and outlier fences by histogram refinement.

Definition (fixed here and in the tests): within a group drop NULL values and
treat NULL or non-positive weights as 0.  With ``cum`` the cumulative weight
up to and including a value (ties are peers) and ``tot`` the group's total
weight, the p-quantile is the mean of

* ``lower``: the smallest value with ``cum >= p * tot``, and
* ``upper``: the smallest value with ``cum > p * tot``

(equal unless the cumulative weight hits ``p * tot`` exactly).  A group whose
weights are all zero has NULL quantiles.

Weights are summed per (group, value) first (map-side combine).  A value is then
selected by refinement: a pass adds up the weights of a group's buckets, and the
bucket in which a target is reached is all that the next pass reads.  The first
pass cuts values by their order of magnitude (``STEPS`` buckets for each power
of two), the others cut what is left into ``PARTS`` equal parts between its
smallest and largest value.  A bucket number is a formula of the value, so a row
costs the same whatever the number of buckets, and a group's histogram is bounded
however many rows it has.  The few values of the last bucket are put in order by a
window.  Without a pass that window reads the whole group, which is right for a
bounded one.  Weights are summed as decimals with six places, so neither the
passes nor the order of the rows changes a sum.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cubeguard.functions.joins import MAX_BROADCAST_ROWS

# A window orders about so many rows of a group.
ROWS_PER_RANGE = 200_000
# Buckets for each power of two, and for each further pass.
STEPS, PARTS = 64, 1024
STATS = ("MIN", "wq25", "wq50", "wq75", "MAX", "LOW", "HIGH")


def passes_for(rows: int | None, rows_per_range: int = ROWS_PER_RANGE) -> int:
    """Passes that leave about ``rows_per_range`` of a group's ``rows`` rows in a bucket."""
    left, passes = rows or 1, 0
    while left > rows_per_range:
        left //= STEPS if passes == 0 else PARTS
        passes += 1
    return passes


@dataclass(frozen=True)
class Target:
    """The smallest value whose cumulative weight reaches (``strict``: exceeds) ``at(tot)``."""

    name: str
    at: Callable[[F.Column], F.Column]
    strict: bool

    def reached(self, cum: F.Column, tot: F.Column) -> F.Column:
        cum, at = cum.cast("double"), self.at(tot.cast("double"))
        return cum > at if self.strict else cum >= at


def _on(left: DataFrame, right: DataFrame, cols, prefix: str):
    cond = None
    for i, c in enumerate(cols):
        e = left[f"`{c}`"].eqNullSafe(right[f"{prefix}{i}"])
        cond = e if cond is None else cond & e
    return cond


def _renamed(cols, prefix: str):
    return [F.col(f"`{c}`").alias(f"{prefix}{i}") for i, c in enumerate(cols)]


def magnitude(v: F.Column) -> F.Column:
    """Bucket of the first pass: grows with ``v``, ``STEPS`` for each power of two.

    A logarithm rounded to the wrong side of a power of two gives the bucket that
    the right one gives, or the one beside it in order.
    """
    a = F.abs(v)
    power = F.floor(F.log2(a))
    step = F.floor((F.try_divide(a, F.pow(F.lit(2.0), power)) - 1) * STEPS)
    return F.when(v == 0, F.lit(0)).otherwise(F.signum(v) * ((power + 1100) * STEPS + step + 1)).cast("bigint")


def _part(v: F.Column, lo: F.Column, hi: F.Column) -> F.Column:
    """Bucket of a further pass: equal parts from ``lo`` to ``hi``."""
    share = F.try_divide(v - lo, hi - lo)
    return F.coalesce(F.least(F.floor(share * PARTS), F.lit(PARTS - 1)), F.lit(0)).cast("bigint")


def _weights(df: DataFrame, groups, value: str, weight: str | None) -> DataFrame:
    """(groups, __v, __w): the weight of each value, summed map-side."""
    v = F.col(f"`{value}`")
    if weight is None:
        w = F.lit(1).cast("bigint")
    else:
        w = F.col(f"`{weight}`").cast("decimal(27,6)")
        w = F.when(w > 0, w).otherwise(F.lit(0).cast("decimal(27,6)"))
    return (df.where(v.isNotNull()).select(*[F.col(f"`{g}`") for g in groups], v.alias("__v"), w.alias("__wp"))
            .groupBy(*groups, "__v").agg(F.sum("__wp").alias("__w")))


def _up_to(order: str, *by):
    return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def select_values(df: DataFrame, group_cols, value: str, weight: str | None, targets: list[Target], passes: int = 0,
                  groups_bound: int | None = None) -> DataFrame:
    """One row per group: ``__tot``, ``__min``, ``__max`` and the value that each target selects.

    ``passes`` histograms narrow each target before the window; the result does
    not depend on it.  ``groups_bound`` bounds the groups: chosen buckets (one a
    group and target) are broadcast behind it, else joined as Spark decides.
    """
    groups = list(group_cols)
    d = _weights(df, groups, value, weight)
    if passes == 0:
        d = d.withColumns({"__cum": F.sum("__w").over(_up_to("__v", *groups)), "__tot": F.sum("__w").over(Window.partitionBy(*groups))})
        return d.groupBy(*groups).agg(
            F.max("__tot").alias("__tot"), F.min("__v").alias("__min"), F.max("__v").alias("__max"),
            *[F.min(F.when(t.reached(F.col("__cum"), F.col("__tot")), F.col("__v"))).alias(t.name) for t in targets])

    def narrowed(rows, by, chosen):
        chosen = chosen.select(*_renamed(by + ["__b"], "__c"), *[c for c in chosen.columns if c not in by and c != "__b"])
        if groups_bound is not None and groups_bound * len(targets) <= MAX_BROADCAST_ROWS:
            chosen = F.broadcast(chosen)
        return rows.join(chosen, _on(rows, chosen, by + ["__b"], "__c")).drop("__b", *[f"__c{i}" for i in range(len(by) + 1)])

    # first pass: one histogram a group for all targets
    rows = d.withColumn("__b", magnitude(F.col("__v").cast("double")))
    h = rows.groupBy(*groups, "__b").agg(F.sum("__w").alias("__bw"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    whole = Window.partitionBy(*groups)
    h = h.withColumns({"__cum": F.sum("__bw").over(_up_to("__b", *groups)), "__tot": F.sum("__bw").over(whole),
                       "__min": F.min("__lo").over(whole), "__max": F.max("__hi").over(whole), "__least": F.min("__b").over(whole)})
    facts = h.groupBy(*groups).agg(F.max("__tot").alias("__tot"), F.max("__min").alias("__min"), F.max("__max").alias("__max"))
    reached = [t.reached(F.col("__cum"), F.col("__tot")) & ~t.reached(F.col("__cum") - F.col("__bw"), F.col("__tot")) for t in targets]
    first = [t.reached(F.col("__cum"), F.col("__tot")) & (F.col("__b") == F.col("__least")) for t in targets]
    here = F.array_compact(F.array(*[F.when(r | f, F.lit(k)) for k, (r, f) in enumerate(zip(reached, first, strict=True))]))
    chosen = h.withColumn("__off", F.col("__cum") - F.col("__bw")).select(*groups, "__b", "__off", "__tot", "__lo", "__hi", F.explode(here).alias("__k"))
    rows = narrowed(rows, groups, chosen)
    by = groups + ["__k"]

    def pick(cum):
        """Whether the target of the row's number is reached."""
        out = F.lit(False)
        for k, t in enumerate(targets):
            out = F.when(F.col("__k") == k, t.reached(cum, F.col("__tot"))).otherwise(out)
        return out

    for _ in range(passes - 1):
        rows = rows.withColumn("__b", _part(F.col("__v"), F.col("__lo"), F.col("__hi"))).drop("__lo", "__hi")
        h = rows.groupBy(*by, "__b").agg(F.sum("__w").alias("__bw"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"),
                                         F.max("__off").alias("__off"), F.max("__tot").alias("__tot"))
        h = h.withColumn("__cum", F.col("__off") + F.sum("__bw").over(_up_to("__b", *by)))
        h = h.where(pick(F.col("__cum"))).withColumn("__first", F.min("__b").over(Window.partitionBy(*by))).where(F.col("__b") == F.col("__first"))
        chosen = h.select(*by, "__b", (F.col("__cum") - F.col("__bw")).alias("__off"), "__lo", "__hi")
        rows = narrowed(rows.drop("__off"), by, chosen)
    rows = rows.withColumn("__cum", F.col("__off") + F.sum("__w").over(_up_to("__v", *by)))
    found = rows.where(pick(F.col("__cum"))).groupBy(*groups).agg(
        *[F.min(F.when(F.col("__k") == k, F.col("__v"))).alias(t.name) for k, t in enumerate(targets)])
    found = found.select(*_renamed(groups, "__f"), *[t.name for t in targets])
    return facts.join(found, _on(facts, found, groups, "__f"), "left").drop(*[f"__f{i}" for i in range(len(groups))])


def weighted_quantiles(df: DataFrame, group_cols, value: str, weight: str | None, probs, passes: int = 0, prefix: str = "",
                       groups_bound: int | None = None) -> DataFrame:
    """One row per group: MIN, MAX and the X1 weighted quantiles
    (``wq25``-style names for probs 0.25/0.5/0.75, else ``q<p>``)."""
    targets, names = [], []
    for p in probs:
        name = prefix + ({0.25: "wq25", 0.5: "wq50", 0.75: "wq75"}.get(p) or f"q{int(round(p * 100))}")
        names.append(name)
        at = lambda tot, p=p: tot * F.lit(float(p))
        targets += [Target(f"__lo_{name}", at, False), Target(f"__hi_{name}", at, True)]
    q = select_values(df, group_cols, value, weight, targets, passes, groups_bound)
    return q.select(*group_cols, F.col("__min").alias(prefix + "MIN"), F.col("__max").alias(prefix + "MAX"),
                    *[F.when(F.col("__tot") > 0, (F.col(f"__lo_{n}") + F.col(f"__hi_{n}")) / F.lit(2.0)).alias(n) for n in names])


def weighted_fences(df: DataFrame, values, weight: str, group_cols, passes: int = 0,
                    groups_bound: int | None = None) -> DataFrame:
    """MIN, wq25, wq50, wq75, MAX, LOW, HIGH per group, on every row.

    ``values`` is a list of (column, prefix of its fences).  The measures are
    stacked as (kind, value) rows, so ONE cumulative-weight computation serves
    all of them; the per-group fences are turned into columns on the small
    per-group table, which is joined back once: as a broadcast where
    ``groups_bound`` proves it small.
    """
    names = [c if isinstance(c, str) else c._jc.toString().strip("`") for c in group_cols]
    kinds = F.explode(F.array(*[F.struct(F.lit(i).alias("__kind"), F.col(f"`{v}`").cast("double").alias("__val"))
                                for i, (v, _) in enumerate(values)]))
    long = (df.select(*[F.col(f"`{g}`") for g in names], F.col(f"`{weight}`").alias("__wt"), kinds.alias("__x"))
            .select(*names, "__wt", "__x.__kind", "__x.__val"))
    q = weighted_quantiles(long, names + ["__kind"], "__val", "__wt", (0.25, 0.5, 0.75), passes,
                           groups_bound=None if groups_bound is None else groups_bound * len(values))
    q = q.groupBy(*names).agg(*[F.max(F.when(F.col("__kind") == i, F.col(c))).alias(prefix + c)
                                for i, (_, prefix) in enumerate(values) for c in ("MIN", "wq25", "wq50", "wq75", "MAX")])
    for _, prefix in values:
        q25, q75 = F.col(prefix + "wq25"), F.col(prefix + "wq75")
        q = q.withColumns({prefix + "LOW": q25 - F.lit(1.5) * (q75 - q25),
                           prefix + "HIGH": q75 + F.lit(1.5) * (q75 - q25)})
    q = q.select(*_renamed(names, "__g"), *[prefix + c for _, prefix in values for c in STATS])
    if groups_bound is not None and groups_bound <= MAX_BROADCAST_ROWS:
        q = F.broadcast(q)
    return df.join(q, _on(df, q, names, "__g"), "left").drop(*[f"__g{i}" for i in range(len(names))])


def order_statistics(df: DataFrame, group_cols, value: str, probs, passes: int = 2) -> DataFrame:
    """Exact linear-interpolated percentiles (the box-plot definition) per
    group, plus n, min and max, without a per-group value buffer.

    With unit weights the cumulative weight is the number of values <= v, so the
    value of 0-based rank r is the smallest v whose number exceeds r; the
    p-percentile is ``v[floor(h)] + (h - floor(h)) * (v[ceil(h)] - v[floor(h)])``
    with ``h = (n - 1) * p``.
    """
    group_cols = list(group_cols)
    rank = lambda p: lambda tot: (tot - F.lit(1.0)) * F.lit(float(p))
    targets = []
    for name, p in probs.items():
        targets += [Target(f"__a_{name}", lambda tot, p=p: F.floor(rank(p)(tot)), True),
                    Target(f"__b_{name}", lambda tot, p=p: F.ceil(rank(p)(tot)), True)]
    g = select_values(df, group_cols, value, None, targets, passes)
    part = {k: rank(p)(F.col("__tot")) - F.floor(rank(p)(F.col("__tot"))) for k, p in probs.items()}
    return g.select(*group_cols, F.col("__tot").cast("bigint").alias("n"), F.col("__min").alias("min"),
                    *[(F.col(f"__a_{k}") + part[k] * (F.col(f"__b_{k}") - F.col(f"__a_{k}"))).alias(k) for k in probs],
                    F.col("__max").alias("max"))

"""Checks on the comparison cube: A9, A10, A17."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeguard.functions.exprs import GEO_LABEL_ORDER, qc_round, round_half_even
from cubeguard.functions.quantile import order_statistics
from cubeguard.operators.geo import translate_geoniv
from cubeguard.operators.levels import get_all_combinations
from cubeguard.spec import col, rounding_digits, select_diffval_pri, select_nevner_pri, select_teller_pri


def _diffvals(df: DataFrame):
    return [c[: -len("_diff")] for c in df.columns if c.endswith("_diff")]


def comparecube_summary(cc: DataFrame) -> DataFrame:
    """Per level (and TOTAL) and measure: identical / different rows, new
    and expired censoring, mean/min/max of diff and reldiff over differing rows.

    Rows with newrow = 0, after publication rounding and level labels.  The
    measures are stacked to long form and aggregated once with grouping sets
    ((Value), (GEOniv, Value)); partial aggregation runs map-side.
    """
    d = translate_geoniv(qc_round(cc.where(F.col("newrow") == 0)))
    vals = _diffvals(d)
    has_rel = {v: f"{v}_reldiff" in d.columns for v in vals}

    def scale(name):
        digits = rounding_digits(name)
        return 10 ** (6 if digits is None else digits)
    structs = [F.struct(F.lit(v).alias("Value"), F.lit(i).alias("vord"),
                        col(f"{v}_new").cast("double").alias("new"), col(f"{v}_old").cast("double").alias("old"),
                        col(f"{v}_diff").cast("double").alias("diff"),
                        (col(f"{v}_reldiff").cast("double") if has_rel[v] else F.lit(None).cast("double")).alias("rel"),
                        F.lit(scale(f"{v}_diff")).cast("bigint").alias("ds"),
                        F.lit(scale(f"{v}_reldiff")).cast("bigint").alias("rs"))
               for i, v in enumerate(vals)]
    long = d.select("GEOniv", F.explode(F.array(*structs)).alias("x")).select("GEOniv", "x.*")
    differs = F.col("diff") != 0
    in_stats = differs & F.col("new").isNotNull() & F.col("old").isNotNull()

    def r3(c):
        return round_half_even(c, 3)

    def mean3(c, sc):
        # Exact mean of values already rounded to 1/sc: integer sum of the
        # scaled values, one division, half-even at 3 decimals.  A float
        # average of such values hits exact ties whose side depends on the
        # summation order.
        num = F.sum(F.when(in_stats & c.isNotNull(), (F.round(c * sc).cast("bigint")
                           * F.greatest(F.lit(1000) / sc, F.lit(1)).cast("bigint")).cast("decimal(38,0)"))).cast("double")
        den = F.count(F.when(in_stats, c)) * F.max(F.greatest(sc / F.lit(1000), F.lit(1))).cast("bigint")
        return F.bround(F.try_divide(num, den), 0) / F.lit(1000.0)

    agg = (long.groupingSets([["Value", "vord"], ["GEOniv", "Value", "vord"]], "GEOniv", "Value", "vord").agg(
        F.grouping("GEOniv").alias("g_geo"),
        F.count_if(F.col("diff") == 0).alias("Identical"),
        F.count_if(differs).alias("Different"),
        F.count_if(F.col("new").isNull() & F.col("old").isNotNull()).alias("New_prikk"),
        F.count_if(F.col("new").isNotNull() & F.col("old").isNull()).alias("Expired_prikk"),
        mean3(F.col("diff"), F.col("ds")).alias("Mean_diff"),
        r3(F.min(F.when(in_stats, F.col("diff")))).alias("Min_diff"),
        r3(F.max(F.when(in_stats, F.col("diff")))).alias("Max_diff"),
        mean3(F.col("rel"), F.col("rs")).alias("Mean_reldiff"),
        r3(F.min(F.when(in_stats, F.col("rel")))).alias("Min_reldiff"),
        r3(F.max(F.when(in_stats, F.col("rel")))).alias("Max_reldiff")))
    # unlabeled levels (H) count in TOTAL only
    agg = agg.where((F.col("g_geo") == 1) | F.col("GEOniv").isNotNull())
    geo_out = F.when(F.col("g_geo") == 1, F.lit("TOTAL")).otherwise(F.col("GEOniv"))
    lvl = reduce(lambda e, kv: e.when(F.col("GEOniv") == kv[1], kv[0] + 1),
                 enumerate(GEO_LABEL_ORDER), F.when(F.col("g_geo") == 1, 0))
    return (agg.withColumn("__ord", lvl).orderBy("__ord", "vord")
            .select(geo_out.alias("GEOniv"), "Value", "Identical", "Different", "New_prikk", "Expired_prikk",
                    "Mean_diff", "Min_diff", "Max_diff", "Mean_reldiff", "Min_reldiff", "Max_reldiff"))


def diffvals_summary(cc: DataFrame, byyear: bool = False) -> DataFrame:
    """A10: number and sum of differences (|round(diff,1)| != 0) for the best
    numerator, the best denominator and every other measure; one TOTAL row
    or one row per period.  Publication rounding on the output."""
    d = cc.where(F.col("newrow") == 0)
    allvals = _diffvals(d)
    rest = [v for v in allvals if "TELLER" not in v and "NEVNER" not in v]
    vals = [v for v in (select_teller_pri(allvals), select_nevner_pri(allvals)) if v] + rest
    aggs = []
    for v in vals:
        dv = col(f"{v}_diff")
        cond = round_half_even(dv, 1) != 0
        aggs.append(F.count_if(cond).alias(f"{v}_ndiff"))
        aggs.append(F.sum(F.when(cond, dv)).alias(f"{v}_sumdiff"))
    if not byyear:
        out = d.agg(*aggs)
        out = out.withColumns({f"{v}_sumdiff": F.coalesce(col(f"{v}_sumdiff"), F.lit(0.0)) for v in vals})
        out = out.select(F.lit("TOTAL").alias("AAR"), *[col(c) for c in out.columns])
    else:
        out = d.groupBy("AAR").agg(*aggs)
        # periods without any difference for a measure get NULL, as a left join would
        out = out.withColumns({
            **{f"{v}_ndiff": F.when(col(f"{v}_ndiff") > 0, col(f"{v}_ndiff")) for v in vals},
            **{f"{v}_sumdiff": F.when(col(f"{v}_ndiff") > 0, col(f"{v}_sumdiff")) for v in vals},
        }).orderBy("AAR")
    return qc_round(out)


def diff_timetrends(cc: DataFrame, passes: int = 2) -> DataFrame:
    """Distribution of the best diff (Absolute) and reldiff (Relative)
    per level, period and kind, for rows uncensored in both cubes.

    Five-number summary (linear-interpolated percentiles, as a box plot
    draws them, to 4 decimals) on a dense (level, period, kind) grid; grid cells without a
    differing value get n = 0 and NULL statistics.
    """
    diffval = select_diffval_pri(cc.columns)
    if diffval is None:
        return None
    relval = diffval.replace("_diff", "_reldiff")
    d = translate_geoniv(cc.where((F.col("newrow") == 0) & (F.col("SPVFLAGG_new") == 0)
                                  & (F.col("SPVFLAGG_old") == 0)))
    long = d.select("GEOniv", "AAR", F.explode(F.array(
        F.struct(F.lit("Absolute").alias("variable"), col(diffval).alias("value")),
        F.struct(F.lit("Relative").alias("variable"), col(relval).alias("value")))).alias("x")) \
        .select("GEOniv", "AAR", "x.variable", "x.value")
    keep = ~(((F.col("variable") == "Absolute") & (F.col("value") == 0))
             | ((F.col("variable") == "Relative") & (F.col("value") == 1)))
    grid = get_all_combinations(long, ["GEOniv", "AAR", "variable"])
    # exact percentiles without a per-group value buffer: a (level, period,
    # kind) group holds all areas of a level, so histograms narrow it first
    stats = order_statistics(long.where(keep), ["GEOniv", "AAR", "variable"], "value",
                             {"q1": 0.25, "median": 0.5, "q3": 0.75},
                             passes)
    cond = (grid["GEOniv"].eqNullSafe(stats["GEOniv"]) & grid["AAR"].eqNullSafe(stats["AAR"])
            & (grid["variable"] == stats["variable"]))
    out = grid.join(stats, cond, "left").select(
        grid["GEOniv"], grid["AAR"], grid["variable"], F.coalesce(stats["n"], F.lit(0)).alias("n"),
        *[round_half_even(stats[c], 4).alias(c) for c in ("min", "q1", "median", "q3", "max")])
    return out

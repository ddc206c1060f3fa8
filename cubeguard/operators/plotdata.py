"""Data behind the reference's plots: A14, A15, A16, W7, K4.

Plots themselves are not drawn; each operator returns the DataFrame a
renderer needs.  Everything is aggregated on Spark; only level counts
(K4) reach the driver.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cubeguard.functions.exprs import round_half_even
from cubeguard.functions.numbering import ordered_numbers
from cubeguard.operators.geo import add_kommune
from cubeguard.operators.levels import district_scope
from cubeguard.spec import (
    DEFAULT_SPEC, CubeSpec, col, identify_coltypes, profile_cube, select_nevner_pri,
    select_outlier_pri, select_teller_pri,
)


def plot_cols(df: DataFrame, change: bool = False, outlierval: str | None = None) -> dict:
    """K4 helper: value, outlier and fence column names (``change_`` prefixed)."""
    v = outlierval or select_outlier_pri(df)
    cols = {"plotvalue": v, "outlier": "OUTLIER", "newoutlier": "NEW_OUTLIER",
            "quantiles": ["wq25", "wq50", "wq75"], "limits": ["LOW", "HIGH"]}
    if change:
        cols = {k: ([f"change_{x}" for x in v_] if isinstance(v_, list) else f"change_{v_}")
                for k, v_ in cols.items()}
    return cols


def boxplot_data(flagged: DataFrame, change: bool = False, outlierval: str | None = None,
                 min_obs: int = 3, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Per stratum (level + dims but area/period): the weighted
    quartiles, N_obs, whisker ends (smallest value >= LOW, largest value
    <= HIGH); strata with N_obs > 2 only."""
    pc = plot_cols(flagged, change, outlierval)
    v = col(pc["plotvalue"])
    d = flagged.where(F.col("GEOniv").isNotNull())
    bycols = ["GEOniv"] + [x for x in identify_coltypes(d, spec=spec).dims_new if x not in (spec.geo, spec.period)]
    low, high = (col(c) for c in pc["limits"])
    out = d.groupBy(*[col(c) for c in bycols + pc["quantiles"]]).agg(
        F.count(v).alias("N_obs"),
        F.min(F.when(v >= low, v)).alias("MINABOVELOW"),
        F.max(F.when(v <= high, v)).alias("MAXBELOWHIGH"))
    return out.where(F.col("N_obs") >= min_obs)


def boxplot_points(flagged: DataFrame, change: bool = False, onlynew: bool = True,
                   outlierval: str | None = None, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """A14 points: outliers (new ones only with ``onlynew``) with label GEO'yy."""
    pc = plot_cols(flagged, change, outlierval)
    flag = pc["newoutlier"] if onlynew and pc["newoutlier"] in flagged.columns else pc["outlier"]
    d = flagged.where(F.col("GEOniv").isNotNull() & (col(flag) == 1))
    bycols = ["GEOniv"] + [x for x in identify_coltypes(d, spec=spec).dims_new if x not in (spec.geo, spec.period)]
    label = F.concat(col(spec.geo).cast("bigint").cast("string"), F.lit("'"),
                     F.regexp_extract(col(spec.period), r"(\d{2})$", 1))
    return d.select(*[col(c) for c in bycols], label.alias("label"), col(pc["plotvalue"]).alias("yval"))


def timeseries_data(flagged: DataFrame, show_n_years: int | None = None, onlynew: bool = True,
                    change: bool = False, show_change_low: float = -10, show_change_high: float = 20,
                    outlierval: str | None = None, panels_per_page: int = 25,
                    spec: CubeSpec = DEFAULT_SPEC, n_periods: int | None = None) -> DataFrame | None:
    """Series (area + dims but period) that contain an outlier, with
    page numbers of ``panels_per_page`` series, over all periods or the last
    ``show_n_years`` (exactly n, T12).

    Page numbers come from row numbers by ranges of the series' keys (area codes of any
    type): places within a partition plus the counts of the partitions before.
    """
    pc = plot_cols(flagged, change, outlierval)
    pv = pc["plotvalue"]
    # the number of periods is known from the comparison's profile; only
    # when it is not given is it measured (one single-row job)
    if (n_periods if n_periods is not None else profile_cube(flagged, [], spec).n_periods) < 2:
        return None
    teller = select_teller_pri(flagged.columns)
    outlierfilter = pc["newoutlier"] if onlynew and pc["newoutlier"] in flagged.columns else pc["outlier"]
    d = flagged.where(F.col("GEOniv").isNotNull() & col(pv).isNotNull())
    d = d.withColumn("AARh", F.regexp_extract(col(spec.period), r"\d{4}_(\d{4})", 1).try_cast("int"))
    if show_n_years is not None:
        last = d.agg(F.max("AARh")).scalar()
        d = d.where(F.col("AARh") > last - F.lit(show_n_years))
    dims = identify_coltypes(flagged, spec=spec).dims_new
    bycols = [spec.geo] + [x for x in dims if x not in (spec.geo, spec.period)]
    v = col(pv)
    strata = d.groupBy(*[col(b) for b in bycols]).agg(
        F.sum(col(outlierfilter)).alias("n_outlier"), F.count(v).alias("n_obs"),
        (F.lit(0.5) * (F.max(v) + F.min(v))).alias("y_middle"),
        F.min(v).alias("__min"), F.max(v).alias("__max"))
    if change:
        strata = strata.where((F.col("__min") < show_change_low) | (F.col("__max") > show_change_high))
    strata = strata.where((F.col("n_outlier") > 0) & (F.col("n_obs") > 0)).drop("__min", "__max")
    strata = ordered_numbers(strata, bycols, "__no")
    strata = strata.withColumn("page", (F.floor(F.col("__no") / panels_per_page) + 1).cast("int")).drop("__no")
    rows = d.select(*[col(b) for b in bycols], "AARh", v.alias("yval"),
                    (round_half_even(col(teller), 0) if teller else F.lit(None).cast("double")).alias("tv"),
                    col(pc["outlier"]).alias("ol"),
                    (col(pc["newoutlier"]) if pc["newoutlier"] in d.columns else F.lit(None)).alias("__new"))
    out = strata.join(rows, bycols, "left")
    label = (F.when(F.col("ol") == 0, "Normal")
             .when((F.col("ol") == 1) & (F.col("__new") == 0), "Previous outlier")
             .when(F.col("ol") == 1, "New outlier"))
    return out.withColumn("ollabel", label).drop("__new")


def bydel_trendlines(flagged: DataFrame, parents: dict, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame | None:
    """Population-weighted mean of the districts vs the municipality
    per city, period and panel; series with a single point are dropped.

    The weighted values are added up as decimals with six places, so the mean
    does not depend on the order of the rows."""
    roles = identify_coltypes(flagged, spec=spec)
    pv = select_outlier_pri(flagged, roles=roles, spec=spec)
    d = district_scope(flagged.where(col(pv).isNotNull()), parents, spec.flag, spec.period)
    d = add_kommune(d, parents, spec.geo)
    bycols = ["KOMMUNE"] + [x for x in roles.dims_new if x != spec.geo]
    panels = [x for x in bycols if x not in ("KOMMUNE", spec.period)]
    exact = lambda x: F.sum(x.cast("decimal(38,6)")).cast("double")
    v, w = col(pv), F.col("WEIGHTS")

    def wmean(level, label):
        part = d.where(F.col("GEOniv") == level)
        return part.groupBy(*[col(b) for b in bycols]).agg(
            F.try_divide(exact(v * w), exact(w)).alias("y")).withColumn("type", F.lit(label))
    bydel = wmean("B", "Vektet bydel")
    kperiods = d.where(F.col("GEOniv") == "B").select(spec.period).distinct()
    kommune = wmean("K", "Kommune").join(kperiods, spec.period, "left_semi")
    trends = kommune.unionByName(bydel)
    n = F.count(F.lit(1)).over(Window.partitionBy("KOMMUNE", "type", *[col(p) for p in panels]))
    return trends.withColumn("N", n).where(F.col("N") > 1)


def country_series(cube: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame | None:
    """Country rows (GEO = 0) per dimension: the other dimensions
    collapsed (A2), measures in long form, NULLs dropped; one block for the
    total and one per dimension (``by_dim``, ``level``).

    All blocks come from ONE scan of the cube.  A row goes to each block for which its
    other dimensions are at their total level; dimensions without a total are then
    collapsed one after the other (in the order of A2, mean of means) for all blocks in
    one aggregate each, in which a block keeps its own dimension's levels.  So a block
    is rolled up from what the dimension before left, never from the cube again.
    """
    d = cube.where(col(spec.geo) == 0)
    roles = identify_coltypes(d, spec=spec)
    plotdims = [x for x in roles.dims_new if x not in (spec.geo, spec.period)]
    profile = profile_cube(d, plotdims, spec)
    if profile.n_periods < 2:
        return None
    plotvals = [v for v in roles.vals_new if v not in ("RATE.n", spec.flag) and not v.startswith("RATE.n") and "TELLER" not in v and "NEVNER" not in v]
    plotvals += [x for x in (select_teller_pri(roles.vals_new), select_nevner_pri(roles.vals_new)) if x]
    at_total = {x: col(x).eqNullSafe(F.lit(t)) for x, t in profile.totals.items() if t is not None}
    blocks = ["Total"] + plotdims
    mine = [F.when(reduce(lambda p, q: p & q, [c for x, c in at_total.items() if x != block], F.lit(True)), F.lit(block)) for block in blocks]
    values = [col(v).cast("double").alias(f"v{i}") for i, v in enumerate(plotvals)]
    rows = d.select(col(spec.period).alias("period"), *[col(x).cast("string").alias(f"d{i}") for i, x in enumerate(plotdims)], *values,
                    F.explode(F.array_compact(F.array(*mine))).alias("by_dim"))
    dims = [f"d{i}" for i in range(len(plotdims))]
    for i, x in enumerate(plotdims):
        if x in at_total:
            continue
        own = F.col("by_dim") == x
        rows = rows.withColumn(dims[i], F.when(own, F.col(dims[i])).otherwise(F.lit("Total")))
        aggs = []
        for k, v in enumerate(plotvals):
            total = F.sum(f"v{k}")
            aggs.append((F.when(own, total).otherwise(F.coalesce(total, F.lit(0.0))) if "TELLER" in v else F.avg(f"v{k}")).alias(f"v{k}"))
        rows = rows.groupBy("by_dim", "period", *dims).agg(*aggs)
    level = F.lit("total")
    for i, x in enumerate(plotdims):
        level = F.when(F.col("by_dim") == x, F.col(dims[i])).otherwise(level)
    long = F.explode(F.array(*[F.struct(F.lit(v).alias("PARAMETER"), F.col(f"v{k}").alias("yvalue")) for k, v in enumerate(plotvals)]))
    out = (rows.select("by_dim", level.alias("level"), F.col("period").alias(spec.period), long.alias("x"))
           .select("by_dim", "level", spec.period, "x.PARAMETER", "x.yvalue").where(F.col("yvalue").isNotNull()))
    return out.withColumn("AARx", F.regexp_extract(col(spec.period), r"^(\d+)_", 1).try_cast("int"))


def get_plot_subset(df: DataFrame, by, maxpanels: int = 25) -> list:
    """K4: smallest set of dimensions to split plot files by, so that each
    file has at most ``maxpanels`` panels and as many as possible.

    Panels are counted from the strata that exist, not from products of level
    counts: one cube aggregate over the distinct strata gives every subset's fullest
    file.  The choice among the 2^dims subsets happens on the driver.
    """
    by = list(by)
    if not by:
        return []
    names = [f"__d{i}" for i in range(len(by))]
    strata = df.select(*[col(b).alias(n) for b, n in zip(by, names, strict=True)]).distinct()
    files = strata.cube(*names).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("__g"))
    fullest = {r["__g"]: r["n"] for r in files.groupBy("__g").agg(F.max("n").alias("n")).collect()}
    everything = (1 << len(by)) - 1  # a bit for each dimension that files are not split by, the first one highest
    if fullest.get(everything, 0) <= maxpanels:
        return []
    best, best_panels = None, -1
    for k in range(1, len(by) + 1):
        for comb in combinations(range(len(by)), k):
            panels = fullest[everything - sum(1 << (len(by) - 1 - i) for i in comb)]
            if panels <= maxpanels and panels > best_panels:
                best, best_panels = [by[i] for i in comb], panels
    return best or []


def plot_files(df: DataFrame, by, maxpanels: int = 25) -> DataFrame:
    """K4: one row per plot file: the file suffix (the split dimensions'
    levels joined by ',', or 'alle'), the number of panels, and the predicate that
    selects the file's rows (``KJONN=='1' & ALDER=='0_17'``, or ``TRUE``), in the words of
    the stored filters, so :func:`~cubeguard.operators.extracts.etab_predicate` reads it.
    The predicates of all files cover each row once, NULL levels included.
    """
    filedims = get_plot_subset(df, by, maxpanels)
    panels = [b for b in by if b not in filedims]
    cnt = (F.count_distinct(F.struct(*[col(p) for p in panels])) if panels else F.lit(1)).cast("bigint").alias("n_panels")
    if not filedims:
        return df.agg(cnt).select(F.lit("alle").alias("suffix"), "n_panels", F.lit("TRUE").alias("predicate"))
    out = df.groupBy(*[col(f) for f in filedims]).agg(cnt)
    suffix = F.concat_ws(",", *[F.coalesce(col(f).cast("string"), F.lit("NA")) for f in filedims])

    def one(f):
        text = col(f).cast("string")
        mark = F.when(text.contains("'"), F.lit('"')).otherwise(F.lit("'"))
        return F.coalesce(F.concat(F.lit(f + "=="), mark, text, mark), F.lit(f"is.na({f})"))
    return out.select(suffix.alias("suffix"), "n_panels", F.concat_ws(" & ", *[one(f) for f in filedims]).alias("predicate"))

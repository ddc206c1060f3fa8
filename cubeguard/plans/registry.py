"""Registered queries: one per operator of the inventory, on the fixtures.

Every query reads the driver tables (through the fixture cubes derived
from them) and returns a lazy DataFrame.  Keys carry the inventory IDs.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from cubeguard.operators import diffs
from cubeguard.plans.comparison import make_comparecube
from cubeguard.sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _compare_lazy(spark: SparkSession, sf_dir: str):
    """The comparison pipeline as one lazy plan (the pipeline queries).

    Built anew for each query, its profile job included, so that no finished
    shuffle of an earlier run is reused.
    """
    new, old, thr = fx.fixture_pair(spark, sf_dir)
    return make_comparecube(new, old, small_threshold=thr)


def _compare(spark: SparkSession, sf_dir: str):
    """The comparison as the checks see it after reading the files: run once
    per session and input folder, written as a table, then shared."""
    key = fx._memo_key(spark, sf_dir, "compare")
    if key not in fx._MEMO:
        new, old, thr = fx.fixture_pair(spark, sf_dir)
        fx._MEMO[key] = make_comparecube(new, old, small_threshold=thr, materialize=True)
    return fx._MEMO[key]


@register("c1_comparecube")
def q_c1_comparecube(spark, sf_dir):
    return _compare_lazy(spark, sf_dir).comparecube


@register("a9_summary")
def q_a9_summary(spark, sf_dir):
    return diffs.comparecube_summary(_compare(spark, sf_dir).comparecube)


# ----------------------------------------------------------------- helpers

from pyspark.sql import functions as F  # noqa: E402

from cubeguard.operators import checks, geo, levels  # noqa: E402
from cubeguard.operators.aggregate import aggregate_cube, aggregate_cube_multi  # noqa: E402
from cubeguard.functions.exprs import round_half_even  # noqa: E402
from cubeguard.session import case_sensitive  # noqa: E402

NEW_DIMS = ["GEO", "AAR", "KJONN", "ALDER", "INNVKAT"]
OLD_DIMS = ["GEO", "AAR", "KJONN", "ALDER", "UTDANN"]
COMMON = ["GEO", "AAR", "KJONN", "ALDER", "INNVKAT", "UTDANN"]


def _pair(spark, sf_dir):
    return fx.fixture_pair(spark, sf_dir)


def _new(spark, sf_dir):
    """Single-cube checks only need the new cube."""
    return fx.fixture_new(spark, sf_dir), fx.small_area_threshold(spark, sf_dir)


def _r6(df, cols):
    return df.withColumns({c: round_half_even(F.col(f"`{c}`"), 6) for c in cols})


# ----------------------------------------------------------------- P / G / F

@register("p2_compare_columns")
def q_p2(spark, sf_dir):
    new, old, _ = _pair(spark, sf_dir)
    return levels.compare_colnames(new, old)


@register("p3_compare_dimensions")
def q_p3(spark, sf_dir):
    new, old, _ = _pair(spark, sf_dir)
    return levels.compare_dimensions(new, old)


@register("p3_level_changes")
def q_p3_long(spark, sf_dir):
    new, old, _ = _pair(spark, sf_dir)
    return levels.level_changes(new, old)


@register("g1_recode_geo")
def q_g1(spark, sf_dir):
    _, old, _ = _pair(spark, sf_dir)
    return old


@register("g1_recode_report")
def q_g1_report(spark, sf_dir):
    return geo.recode_report(fx.old_cube_raw(spark, sf_dir, fx.fixture_cells(spark, sf_dir)),
                             fx.georecode(spark, sf_dir))


@register("g2_geo_params")
def q_g2(spark, sf_dir):
    new, _ = _new(spark, sf_dir)
    return new


@register("g3_split_small")
def q_g3(spark, sf_dir):
    new, thr = _new(spark, sf_dir)
    return geo.split_kommuneniv(new, thr).select(*NEW_DIMS, "GEOniv", "WEIGHTS")


@register("g4_labels")
def q_g4(spark, sf_dir):
    new, thr = _new(spark, sf_dir)
    d = geo.translate_geoniv(geo.split_kommuneniv(new, thr))
    return d.groupBy("GEOniv").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("GEO").alias("n_codes"))


@register("g5_parent")
def q_g5(spark, sf_dir):
    new, _ = _new(spark, sf_dir)
    return (geo.add_kommune(new, fx.CITY_PARENTS).where(F.col("KOMMUNE").isNotNull())
            .select(*NEW_DIMS, "GEOniv", "KOMMUNE"))


@register("f1_common_levels")
def q_f1(spark, sf_dir):
    new, old, _ = _pair(spark, sf_dir)
    return levels.filter_cube(new, old, "new")


@register("f1_common_levels_old")
def q_f1_old(spark, sf_dir):
    new, old, _ = _pair(spark, sf_dir)
    return levels.filter_cube(new, old, "old")


@register("f2_complete_strata")
def q_f2(spark, sf_dir):
    new, _ = _new(spark, sf_dir)
    return levels.get_complete_strata(new, NEW_DIMS, "censored")


@register("f2_complete_strata_missing")
def q_f2_missing(spark, sf_dir):
    new, _ = _new(spark, sf_dir)
    new = new.where(F.col("GEOniv").isin("L", "F"))
    return levels.get_complete_strata(new, ["GEO", "AAR", "ALDER"], "missing", "RATE")


@register("f2_complete_strata_missing_all")
def q_f2_missing_all(spark, sf_dir):
    """F2 'missing' on the strata of all dimensions (a non-empty result)."""
    new, _ = _new(spark, sf_dir)
    return levels.get_complete_strata(new, NEW_DIMS, "missing", "RATE")


@register("f3_flag_new")
def q_f3_new(spark, sf_dir):
    new, old, _ = _pair(spark, sf_dir)
    return levels.flag_rows(new, old, "newrow").select(*NEW_DIMS, "newrow")


@register("f3_flag_expired")
def q_f3_exp(spark, sf_dir):
    new, old, _ = _pair(spark, sf_dir)
    return levels.flag_rows(new, old, "exprow").select(*OLD_DIMS, "exprow")


# ----------------------------------------------------------------- A1 / A2

@register("a1_collapse_total")
def q_a1_total(spark, sf_dir):
    new, _ = _new(spark, sf_dir)
    return aggregate_cube(new, "KJONN")


@register("a1_collapse_mean")
def q_a1_mean(spark, sf_dir):
    new, _ = _new(spark, sf_dir)
    # a mean of doubles depends on the summation order in its last bits; the
    # six places of RATE over at most twelve values have no tie at nine
    out = aggregate_cube(new.where(F.col("ALDER") != "1_7"), "ALDER")
    return _r6(out, ["NEVNER", "RATE.n"]).withColumn("RATE", round_half_even(F.col("RATE"), 9))


@register("a2_collapse_multi")
def q_a2(spark, sf_dir):
    new, _ = _new(spark, sf_dir)
    d = new.where((F.col("ALDER") != "1_7") & (F.col("INNVKAT") != 0))
    out = aggregate_cube_multi(d, ["ALDER", "INNVKAT"])  # see a1_collapse_mean
    return _r6(out, ["NEVNER", "RATE.n"]).withColumn("RATE", round_half_even(F.col("RATE"), 9))


# ----------------------------------------------------------------- C / W

@register("c4_any_diffs")
def q_c4(spark, sf_dir):
    cc = _compare(spark, sf_dir).comparecube
    return cc.groupBy("GEOniv").agg(F.count_if(F.col("any_diffs") == 1).alias("n_any_diffs"),
                                    F.count(F.lit(1)).alias("n_rows"))


@register("w1_change")
def q_w1(spark, sf_dir):
    nf = _compare_lazy(spark, sf_dir).newcube_flag
    return nf.select(*COMMON, "RATE", "change_RATE")


_FENCES = ["MIN", "wq25", "wq50", "wq75", "MAX", "LOW", "HIGH"]
_STRATA = ["GEOniv", "KJONN", "ALDER", "INNVKAT", "UTDANN"]


@register("w2_weighted_fences")
def q_w2(spark, sf_dir):
    nf = _compare_lazy(spark, sf_dir).newcube_flag
    return nf.select(*_STRATA, *_FENCES).distinct()


@register("w2_change_fences")
def q_w2_change(spark, sf_dir):
    nf = _compare_lazy(spark, sf_dir).newcube_flag
    return nf.select(*_STRATA, *["change_" + c for c in _FENCES]).distinct()


@register("w3_flag_outliers_old")
def q_w3_old(spark, sf_dir):
    of = _compare_lazy(spark, sf_dir).oldcube_flag
    return of.select(*COMMON, "GEOniv", "exprow", "OUTLIER", "change_OUTLIER")


@register("w4_new_outlier")
def q_w4(spark, sf_dir):
    nf = _compare_lazy(spark, sf_dir).newcube_flag
    return nf.select(*COMMON, "newrow", "OUTLIER", "PREV_OUTLIER", "NEW_OUTLIER",
                     "change_OUTLIER", "change_PREV_OUTLIER", "change_NEW_OUTLIER")


# ----------------------------------------------------------------- A3 - A8, A10, A11, A13, A17

@register("a3_censoring")
def q_a3(spark, sf_dir):
    new, old, _ = _pair(spark, sf_dir)
    return checks.compare_censoring(new, old)


@register("a3_censoring_by_sex")
def q_a3_by(spark, sf_dir):
    new, old, _ = _pair(spark, sf_dir)
    return checks.compare_censoring(new, old, by=["KJONN"])


@register("a4_censoring_series")
def q_a4(spark, sf_dir):
    new, old, _ = _pair(spark, sf_dir)
    return checks.compare_censoring_timeseries(new, old)


@register("a4_censoring_series_new")
def q_a4_new(spark, sf_dir):
    new, _ = _new(spark, sf_dir)
    return checks.compare_censoring_timeseries(new)


@register("a5_coverage_geolevel")
def q_a5(spark, sf_dir):
    new, thr = _new(spark, sf_dir)
    return checks.check_coverage_geolevel(new, thr)


@register("a6_coverage_geocode")
def q_a6(spark, sf_dir):
    new, _ = _new(spark, sf_dir)
    return checks.check_coverage_geocode(new)


def _a7(kind):
    def q_a7(spark, sf_dir):
        new, _ = _new(spark, sf_dir)
        if kind == "BK":  # KOMMUNE and Kommune differ only in case
            new = case_sensitive(checks.geolevel_rows(new, kind, fx.CITY_PARENTS), "districts")
        return checks.compare_geolevels(new, kind, fx.CITY_PARENTS, fx.OO_PAIR)
    return q_a7


for _k in ("FL", "FK", "BK", "OO"):
    register(f"a7_geolevel_{_k.lower()}")(_a7(_k))


@register("a8_unknown_district")
def q_a8(spark, sf_dir):
    new, _ = _new(spark, sf_dir)
    return checks.unknown_bydel(new, fx.CITY_PARENTS, "missing")


@register("a8_unknown_district_censored")
def q_a8_c(spark, sf_dir):
    new, _ = _new(spark, sf_dir)
    return checks.unknown_bydel(new, fx.CITY_PARENTS, "censored")


@register("w8_topn")
def q_w8(spark, sf_dir):
    new, _ = _new(spark, sf_dir)
    out = checks.unknown_bydel(new, fx.CITY_PARENTS, "missing")
    return checks.top_n_per_group(out, ["KOMMUNE", "TARGET"], F.col("UNKNOWN_pct").desc_nulls_last(), 50,
                                  tie_break=["AAR", "KJONN", "ALDER", "INNVKAT"])


@register("a10_diffvals")
def q_a10(spark, sf_dir):
    return diffs.diffvals_summary(_compare(spark, sf_dir).comparecube)


@register("a10_diffvals_by_year")
def q_a10_year(spark, sf_dir):
    return diffs.diffvals_summary(_compare(spark, sf_dir).comparecube, byyear=True)


@register("a11_uncensored_small")
def q_a11(spark, sf_dir):
    new, _ = _new(spark, sf_dir)
    return checks.check_censoring(new, fx.control_kuber(spark), fx.CUBE_NAME)


@register("a13_suppression_attack")
def q_a13(spark, sf_dir):
    new, _ = _new(spark, sf_dir)
    cube = fx.with_suppression_bookkeeping(new, fx.partitions_for(spark, sf_dir))
    return checks.attack_naboprikk(cube, checks.find_specs(fx.spec_table(spark), cube=new))


@register("g7_area_sets")
def q_g7(spark, sf_dir):
    new, _ = _new(spark, sf_dir)
    return geo.add_geotriangles(geo.area_sets(new), new.select("GEOniv")).select("pair", "set_label")


@register("g7_area_parents")
def q_g7_parents(spark, sf_dir):
    """All links of the hierarchy, the areas of the lowest level under their municipality."""
    new, _ = _new(spark, sf_dir)
    return geo.area_parents(new, ("LF", "FK", "KB", "BV", "KV"))


@register("a17_diff_trend")
def q_a17(spark, sf_dir):
    return diffs.diff_timetrends(_compare(spark, sf_dir).comparecube)


@register("w5_denominator_change")
def q_w5(spark, sf_dir):
    new, _ = _new(spark, sf_dir)
    return checks.check_nevner_change(new)


@register("w6_growth")
def q_w6(spark, sf_dir):
    new, old, _ = _pair(spark, sf_dir)
    _, befolk = fx.population_cubes(new, old)
    return checks.calculate_befvekst_for_befolk(befolk, ["GEO", "AAR", "KJONN", "ALDER"])


@register("c5_growth_reconcile")
def q_c5(spark, sf_dir):
    new, old, _ = _pair(spark, sf_dir)
    befvekst, befolk = fx.population_cubes(new, old)
    return checks.check_befvekst(befvekst, befolk)


# ----------------------------------------------------------------- plot data

from cubeguard.operators import barometer as baro, plotdata  # noqa: E402

_PANELS = ["KJONN", "ALDER", "INNVKAT", "UTDANN"]


@register("a14_boxplot")
def q_a14(spark, sf_dir):
    return plotdata.boxplot_data(_compare(spark, sf_dir).newcube_flag)


@register("a14_boxplot_change")
def q_a14_change(spark, sf_dir):
    return plotdata.boxplot_data(_compare(spark, sf_dir).newcube_flag, change=True)


@register("a14_boxplot_points")
def q_a14_points(spark, sf_dir):
    return plotdata.boxplot_points(_compare(spark, sf_dir).newcube_flag)


@register("w7_series")
def q_w7(spark, sf_dir):
    res = _compare(spark, sf_dir)
    return plotdata.timeseries_data(res.newcube_flag, n_periods=res.n_periods_new)


@register("w7_series_change")
def q_w7_change(spark, sf_dir):
    res = _compare(spark, sf_dir)
    return plotdata.timeseries_data(res.newcube_flag, change=True, n_periods=res.n_periods_new)


@register("a15_trend")
def q_a15(spark, sf_dir):
    # y is a weighted mean of doubles: its last bits depend on the summation order
    out = plotdata.bydel_trendlines(_compare(spark, sf_dir).newcube_flag, fx.CITY_PARENTS)
    return out.withColumn("y", round_half_even(F.col("y"), 6))


@register("a16_country")
def q_a16(spark, sf_dir):
    new, _ = _new(spark, sf_dir)
    return plotdata.country_series(new)


@register("a16_country_means")
def q_a16_means(spark, sf_dir):
    """A16 on a cube without total levels of age and supplier group: means of means."""
    new, _ = _new(spark, sf_dir)
    out = plotdata.country_series(new.where((F.col("ALDER") != fx.AGE_TOTAL) & (F.col("INNVKAT") != 0)))
    # a mean of doubles depends on the summation order in its last bits
    return out.withColumn("yvalue", round_half_even(F.col("yvalue"), 6))


@register("k4_plot_files")
def q_k4(spark, sf_dir):
    bp = plotdata.boxplot_data(_compare(spark, sf_dir).newcube_flag, min_obs=0)
    return plotdata.plot_files(bp, _PANELS, maxpanels=25)


# ----------------------------------------------------------------- barometer

@register("c6_barometer")
def q_c6(spark, sf_dir):
    new, _ = _new(spark, sf_dir)
    bar, ind = fx.barometer_tables(new)
    return baro.check_barometer(bar, ind, "kommune")


@register("c6_barometer_fylke")
def q_c6_f(spark, sf_dir):
    new, _ = _new(spark, sf_dir)
    bar, ind = fx.barometer_tables(new, with_lpnr=True)
    return baro.check_barometer(bar, ind, "fylke")


@register("c6_barometer_missing")
def q_c6_missing(spark, sf_dir):
    new, _ = _new(spark, sf_dir)
    bar, ind = fx.barometer_tables(new, with_lpnr=True, drop_lpnr=1)
    return baro.barometer_missing_indicators(bar, ind)


# ----------------------------------------------------------------- extracts

from cubeguard.operators import extracts as ext  # noqa: E402

_CUBE_FILE = f"{fx.CUBE_NAME}_{fx.NEW_DATETAG}.parquet"


def _extract_inputs(spark, sf_dir):
    new, _ = _new(spark, sf_dir)
    return new, fx.fixture_extracts(spark, sf_dir)


@register("c7_extract_report")
def q_c7(spark, sf_dir):
    cube, e = _extract_inputs(spark, sf_dir)
    return ext.check_friskvik(e, cube, _CUBE_FILE, fx.control_friskvik(spark), fx.cube_spec_rows(spark),
                              fx.published_files(spark), fx.PROFILE, fx.GEOLEVEL, 2025)


_EXT_DIMS = ["GEO", "AAR", "KJONN", "ALDER"]


@register("f4_cube_to_extract")
def q_f4(spark, sf_dir):
    cube, e = _extract_inputs(spark, sf_dir)
    return ext.filter_cube_to_extracts(cube, e)


@register("c8_last_year")
def q_c8(spark, sf_dir):
    cube, e = _extract_inputs(spark, sf_dir)
    return ext.last_year_check(e, ext.filter_cube_to_extracts(cube, e))


@register("c9_mask_match")
def q_c9(spark, sf_dir):
    cube, e = _extract_inputs(spark, sf_dir)
    return ext.compare_censoring_mask(e, ext.filter_cube_to_extracts(cube, e), _EXT_DIMS)


@register("c9_mask_areas")
def q_c9_areas(spark, sf_dir):
    cube, e = _extract_inputs(spark, sf_dir)
    return ext.mask_areas(e, ext.filter_cube_to_extracts(cube, e), _EXT_DIMS)


@register("c10_measure_match")
def q_c10(spark, sf_dir):
    cube, e = _extract_inputs(spark, sf_dir)
    return ext.compare_values(e, ext.filter_cube_to_extracts(cube, e), _EXT_DIMS,
                              ["TELLER", "NEVNER", "RATE", "TELLER_uprikk"])


def _repeated_keys(spark, sf_dir):
    """Extracts and cube without INNVKAT: a key is held once for each of its levels; one value is changed."""
    cube, e = _extract_inputs(spark, sf_dir)
    top = e.agg(F.max("GEO")).scalar()
    total = e.where(F.col("Friskvik").startswith("RETURNS_TOTAL"))
    one = cube.where((F.col("GEOniv") == "K") & (F.col("KJONN") == 0) & (F.col("ALDER") == "1_7"))
    years = total.select("AAR").distinct()
    base = one.join(years, "AAR", "left_semi").select("GEO", "AAR", "KJONN", "ALDER", F.col("RATE").alias("MEIS"))
    changed = F.when((F.col("GEO") == top) & (F.col("MEIS") > 0), F.col("MEIS") + 1).otherwise(F.col("MEIS"))
    rows = base.select(F.lit("ALL.csv").alias("Friskvik"), "*").unionByName(
        base.withColumn("MEIS", changed).select(F.lit("CHANGED.csv").alias("Friskvik"), "*")).unionByName(
        base.groupBy("GEO", "AAR", "KJONN", "ALDER").agg(F.max("MEIS").alias("MEIS")).select(F.lit("ONCE.csv").alias("Friskvik"), "*"))
    cube = cube.drop("INNVKAT")
    return rows, ext.filter_cube_to_extracts(cube, rows)


@register("c10_repeated_keys")
def q_c10_repeated(spark, sf_dir):
    """Keys held several times on both sides pair as multisets."""
    e, cf = _repeated_keys(spark, sf_dir)
    return ext.compare_values(e, cf, _EXT_DIMS, ["TELLER", "NEVNER", "RATE"])


@register("c9_repeated_keys")
def q_c9_repeated(spark, sf_dir):
    e, cf = _repeated_keys(spark, sf_dir)
    return ext.mask_areas(e, cf, _EXT_DIMS)


@register("c11_extract_files")
def q_c11(spark, sf_dir):
    """C11: extract files of two cubes with different columns (parquet and CSV), one of them without a cube, in one plan."""
    from cubeguard.operators.extract_files import check_extract_files
    cube, e = _extract_inputs(spark, sf_dir)
    root = _scratch(spark)
    csv = {"sep": ";", "header": "true"}
    for name in [fx.extract_name(i) for i in fx.INDICATORS]:
        e.where(F.col("Friskvik") == name).drop("Friskvik").coalesce(1).write.options(**csv).csv(f"{root}/ext/{name}")
    band = cube.where((F.col("GEOniv") == "K") & (F.col("KJONN") == 2) & (F.col("ALDER") == "1_2") & (F.col("INNVKAT") == 0))
    band.select("ALDER", "GEO", "AAR", F.col("RATE").alias("MEIS"), "KJONN").coalesce(1).write.options(**csv).csv(f"{root}/ext/RETURNS_BAND_{fx.OLD_DATETAG}.csv")
    cube.write.parquet(f"{root}/parquet/{_CUBE_FILE}")
    total = cube.where(F.col("INNVKAT") == 0).drop("INNVKAT", "GEOniv", "WEIGHTS").withColumnRenamed("TELLER", "antall")
    total.write.options(**csv).csv(f"{root}/csv/{fx.SECOND_CUBE}_{fx.OLD_DATETAG}.csv")
    fx.cube_spec_rows(spark).coalesce(1).write.options(**csv).csv(f"{root}/specs/{fx.CUBE_NAME}_{fx.NEW_DATETAG}.csv")
    paths = cubes.list_files(spark, f"{root}/ext")
    return check_extract_files(spark, paths, [f"{root}/parquet", f"{root}/csv"], f"{root}/specs", fx.control_two_cubes(spark), fx.published_files(spark),
                               fx.PROFILE, fx.GEOLEVEL, 2025)


@register("a12_unique_levels")
def q_a12(spark, sf_dir):
    cube, e = _extract_inputs(spark, sf_dir)
    cf = ext.filter_cube_to_extracts(cube, e)
    return ext.unique_levels(cf, "ALDER").join(ext.unique_levels(cf, "KJONN"), "Friskvik")


# ----------------------------------------------------------------- sources / lookups / P10 / P11

from cubeguard.functions.exprs import qc_round  # noqa: E402
from cubeguard.session import ensure_checkpoint_dir  # noqa: E402
from cubeguard.sources import cubes, lookups, sinks  # noqa: E402
from cubeguard.spec import RENAME  # noqa: E402
import uuid  # noqa: E402


def _scratch(spark):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/cubeguard/files-{uuid.uuid4().hex}"


def _write_raw_cube(spark, sf_dir, root, fmt, old=False, prefix=""):
    """Write a raw cube as a cube file, with the source column names the
    rename map turns back into the standard ones."""
    build, tag = (fx.old_cube_raw, fx.OLD_DATETAG) if old else (fx.new_cube_raw, fx.NEW_DATETAG)
    raw = build(spark, sf_dir, fx.fixture_cells(spark, sf_dir))
    inverse = {new: old for old, new in RENAME.items() if new in ("TELLER", "RATE")}
    raw = raw.withColumnsRenamed(inverse)
    path = f"{root}/QC/{prefix}{fx.CUBE_NAME}_{tag}.{fmt}"
    if fmt == "csv":
        raw.write.option("sep", ";").option("header", True).csv(path)
    else:
        raw.write.parquet(path)
    return path


@register("s6_read_csv")
def q_s6(spark, sf_dir):
    root = _scratch(spark)
    path = _write_raw_cube(spark, sf_dir, root, "csv")
    df, _ = cubes.read_cube(spark, path, "New")
    return df


@register("s3_find_read")
def q_s3(spark, sf_dir):
    root = _scratch(spark)
    _write_raw_cube(spark, sf_dir, root, "csv")
    _write_raw_cube(spark, sf_dir, root, "parquet")
    path = cubes.find_cube(spark, f"{fx.CUBE_NAME}_{fx.NEW_DATETAG}", root)  # parquet wins
    df, _ = cubes.read_cube(spark, path, "New")
    return df


@register("l1_codemap")
def q_l1(spark, sf_dir):
    k, f = fx.code_tables(spark, sf_dir)
    return lookups.update_georecode(k, f)


@register("l2_popinfo")
def q_l2(spark, sf_dir):
    new, _ = _new(spark, sf_dir)
    pop = new.withColumn("TELLER", F.col("TELLER_uprikk"))
    return lookups.update_popinfo(pop, total_age="1_7", total_sex=0, extra_filter=F.col("INNVKAT") == 0)


@register("l3_dimlist")
def q_l3(spark, sf_dir):
    return lookups.update_dimlist(fx.file_groups(spark, sf_dir), at="2025-01-01 00:00:00")


@register("l4_validgeo")
def q_l4(spark, sf_dir):
    return lookups.update_validgeo(fx.geo_register(spark, sf_dir), "2025")


@register("p10_round")
def q_p10(spark, sf_dir):
    return qc_round(_compare(spark, sf_dir).comparecube)


@register("p11_grid")
def q_p11(spark, sf_dir):
    new, _ = _new(spark, sf_dir)
    return levels.get_all_combinations(new, ["GEOniv", "AAR", "KJONN"])


@register("w2_weighted_fences_range")
def q_w2_range(spark, sf_dir):
    """W2 with every stratum cut into value ranges, as a hot one would be."""
    new, old, thr = _pair(spark, sf_dir)
    nf = make_comparecube(new, old, small_threshold=thr, rows_per_range=200).newcube_flag
    return nf.select(*_STRATA, *_FENCES, *["change_" + c for c in _FENCES]).distinct()


def _read_and_compare(spark, sf_dir, dump_dir=None, **switches):
    from cubeguard.plans.comparison import read_and_compare
    root = _scratch(spark)
    _write_raw_cube(spark, sf_dir, root, "parquet")
    _write_raw_cube(spark, sf_dir, root, "parquet", old=True)
    return read_and_compare(spark, f"{fx.CUBE_NAME}_{fx.NEW_DATETAG}", root, f"{fx.CUBE_NAME}_{fx.OLD_DATETAG}",
                            dump_dir, recode_old=True, codemap=fx.georecode(spark, sf_dir),
                            popinfo=fx.popinfo(spark, sf_dir), small_threshold=fx.small_area_threshold(spark, sf_dir), **switches)


@register("s1_load_pair")
def q_s1(spark, sf_dir):
    """From cube files to the comparison cube."""
    return _read_and_compare(spark, sf_dir)[0].comparecube


@register("s1_load_only")
def q_s1_load_only(spark, sf_dir):
    """S1 without the comparison: the old cube as read and recoded."""
    return _read_and_compare(spark, sf_dir, comparecube=False)[0].oldcube_flag


@register("k2_dump")
def q_k2(spark, sf_dir):
    """K2: the comparison cube as dumped, read back."""
    _, written = _read_and_compare(spark, sf_dir, _scratch(spark))
    path = next(p for name, p in written.items() if name.startswith("compare_"))
    return spark.read.parquet(path)


@register("k1_check_table")
def q_k1(spark, sf_dir):
    """K1: a check table as saved, read back."""
    new, thr = _new(spark, sf_dir)
    check, out = checks.check_coverage_geolevel(new, thr), _scratch(spark)
    sinks.save_table(check, out, fx.CUBE_NAME, "coverage", fx.NEW_DATETAG)
    return sinks.read_table(spark, out, fx.CUBE_NAME, "coverage", fx.NEW_DATETAG, check.schema)


@register("k3_extract_report")
def q_k3(spark, sf_dir):
    """K3: the extract report as saved, read back."""
    out = _scratch(spark)
    sinks.save_table(q_c7(spark, sf_dir), out, fx.CUBE_NAME, "extracts", fx.NEW_DATETAG)
    return sinks.read_table(spark, out, fx.CUBE_NAME, "extracts", fx.NEW_DATETAG)


def _read_named(spark, sf_dir, prefix=""):
    """The new cube written under a file name with ``prefix`` and read again."""
    path = _write_raw_cube(spark, sf_dir, _scratch(spark), "parquet", prefix=prefix)
    return cubes.read_cube(spark, path, "New")


@register("s7_renamed_columns")
def q_s7(spark, sf_dir):
    return cubes.renamed_columns_report(*_read_named(spark, sf_dir))


@register("s8_forbidden_columns")
def q_s8(spark, sf_dir):
    return cubes.forbidden_outcols(*_read_named(spark, sf_dir, "ikkegeoprikket_"))


@register("p9_convert_types")
def q_p9(spark, sf_dir):
    """Text, whole and decimal numbers; text that is no number becomes NULL."""
    new, _ = _new(spark, sf_dir)
    d = new.select(*NEW_DIMS, F.col("AAR").alias("period"), F.col("GEO").cast("string").alias("code"), F.col("KJONN").alias("sex"),
                   F.col("TELLER").alias("count"), F.col("GEOniv"))
    d = cubes.convert_coltype(cubes.convert_coltype(d, ["code", "count", "period"], "integer"), ["sex"], "numeric")
    return cubes.convert_coltype(d, ["GEO"], "factor")


@register("l5_refresh")
def q_l5(spark, sf_dir):
    """The three lookups refreshed, written and read back as (lookup, code)."""
    out = _scratch(spark)
    names = lookups.update_internal_data(q_l4(spark, sf_dir), q_l2(spark, sf_dir), q_l1(spark, sf_dir), out)
    codes = {"validgeo": "GEO", "popinfo": "GEO", "georecode": "old"}
    parts = [spark.read.parquet(f"{out}/{n}").select(F.lit(n).alias("lookup"), F.col(codes[n]).cast("bigint").alias("code")) for n in sorted(names)]
    return reduce(DataFrame.unionByName, parts)


def _repeated(spark, sf_dir):
    """Both cubes without their extra dimension: the key they share is held several times."""
    new, old, _ = _pair(spark, sf_dir)
    return make_comparecube(new.drop("INNVKAT"), old.drop("UTDANN", "origgeo"), outliers=False)


@register("c1_first_match")
def q_c1_first_match(spark, sf_dir):
    """One row for each key, the first one of either cube."""
    return _repeated(spark, sf_dir).comparecube


@register("c1_dropped_rows")
def q_c1_dropped(spark, sf_dir):
    """What the first match left out."""
    return _repeated(spark, sf_dir).dropped


@register("c1_duplicate_keys")
def q_c1_duplicate_keys(spark, sf_dir):
    """T15 on the key that both cubes share: it is unique only once INNVKAT is collapsed."""
    new, _ = _new(spark, sf_dir)
    return levels.duplicate_keys(new, ["GEO", "AAR", "KJONN", "ALDER"])

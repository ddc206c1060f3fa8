"""Levels, strata, flags and collapsing."""

import pytest
from pyspark.sql import functions as F

from cubeguard.operators.aggregate import aggregate_cube, aggregate_cube_multi
from cubeguard.functions.numbering import ordered_numbers
from cubeguard.operators.levels import (
    compare_colnames, compare_dimensions, flag_rows, get_all_combinations, get_complete_strata,
)
from cubeguard.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def test_aggregate_cube(spark):
    c = fx.fixture_new(spark, SF)
    with pytest.raises(ValueError, match="cannot aggregate on 'AAR'"):
        aggregate_cube(c, "AAR")
    kept = aggregate_cube(c, "KJONN")  # the total 0 exists: its rows are kept
    assert kept.exceptAll(c.where("KJONN = 0")).count() == 0 and kept.count() == c.where("KJONN = 0").count()
    bands = c.where("ALDER <> '1_7'")
    t = aggregate_cube(bands, "ALDER")
    assert {r.ALDER for r in t.select("ALDER").distinct().collect()} == {"Total"}
    assert t.agg(F.sum("TELLER_uprikk")).first()[0] == bands.agg(F.sum("TELLER_uprikk")).first()[0]
    two = aggregate_cube_multi(bands.where("INNVKAT <> 0"), ["ALDER", "INNVKAT"])
    assert two.select("ALDER", "INNVKAT").distinct().count() == 1


def test_aggregate_sum_and_mean(spark):
    rows = [(1, "2020_2020", "a", 2.0, None, 0), (1, "2020_2020", "b", 4.0, 3.0, 1), (2, "2020_2020", "a", None, None, 0)]
    df = spark.createDataFrame(rows, "GEO bigint, AAR string, ALDER string, TELLER double, RATE double, SPVFLAGG bigint")
    out = {r.GEO: r for r in aggregate_cube(df, "ALDER").collect()}
    assert out[1].TELLER == 6.0 and out[1].RATE == 3.0 and out[1].ALDER == "Total" and out[1].SPVFLAGG == 0
    assert out[2].TELLER == 0.0 and out[2].RATE is None      # all-NULL sum 0, mean NULL


def test_complete_strata(spark):
    c = fx.fixture_new(spark, SF)
    by = ["AAR", "KJONN", "ALDER", "INNVKAT"]
    for kind, value, bad in (("censored", None, F.col("SPVFLAGG") != 0), ("missing", "RATE", F.col("RATE").isNull())):
        gone = c.where(bad).select(*by).distinct()
        want = c.join(gone, by, "left_anti")
        got = get_complete_strata(c, ["GEO", *by], kind, *([value] if value else []))
        assert got.count() == want.count() < c.count()
    with pytest.raises(ValueError, match="valid column name"):
        get_complete_strata(c, ["AAR"], "missing", None)


def test_complete_strata_null_levels_and_no_strata(spark):
    """NULL levels form their own stratum (null-safe); with no stratum columns
    the whole table is one stratum."""
    rows = [(1, None, 0), (2, None, 0), (1, "a", 0), (2, "a", 1), (3, None, None)]
    df = spark.createDataFrame(rows, "GEO bigint, ALDER string, SPVFLAGG bigint")
    kept = {(r.GEO, r.ALDER) for r in get_complete_strata(df, ["GEO", "ALDER"], "censored").collect()}
    assert kept == {(1, None), (2, None), (3, None)}
    assert get_complete_strata(df.where("ALDER IS NULL"), ["GEO"], "missing", "SPVFLAGG").count() == 0
    assert get_complete_strata(df.where("SPVFLAGG IS NOT NULL"), ["GEO"], "missing", "SPVFLAGG").count() == 4


def test_all_combinations(spark):
    c = fx.fixture_new(spark, SF)
    assert get_all_combinations(c, ["KJONN", "ALDER"]).count() == 3 * 4
    with pytest.raises(ValueError):
        get_all_combinations(c.drop("KJONN"), ["KJONN", "ALDER"])


def test_grid_of_nulls_types_and_products(spark):
    rows = [(1, "a", 0.5, None), (2, None, 0.5, "x"), (1, "b", 1e300, "x"), (None, "a", None, "y.z")]
    df = spark.createDataFrame(rows, "g long, t string, v double, `a.b` string")
    got = get_all_combinations(df, ["g", "t", "v", "a.b"])
    assert [f.dataType for f in got.schema] == [f.dataType for f in df.schema]
    want = {(a, b, c, d) for a in (1, 2, None) for b in ("a", "b", None) for c in (0.5, 1e300, None) for d in (None, "x", "y.z")}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(want) == 81 and set(rows) == want
    assert get_all_combinations(df.where("g > 5"), ["g", "t"]).count() == 0


def test_grid_of_a_million_levels(spark):
    """No list of a column's levels anywhere, and each task makes its share of the rows."""
    df = spark.range(1_000_000).selectExpr("id * 3 as GEO", "cast(id % 3 as string) as AAR")
    grid = get_all_combinations(df, ["GEO", "AAR"])
    assert "collect_set" not in grid._jdf.queryExecution().optimizedPlan().toString()
    row = grid.agg(F.count(F.lit(1)), F.sum("GEO"), F.count_distinct("AAR"), F.sum(F.xxhash64("GEO", "AAR").cast("decimal(38,0)"))).first()
    plain = df.select("GEO").distinct().select("GEO", F.explode(F.array(F.lit("0"), F.lit("1"), F.lit("2"))).alias("AAR"))
    assert row[:3] == (3_000_000, 3 * 3 * 499_999_500_000, 3)
    assert row[3] == plain.agg(F.sum(F.xxhash64("GEO", "AAR").cast("decimal(38,0)"))).first()[0]


def test_ordered_numbers(spark):
    df = spark.createDataFrame([(k * 7919 % 1000, "x" * (k % 3)) for k in range(1000)], "a long, b string").repartition(5)
    got = ordered_numbers(df, ["b", "a"], "no").collect()
    assert [(r.b, r.a) for r in sorted(got, key=lambda r: r.no)] == sorted((r.b, r.a) for r in got) and {r.no for r in got} == set(range(1000))


def _cubes(spark):
    new = spark.createDataFrame(
        [(0, "2020_2020", 0, 1.0), (0, "2021_2021", 0, 2.0), (1, "2021_2021", 0, 3.0), (0, "2021_2021", 1, 4.0)],
        "GEO bigint, AAR string, INNVKAT bigint, RATE double")
    old = spark.createDataFrame(
        [(0, "2020_2020", 0, 1.0), (0, "2020_2020", 5, 1.0), (2, "2020_2020", 0, 2.0)],
        "GEO bigint, AAR string, UTDANN bigint, RATE double")
    return new, old


def test_flag_rows(spark):
    new, old = _cubes(spark)
    nr = {(r.GEO, r.AAR, r.INNVKAT): r.newrow for r in flag_rows(new, old, "newrow").collect()}
    assert nr == {(0, "2020_2020", 0): 0, (0, "2021_2021", 0): 1, (1, "2021_2021", 0): 1, (0, "2021_2021", 1): 1}
    er = {(r.GEO, r.UTDANN): r.exprow for r in flag_rows(new, old, "exprow").collect()}
    assert er == {(0, 0): 0, (0, 5): 1, (2, 0): 1}
    assert {r.newrow for r in flag_rows(new, None, "newrow").collect()} == {1}
    with pytest.raises(ValueError):
        flag_rows(new, None, "exprow")
    with pytest.raises(ValueError):
        flag_rows(None, old, "newrow")


def test_compare_dimensions_and_columns(spark):
    new, old = _cubes(spark)
    d = {r.Dimension: r for r in compare_dimensions(new, old).collect()}
    assert d["GEO"].N_levels == 2 and d["GEO"].New_levels == "1" and d["GEO"].Expired_levels == "2"
    assert d["AAR"].New_levels == "2021_2021" and d["AAR"].Expired_levels == ""
    assert d["INNVKAT"].New_levels == "0, 1"
    cols = {(r.column, r.status) for r in compare_colnames(new, old).collect()}
    assert ("INNVKAT", "new") in cols and ("UTDANN", "expired") in cols
    held = {(r.column, r.status): (r.n_values_new, r.n_values_old) for r in compare_colnames(new, old).collect()}
    assert held[("RATE", "present")] == (4, 3) and held[("INNVKAT", "new")] == (4, None) and held[("UTDANN", "expired")] == (None, 3)
    assert {r.n_values_old for r in compare_colnames(new).collect()} == {None}


def test_level_table_broadcast_needs_a_bound(spark):
    """The level-key table is hinted only behind a bound: a profile bound
    within the limit, or a counted check when no bound is given."""
    from cubeguard.functions import joins
    df = spark.createDataFrame([(1, "a"), (2, None)], "GEO bigint, ALDER string")
    keys = joins.level_keys(df, ["GEO", "ALDER"])

    def plan(d):
        return d._jdf.queryExecution().logical().toString()
    assert "Hint" in plan(joins._broadcast_levels(keys, 10))
    assert "Hint" not in plan(joins._broadcast_levels(keys, joins.MAX_BROADCAST_ROWS + 1))
    assert "Hint" in plan(joins._broadcast_levels(keys, None))  # counted: 4 keys
    out = joins.semi_filter(df, df, ["GEO", "ALDER"], level_bound=10)
    assert {(r.GEO, r.ALDER) for r in out.collect()} == {(1, "a"), (2, None)}


def test_level_lookups_do_not_shuffle_the_cube(spark, tmp_path, monkeypatch):
    """More levels than may be broadcast, in several dimensions: the few that differ are looked up, and the cube stays where it is."""
    from cubeguard.functions import joins
    n = 30_000
    spark.range(n).selectExpr("id as GEO", "concat(2000 + id % 9, '_') as AAR", "concat(id, '_', id) as ALDER", "id * 2 as KJONN", "1.0D as RATE").write.parquet(str(tmp_path / "new"))
    spark.range(5, n + 50).selectExpr("id as GEO", "concat(2000 + id % 8, '_') as AAR", "concat(id, '_', id) as ALDER", "id * 2 as KJONN", "2.0D as RATE").write.parquet(str(tmp_path / "old"))
    new, old = spark.read.parquet(str(tmp_path / "new")), spark.read.parquet(str(tmp_path / "old"))
    dims = ["GEO", "AAR", "ALDER", "KJONN"]
    small = joins.any_level_missing(new, old, dims, "f"), joins.semi_filter(new, old, dims)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 1 << 20)
        monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 8192)
        for bound in (None, 4 * n):
            flagged = joins.any_level_missing(new, old, dims, "f", level_bound=bound)
            kept = joins.semi_filter(new, old, dims, level_bound=bound)
            assert flagged.exceptAll(small[0]).count() == small[0].exceptAll(flagged).count() == 0 < flagged.where("f = 1").count() < n
            assert kept.exceptAll(small[1]).count() == small[1].exceptAll(kept).count() == 0
            for df in (flagged, kept):
                plan = df._jdf.queryExecution().executedPlan().toString()
                moved = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "__key" not in x]
                assert moved == [] and plan.count("BroadcastHashJoin") >= len(dims)
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)

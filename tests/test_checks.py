"""Table checks: symmetry, crop, errors."""

import pytest
from pyspark.sql import functions as F

from cubeguard.operators import checks
from cubeguard.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def new(spark):
    return fx.fixture_new(spark, SF)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_geolevel_letter_order(new):
    for a, b in (("FL", "LF"), ("FK", "KF"), ("BK", "KB")):
        assert rows(checks.compare_geolevels(new, a, fx.CITY_PARENTS)) == \
            rows(checks.compare_geolevels(new, b, fx.CITY_PARENTS))


def test_geolevel_additive_by_construction(new):
    fk = checks.compare_geolevels(new, "FK", fx.CITY_PARENTS)
    assert fk.where("Relative IS NOT NULL AND Relative != 1").count() == 0


def test_geolevel_errors(spark, new):
    with pytest.raises(ValueError):
        checks.compare_geolevels(new, "XY", fx.CITY_PARENTS)
    with pytest.raises(ValueError, match="Only 1"):
        checks.compare_geolevels(new.where("GEOniv = 'F'"), "FL", fx.CITY_PARENTS, check_levels=True)
    assert checks.compare_geolevels(new.drop("TELLER", "TELLER_uprikk"), "FL", fx.CITY_PARENTS) is None


def test_cities_and_districts_can_be_written(spark, tmp_path):
    """columns KOMMUNE and Kommune differ only in case; the caller's session stays as it is."""
    import pyarrow.dataset as ds
    from cubeguard.plans.registry import QUERIES
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    tables = {"nation": ("(0, 0), (9, 1)", "n_nationkey, n_regionkey"), "supplier": ("(7)", "s_suppkey"),
              "customer": ("(1, 0, 'AUTOMOBILE'), (2, 0, 'MACHINERY'), (3, 9, 'BUILDING')", "c_custkey, c_nationkey, c_mktsegment"),
              "orders": ("(1, 1, DATE'1995-01-01', '1-URGENT'), (2, 2, DATE'1995-05-01', '2-HIGH'), (3, 3, DATE'1995-01-01', '1-URGENT')",
                         "o_orderkey, o_custkey, o_orderdate, o_orderpriority"),
              "lineitem": ("(1, 7, 1, 30D, 'R', 'F', 0.01D), (2, 7, 1, 12D, 'R', 'F', 0.01D), (3, 7, 1, 50D, 'R', 'F', 0.01D)",
                           "l_orderkey, l_suppkey, l_linenumber, l_quantity, l_returnflag, l_linestatus, l_discount")}
    for name, (values, columns) in tables.items():
        spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})").write.parquet(f"{src}/{name}.parquet")
    QUERIES["a7_geolevel_bk"](spark, src).write.parquet(out)
    got = ds.dataset(out).to_table().to_pylist()
    assert [k for k in got[0] if k.lower() == "kommune"] == ["KOMMUNE", "Kommune"]
    # the city has both customers' lines, its only district one of them; eight strata of one line
    assert {(r["KOMMUNE"], r["AAR"], r["Kommune"], r["Bydel"], r["Absolute"], r["Relative"]) for r in got} == {("NATION_0", "1995_1995", 42.0, 30.0, 12.0, 1.4)}
    assert len(got) == 8 and spark.conf.get("spark.sql.caseSensitive") == "false"


def test_unknown_district_returns_every_row(spark, new):
    """More rows than any screen shows: nothing is dropped."""
    many = new.crossJoin(spark.range(4).select(F.concat(F.lit("x"), F.col("id")).alias("UTDANN")))
    out = checks.unknown_bydel(many, fx.CITY_PARENTS)
    assert out.count() == 4 * checks.unknown_bydel(new, fx.CITY_PARENTS).count() > 4000


def test_top_n_is_per_group_whatever_their_number(spark):
    df = spark.createDataFrame([(g, v) for g in range(10) for v in range(g % 3)], "g int, v int")
    got = sorted(map(tuple, checks.top_n_per_group(df, ["g"], F.col("v").desc(), 1).collect()))
    assert got == [(g, g % 3 - 1) for g in range(10) if g % 3]


def test_check_censoring_unknown_cube(spark, new):
    with pytest.raises(ValueError, match="not found"):
        checks.check_censoring(new, fx.control_kuber(spark), "NO_SUCH_CUBE")
    empty = spark.createDataFrame([(fx.CUBE_NAME, None, None, None, None)],
                                  "KUBE_NAVN string, PRIKK_T double, PRIKK_N double, Stata_PRIKK_T double, "
                                  "Stata_PRIKK_N double")
    assert checks.check_censoring(new, empty, fx.CUBE_NAME) is None


def test_censoring_counts_new_only(new):
    out = checks.compare_censoring(new)
    assert out.agg(F.sum("N_new")).first()[0] == new.count()


def test_coverage_bounds(new):
    cov = checks.check_coverage_geolevel(new, 10.0)
    assert cov.where("Coverage_pct < 0 OR Coverage_pct > 100").count() == 0


def test_attack_sets(spark):
    sets = checks.decode_triangles(checks.find_specs(fx.spec_table(spark)))
    got = sorted((r.dim, r.set_label, r.level) for r in sets.collect())
    assert ("KJONN", "{1,2,0}", "0") in got and ("ALDER", "{1_2,3_4,5_7,1_7}", "1_7") in got
    assert not [g for g in got if g[0] == "UTDANN"]


def test_attack_with_area_sets(spark):
    """An area set with one protecting cell is recoverable, as a spec set is."""
    cube = spark.createDataFrame([(1, "2020_2020", 0, 1, 0), (101, "2020_2020", 0, 0, 1), (102, "2020_2020", 0, 0, 0),
                                  (2, "2020_2020", 0, 0, 0), (201, "2020_2020", 0, 0, 1)],
                                 "GEO long, AAR string, KJONN long, pvern int, prikket_ok int")
    none = spark.createDataFrame([], "Kolonne string, Innhold string")
    sets = spark.createDataFrame([("{1,101,102}", "1"), ("{1,101,102}", "101"), ("{1,101,102}", "102"),
                                  ("{2,201}", "2"), ("{2,201}", "201")], "set_label string, level string")
    assert checks.attack_naboprikk(cube, none).count() == 0
    assert [tuple(r) for r in checks.attack_naboprikk(cube, none, sets).collect()] == [("{1,101,102}", "2020_2020", "0")]


def test_attack_with_derived_area_sets(spark):
    """The cube's own hierarchy gives the sets: country, counties, municipalities, districts."""
    cube = spark.createDataFrame([(0, "L", 0, 1), (1, "F", 1, 0), (2, "F", 0, 0), (101, "K", 0, 1), (102, "K", 0, 0), (201, "K", 0, 0), (10101, "B", 0, 0)],
                                 "GEO long, GEOniv string, pvern int, prikket_ok int").selectExpr("*", "'2020_2020' as AAR", "0L as KJONN")
    none = spark.createDataFrame([], "Tabell string, Kolonne string, Innhold string")
    specs = checks.find_specs(none, cube=cube)
    assert sorted(r.Innhold for r in specs.collect()) == ["{0,1,2}", "{1,101,102}", "{101,10101}", "{2,201}"]
    got = sorted(tuple(r) for r in checks.attack_naboprikk(cube, specs).select("GEO", "AAR", "KJONN").collect())
    assert got == [("{0,1,2}", "2020_2020", "0"), ("{1,101,102}", "2020_2020", "0")]


def test_barometer_codes_must_be_contiguous(spark):
    from cubeguard.operators.barometer import barometer_lpnr
    schema = "stedskode_string string, indikator_kodet long"
    good = spark.createDataFrame([("1", 2), ("1", 3), ("1", 4)], schema)
    assert sorted(r.LPnr for r in barometer_lpnr(good).collect()) == [1, 2, 3]
    for codes in ([2, 3, 9], [2, 3, 3]):
        with pytest.raises(ValueError, match="contiguous"):
            barometer_lpnr(spark.createDataFrame([("1", c) for c in codes], schema))


def test_duplicate_keys(spark):
    from cubeguard.operators.levels import duplicate_keys
    df = spark.createDataFrame([(1, None, 1), (1, None, 2), (1, "a", 3), (2, "a", 4)], "GEO long, AAR string, v int")
    assert [tuple(r) for r in duplicate_keys(df, ["GEO", "AAR"]).collect()] == [(1, None, 2)]

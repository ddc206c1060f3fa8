"""Geography operators (G1-G5) with the reference's expectations."""

import pytest

from cubeguard.operators.geo import (
    add_geoparams, add_geotriangles, add_kommune, area_parents, area_sets, recode_geo, recode_report, split_kommuneniv, translate_geoniv,
)

PARENTS = {301: "Oslo", 1103: "Stavanger", 4601: "Bergen", 5001: "Trondheim"}


def _pop(spark):
    rows = [(0, "L", 5_000_000.0), (3, "F", 700_000.0), (301, "K", 700_000.0), (1103, "K", 150_000.0),
            (4601, "K", 290_000.0), (5001, "K", 210_000.0), (1111, "K", 3_000.0), (110301, "B", 9_000.0)]
    return spark.createDataFrame(rows, "GEO bigint, GEOniv string, WEIGHTS double")


def test_geoparams_split_labels_parents(spark):
    codes = [0, 3, 301, 1103, 4601, 5001, 1111, 110301]
    df = spark.createDataFrame([(g, i) for i, g in enumerate(codes)], "GEO bigint, i int")
    d = split_kommuneniv(add_geoparams(df, _pop(spark)), 10000)
    d = add_kommune(d, PARENTS).orderBy("i")
    rows = d.collect()
    assert [r.GEOniv for r in rows] == ["L", "F", "K", "K", "K", "K", "k", "B"]
    assert [r.KOMMUNE for r in rows] == [None, None, "Oslo", "Stavanger", "Bergen", "Trondheim", None, "Stavanger"]
    labels = [r.GEOniv for r in translate_geoniv(d).orderBy("i").collect()]
    assert labels == ["Land", "Fylke", "Kommune", "Kommune", "Kommune", "Kommune", "Kommune", "Bydel"]
    with pytest.raises(ValueError, match="GEOniv column not present"):
        translate_geoniv(d.drop("GEOniv"))


def test_geoparams_fallback_levels(spark):
    # codes without parameters get their level from the number of digits, weight 0
    codes = [0, 3, 1101, 1111, 110301, 99, 123456789]
    df = spark.createDataFrame([(g,) for g in codes], "GEO bigint")
    pop = spark.createDataFrame([(0, "L", 10.0)], "GEO bigint, GEOniv string, WEIGHTS double")
    got = {r.GEO: (r.GEOniv, r.WEIGHTS) for r in add_geoparams(df, pop).collect()}
    assert got == {0: ("L", 10.0), 3: ("F", 0.0), 1101: ("K", 0.0), 1111: ("K", 0.0), 110301: ("B", 0.0),
                   99: ("F", 0.0), 123456789: ("V", 0.0)}


def test_split_keeps_99_codes(spark):
    df = spark.createDataFrame([(1199, "K", 10.0), (1101, "K", 10.0)], "GEO bigint, GEOniv string, WEIGHTS double")
    assert {r.GEO: r.GEOniv for r in split_kommuneniv(df, 10000).collect()} == {1199: "K", 1101: "k"}


def test_recode(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "GEO bigint")
    m = spark.createDataFrame([(2, 20), (3, 399)], "old bigint, current bigint")
    got = {r.origgeo: r.GEO for r in recode_geo(df, m).collect()}
    assert got == {1: 1, 2: 20, 3: 399}
    rep = recode_report(df, m).collect()[0]
    assert rep.recoded_codes == 2 and rep.rows_on_99_codes == 1


def test_area_sets_of_all_levels(spark):
    """Codes of one to ten digits, an area without a parent, a pair without its upper level, small municipalities."""
    areas = spark.createDataFrame([(0, "L"), (3, "F"), (11, "F"), (301, "K"), (1103, "K"), (1111, "k"), (4601, "K"), (30101, "B"), (110301, "B"),
                                   (110302, "B"), (1103010001, "V"), (301010007, "V"), (99, None), (None, "K"), (1103, "K")], "GEO long, GEOniv string")
    got = {(r.pair, r.parent, r.child) for r in area_parents(areas).collect()}
    assert got == {("LF", 0, 3), ("LF", 0, 11), ("FK", 3, 301), ("FK", 11, 1103), ("FK", 11, 1111), ("KB", 301, 30101), ("KB", 1103, 110301),
                   ("KB", 1103, 110302), ("BV", 110301, 1103010001), ("BV", 30101, 301010007)}
    labels = {r.pair: r.set_label for r in area_sets(areas).collect() if r.pair in ("LF", "BV") or r.set_label.startswith("{1103,")}
    assert labels["LF"] == "{0,3,11}" and labels["KB"] == "{1103,110301,110302}"
    assert area_sets(areas.where("GEOniv <> 'F'")).where("pair in ('LF', 'FK')").count() == 0
    sets = spark.createDataFrame([(["L", "F"], "a"), (["F", "K"], "b"), (["B", "V"], "c")], "levels array<string>, set_label string")
    there = spark.createDataFrame([("L",), ("F",), ("K",), ("K",)], "GEOniv string")
    assert sorted(r.set_label for r in add_geotriangles(sets, there).collect()) == ["a", "b"]
    assert sorted(r.set_label for r in add_geotriangles(sets, ["B", "V"]).collect()) == ["c"]
    assert area_sets(areas.limit(0)).count() == 0

"""Comparison pipeline invariants."""

import pytest
from pyspark.sql import functions as F

from cubeguard.operators.outliers import add_changeval
from cubeguard.plans.comparison import make_comparecube
from cubeguard.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def test_cube_against_itself(spark):
    new = fx.fixture_new(spark, SF)
    res = make_comparecube(new, new, small_threshold=fx.small_area_threshold(spark, SF))
    cc = res.comparecube
    diffs = [c for c in cc.columns if c.endswith("_diff")]
    rels = [c for c in cc.columns if c.endswith("_reldiff")]
    agg = cc.agg(F.count(F.lit(1)).alias("n"), F.max("newrow").alias("newrow"), F.max("any_diffs").alias("anyd"),
                 *[F.max(F.abs(F.col(f"`{c}`"))).alias(f"d{i}") for i, c in enumerate(diffs)],
                 *[F.min(F.col(f"`{c}`")).alias(f"rmin{i}") for i, c in enumerate(rels)],
                 *[F.max(F.col(f"`{c}`")).alias(f"rmax{i}") for i, c in enumerate(rels)]).first().asDict()
    assert agg["n"] == new.where("GEOniv <> 'V'").count() < new.count() and agg["newrow"] == 0 and agg["anyd"] == 0
    assert all(agg[f"d{i}"] == 0 for i in range(len(diffs)))
    assert all(agg[f"rmin{i}"] == 1 and agg[f"rmax{i}"] == 1 for i in range(len(rels)))
    # nothing is new when the cube is compared with itself
    assert res.newcube_flag.where("NEW_OUTLIER = 1").count() == 0


def test_no_old_cube(spark):
    new = fx.fixture_new(spark, SF)
    res = make_comparecube(new, None, small_threshold=60.0)
    assert res.comparecube is None and res.oldcube_flag is None
    assert {r.newrow for r in res.newcube_flag.select("newrow").distinct().collect()} == {1}
    assert "OUTLIER" in res.newcube_flag.columns and "change_OUTLIER" in res.newcube_flag.columns


def test_change_is_order_independent(spark):
    rows = [("a", "2019_2019", 2.0), ("a", "2020_2020", None), ("a", "2021_2021", 0.0), ("a", "2022_2022", 3.0),
            ("b", "2019_2019", 4.0), ("b", "2020_2020", 5.0)]
    df = spark.createDataFrame(rows, "s string, AAR string, RATE double")
    a = {(r.s, r.AAR): r.change_RATE for r in add_changeval(df, "RATE", ["s"]).collect()}
    b = {(r.s, r.AAR): r.change_RATE for r in add_changeval(df.orderBy(F.desc("AAR")), "RATE", ["s"]).collect()}
    assert a == b
    assert a[("a", "2019_2019")] is None and a[("a", "2020_2020")] is None
    assert a[("a", "2021_2021")] == -100.0                     # last non-null earlier value: 2
    assert a[("a", "2022_2022")] == 100.0 * (3.0 / 1.0 - 1.0)  # previous 0 -> half of smallest non-zero (2/2)
    assert a[("b", "2020_2020")] == 100.0 * (5.0 / 4.0 - 1.0)


def test_uprikk_rebuild(spark):
    new = spark.createDataFrame([(0, "2020_2020", 10.0, 0), (1, "2020_2020", 3.0, 1)],
                                "GEO bigint, AAR string, TELLER_uprikk double, SPVFLAGG bigint")
    old = spark.createDataFrame([(0, "2020_2020", 9.0, 0), (1, "2020_2020", None, 1)],
                                "GEO bigint, AAR string, TELLER double, SPVFLAGG bigint")
    res = make_comparecube(new, old, outliers=False)
    got = {r.GEO: (r.TELLER_new, r.TELLER_old, r.TELLER_diff) for r in res.comparecube.collect()}
    assert got == {0: (10.0, 9.0, 1.0), 1: (None, None, 0.0)}


def test_profile_bounds_and_ranges(spark):
    """The profile bounds the rows of every stratum and their number; cutting
    strata into many ranges gives the same flagged cube."""
    from cubeguard.spec import identify_coltypes, profile_cube
    new, old, thr = fx.fixture_pair(spark, SF)
    dims = [d for d in identify_coltypes(new).dims_new if d not in ("GEO", "AAR")]
    largest = new.groupBy("GEOniv", *dims).count().agg(F.max("count")).first()[0]
    prof = profile_cube(new, list(identify_coltypes(new).dims_new))
    assert prof.n_rows == new.count() and largest <= prof.stratum_bound <= prof.n_rows
    from cubeguard.functions.joins import level_keys
    dims_all = list(identify_coltypes(new).dims_new)
    assert level_keys(new, dims_all).count() <= prof.level_bound
    from cubeguard.operators.geo import split_kommuneniv
    assert split_kommuneniv(new, thr).select("GEOniv", *dims).distinct().count() <= prof.strata_bound
    win = make_comparecube(new, old, small_threshold=thr).newcube_flag
    hot = make_comparecube(new, old, small_threshold=thr, rows_per_range=50).newcube_flag
    cols = [c for c in win.columns]
    assert win.select(*[F.col(f"`{c}`") for c in cols]).exceptAll(
        hot.select(*[F.col(f"`{c}`") for c in cols])).count() == 0
    assert win.count() == hot.count()


def _physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_shape_at_scale(spark):
    """With automatic broadcasts off (the static plan of a 100 TB input), the
    level lookups stay broadcast behind their proven bounds and the comparison
    has no shuffle join: the null-safe full outer match is one exchange of both
    cubes by the key, picked before it; F2 has no window over a stratum."""
    from cubeguard.operators.levels import get_complete_strata
    new, old, thr = fx.fixture_pair(spark, SF)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        cc = make_comparecube(new, old, small_threshold=thr).comparecube
        plan = _physical(cc)
        assert "SortMergeJoin" not in plan
        assert len([x for x in plan.splitlines() if "Exchange hashpartitioning(__key0" in x]) == 1
        assert plan.count("BroadcastHashJoin") >= 2
        f2 = _physical(get_complete_strata(new, ["GEO", "AAR", "KJONN", "ALDER", "INNVKAT"], "censored"))
        assert "Window" not in f2
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_first_match_of_repeated_keys(spark):
    """A key held twice on both sides gives one row, the least by its columns, whatever the order and number of partitions."""
    from cubeguard.operators.compare import dropped_rows, match_first
    new = spark.createDataFrame([(1, None, 5.0, "b"), (1, None, 4.0, "z"), (1, None, None, "y"), (2, "x", 1.0, "a"), (4, "q", 1.0, None)],
                                "g long, a string, `v.n` double, t string")
    old = spark.createDataFrame([(1, None, 9.0), (1, None, 8.0), (3, "x", 7.0), (4, "q", None), (4, "q", None)], "g int, a string, w double")
    seen = set()
    for parts in (1, 3, 7):
        m = match_first(new.repartition(parts), old.repartition(parts), ["g", "a"], ["v.n", "t"], ["w"])
        assert m.schema["g"].dataType == new.schema["g"].dataType
        rows = sorted((tuple(r) for r in m.collect()), key=str)
        assert rows == sorted([(1, None, None, "y", 8.0, 3, 2), (2, "x", 1.0, "a", None, 1, 0), (3, "x", None, None, 7.0, 0, 1),
                               (4, "q", 1.0, None, None, 1, 2)], key=str)
        seen.add(str(sorted((tuple(r) for r in dropped_rows(m, ["g", "a"]).collect()), key=str)))
    assert seen == {str(sorted([(1, None, "new", 2), (1, None, "old", 1), (4, "q", "old", 1)], key=str))}
    by_text = match_first(new, old, ["g", "a"], ["v.n", "t"], ["w"], first_by=["t"]).where("g = 1").first()
    assert (by_text["v.n"], by_text["t"]) == (5.0, "b")


def test_comparison_has_one_exchange_of_the_cubes(spark):
    """Without outliers the match is the only exchange by the key, and no join multiplies rows."""
    new = fx.fixture_new(spark, SF)
    res = make_comparecube(new.drop("INNVKAT"), new.drop("INNVKAT"), outliers=False)
    keys = ["GEO", "AAR", "KJONN", "ALDER"]
    assert res.comparecube.groupBy(*keys).count().where("count > 1").count() == 0
    assert res.comparecube.count() == new.where("GEOniv <> 'V'").select(*keys).distinct().count()
    plan = res.comparecube._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "FullOuter" not in plan


def test_release_deletes_what_was_written(spark):
    """Only the tables of this session, and fixtures are derived again afterwards."""
    from cubeguard import session
    a = session.materialize(spark.range(10))
    folder = a.inputFiles()[0].rpartition("/")[0]
    mine = session._WRITTEN[session.session_id(spark)]
    kept, session._WRITTEN[session.session_id(spark)] = list(mine[:-1]), [mine[-1]]
    memo = dict(fx._MEMO)
    assert session.release(spark) == 1 and not fx._MEMO
    with pytest.raises(Exception):
        spark.read.parquet(folder)
    session._WRITTEN[session.session_id(spark)] = kept
    fx._MEMO.update(memo)

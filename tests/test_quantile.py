"""X1 weighted quantile definition, checked against a brute-force reference."""

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cubeguard.functions.quantile import magnitude, order_statistics, passes_for, weighted_fences, weighted_quantiles


def brute(values, weights, p):
    pairs = sorted((v, w) for v, w in zip(values, weights) if v is not None and w is not None and w > 0)
    tot = sum(w for _, w in pairs)
    if tot == 0:
        return None
    cum, lower, upper = 0.0, None, None
    vals = sorted({v for v, _ in pairs})
    for v in vals:
        cum += sum(w for x, w in pairs if x == v)
        if lower is None and cum >= p * tot:
            lower = v
        if upper is None and cum > p * tot:
            upper = v
    return (lower + upper) / 2


def run(spark, values, weights):
    df = spark.createDataFrame([("g", v, w) for v, w in zip(values, weights)], "g string, v double, w double")
    r = weighted_fences(df, [("v", "")], "w", ["g"]).select("wq25", "wq50", "wq75", "MIN", "MAX").first()
    return r


def test_unit_weights(spark):
    r = run(spark, [1.0, 2.0, 3.0, 4.0], [1.0, 1.0, 1.0, 1.0])
    assert (r.wq25, r.wq50, r.wq75) == (1.5, 2.5, 3.5)
    assert (r.MIN, r.MAX) == (1.0, 4.0)


def test_zero_and_null_weights_are_ignored(spark):
    r = run(spark, [1.0, 2.0, 3.0, 100.0, None], [1.0, 1.0, 2.0, 0.0, 5.0])
    assert r.wq50 == 2.5 and r.MAX == 100.0
    r = run(spark, [1.0, 2.0], [0.0, 0.0])
    assert r.wq50 is None


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 4)), min_size=1, max_size=12))
def test_against_brute_force(spark, data):
    values = [float(v) for v, _ in data]
    weights = [float(w) for _, w in data]
    r = run(spark, values, weights)
    for p, got in ((0.25, r.wq25), (0.5, r.wq50), (0.75, r.wq75)):
        exp = brute(values, weights, p)
        assert (got is None and exp is None) or np.isclose(got, exp)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.integers(-30, 30), st.sampled_from([-1e300, -0.0, 1e-300, 0.1, 2.0 ** -1074, 1.7e308])),
                          st.integers(0, 3)), min_size=1, max_size=40))
def test_number_of_passes_changes_nothing(spark, data):
    df = spark.createDataFrame([(g, float(v), float(w)) for g, v, w in data], "g string, v double, w double")
    key = lambda t: tuple((x is None, x) for x in t)
    got = [sorted((tuple(r) for r in weighted_quantiles(df, ["g"], "v", "w", (0.25, 0.5, 0.75), passes=n).collect()), key=key) for n in (0, 1, 2, 4)]
    assert got[0] == got[1] == got[2] == got[3]
    for g, lo, *q, hi in [(r[0], r[1], *r[3:], r[2]) for r in got[0]]:
        own = [(float(v), float(w)) for x, v, w in data if x == g]
        assert (lo, hi) == (min(own)[0], max(own)[0])
        assert q == [brute([v for v, _ in own], [w for _, w in own], p) for p in (0.25, 0.5, 0.75)]
    o = {r.g: r for r in order_statistics(df, ["g"], "v", {"median": 0.5}, 3).collect()}
    for g in {x for x, _, _ in data}:
        vals = [float(v) for x, v, _ in data if x == g]
        assert o[g].n == len(vals) and np.isclose(o[g].median, float(np.percentile(vals, 50)))


def test_first_pass_keeps_order(spark):
    """The bucket by magnitude never falls as values grow, at powers of two in particular."""
    values = sorted({x for e in range(-1074, 1024) for s in (1.0, -1.0) for x in (
        s * 2.0 ** e, s * np.nextafter(2.0 ** e, 0), s * np.nextafter(2.0 ** e, np.inf), s * 1.37 * 2.0 ** e) if np.isfinite(x)})
    df = spark.createDataFrame([(float(v),) for v in values], "v double").select("v", magnitude(F.col("v")).alias("b"))
    buckets = [r.b for r in sorted(df.collect())]
    assert all(a <= b for a, b in zip(buckets, buckets[1:], strict=False)) and len(set(buckets)) > 10_000


def test_many_narrow_buckets(spark):
    """A group cut into more than 1,000 buckets, most of its values in one power of two, one far away."""
    rng = np.random.default_rng(3)
    values = np.concatenate([1.0 + rng.integers(0, 1 << 30, 60_000) / 2.0 ** 34, [1e9, -1e-9, 0.0]])
    weights = rng.integers(0, 5, len(values)).astype(float)
    df = spark.createDataFrame(list(zip(["g"] * len(values), values.tolist(), weights.tolist(), strict=True)), "g string, v double, w double")
    passes = passes_for(len(values), len(values) // 1000)
    assert passes == 2 and passes_for(len(values)) == 0
    order = np.argsort(values)
    v, cum = values[order], np.cumsum(weights[order])
    want = [(v[np.searchsorted(cum, p * cum[-1], "left")] + v[np.searchsorted(cum, p * cum[-1], "right")]) / 2 for p in (0.25, 0.5, 0.75)]
    for n in (0, passes, 3):
        r = weighted_quantiles(df, ["g"], "v", "w", (0.25, 0.5, 0.75), passes=n).first()
        assert [r.wq25, r.wq50, r.wq75] == want and (r.MIN, r.MAX) == (values.min(), values.max())


def test_passes_read_the_table_once(spark, tmp_path):
    """The passes share one shuffle of summed weights, and no sketch or list of cut points is built."""
    spark.range(20_000).selectExpr("id % 3 as g", "cast(id as double) as v", "1.0D as w").write.parquet(str(tmp_path / "t"))
    q = weighted_quantiles(spark.read.parquet(str(tmp_path / "t")), ["g"], "v", "w", (0.25, 0.5, 0.75), passes=3)
    assert len(q.collect()) == 3
    plan = q._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and "ReusedExchange" in plan
    assert "percentile_approx" not in plan and "array_sort" not in plan


def test_fences_of_value_and_change(spark):
    """Value and change fences against brute force, with one range and with
    many: NULL level, NULL values, zero/NULL weights, ties."""
    from cubeguard.operators.outliers import add_outliers
    rng = np.random.default_rng(7)
    rows = []
    for i in range(300):
        lvl = [None, "K", "F"][i % 3]
        kj = i % 2
        v = None if i % 17 == 0 else float(rng.integers(0, 12))
        c = None if i % 11 == 0 else float(rng.normal())
        w = None if i % 23 == 0 else float(rng.integers(0, 4))
        rows.append((i, lvl, kj, v, c, w))
    df = spark.createDataFrame(rows, "GEO long, GEOniv string, KJONN long, RATE double, change_RATE double, "
                                     "WEIGHTS double")
    by = ["GEO", "KJONN"]
    one = add_outliers(df, "RATE", by, True)
    many = add_outliers(df, "RATE", by, True, passes=2)
    assert one.columns == many.columns
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0
    for r in one.where("GEOniv is not null").dropDuplicates(["GEOniv", "KJONN"]).collect():
        for k, prefix in ((3, ""), (4, "change_")):
            own = [x for x in rows if (x[1], x[2]) == (r.GEOniv, r.KJONN) and x[k] is not None]
            for p, name in ((0.25, "wq25"), (0.5, "wq50"), (0.75, "wq75")):
                assert np.isclose(r[prefix + name], brute([x[k] for x in own], [x[5] or 0.0 for x in own], p))


def test_weights_add_up_in_any_order(spark):
    """An exact hit on p * tot does not depend on the order of the sums."""
    rows = [("g", float(v), 0.1) for v in range(40)]
    df = spark.createDataFrame(rows, "g string, v double, w double")
    for n in (1, 4, 7):
        r = weighted_fences(df.repartition(n), [("v", "")], "w", ["g"], passes=n // 3).first()
        assert (r.wq25, r.wq50, r.wq75) == (9.5, 19.5, 29.5)

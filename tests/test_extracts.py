"""Extract operators: stored filters by shape, pairing of repeated keys."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from cubeguard.functions.numbering import occurrence_numbers
from cubeguard.operators import extracts as ext


def test_shapes_of_stored_filters(spark):
    texts = ["GEO > 0", "GEO > 17 & KJONN %in% c(1, -2)", "!is.na(RATE.n) | ALDER == '15_24' & x2 != 1.5", 'a == "5"', "", "GEO>=3"]
    shape, literals = ext.filter_shape(F.col("t"))
    got = [tuple(r) for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
           .select("k", shape.alias("s"), literals.alias("l")).orderBy("k").collect()]
    assert [r[1:] for r in got] == [
        ("GEO > #i#", ["0"]), ("GEO > #i# & KJONN %in% c(#i#, #i#)", ["17", "1", "-2"]),
        ("!is.na(RATE.n) | ALDER == #s# & x2 != #d#", ["15_24", "1.5"]), ("a == #s#", ["5"]), ("", []), ("GEO>=#i#", ["3"])]
    with pytest.raises(ValueError):
        ext.etab_predicate("GEO > #i#")  # a mark needs its literals


def test_filters_by_shape_equal_filters_one_by_one(spark):
    rng = random.Random(3)
    cube = spark.createDataFrame([(g, "2020_2020", k, a, None if g % 7 == 0 else g / 2) for g in range(40) for k in (0, 1, None) for a in ("0_17", "18_99")],
                                 "GEO long, AAR string, KJONN long, ALDER string, RATE double")
    texts = ["GEO > {a}", "GEO > {a} & KJONN %in% c({b}, 7)", "is.na(RATE) | ALDER == '0_17'", "!(RATE < {a}.5) & ALDER != \"0_17\"", None, " ", "KJONN == {b}"]
    filters = {f"E{k}.csv": (t or "").format(a=rng.randrange(30), b=rng.randrange(2)) if t is not None else None for k, t in enumerate(texts * 4)}
    rows = [(f, t, g, "2020_2020", a) for f, t in filters.items() for g in range(0, 40, 3) for a in ("0_17", "18_99")]
    got = ext.filter_cube_to_extracts(cube, spark.createDataFrame(rows, "Friskvik string, ETAB string, GEO long, AAR string, ALDER string"))
    got = sorted(((r.Friskvik, r.GEO, r.KJONN, r.ALDER) for r in got.collect()), key=str)
    want = []
    for f, t in filters.items():
        one = cube.where(F.col("GEO") % 3 == 0)
        one = one.where(ext.etab_predicate(t)) if t and t.strip() else one
        want += [(f, r.GEO, r.KJONN, r.ALDER) for r in one.collect()]
    assert got == sorted(want, key=str)


def test_ten_thousand_filters_plan_in_seconds(spark):
    cube = spark.range(200).selectExpr("id as GEO", "'2020_2020' as AAR", "cast(id as double) as RATE")
    e = spark.range(10_000).selectExpr("concat('E', id, '.csv') as Friskvik", "concat('GEO > ', id % 190, ' & RATE < ', id, '.5') as ETAB",
                                       "id % 200 as GEO", "'2020_2020' as AAR")
    began = time.time()
    out = ext.filter_cube_to_extracts(cube, e)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert time.time() - began < 20 and len(plan) < 100_000
    want = spark.range(10_000).where("id % 200 > id % 190 and id % 200 < id + 0.5").count()
    assert out.count() == want > 0


def test_occurrence_numbers(spark):
    rng = np.random.default_rng(2)
    rows = [(None if k == 3 else k, "a", None if v % 5 == 0 else float(v) * 10 ** (v % 9), int(t)) for k in range(5)
            for v, t in zip(rng.integers(0, 40, 60 if k == 3 else k).tolist(), rng.integers(0, 3, 60).tolist(), strict=False)]
    df = spark.createDataFrame(rows, "g long, s string, v double, t long").repartition(4)
    got = occurrence_numbers(df, ["g", "s"], ["v"], "no").collect()
    assert sorted(map(str, [tuple(r)[:4] for r in got])) == sorted(map(str, rows))
    for g in {r.g for r in got}:
        own = sorted((r for r in got if r.g == g), key=lambda r: r.no)
        assert [r.no for r in own] == list(range(len(own)))
        order = [(r.v is not None, r.v or 0, r.t) for r in own]
        assert order == sorted(order)


def test_multisets_pair(spark):
    """Twice on both sides pairs twice; what one side holds more often has no partner; a hot key is not gathered."""
    cube = spark.createDataFrame([("E.csv", 1, "2020_2020", 2.0, 0), ("E.csv", 1, "2020_2020", 1.0, 0), ("E.csv", 1, "2020_2020", None, 3),
                                  ("E.csv", 2, "2020_2020", 5.0, 0), ("E.csv", 2, "2020_2020", 5.0, 0)],
                                 "Friskvik string, GEO long, AAR string, RATE double, SPVFLAGG long")
    full = spark.createDataFrame([("E.csv", 1, "2020_2020", 1.0), ("E.csv", 1, "2020_2020", None), ("E.csv", 1, "2020_2020", 2.0),
                                  ("E.csv", 2, "2020_2020", 5.0), ("E.csv", 2, "2020_2020", 5.0)], "Friskvik string, GEO long, AAR string, MEIS double")
    assert ext.compare_values(full, cube, ["GEO", "AAR"], ["RATE"]).first().MATCHER_KOLONNE == "RATE"
    assert ext.mask_areas(full, cube, ["GEO", "AAR"]).count() == 0
    less = full.distinct()  # GEO 2 once only
    assert ext.compare_values(less, cube, ["GEO", "AAR"], ["RATE"]).first().MATCHER_KOLONNE == "!!NO MATCH!!"
    assert [tuple(r) for r in ext.mask_areas(less, cube, ["GEO", "AAR"]).collect()] == [("E.csv", 2)]

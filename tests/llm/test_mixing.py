import itertools

import pytest
from pyspark.sql import functions as F

from cubeguard.llm import mixing as M
from tests.llm.helpers import SCHEMA, frame, rows


def cells(spark, own):
    return spark.createDataFrame(own, "source string, lang string, topic string, n_tokens long")


def brute(own, goals):
    total = sum(n for *_, n in own)
    w = {c[:3]: float(c[3]) for c in own}
    goals = [{v: t / sum(x for k, x in g.items() if k in {c[i] for c in w}) * total for v, t in g.items()} for i, g in enumerate(goals)]
    for _ in range(400):
        for i, g in enumerate(goals):
            sums = {}
            for c, x in w.items():
                sums[c[i]] = sums.get(c[i], 0) + x
            w = {c: x * g.get(c[i], 0) / sums[c[i]] if sums[c[i]] else 0.0 for c, x in w.items()}
    return w


def test_rakes_to_all_marginals(spark):
    own = [(s, la, t, 10 + 37 * i % 91) for i, (s, la, t) in enumerate(itertools.product("abcd", ["en", "fr"], ["x", "y", "z"]))]
    goals = [{"a": 1, "b": 2, "c": 3, "d": 4, "not there": 5}, {"en": 0.2, "fr": 0.8}, {"x": 1, "y": 1, "z": 1}]
    frames = {d: spark.createDataFrame(list(g.items()), "value string, target double") if isinstance(list(g.values())[0], float) else spark.createDataFrame([(k, float(v)) for k, v in g.items()], "value string, target double") for d, g in zip(M.DIMENSIONS, goals, strict=True)}
    got = {(r.source, r.lang, r.topic): r.w for r in M.rake(cells(spark, own), frames).collect()}
    want = brute(own, goals)
    assert got.keys() == want.keys()
    assert all(abs(got[c] - want[c]) < 1e-3 * max(1, want[c]) for c in want)


def test_expected_tokens_are_the_budget(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = M.mix_report(docs, budget=0.6)
    r = got.agg(F.sum(F.col("probability") * F.col("n_tokens")), F.sum("n_tokens"), F.min("probability"), F.max("probability"), F.count("*")).first()
    assert abs(r[0] / r[1] - 0.6) < 1e-6 and r[2] >= 0 and r[3] <= 1 and r[4] == docs.count()
    again = M.mix_report(docs.repartition(7), budget=0.6)
    assert {(r.doc_id, r.kept, round(r.probability, 9)) for r in got.collect()} == {(r.doc_id, r.kept, round(r.probability, 9)) for r in again.collect()}


def test_tokens_and_topics(spark):
    got = {r.doc_id: r for r in M.mix_report(frame(spark, [(1, "a b\tc\n d\x1ce", "en", "s", None, None, None), (2, "AB!! c", "en", "s", None, None, None), (3, "a | b", None, None, None, None, None), (4, None, None, None, None, None, None)])).collect()}
    assert [got[k].n_tokens for k in (1, 2, 3, 4)] == [4, 2, 3, 0]
    assert [got[k].topic for k in (1, 2, 3, 4)] == ["prose", "shout", "table", "prose"]
    assert got[3].source == got[3].lang == M.NONE


def test_awkward_rows(spark):
    got = M.mixed(frame(spark))
    assert got.count() == len(rows())
    kept = M.keep_mixed(frame(spark), budget=1.0)
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert 0 < kept.count() <= len(rows())


def test_no_python_in_the_plan(spark):
    plan = M.mix_report(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("own", [[], [(1, None, None, None, None, None, None)]])
def test_nothing_to_mix(spark, own):
    assert M.mix_report(frame(spark, own)).count() == len(own)

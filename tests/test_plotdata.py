"""Plot files and pages."""

import random

from pyspark.sql import functions as F

from cubeguard.operators import plotdata
from cubeguard.operators.extracts import etab_predicate


def test_predicates_cover_each_row_once(spark):
    rng = random.Random(4)
    rows = [(k, rng.choice(["x", "it's", None]), rng.choice([1, 2, None]), rng.choice(["a", "b"]), rng.random()) for k in range(400)]
    df = spark.createDataFrame(rows, "id long, t string, `n.r` long, u string, v double")
    for by, most in ((["t", "n.r", "u"], 4), (["t", "n.r"], 3), (["u"], 1), (["t", "n.r", "u"], 100), ([], 5)):
        files = plotdata.plot_files(df, by, most).collect()
        seen = []
        for f in files:
            part = df.where(etab_predicate(f.predicate))
            strata = part.select(*[F.col(f"`{b}`") for b in by]).distinct().count() if by else 1
            assert strata <= most and strata == f.n_panels
            seen += [r.id for r in part.select("id").collect()]
        assert sorted(seen) == list(range(400)), (by, most)
        assert len({f.suffix for f in files}) == len(files)


def test_panels_are_counted_from_strata_that_exist(spark):
    """Ten levels by ten, of which ten pairs exist: one file holds them, where a product would ask for ten."""
    df = spark.createDataFrame([(k % 10, "p") for k in range(30)] + [(3, "q")], "b long, c string").withColumn("a", F.col("b") * 2)
    assert plotdata.get_plot_subset(df, ["a", "b"], 10) == []
    assert plotdata.get_plot_subset(df, ["a", "b", "c"], 10) == ["c"]


def test_pages_of_text_codes(spark):
    """Series are numbered in the order of their keys, areas with codes of any form, without a window over all."""
    rng = random.Random(5)
    rows = [(f"N{g:03d}x", "K", f"{y}_{y}", s, float(rng.randint(0, 9)), 1, 1) for g in range(60) for s in (0, 1) for y in (2019, 2020)]
    df = spark.createDataFrame(rows, "GEO string, GEOniv string, AAR string, KJONN long, RATE double, OUTLIER int, NEW_OUTLIER int").repartition(7)
    got = plotdata.timeseries_data(df, n_periods=2, panels_per_page=25).select("GEO", "KJONN", "page").distinct().collect()
    assert {(r.GEO, r.KJONN): r.page for r in got} == {k: i // 25 + 1 for i, k in enumerate(sorted({(r[0], r[3]) for r in rows}))}


def test_country_series_reads_the_cube_once(spark, tmp_path):
    spark.createDataFrame([(0, f"{y}_{y}", k, a, 1.0 * y + k, 2.0) for y in (2019, 2020) for k in (0, 1, 2) for a in ("0_17", "18_99")],
                          "GEO long, AAR string, KJONN long, ALDER string, RATE double, TELLER double").write.parquet(str(tmp_path / "c"))
    out = plotdata.country_series(spark.read.parquet(str(tmp_path / "c")))
    got = {(r.by_dim, r.level, r.AAR): r.yvalue for r in out.where("PARAMETER = 'TELLER'").collect()}
    assert got[("Total", "total", "2019_2019")] == 4.0 and got[("KJONN", "2", "2020_2020")] == 4.0 and got[("ALDER", "0_17", "2019_2019")] == 2.0
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and "Union" not in plan

"""Plans whose memory and shuffles follow the rows: cubes from cells, the suppression attack."""

from itertools import product

from cubeguard.operators import checks
from cubeguard.sources import fixtures as fx

CELLS = "r bigint, n bigint, s bigint, v bigint, y int, kj bigint, band string, innv bigint, utd bigint, in_old boolean, t double, nv double, cnt bigint"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cube_rows_of_areas_and_suppliers(spark):
    cells = [(0, 0, 1, None, 2000, 1, "1_2", 1, 3, True, 30.0, 50.0, 2), (0, 5, 5, None, 2000, 2, "3_4", 2, 1, True, 5.0, 9.0, 1),
             (None, None, None, None, 2000, 1, "1_2", 1, 3, True, 4.0, 6.0, 1),
             (None, None, None, 100000007, 2000, 1, "1_2", 1, 3, True, 12.0, 20.0, 1),
             (None, None, None, 100000007, 2000, 1, "1_2", 1, 4, False, 13.0, 21.0, 3),
             (None, None, None, 100000008, 2001, 2, "5_7", 2, None, True, 1.0, 2.0, 1)]
    want = {}
    for r, n, s, v, y, kj, band, innv, _, _, t, nv, cnt in cells:
        geo = [v] if v is not None else [0] + ([] if r is None else [r + 1, 100 * (r + 1) + n] + ([100 * (100 * (r + 1) + n) + s] if n < 4 and s < 5 else []))
        for key in product(geo, [f"{y}_{y}"], [0, kj], ["1_7", band], [0, innv]):
            got = want.setdefault(key, [0.0, 0])
            got[0] += t
            got[1] += cnt
    cube = fx._cube_from_cells(spark.createDataFrame(cells, CELLS), "INNVKAT", "innv", 3)
    rows = cube.collect()
    assert {(r["GEO"], r["AAR"], r["KJONN"], r["ALDER"], r["INNVKAT"]): r["TELLER_uprikk"] for r in rows} == {k: x[0] for k, x in want.items()}
    assert all(r["RATE.n"] is None or r["RATE.n"] == want[(r["GEO"], r["AAR"], r["KJONN"], r["ALDER"], r["INNVKAT"])][1] for r in rows)
    assert len(rows) == len(want)


def test_a_suppliers_cells_are_dealt_before_they_are_expanded(spark):
    cells = spark.createDataFrame([(None, None, None, 100000007, 2000, 1, "1_2", 1, 3, True, 12.0, 20.0, 1)], CELLS)
    text = plan(fx._cube_from_cells(cells, "INNVKAT", "innv", 3))
    suppliers = text[text.index("REPARTITION_BY_NUM") - 200:]
    assert ", 3), REPARTITION_BY_NUM" in suppliers
    assert text.count("Exchange ") == 2  # the suppliers' cells, and the areas' rows


def test_partitions_follow_the_lines(spark, tmp_path, monkeypatch):
    for name in ("orders", "customer", "nation", "supplier"):
        spark.range(1).write.parquet(f"{tmp_path}/{name}.parquet")
    spark.range(1000).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(fx, "LINES_PER_PART", 10)
    assert fx.partitions_for(spark, str(tmp_path)) == 100


def test_lines_are_joined_in_partitions_that_follow_their_number(spark, tmp_path, monkeypatch):
    tables = {"nation": ([(1, 0), (2, 1)], "n_nationkey int, n_regionkey int"),
              "customer": ([(10, 1, "BUILDING"), (11, 2, "MACHINERY"), (None, 1, "BUILDING")], "c_custkey bigint, c_nationkey int, c_mktsegment string"),
              "orders": ([(k, 10 + k % 2, f"199{k % 4}-02-03", f"{k % 5 + 1}-X") for k in range(40)] + [(None, 10, "1993-01-01", "1-X")],
                         "o_orderkey bigint, o_custkey bigint, o_orderdate string, o_orderpriority string"),
              "supplier": ([(0,)], "s_suppkey bigint"),
              "lineitem": ([(k % 50, k % 7, k % 7 + 1, float(k % 30), "RN"[k % 2], "FO"[k % 3 > 0], 0.05 * (k % 3)) for k in range(400)]
                           + [(None, 1, 1, 3.0, "R", "F", 0.0), (3, None, 1, None, None, None, None)],
                           "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string, l_discount double")}
    for name, (rows, schema) in tables.items():
        df = spark.createDataFrame(rows, schema)
        (df.withColumn("o_orderdate", df["o_orderdate"].cast("timestamp")) if name == "orders" else df).write.parquet(f"{tmp_path}/{name}.parquet")
    few = fx.fine_cells(spark, str(tmp_path))
    assert "REPARTITION_BY_NUM" not in plan(few)
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(fx, "LINES_PER_DEAL", 402 // (2 * cores))
    parts = fx.partitions_for(spark, str(tmp_path), fx.LINES_PER_DEAL)
    many = fx.fine_cells(spark, str(tmp_path))
    assert parts > cores and plan(many).count(f", {parts}), REPARTITION_BY_NUM") == 2  # lines and orders
    assert sorted(many.collect(), key=str) == sorted(few.collect(), key=str) and many.count() > 50


def test_attack_groups_by_digests_of_labels(spark):
    cube = spark.createDataFrame(
        [(1, "2000_2000", 0, 0, 1), (1, "2000_2000", 1, 1, 0), (1, "2000_2000", 2, 1, 0), (2, "2000_2000", 0, 1, 0), (2, "2000_2000", 1, 1, 0),
         (None, "2000_2000", 1, 1, 0), (None, "2000_2000", 2, 0, 1)], "GEO bigint, AAR string, KJONN bigint, pvern int, prikket_ok int")
    specs = spark.createDataFrame([("Stata_naboprKJONN", "{0,1,2}{1,2}"), ("Stata_naboprAAR", "{9}")], "Kolonne string, Innhold string")
    sets = spark.createDataFrame([("{1,2}", "1"), ("{1,2}", "2")], "set_label string, level string")
    out = checks.attack_naboprikk(cube, specs, sets)
    assert sorted(out.collect(), key=str) == sorted(
        [("1", "2000_2000", "{0,1,2}"), (None, "2000_2000", "{0,1,2}"), (None, "2000_2000", "{1,2}"), ("{1,2}", "2000_2000", "0")], key=str)
    text = plan(out)
    partial = text[text.index("partial_sum"):]
    assert "set_label" not in partial[:partial.index("BroadcastHashJoin")] and "sha2(" in text


def test_csv_schema_is_as_wide_as_the_files(spark, tmp_path):
    from cubeguard.operators import extract_files as ef
    for name, text in (("A_2024-01-01-00-00", "GEO;AAR;MEIS\n1;2000_2000;3\n"), ("B_2024-01-01-00-00", '﻿MEIS;"GEO";AAR;ALDER;KJONN\n5;2;2001_2001;"1;2";0\n')):
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
    assert ef.csv_columns(spark, str(tmp_path)) == 6
    rows = ef.read_csv_by_name(spark, str(tmp_path), lambda v: ef.F.array_contains(v, "MEIS"))
    got = {r["cube"]: (r["names"], r["values"][:len(r["names"])]) for r in rows.collect()}
    assert got == {"A_2024-01-01-00-00": (["GEO", "AAR", "MEIS"], ["1", "2000_2000", "3"]),
                   "B_2024-01-01-00-00": (["MEIS", "GEO", "AAR", "ALDER", "KJONN"], ["5", "2", "2001_2001", "1;2", "0"])}

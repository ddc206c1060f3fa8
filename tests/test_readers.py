"""Readers, renames, version lookup and sinks."""

import os
import tempfile

import pytest

from cubeguard.sources import cubes, sinks


def _write(path, text):
    with open(path, "w", encoding="utf-8-sig") as f:   # UTF-8 with BOM, as the reference's files
        f.write(text)


def test_read_csv_with_renames_and_types(spark):
    d = tempfile.mkdtemp(prefix="cg-read-")
    p = os.path.join(d, "rename.csv")
    _write(p, "antall;Crude;Adjusted;sumTELLER;sumNEVNER;smr;Utdanningsnivå\n0;0;0;0;0;0;0\n")
    df, ref = cubes.read_cube(spark, p)
    assert df.columns == ["TELLER", "RATE", "MEIS", "sumTELLER", "sumNEVNER", "SMR", "UTDANN"]
    assert dict(df.dtypes)["UTDANN"] == "bigint" and dict(df.dtypes)["RATE"] == "double"
    assert ("antall", "TELLER") in ref.renamed


def test_bad_numbers_become_null(spark):
    d = tempfile.mkdtemp(prefix="cg-read-")
    p = os.path.join(d, "c_2024-01-01-00-00.csv")
    _write(p, "GEO;AAR;TELLER;SPVFLAGG\n301;2024_2024;x;0\n")
    df, ref = cubes.read_cube(spark, p)
    r = df.first()
    assert r.GEO == 301 and r.AAR == "2024_2024" and r.TELLER is None and r.SPVFLAGG == 0
    assert ref.name == "c" and ref.datetag == "2024-01-01-00-00"


def test_find_cube(spark):
    root = tempfile.mkdtemp(prefix="cg-root-")
    os.makedirs(f"{root}/QC")
    os.makedirs(f"{root}/DATERT/csv")
    _write(f"{root}/QC/QC_A_2024-01-01-00-00.csv", "GEO\n1\n")
    _write(f"{root}/QC/QC_A_2024-01-01-00-00.parquet", "")
    _write(f"{root}/DATERT/csv/B_2024-01-01-00-00.csv", "GEO\n1\n")
    _write(f"{root}/DATERT/csv/B_2024-01-01-00-00x.csv", "GEO\n1\n")
    assert cubes.find_cube(spark, "A_2024-01-01-00-00", root).endswith(".parquet")
    with pytest.raises(ValueError, match="> 1 file"):
        cubes.find_cube(spark, "B_2024-01-01-00-00", root)
    with pytest.raises(FileNotFoundError):
        cubes.find_cube(spark, "C_2024-01-01-00-00", root)


def test_forbidden_outcols(spark):
    df = spark.createDataFrame([(1, 2.0)], "GEO bigint, TELLER double")
    ref = cubes.CubeRef("x", "ikkegeoprikket_X_2024-01-01-00-00.csv", "Other", "New")
    assert [r.column for r in cubes.forbidden_outcols(df, ref).collect()] == ["TELLER"]


def test_sinks(spark):
    out = tempfile.mkdtemp(prefix="cg-out-")
    df = spark.createDataFrame([(1, "2020_2020", 1.234)], "GEO bigint, AAR string, RATE double")
    sinks.save_table(df, out, "CUBE", "coverage", "2024-01-01-00-00")
    back = sinks.read_table(spark, out, "CUBE", "coverage", "2024-01-01-00-00", df.schema)
    assert [tuple(r) for r in back.collect()] == [(1, "2020_2020", 1.234)]
    name = sinks.dump_name("comparecube", "CUBE", "t1", "CUBE", "t0")
    assert name == "compare_CUBE_t1_vs_t0"
    p = sinks.save_dump(df, out, name)
    assert spark.read.parquet(p).first().RATE == 1.23


def test_tables_are_committed_by_one_rename(spark):
    """A reader sees the old table until the new one is whole; a failed write leaves it alone; old files can go."""
    path = tempfile.mkdtemp(prefix="cg-commit-") + "/t"
    first, second = spark.range(5), spark.range(7)
    sinks.commit_table(first, path)
    before = spark.read.parquet(sinks.committed_path(spark, path))
    with pytest.raises(Exception, match="no"):
        sinks.commit_table(first.selectExpr("if(id > 2, raise_error('no'), id) as id"), path)
    assert spark.read.parquet(sinks.committed_path(spark, path)).count() == 5
    sinks.commit_table(second, path)
    assert spark.read.parquet(sinks.committed_path(spark, path)).count() == 7 and before.count() == 5
    assert sinks.drop_old_versions(spark, path) == 2 and spark.read.parquet(sinks.committed_path(spark, path)).count() == 7


def test_dumps_have_a_file_for_each_range(spark):
    """Not one for each task and period."""
    from cubeguard.operators.levels import duplicate_keys
    df = spark.range(4000).selectExpr("id % 200 as GEO", "concat(2000 + id div 200, '_', 2000 + id div 200) as AAR", "id * 1.0D as RATE").repartition(16)
    p = sinks.save_dump(df, tempfile.mkdtemp(prefix="cg-dump-"), "compare_x")
    files = [f for f in os.listdir(p) if f.endswith(".parquet")]
    assert len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    back = spark.read.parquet(p)
    assert back.count() == 4000 and duplicate_keys(back, ["GEO", "AAR"]).count() == 0


def test_find_by_datetag(spark):
    root = tempfile.mkdtemp(prefix="cg-tag-")
    os.makedirs(f"{root}/parquet")
    os.makedirs(f"{root}/csv")
    _write(f"{root}/csv/A_2024-01-01-00-00.csv", "x\n")
    _write(f"{root}/csv/B_2024-01-01-00-00.csv", "x\n")
    hits = cubes.find_by_datetag(spark, [f"{root}/parquet", f"{root}/csv"], "2024-01-01-00-00", "B")
    assert [h.rsplit("/", 1)[-1] for h in hits] == ["B_2024-01-01-00-00.csv"]
    _write(f"{root}/parquet/A_2024-01-01-00-00.parquet", "")
    hits = cubes.find_by_datetag(spark, [f"{root}/parquet", f"{root}/csv"], "2024-01-01-00-00")
    assert [h.rsplit("/", 1)[-1] for h in hits] == ["A_2024-01-01-00-00.parquet"]


def test_read_extracts(spark):
    from cubeguard.operators.extracts import etab_predicate, read_extracts
    d = tempfile.mkdtemp(prefix="cg-ext-")
    _write(f"{d}/IND_A_2024-01-01-00-00.csv", "GEO;AAR;KJONN;ETAB;MEIS\n301;2024_2024;0;GEO > 0;1.5\n")
    _write(f"{d}/IND_B_2024-01-01-00-00.csv", "GEO;AAR;KJONN;ETAB;MEIS\n301;2024_2024;1;;\n")
    df = read_extracts(spark, d)
    got = sorted((r.Friskvik, r.GEO, r.KJONN, r.MEIS) for r in df.collect())
    assert got == [("IND_A_2024-01-01-00-00.csv", 301, 0, 1.5), ("IND_B_2024-01-01-00-00.csv", 301, 1, None)]
    df = spark.createDataFrame([(0, 1, None, "a"), (5, 2, 1.5, "b c"), (7, 3, -2.0, "d")], "GEO long, KJONN long, `RATE.n` double, x string")
    for text, want in [("GEO > 0 & KJONN == 2", [5]), ("KJONN %in% c(1, 3)", [0, 7]), ("is.na(RATE.n) | GEO >= 7", [0, 7]),
                       ("!is.na(RATE.n) && !(x %in% c('b c'))", [7]), ("RATE.n < -1.5", [7]), ('GEO==0||x!="d"&GEO<6', [0, 5])]:
        assert [r.GEO for r in df.where(etab_predicate(text)).orderBy("GEO").collect()] == want, text
    for text in ("java_method('java.lang.Math','max',1,2) == '2'", "GEO > ", "GEO > 0)", "GEO > KJONN", "GEO > 0 GEO", "", "x == 'a",
                 "GEO > 0; drop", "c(1) %in% GEO", "is.na(is.na(GEO))", "reflect('a') == 1"):
        with pytest.raises(ValueError):
            etab_predicate(text)
    with pytest.raises(ValueError):
        etab_predicate("system('rm'); 1")


def test_geotriangles(spark):
    from cubeguard.operators.geo import add_geotriangles
    sets = spark.createDataFrame([("FK", ["F", "K"]), ("KB", ["K", "B"]), ("LF", ["L", "F"])],
                                 "name string, levels array<string>")
    got = sorted(r.name for r in add_geotriangles(sets, ["L", "F", "K"]).collect())
    assert got == ["FK", "LF"]


def test_convert_coltype(spark):
    df = spark.createDataFrame([("0",), ("1",), ("x",)], "c string")
    assert [r.c for r in cubes.convert_coltype(df, ["c"], "numeric").collect()] == [0.0, 1.0, None]
    df = spark.createDataFrame([(1,), (2,)], "c bigint")
    assert [r.c for r in cubes.convert_coltype(df, ["c"], "character").collect()] == ["1", "2"]
    with pytest.raises(ValueError):
        cubes.convert_coltype(df, ["c"], "date")


def test_load_pair_and_dumps(spark):
    from cubeguard.plans.comparison import make_comparecube
    root = tempfile.mkdtemp(prefix="cg-pair-")
    os.makedirs(f"{root}/QC")
    _write(f"{root}/QC/C_2024-01-01-00-00.csv", "GEO;AAR;KJONN;antall;SPVFLAGG\n0;2023_2023;0;5;0\n1101;2023_2023;0;3;0\n")
    _write(f"{root}/QC/C_2023-01-01-00-00.csv", "GEO;AAR;KJONN;antall;SPVFLAGG\n0;2023_2023;0;4;0\n1199;2023_2023;0;3;0\n")
    codemap = spark.createDataFrame([(1199, 1101)], "old bigint, current bigint")
    pop = spark.createDataFrame([(0, "L", 100.0), (1101, "K", 50.0)], "GEO bigint, GEOniv string, WEIGHTS double")
    (new, nref), (old, oref) = cubes.load_pair(spark, "C_2024-01-01-00-00", root, "C_2023-01-01-00-00",
                                              recode_old=True, codemap=codemap, popinfo=pop)
    assert sorted(r.GEO for r in old.collect()) == [0, 1101]
    res = make_comparecube(new, old, outliers=False)
    got = {r.GEO: r.TELLER_diff for r in res.comparecube.collect()}
    assert got == {0: 1.0, 1101: 0.0}
    from cubeguard.sources.sinks import save_dumps
    out = tempfile.mkdtemp(prefix="cg-dump-")
    written = save_dumps(res, out, nref, oref)
    assert sorted(written) == ["compare_C_2024-01-01-00-00_vs_2023-01-01-00-00", "newflag_C_2024-01-01-00-00",
                               "oldflag_C_2023-01-01-00-00"]


def test_update_internal_data(spark):
    from cubeguard.sources.lookups import update_internal_data
    df = spark.createDataFrame([(1,)], "GEO bigint")
    out = tempfile.mkdtemp(prefix="cg-lk-")
    got = update_internal_data(df, df, df, out)
    assert sorted(got) == ["georecode", "popinfo", "validgeo"]
    assert spark.read.parquet(f"{out}/validgeo").count() == 1


def test_extract_files_end_to_end(spark):
    from pyspark.sql import functions as F
    from cubeguard.operators.extract_files import check_extract_files
    root = tempfile.mkdtemp(prefix="cg-fv-")
    for d in ("ext", "cubes/parquet", "cubes/csv", "specs"):
        os.makedirs(f"{root}/{d}")
    tag = "2024-05-01-10-00"
    _write(f"{root}/ext/IND_A_{tag}.csv", "GEO;AAR;KJONN;MEIS\n301;2023_2023;0;1.5\n1101;2023_2023;0;\n")
    _write(f"{root}/ext/IND_X_{tag}.csv", "GEO;AAR;KJONN;MEIS\n301;2023_2023;0;1.5\n")
    _write(f"{root}/cubes/csv/CUBEA_{tag}.csv",
           "GEO;AAR;KJONN;RATE;SPVFLAGG\n301;2023_2023;0;1.5;0\n1101;2023_2023;0;;3\n301;2023_2023;1;2.0;0\n")
    _write(f"{root}/specs/CUBEA_{tag}.csv", "Tabell;Kolonne;Innhold\nKUBER;REFVERDI_VP;P\n")
    control = spark.createDataFrame(
        [("FHP", "2024", "K", "IND_A", "CUBEA", "2023", "2023", "per 1000 (ak)"),
         ("FHP", "2024", "K", "IND_X", "NOCUBE", "2023", "2023", "x")],
        "PROFILTYPE string, AARGANG string, MODUS string, INDIKATOR string, KUBE_NAVN string, "
        "Periode_bm string, Periode_nn string, Enhet string")
    published = spark.createDataFrame([(f"CUBEA_{tag}",)], "file string")
    rep = {r.Friskvik: r for r in check_extract_files(
        spark, f"{root}/ext", [f"{root}/cubes/parquet", f"{root}/cubes/csv"], f"{root}/specs", control,
        published, "FHP", "K", 2024).collect()}
    a = rep[f"IND_A_{tag}.csv"]
    assert a.IDENTISK_PRIKKING == "Yes" and a.MATCHER_KOLONNE == "RATE" and a.SISTE_AAR == "Yes"
    assert a.FIL_I_STATBANK == "TRUE" and a.REFVERDI_VP == "P" and a.KUBE_KJONN == "0"
    assert a.VALID_kombo == "!! No!!" and a.ALT_OK == "!! KANSKJE IKKE !!"
    assert rep[f"IND_X_{tag}.csv"].ALT_OK == "not_loaded"
    del F


def test_long_codes_are_not_read_through_doubles(spark):
    df = spark.createDataFrame([("9007199254740993",), ("12.0",), ("x",), (None,), ("1e3",)], "GEO string")
    assert [r.GEO for r in cubes.type_columns(df).collect()] == [9007199254740993, 12, None, None, 1000]


def test_filters_reach_the_scan(spark):
    """Columns that have their type already are not cast, so filters are pushed down."""
    root = tempfile.mkdtemp(prefix="cg-push-")
    df = spark.createDataFrame([(0, "2020_2020", 1.5, 3), (1, "2020_2020", 7.0, 0)], "GEO long, AAR string, RATE double, SPVFLAGG int")
    df.write.parquet(f"{root}/C_2024-01-01-00-00.parquet")
    cube, _ = cubes.read_cube(spark, f"{root}/C_2024-01-01-00-00.parquet")
    assert dict(cube.dtypes) == {"GEO": "bigint", "AAR": "string", "RATE": "double", "SPVFLAGG": "bigint"}
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = cube.where("GEO = 0 AND RATE > 1 AND SPVFLAGG = 3")._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert all(f in pushed for f in ("EqualTo(GEO,0)", "GreaterThan(RATE,1.0)", "EqualTo(SPVFLAGG,3)"))


def test_cluster_needs_a_shared_folder():
    from cubeguard.session import ensure_checkpoint_dir

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_extract_files_of_two_cubes_in_one_plan(spark):
    """Files of different columns and kinds, a byte order mark, an extract that lacks a dimension, one without a cube."""
    from cubeguard.operators.extract_files import check_extract_files, read_extract_files
    root = tempfile.mkdtemp(prefix="cg-two-")
    for d in ("ext", "cubes/parquet", "cubes/csv", "specs"):
        os.makedirs(f"{root}/{d}")
    a, b = "2024-05-01-10-00", "2024-06-01-10-00"
    _write(f"{root}/ext/IND_A_{a}.csv", "\ufeffGEO;AAR;KJONN;MEIS\n301;2023_2023;0;1.5\n1101;2023_2023;0;\n")
    _write(f"{root}/ext/IND_X_{a}.csv", "GEO;AAR;KJONN;MEIS\n301;2023_2023;0;1.5\n")
    _write(f"{root}/ext/IND_B_{b}.csv", "ETAB;AAR;GEO;ALDER;MEIS\nGEO > 100;2022_2022;301;0_17;7\nGEO > 100;2022_2022;302;0_17;8\n")
    _write(f"{root}/ext/IND_C_{b}.csv", "AAR;GEO;MEIS\n2022_2022;301;3\n2022_2022;302;4\n")
    _write(f"{root}/cubes/csv/CUBEA_{a}.csv", "GEO;AAR;KJONN;Crude;SPVFLAGG\n301;2023_2023;0;1.5;0\n1101;2023_2023;0;;3\n301;2023_2023;1;2.0;0\n")
    spark.createDataFrame([(301, "2022_2022", "0_17", 0, 7.0, 1.0, 0), (302, "2022_2022", "0_17", 0, 8.0, 1.0, 0), (301, "2022_2022", "0_17", 5, 9.0, 1.0, 0),
                           (301, "2022_2022", "18_99", 0, 3.0, 2.0, 0), (302, "2022_2022", "18_99", 0, 4.0, 4.0, 0), (301, "2021_2021", "0_17", 0, 1.0, 1.0, 0)],
                          "GEO long, AAR string, ALDER string, UTDANN long, MEIS double, antall double, SPVFLAGG long").write.parquet(f"{root}/cubes/parquet/CUBEB_{b}.parquet")
    _write(f"{root}/specs/CUBEA_{a}.csv", "Tabell;Kolonne;Innhold\nKUBER;REFVERDI_VP;P\n")
    control = spark.createDataFrame([("FHP", "2024", "K", i, c, "2023", n, "per 1000 (ak)") for i, c, n in
                                     (("IND_A", "CUBEA", "2023"), ("IND_X", "NOCUBE", "2023"), ("IND_B", "CUBEB", "2023"), ("IND_C", "CUBEB", ""))],
                                    "PROFILTYPE string, AARGANG string, MODUS string, INDIKATOR string, KUBE_NAVN string, Periode_bm string, Periode_nn string, Enhet string")
    published = spark.createDataFrame([(f"CUBEA_{a}",)], "file string")
    rows = read_extract_files(spark, f"{root}/ext").where("GEO = 301").collect()
    assert {(r.Friskvik[:5], tuple(r["__edims"]), r.MEIS) for r in rows} == {
        ("IND_A", ("GEO", "AAR", "KJONN"), 1.5), ("IND_X", ("GEO", "AAR", "KJONN"), 1.5), ("IND_B", ("AAR", "GEO", "ALDER"), 7.0), ("IND_C", ("AAR", "GEO"), 3.0)}
    report = check_extract_files(spark, f"{root}/ext", [f"{root}/cubes/parquet", f"{root}/cubes/csv"], f"{root}/specs", control, published, "FHP", "K", 2024)
    rep = {r.Friskvik[:5]: r for r in report.collect()}
    one = rep["IND_A"]
    assert (one.Kube, one.IDENTISK_PRIKKING, one.MATCHER_KOLONNE, one.REFVERDI_VP, one.FIL_I_STATBANK, one.KUBE_KJONN, one.KUBE_ALDER) == (
        f"CUBEA_{a}.csv", "Yes", "RATE", "P", "TRUE", "0", None)
    two = rep["IND_B"]
    assert (two.Kube, two.MATCHER_KOLONNE, two.Different_kubecol, two.KUBE_UTDANN, two.KUBE_ALDER, two.FRISKVIK_ETAB, two.SISTE_AAR, two.FIL_I_STATBANK) == (
        f"CUBEB_{b}.parquet", "MEIS", "TELLER", "0", "0_17", "GEO > 100", "Yes", "FALSE")
    three = rep["IND_C"]  # no ALDER: all ages are asked for, so each area is held twice in the cube
    assert (three.KUBE_ALDER, three.IDENTISK_PRIKKING, three.Periode_nn, three.REFVERDI_VP) == (
        "0_17, 18_99", "!!NO!! Diff for GEO: 301, 302", "!! empty", "!! MISSING from SPECS-file")
    assert rep["IND_X"].ALT_OK == "not_loaded" and rep["IND_X"].Kube is None

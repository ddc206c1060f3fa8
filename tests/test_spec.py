"""Column roles, priorities, rounding policy and ids."""

import pytest
from pyspark.sql import functions as F

from cubeguard.functions.exprs import qc_round
from cubeguard.spec import (
    CubeSpec, find_total, get_cubedatetag, get_cubefilename, get_cubename, check_readfiles_args,
    identify_coltypes, rounding_digits, select_diffval_pri, select_nevner_pri, select_outlier_pri,
    select_teller_pri,
)

NEW = ["GEO", "AAR", "KJONN", "ALDER", "UTDANN", "INNVKAT", "TELLER", "RATE", "SMR", "sumTELLER", "sumNEVNER",
       "RATE.n", "SPVFLAGG", "TELLER_uprikk", "GEOniv", "WEIGHTS", "pvern"]
OLD = ["GEO", "AAR", "KJONN", "ALDER", "LANDBAK", "RATE", "SMR", "MEIS", "SPVFLAGG", "origgeo"]


def test_identify_coltypes_eleven_lists():
    r = identify_coltypes(NEW, OLD)
    assert r.dims_new == ["GEO", "AAR", "KJONN", "ALDER", "UTDANN", "INNVKAT"]
    assert r.vals_new == ["TELLER", "RATE", "SMR", "sumTELLER", "sumNEVNER", "RATE.n", "SPVFLAGG", "TELLER_uprikk"]
    assert r.dims_old == ["GEO", "AAR", "KJONN", "ALDER", "LANDBAK"]
    assert r.vals_old == ["RATE", "SMR", "MEIS", "SPVFLAGG"]
    assert r.commondims == ["GEO", "AAR", "KJONN", "ALDER"]
    assert r.commonvals == ["RATE", "SMR", "SPVFLAGG"]
    assert r.commoncols == r.commondims + r.commonvals
    assert r.newdims == ["UTDANN", "INNVKAT"] and r.expdims == ["LANDBAK"]
    assert r.newvals == ["TELLER", "sumTELLER", "sumNEVNER", "RATE.n", "TELLER_uprikk"]
    assert r.expvals == ["MEIS"]
    assert len([f for f in vars(r)]) == 11


def test_priorities():
    """The best column wins wherever it stands; names that only resemble one do not count."""
    assert select_teller_pri(["NEVNER", "TELLER", "GEO", "sumTELLER"]) == "sumTELLER"
    assert select_teller_pri(["TELLER", "xTELLER_uprikk", "TELLER_uprikk"]) == "TELLER_uprikk"
    assert select_teller_pri(["TELLER_uprikk", "sumTELLER_uprikk", "sumTELLER"]) == "sumTELLER_uprikk"
    assert select_nevner_pri(["TELLER", "NEVNER", "NEVNER_uprikk"]) == "NEVNER_uprikk"
    assert select_teller_pri(["teller", "NEVNER"]) is None and select_nevner_pri([]) is None
    assert select_outlier_pri(["GEO", "SMR", "RATE"]) == select_outlier_pri(NEW, OLD) == "RATE"
    assert select_outlier_pri(["GEO", "SPVFLAGG"]) is None
    assert select_diffval_pri(["AAR", "SMR_diff", "RATE_diff", "RATE_reldiff"]) == "RATE_diff"


@pytest.mark.parametrize("name, digits", [
    ("sumNEVNER_uprikk", 1), ("NEVNER_old", 1), ("TELLER_reldiff", 2), ("SMR_diff", 2), ("change_wq75", 2), ("change_LOW", 2),
    ("RATE.n_new", 0), ("SPVFLAGG_old", 0), ("ALDER", None), ("WEIGHTS", None),
    ("RATE_sumdiff", 2), ("TELLER_uprikk_ndiff", 1), ("change_wq25", 2), ("wqxx", None), ("NEVNER_reldiff", 2), ("SPVFLAGG_reldiff", 0), ("MINABOVELOW", 2)])
def test_rounding_by_name(spark, name, digits):
    """Ties go to the even digit, negatives like positives, NULL stays NULL."""
    assert rounding_digits(name) == digits
    values = [None, -2.675, 0.125, 0.375, 2.5, -3.5, 1e6 + 0.25]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, `{name}` double")
    got = [r[1] for r in qc_round(df.select(F.col(f"`{name}`").cast("double").alias(name), "k")).select("k", f"`{name}`").orderBy("k").collect()]
    want = [None if v is None else v if digits is None else round(v * 10 ** digits) / 10 ** digits for v in values]
    assert got == want


def test_round_half_even(spark):
    from cubeguard.functions.exprs import round_half_even
    r = spark.range(1).select(round_half_even(F.lit(2.5), 0).alias("a"), round_half_even(F.lit(3.5), 0).alias("b"),
                              round_half_even(F.lit(0.125), 2).alias("c")).collect()[0]
    assert (r.a, r.b, r.c) == (2.0, 4.0, 0.12)


def test_cube_ids():
    f = "QC_LINES_OF_2_5_2025-01-31-23-59.parquet"
    assert get_cubename(f) == get_cubename(f.removeprefix("QC_").replace(".parquet", ".csv")) == "LINES_OF_2_5"
    assert get_cubedatetag(f) == "2025-01-31-23-59"
    assert get_cubefilename(f) == "LINES_OF_2_5_2025-01-31-23-59"
    assert get_cubename("PLAIN.csv") == get_cubename("PLAIN") == "PLAIN"


def test_readfiles_args():
    check_readfiles_args("CUBE_2025-02-25-08-47")
    check_readfiles_args("CUBE_2025-02-25-08-47.csv", "CUBE_2024-01-01-00-00")
    with pytest.raises(ValueError):
        check_readfiles_args("CUBE_2025-02-25")
    with pytest.raises(ValueError):
        check_readfiles_args(None)
    with pytest.raises(ValueError):
        check_readfiles_args("CUBE_2025-02-25-08-47", "OLD")
    with pytest.raises(TypeError):
        check_readfiles_args("CUBE_2025-02-25-08-47", recode_new="yes")


def test_find_total_of_the_driver_cube(spark):
    """Zero is a numeric dimension's total, the widest band the age dimension's."""
    from cubeguard.sources import fixtures as fx
    cube = fx.fixture_new(spark, "/root/testdata/sf0.001")
    assert [find_total(cube, d) for d in ("GEO", "KJONN", "INNVKAT", "ALDER")] == [0, 0, 0, "1_7"]
    assert find_total(cube.where("KJONN > 0"), "KJONN") is None
    assert find_total(cube.where("ALDER <> '1_7'"), "ALDER") is None
    assert find_total(cube.where("ALDER IN ('1_2', '1_7', '5_7')"), "ALDER") == "1_7"


def test_added_dimension_is_a_role():
    spec = CubeSpec().with_dims("INNVAND")
    assert identify_coltypes(["GEO", "INNVAND", "RATE"], spec=spec).dims_new == ["GEO", "INNVAND"]
    assert identify_coltypes(["GEO", "INNVAND", "RATE"]).dims_new == ["GEO"]


def test_total_band_without_gathering_levels(spark):
    from cubeguard.spec import find_totals
    for levels, want in ((["0_17", "18_99", "0_99"], "0_99"), (["0_17", "18_99"], None), (["0_99", "00_120", "5_120"], None), (["x", None, "7_7"], "7_7"), ([None], None)):
        df = spark.createDataFrame([(x,) for x in levels], "ALDER string")
        assert find_totals(df, ["ALDER"])["ALDER"] == want, levels

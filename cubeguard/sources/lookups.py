"""Lookup builders L1-L5: code map, geo parameters, dimension list, valid codes."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeguard.spec import STANDARD_DIMS

# Health regions added to the geo parameters with weight 0
HEALTH_REGIONS = (81, 82, 83, 84)
# Levels of the valid-code register that are kept
VALID_LEVELS = ("fylke", "kommune", "bydel", "levekaar")


def update_georecode(municipality_codes: DataFrame, county_codes: DataFrame) -> DataFrame:
    """L1: (old, current) pairs from the municipality and county code
    tables (oldCode, currentCode), keeping real changes only."""
    both = (municipality_codes.select("oldCode", "currentCode")
            .unionByName(county_codes.select("oldCode", "currentCode")))
    return (both.select(F.col("oldCode").alias("old"), F.col("currentCode").alias("current"))
            .where(F.col("old").isNotNull() & (F.col("old") != F.col("current"))))


def update_popinfo(popcube: DataFrame, total_age: str = "0_120", total_sex=0,
                   extra_filter=None) -> DataFrame:
    """L2: geo parameters from a population cube: all ages, both sexes,
    latest period; (GEO, GEOniv, WEIGHTS = TELLER) plus the health regions
    with weight 0.  The latest period is a scalar subquery (no collect)."""
    d = popcube.where((F.col("ALDER") == total_age) & (F.col("KJONN") == total_sex))
    if extra_filter is not None:
        d = d.where(extra_filter)
    latest = d.agg(F.max("AAR")).scalar()
    d = d.where(F.col("AAR") == latest).select(
        F.col("GEO").cast("bigint").alias("GEO"), F.col("GEOniv"), F.col("TELLER").cast("double").alias("WEIGHTS"))
    spark = popcube.sparkSession
    h = spark.createDataFrame([(g, "H", 0.0) for g in HEALTH_REGIONS], "GEO bigint, GEOniv string, WEIGHTS double")
    return d.unionByName(h)


def update_dimlist(filgrupper: DataFrame, at=None) -> DataFrame:
    """L3: sorted distinct dimension names: TAB1..TAB3 of the file groups
    valid at ``at`` (default now) plus the standard dimensions."""
    at = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    valid = filgrupper.where((F.col("VERSJONFRA") <= at) & (F.col("VERSJONTIL") > at))
    tabs = valid.select(F.explode(F.array("TAB1", "TAB2", "TAB3")).alias("dim")).where(F.col("dim").isNotNull())
    spark = filgrupper.sparkSession
    std = spark.createDataFrame([(d,) for d in STANDARD_DIMS], "dim string")
    return tabs.unionByName(std).distinct().orderBy("dim")


def update_validgeo(tblgeo: DataFrame, year) -> DataFrame:
    """L4: area codes valid in ``year`` at the county / municipality /
    district / living-condition levels, plus 0 (the country), sorted."""
    codes = tblgeo.where((F.col("validTO") == F.lit(str(year))) & F.col("level").isin(*VALID_LEVELS)) \
        .select(F.col("code").cast("bigint").alias("GEO"))
    spark = tblgeo.sparkSession
    return codes.unionByName(spark.createDataFrame([(0,)], "GEO bigint")).orderBy("GEO")


def update_internal_data(validgeo: DataFrame, popinfo: DataFrame, georecode: DataFrame,
                         out_dir: str | None = None) -> dict:
    """The three lookups together; written as parquet when ``out_dir`` is given."""
    out = {"validgeo": validgeo, "popinfo": popinfo, "georecode": georecode}
    if out_dir:
        for k, df in out.items():
            df.write.mode("overwrite").parquet(f"{out_dir}/{k}")
    return out

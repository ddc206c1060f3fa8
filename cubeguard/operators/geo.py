"""Geography operators G1-G7."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeguard.functions.exprs import (
    geo_code_text, geo_label, geo_level_from_code, parent_name,
)
from cubeguard.functions.joins import checked_broadcast
from cubeguard.spec import col


def recode_geo(df: DataFrame, codemap: DataFrame, geo: str = "GEO") -> DataFrame:
    """G1: replace outdated area codes by current ones, keeping ``origgeo``.

    ``codemap`` has columns (old, current).  Left join to the size-checked
    broadcast map; codes absent from the map are kept.
    """
    m = checked_broadcast(codemap.select(F.col("old").cast("bigint").alias("__old"),
                                         F.col("current").cast("bigint").alias("__cur")))
    out = df.withColumn("origgeo", F.col(geo))
    out = out.join(m, out[geo] == m["__old"], "left")
    return (out.withColumn(geo, F.coalesce(F.col("__cur"), F.col(geo)).cast(df.schema[geo].dataType))
            .drop("__old", "__cur"))


def recode_report(df: DataFrame, codemap: DataFrame, geo: str = "GEO") -> DataFrame:
    """G1 report: number of recoded codes and rows that end up on a 99-code."""
    m = checked_broadcast(codemap.select(F.col("old").cast("bigint").alias("__old"),
                                         F.col("current").cast("bigint").alias("__cur")))
    j = df.join(m, df[geo] == m["__old"], "left")
    return j.agg(F.count_distinct(F.col("__old")).alias("recoded_codes"),
                 F.count_if(geo_code_text(F.coalesce(F.col("__cur"), F.col(geo))).endswith("99"))
                 .alias("rows_on_99_codes"))


def add_geoparams(df: DataFrame, popinfo: DataFrame, geo: str = "GEO") -> DataFrame:
    """Add GEOniv and WEIGHTS from the geo parameter table.

    Missing levels come from the number of digits of the code; missing
    weights become 0.  The parameter table has one row per area code (its
    size is bounded by the number of areas) and is broadcast after a check.
    """
    p = checked_broadcast(popinfo.select(F.col("GEO").cast("bigint").alias("__g"),
                                         F.col("GEOniv").alias("__niv"),
                                         F.col("WEIGHTS").cast("double").alias("__w"))
                          .dropDuplicates(["__g"]))
    out = df.join(p, df[geo].cast("bigint") == p["__g"], "left")
    return (out.withColumns({
        "GEOniv": F.coalesce(F.col("__niv"), geo_level_from_code(F.col(geo))),
        "WEIGHTS": F.coalesce(F.col("__w"), F.lit(0.0)),
    }).drop("__g", "__niv", "__w"))


def split_kommuneniv(df: DataFrame, threshold: float = 10000.0, geo: str = "GEO") -> DataFrame:
    """Municipalities with weight < threshold become level ``k``.

    Codes ending in 99 stay ``K``.
    """
    if "GEOniv" not in df.columns or "WEIGHTS" not in df.columns:
        return df
    small = ((F.col("GEOniv") == F.lit("K")) & (F.col("WEIGHTS") < F.lit(float(threshold)))
             & ~geo_code_text(F.col(geo)).endswith("99"))
    return df.withColumn("GEOniv", F.when(small, F.lit("k")).otherwise(F.col("GEOniv")))


def translate_geoniv(df: DataFrame) -> DataFrame:
    """Level codes to labels (Land, Fylke, Kommune, Bydel, Levekaar)."""
    if "GEOniv" not in df.columns:
        raise ValueError("GEOniv column not present")
    return df.withColumn("GEOniv", geo_label(F.col("GEOniv")))


def add_kommune(df: DataFrame, parents: dict, geo: str = "GEO") -> DataFrame:
    """KOMMUNE = parent city name for the city rows and their district rows."""
    return df.withColumn("KOMMUNE", parent_name(F.col(geo), F.col("GEOniv"), parents))


def exclude_lks_for_compare(df: DataFrame) -> DataFrame:
    """Drop living-condition areas (level V) before comparing."""
    if df is None or "GEOniv" not in df.columns:
        return df
    return df.where(~F.col("GEOniv").eqNullSafe(F.lit("V")))


#: Digits of an area code by level (zero-padded); a parent's code is the front of its children's.
LEVEL_DIGITS = {"L": 0, "F": 2, "K": 4, "B": 6, "V": 10}
#: The pairs of levels, parent first, whose areas add up.
LEVEL_PAIRS = ("LF", "FK", "KB", "BV")


def area_parents(areas: DataFrame, pairs=LEVEL_PAIRS, geo: str = "GEO", level: str = "GEOniv") -> DataFrame:
    """(pair, parent, child): the prefix tree of the area codes, a row for each link of the ``pairs`` of levels.

    Codes are zero-padded to their level's digits, so a child's parent on a level is
    found by one equality join on the front of its code; the country is every county's
    parent.  Only areas that are there are linked, so a pair of which one level is
    missing gives no row.  Small municipalities (``k``) count as municipalities.
    """
    niv = F.when(F.col(level) == "k", "K").otherwise(F.col(level))
    one = areas.where(col(geo).isNotNull()).select(col(geo).cast("bigint").alias("code"), niv.alias("niv")).distinct()
    digits = F.create_map(*[F.lit(x) for kv in LEVEL_DIGITS.items() for x in kv])
    padded = F.when(F.col("niv") == "L", F.lit("")).otherwise(F.lpad(F.col("code").cast("string"), digits[F.col("niv")], "0"))
    one = one.where(F.col("niv").isin(*LEVEL_DIGITS)).withColumn("key", padded)
    links = F.array(*[F.struct(F.lit(p).alias("pair"), F.lit(p[0]).alias("up"), F.lit(p[1]).alias("down"), F.lit(LEVEL_DIGITS[p[0]]).alias("n")) for p in pairs])
    down = one.select("code", "niv", "key", F.explode(links).alias("x")).where(F.col("niv") == F.col("x.down"))
    down = down.select(F.col("code").alias("child"), "x.pair", "x.up", F.substring(F.col("key"), F.lit(1), F.col("x.n")).alias("front"))
    return (down.join(one, (F.col("up") == F.col("niv")) & (F.col("front") == F.col("key")))
            .select("pair", F.col("code").alias("parent"), "child"))


def area_sets(areas: DataFrame, pairs=LEVEL_PAIRS, geo: str = "GEO", level: str = "GEOniv") -> DataFrame:
    """(pair, levels, set_label): the additive set ``{parent,child,...}`` of each parent area.

    A label holds the children of one area, as many as the digits between two levels
    allow (at most 10,000), in order of their codes.
    """
    links = area_parents(areas, pairs, geo, level)
    children = F.array_sort(F.collect_list("child"))
    return links.groupBy("pair", "parent").agg(children.alias("children")).select(
        "pair", F.split("pair", "").alias("levels"),
        F.concat(F.lit("{"), F.concat_ws(",", F.concat(F.array("parent"), F.col("children")).cast("array<string>")), F.lit("}")).alias("set_label"))


def add_geotriangles(sets: DataFrame, geolevels) -> DataFrame:
    """Keep parent/child suppression sets whose two levels are both present.

    ``sets`` has an array column ``levels`` (the two level codes of the set);
    ``geolevels`` is a list of levels, or a DataFrame with the level in its first
    column, which is not collected: a set stays if it finds all of its levels there.
    """
    if not isinstance(geolevels, DataFrame):
        present = F.array(*[F.lit(g) for g in geolevels]).cast("array<string>")
        return sets.where(F.size(F.array_except(F.col("levels"), present)) == 0)
    there = geolevels.select(col(geolevels.columns[0]).alias("__level")).distinct()  # a handful of level codes
    for k in (0, 1):
        sets = sets.join(F.broadcast(there), sets["levels"][k] == F.col("__level"), "left_semi")
    return sets

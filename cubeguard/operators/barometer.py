"""Barometer consistency (colour markers vs indicator values)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Barometer columns kept, and the language whose values are used
BAROMETER_COLS = ("stedskode_string", "stedskode_numeric", "indikator_kodet", "LPnr",
                  "roede", "groenne", "hvitMprikk")
LANGUAGE = "BOKMAAL"


def barometer_lpnr(bar: DataFrame) -> DataFrame:
    """Indicator number of the barometer rows.

    When absent it is derived from the indicator code as the reverse order
    (``max(code) + min(code) - code - 1``, the order-explicit form of
    reversing the code list, T26).  That holds for contiguous codes with the
    same number of rows each only, so other code lists are an error.  A
    0-based numbering is shifted by one.
    """
    bar = bar.select(*[c for c in BAROMETER_COLS if c in bar.columns])
    if "LPnr" not in bar.columns:
        codes = bar.groupBy("indikator_kodet").agg(F.count(F.lit(1)).alias("n"))
        r = codes.agg(F.min("indikator_kodet").alias("lo"), F.max("indikator_kodet").alias("hi"),
                      F.count(F.lit(1)).alias("n"), F.min("n").alias("least"), F.max("n").alias("most")).first()
        if r["n"] and (r["hi"] - r["lo"] + 1 != r["n"] or r["least"] != r["most"]):
            raise ValueError("indicator codes are not contiguous with equally many rows each")
        lo, hi = F.lit(r["lo"]), F.lit(r["hi"])
        bar = bar.withColumn("LPnr", hi + lo - F.col("indikator_kodet") - 1)
    zero_based = bar.agg(F.min("LPnr")).scalar() == 0
    bar = bar.withColumn("LPnr", F.when(zero_based, F.col("LPnr") + 1).otherwise(F.col("LPnr")))
    return bar.drop("indikator_kodet")


def check_barometer(bar: DataFrame, indicators: DataFrame, geo: str = "kommune") -> DataFrame:
    """Barometer rows whose value equals the reference value yet carry a
    colour marker (red, green or white-censored)."""
    geo = geo.lower()
    if geo not in ("fylke", "kommune", "bydel"):
        raise ValueError("geo must be fylke, kommune or bydel")
    b = barometer_lpnr(bar)
    verdi = [c for c in indicators.columns if "Verdi" in c]
    ind = (indicators.where(F.col("SpraakId") == LANGUAGE)
           .select(F.col("Sted_kode").alias("__sted"), F.col("LPnr").alias("__lp"), "Aar", *verdi))
    out = b.join(ind, (b["stedskode_string"] == ind["__sted"]) & (b["LPnr"] == ind["__lp"]), "left") \
        .drop("__sted", "__lp")
    value = "Verdi_mellomGeonivaa" if geo == "fylke" else "Verdi_lavesteGeonivaa"
    marked = F.col("roede").isNotNull() | F.col("groenne").isNotNull() | F.col("hvitMprikk").isNotNull()
    return out.where((F.col(value) == F.col("Verdi_referansenivaa")) & marked)


def barometer_missing_indicators(bar: DataFrame, indicators: DataFrame) -> DataFrame:
    """C6 completeness (T30): indicator numbers of the indicator list that
    the barometer does not have."""
    b = barometer_lpnr(bar).select("LPnr").distinct()
    ind = indicators.where(F.col("SpraakId") == LANGUAGE).select("LPnr").distinct()
    return ind.join(b, "LPnr", "left_anti")

"""Column expressions shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubeguard.spec import col, rounding_digits


def round_half_even(c: Column, digits: int) -> Column:
    """Round half to even at ``digits`` decimals.

    Defined as ``bround(c * 10^d) / 10^d`` so that the result is the same in
    any engine that rounds doubles half-even to an integer (the oracle uses
    ``round_even(x * 10^d, 0) / 10^d``).
    """
    if digits == 0:
        return F.bround(c, 0)
    scale = float(10 ** digits)
    return F.bround(c * F.lit(scale), 0) / F.lit(scale)


def qc_round(df: DataFrame, spec=None) -> DataFrame:
    """P10: publication rounding of every measure by its name."""
    from cubeguard.spec import DEFAULT_SPEC
    spec = spec or DEFAULT_SPEC
    numeric = {"double", "float", "bigint", "int", "smallint", "tinyint"}
    changes = {}
    for f in df.schema.fields:
        d = rounding_digits(f.name, spec)
        if d is not None and f.dataType.simpleString() in numeric:
            rounded = round_half_even(col(f.name).cast("double"), d)
            changes[f.name] = rounded if f.dataType.simpleString() in ("double", "float") else rounded.cast(f.dataType)
    return df.withColumns(changes) if changes else df


def any_abs_above(cols, threshold: float) -> Column:
    """1 when any |c| > threshold (NULLs ignored), else 0."""
    conds = [F.coalesce(F.abs(c) > F.lit(threshold), F.lit(False)) for c in cols]
    if not conds:
        return F.lit(0)
    return F.when(reduce(lambda a, b: a | b, conds), 1).otherwise(0)


def geo_code_text(geo: Column) -> Column:
    """Area code as digits (T14: BIGINT first, so 1e5 never shows up)."""
    return geo.cast("bigint").cast("string")


def geo_level_from_code(geo: Column) -> Column:
    """G2 fallback level from the number of digits in the area code."""
    n = F.length(geo_code_text(geo))
    return (F.when(n.isin(1, 2), "F").when(n.isin(3, 4), "K")
            .when(n.isin(5, 6), "B").when(n.isin(9, 10), "V"))


# Level code -> label (H has no label, T18)
GEO_LABELS = {"L": "Land", "F": "Fylke", "K": "Kommune", "k": "Kommune",
              "B": "Bydel", "V": "Levekaar"}
# Label order used for sorting
GEO_LABEL_ORDER = ("Land", "Fylke", "Kommune", "Bydel", "Levekaar")
# Level order used for sorting
GEO_LEVEL_ORDER = ("L", "H", "F", "K", "k", "B", "V")


def geo_label(geoniv: Column) -> Column:
    """Level code to label (H -> NULL)."""
    expr = None
    for code, label in GEO_LABELS.items():
        # binary comparison: K and k are different levels
        cond = geoniv.cast("binary") == F.lit(code).cast("binary")
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def parent_name(geo: Column, geoniv: Column, parents: dict, child_level: str = "B") -> Column:
    """Name of the parent municipality for its own row and its district rows.

    ``parents`` maps the municipality code (as digits) to its name.  District
    codes start with the municipality code.
    """
    text = geo_code_text(geo)
    codes = [int(k) for k in parents]
    in_scope = geo.cast("bigint").isin(codes) | (geoniv == F.lit(child_level)) | (geoniv == F.lit("Bydel"))
    expr = None
    for code, name in parents.items():
        cond = text.startswith(str(code))
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return F.when(in_scope, expr)

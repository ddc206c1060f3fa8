"""Outlier operators W1-W4.

Plan shape of :func:`flag_outliers` (per cube): one exchange by series
(all dimensions but the period) for the change from the last observation,
then one computation of weights per (stratum, value) shared by the fences on
the value and the fences on the change, joined back as a small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cubeguard.functions.quantile import ROWS_PER_RANGE, STATS, passes_for, weighted_fences
from cubeguard.operators.geo import split_kommuneniv
from cubeguard.spec import DEFAULT_SPEC, CubeSpec, col, identify_coltypes, profile_cube

def add_changeval(df: DataFrame, val: str, by, period: str = "AAR") -> DataFrame:
    """``change_<val>`` = 100 * (val / prev - 1).

    ``prev`` is the last non-NULL earlier value of the series (``by``
    ordered by period).  A previous value of 0 is replaced by half of the
    smallest non-zero value of the whole column (a scalar subquery).
    """
    w = (Window.partitionBy(*[col(b) for b in by]).orderBy(col(period))
         .rowsBetween(Window.unboundedPreceding, -1))
    prev = F.last(col(val), ignorenulls=True).over(w)
    min_nonzero = df.where(col(val) != 0).agg(F.min(col(val))).scalar()
    prev = F.when(prev == 0, min_nonzero / F.lit(2.0)).otherwise(prev)
    return df.withColumn(f"change_{val}", F.lit(100.0) * (F.try_divide(col(val), prev) - F.lit(1.0)))


def flag_outliers(cube: DataFrame, outlierval: str, small_threshold: float = 10000.0,
                  with_change: bool | None = None, spec: CubeSpec = DEFAULT_SPEC, profile=None,
                  rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Split small municipalities, fences on the value, change value and
    fences on the change.  The change part is skipped when the cube has
    fewer than two periods (``with_change=None`` takes it from the profile).

    ``profile`` bounds the rows of a stratum, which gives the passes that select
    its quantiles, and the number of strata; it is one single-row job if not given.
    """
    dt = split_kommuneniv(cube, small_threshold)
    roles = identify_coltypes(dt, spec=spec)
    dims = [d for d in roles.dims_new if d != spec.period]
    profile = profile or profile_cube(dt, list(roles.dims_new), spec)
    if with_change is None:
        with_change = profile.n_periods >= 2
    if with_change:
        dt = add_changeval(dt, outlierval, dims, spec.period)
    return add_outliers(dt, outlierval, dims, with_change, passes_for(profile.stratum_bound, rows_per_range),
                        profile.strata_bound)


def add_outliers(df: DataFrame, val: str, by, with_change: bool, passes: int = 0,
                 strata_bound: int | None = None) -> DataFrame:
    """Weighted fences per stratum and the OUTLIER flag, for the value
    and (optionally) its change.

    ``by`` are the dimensions without the period; GEO is replaced by GEOniv.
    Fence columns MIN, wq25, wq50, wq75, MAX, LOW, HIGH, OUTLIER (prefixed
    ``change_`` for the change value).  Rows without a level keep NULL
    fences and OUTLIER 0 (T13).
    """
    strata = ["GEOniv" if b == "GEO" else b for b in by]
    specs = [(val, "")] + ([(f"change_{val}", "change_")] if with_change else [])
    out = weighted_fences(df, specs, "WEIGHTS", strata, passes, strata_bound)
    has_level = F.col("GEOniv").isNotNull()
    base = [c for c in df.columns]
    cols = []
    for value, prefix in specs:
        fence_cols = [prefix + c for c in STATS]
        out = out.withColumns({c: F.when(has_level, F.col(c)) for c in fence_cols})
        v = col(value)
        out = out.withColumn(prefix + "OUTLIER",
                             F.when((v > F.col(prefix + "HIGH")) | (v < F.col(prefix + "LOW")), 1).otherwise(0))
        cols += fence_cols + [prefix + "OUTLIER"]
    return out.select(*[col(c) for c in base], *cols)


def prev_outlier_columns(old_outlier: str, outlier: str, prefix: str = "",
                         reference_parenthesis: bool = False) -> dict:
    """W4 expressions: PREV_OUTLIER and NEW_OUTLIER.

    NEW_OUTLIER = 1 when the row is an outlier now and was not one before
    (no previous row or previous flag 0).  ``reference_parenthesis=True``
    reproduces the original's misplaced parenthesis (T5): new only when there
    is no previous row.
    """
    prev = F.col(old_outlier)
    was_not = prev.isNull() if reference_parenthesis else (prev.isNull() | (prev == 0))
    return {
        f"{prefix}PREV_OUTLIER": prev,
        f"{prefix}NEW_OUTLIER": F.when((F.col(outlier) == 1) & was_not, 1).otherwise(0),
    }

"""The comparison pipeline (new vs old cube) and S1 (load a pair).

Plan: both cubes get level flags (broadcast joins against distinct level
lists), change values (exchange by series) and fences (one computation by
stratum, joined back as a small table).  Then ONE null-safe full outer match on the common dimensions
(one exchange of both cubes, the first row of a key picked before it) yields both the new cube's
previous-outlier flags (W4) and the comparison cube (C3).
The only actions are two single-row profiles (totals, number of periods).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeguard.functions.quantile import ROWS_PER_RANGE
from cubeguard.operators.compare import add_diffcolumns, add_totals_for_missing_dims, dropped_rows, match_first, uprikk_rebuild
from cubeguard.operators.geo import exclude_lks_for_compare
from cubeguard.operators.levels import flag_rows
from cubeguard.operators.outliers import flag_outliers, prev_outlier_columns
from cubeguard.spec import (
    DEFAULT_SPEC, ColumnRoles, CubeSpec, check_readfiles_args, col, identify_coltypes, profile_cube, profile_cubes, select_outlier_pri,
)


@dataclass
class CompareResult:
    newcube_flag: DataFrame
    oldcube_flag: DataFrame | None
    comparecube: DataFrame | None
    roles: ColumnRoles
    outlierval: str | None
    n_periods_new: int = 0
    # rows that a key held several times left out (keys, side, n_dropped)
    dropped: DataFrame | None = None


def make_comparecube(cube_new: DataFrame, cube_old: DataFrame | None = None, outliers: bool = True,
                     small_threshold: float = 10000.0, spec: CubeSpec = DEFAULT_SPEC,
                     reference_parenthesis: bool = False, rows_per_range: int = ROWS_PER_RANGE,
                     materialize: bool = False) -> CompareResult:
    """Flagged new cube, flagged old cube and comparison cube (all lazy).

    Histograms narrow a stratum's quantiles to about ``rows_per_range`` rows; how
    many follows from the profile's bound of a stratum's rows.

    ``materialize=True`` writes the joined new/old table once as a table in
    the shared checkpoint folder and derives the flagged new cube and the
    comparison cube from it; use it when several checks read the result (as
    after reading the files), so the pipeline runs once and its lineage is
    cut.
    """
    roles = identify_coltypes(cube_new, cube_old, spec)
    outlierval = select_outlier_pri(cube_new, cube_old, roles, spec) if outliers else None

    new = exclude_lks_for_compare(cube_new)
    old = exclude_lks_for_compare(cube_old)
    if old is not None:
        prof_new, prof_old = profile_cubes([(new, list(roles.dims_new)), (old, list(roles.dims_old))], spec)
    else:
        prof_new, prof_old = profile_cube(new, list(roles.dims_new), spec), None
    added_new, added_old = {}, {}
    if old is not None:
        new = _add_totals(new, old, roles.expdims, prof_old.totals, spec)
        old = _add_totals(old, cube_new, roles.newdims, prof_new.totals, spec)
        added_new = {d: prof_old.totals[d] for d in roles.expdims}
        added_old = {d: prof_new.totals[d] for d in roles.newdims}
    roles = identify_coltypes(new, old, spec)

    # level-key tables are bounded by the profiles (each added total is one level)
    new_flag = flag_rows(new, old, "newrow", spec, constants=added_new,
                         level_bound=None if prof_old is None else prof_old.level_bound + len(added_old))
    if outlierval is not None:
        new_flag = flag_outliers(new_flag, outlierval, small_threshold, prof_new.n_periods >= 2, spec,
                                 prof_new, rows_per_range)
    if old is None:
        return CompareResult(new_flag, None, None, roles, outlierval, prof_new.n_periods)

    old_flag = flag_rows(new, old, "exprow", spec, constants=added_old,
                         level_bound=prof_new.level_bound + len(added_new))
    if outlierval is not None:
        old_flag = flag_outliers(old_flag, outlierval, small_threshold, prof_old.n_periods >= 2, spec,
                                 prof_old, rows_per_range)

    newcube_flag, comparecube, dropped = _join_new_old(new_flag, old_flag, roles, outlierval, reference_parenthesis,
                                              materialize)
    return CompareResult(newcube_flag, old_flag, comparecube, roles, outlierval, prof_new.n_periods, dropped)


def _add_totals(dt, ref, dims, ref_totals, spec):
    dims = list(dims or [])
    if not dims:
        return dt
    missing = [d for d in dims if ref_totals.get(d) is None]
    if missing:
        return add_totals_for_missing_dims(dt, ref, dims, spec)  # raises with the message
    return dt.withColumns({d: F.lit(ref_totals[d]).cast(ref.schema[d].dataType) for d in dims})


def _join_new_old(new_flag: DataFrame, old_flag: DataFrame, roles: ColumnRoles, outlierval,
                  reference_parenthesis: bool, materialize: bool = False):
    keys = roles.commondims
    extra, vals = uprikk_rebuild(new_flag.columns, old_flag.columns, roles.commonvals)
    n = new_flag.withColumns(extra)
    # names that clash with the new side's columns get their side's name
    old_cols = {"exprow": "__exprow", **{v: f"{v}_old" for v in vals}}
    has_out = outlierval is not None and "OUTLIER" in old_flag.columns
    has_chg = has_out and "change_OUTLIER" in old_flag.columns and "change_OUTLIER" in new_flag.columns
    if has_out:
        old_cols["OUTLIER"] = "__old_OUTLIER"
    if has_chg:
        old_cols["change_OUTLIER"] = "__old_change_OUTLIER"
    o = old_flag.select(*[col(k) for k in keys], *[col(c).alias(a) for c, a in old_cols.items()])
    joined = match_first(n, o, keys, [c for c in n.columns if c not in keys], list(old_cols.values()))
    joined = joined.withColumn("__in_new", F.when(F.col("__n_new") > 0, True))
    if materialize:
        from cubeguard.session import materialize as _mat
        joined = _mat(joined, "compare_joined")

    # The new cube with previous-outlier information
    prev_cols = {}
    if has_out:
        prev_cols.update(prev_outlier_columns("__old_OUTLIER", "OUTLIER", "", reference_parenthesis))
    if has_chg:
        prev_cols.update(prev_outlier_columns("__old_change_OUTLIER", "change_OUTLIER", "change_",
                                              reference_parenthesis))
    base_cols = [c for c in new_flag.columns]
    newcube_flag = joined.where(F.col("__in_new")).withColumns(prev_cols)
    order = [c for c in base_cols + list(prev_cols) if not c.startswith("change_")] + \
            [c for c in base_cols + list(prev_cols) if c.startswith("change_")]
    newcube_flag = newcube_flag.select(*[col(c) for c in order])

    # Comparison cube; old side only for rows that are not expired
    keep = F.col("__in_new").isNotNull() | (F.col("__exprow") == 0)
    cc = joined.where(keep)
    geoniv = col("GEOniv") if "GEOniv" in new_flag.columns else F.lit(None).cast("string").alias("GEOniv")
    sel = [geoniv, col("newrow")]
    sel += [col(k) for k in keys]
    for v in vals:
        sel.append(col(v).alias(f"{v}_new"))
        sel.append(F.when(F.col("__exprow") == 0, col(f"{v}_old")).alias(f"{v}_old"))
    comparecube = add_diffcolumns(cc.select(*sel), vals)
    return newcube_flag, comparecube, dropped_rows(joined, keys)


def read_and_compare(spark, cube_new: str, root: str, cube_old: str | None = None, dump_dir: str | None = None,
                     dumps=("newcube_flag", "oldcube_flag", "comparecube"), recode_new: bool = False,
                     recode_old: bool = False, codemap: DataFrame | None = None, popinfo: DataFrame | None = None,
                     dump_format: str = "parquet", comparecube: bool = True, outliers: bool = True, **settings):
    """S1 end to end: find and read the cube files, recode areas, add geo
    parameters, compare (C1) and write the requested dumps (K2).

    Without ``comparecube`` the cubes are read only: the result holds them unflagged
    and no comparison.  Without ``outliers`` they are compared but not searched for outliers.

    Returns (result, dump name -> path).  The comparison is written once to
    the shared folder, as the dumps and later checks read it again.
    """
    from cubeguard.sources.cubes import load_pair
    from cubeguard.sources.sinks import save_dumps
    check_readfiles_args(cube_new, cube_old, recode_new, recode_old, comparecube, outliers)
    (new, new_ref), old = load_pair(spark, cube_new, root, cube_old, recode_new, recode_old, codemap, popinfo)
    if not comparecube:
        roles = identify_coltypes(new, old[0] if old else None, settings.get("spec", DEFAULT_SPEC))
        return CompareResult(new, old[0] if old else None, None, roles, None), {}
    result = make_comparecube(new, old[0] if old else None, outliers, materialize=True, **settings)
    written = {} if dump_dir is None else save_dumps(result, dump_dir, new_ref, old[1] if old else None, dumps, dump_format)
    return result, written

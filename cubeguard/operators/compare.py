"""Comparison cube operators C2-C4 (the pipeline C1 is in ``plans``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeguard.functions.exprs import any_abs_above
from cubeguard.spec import DEFAULT_SPEC, CubeSpec, col, find_totals

# Measures that may be rebuilt from their ``_uprikk`` variant
UPRIKK_REBUILD = ("TELLER", "NEVNER", "sumTELLER", "sumNEVNER", "RATE.n")
# Measures without a relative difference
NO_RELDIFF = ("SPVFLAGG", "RATE.n")
ANY_DIFF_THRESHOLD = 0.1


def add_totals_for_missing_dims(dt: DataFrame, ref: DataFrame, dimlist,
                                spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """A dimension present only in ``ref`` is added to ``dt`` at ref's total level."""
    dimlist = list(dimlist or [])
    if dt is None or ref is None or not dimlist:
        return dt
    totals = find_totals(ref, dimlist, spec)
    out = dt
    for d in dimlist:
        t = totals.get(d)
        if t is None:
            raise ValueError(f"New or expired dimension {d} has no total level in the other cube; "
                             "it cannot be matched. Read the cubes without comparison and add it manually.")
        out = out.withColumn(d, F.lit(t).cast(ref.schema[d].dataType))
    return out


def uprikk_rebuild(new_cols, old_cols, commonvals, flag: str = "SPVFLAGG"):
    """C3 rule: a measure in the old cube that the new cube has only as
    ``<m>_uprikk`` is rebuilt from it (censored rows NULL) and compared."""
    extra = {}
    vals = list(commonvals)
    for m in UPRIKK_REBUILD:
        if m in old_cols and m not in new_cols and f"{m}_uprikk" in new_cols:
            extra[m] = F.when(col(flag) != 0, F.lit(None).cast("double")).otherwise(col(f"{m}_uprikk"))
            vals.append(m)
    return extra, vals


def diff_columns(values) -> dict:
    """C4: ``_diff`` and ``_reldiff`` expressions per measure.

    One side NULL -> NULL; both NULL -> diff 0 and reldiff 1; division by 0
    -> NULL (T1).  No reldiff for SPVFLAGG and RATE.n.
    """
    out = {}
    for v in values:
        new, old = col(f"{v}_new"), col(f"{v}_old")
        both_null = new.isNull() & old.isNull()
        out[f"{v}_diff"] = F.when(both_null, F.lit(0.0)).otherwise((new - old).cast("double"))
        if v not in NO_RELDIFF:
            out[f"{v}_reldiff"] = F.when(both_null, F.lit(1.0)).otherwise(F.try_divide(new.cast("double"), old.cast("double")))
    return out


def add_diffcolumns(comparecube: DataFrame, values) -> DataFrame:
    """C4: diff columns and ``any_diffs`` (any |diff| > 0.1)."""
    diffs = diff_columns(values)
    out = comparecube.withColumns(diffs)
    diffcols = [c for c in out.columns if c.endswith("_diff")]
    return out.withColumn("any_diffs", any_abs_above([col(c) for c in diffcols], ANY_DIFF_THRESHOLD))


def match_first(new: DataFrame, old: DataFrame, keys, new_cols, old_cols, first_by=()) -> DataFrame:
    """The full outer match of two tables, one row for each key held by either.

    Columns: the keys, ``new_cols`` and ``old_cols`` (NULL where that side lacks the key),
    ``__n_new`` and ``__n_old`` (rows of the key on each side).  A key that a side holds
    several times takes its first row there (T15): the least by ``first_by`` where given,
    then by all its columns from left to right, NULLs first, so the pick never depends on
    the order of the rows.  NULL levels match each other.

    Both sides go through ONE exchange by the key and are picked map-side before it, so a
    hot key costs a row for each task and no rows multiply.
    """
    def side(df, cols, name):
        ranked = [col(c).alias(f"r{i}") for i, c in enumerate(first_by) if c in df.columns]
        row = F.struct(*ranked, *[col(c).alias(f"c{i}") for i, c in enumerate(cols)])
        return df.select(*[col(k).cast(new.schema[k].dataType).alias(f"__key{i}") for i, k in enumerate(keys)], row.alias(name))

    left, right = side(new, new_cols, "__n"), side(old, old_cols, "__o")
    g = left.unionByName(right, allowMissingColumns=True).groupBy(*[f"__key{i}" for i in range(len(keys))]).agg(
        F.min("__n").alias("__n"), F.min("__o").alias("__o"), F.count("__n").alias("__n_new"), F.count("__o").alias("__n_old"))
    return g.select(*[F.col(f"__key{i}").alias(k) for i, k in enumerate(keys)],
                    *[F.col("__n").getField(f"c{i}").alias(c) for i, c in enumerate(new_cols)],
                    *[F.col("__o").getField(f"c{i}").alias(c) for i, c in enumerate(old_cols)], "__n_new", "__n_old")


def dropped_rows(matched: DataFrame, keys) -> DataFrame:
    """What :func:`match_first` left out: (keys, side, n_dropped) for each key that a side holds several times."""
    sides = F.array(F.struct(F.lit("new").alias("side"), (F.col("__n_new") - 1).alias("n")),
                    F.struct(F.lit("old").alias("side"), (F.col("__n_old") - 1).alias("n")))
    return (matched.where((F.col("__n_new") > 1) | (F.col("__n_old") > 1)).select(*[col(k) for k in keys], F.explode(sides).alias("x"))
            .where(F.col("x.n") > 0).select(*[col(k) for k in keys], F.col("x.side").alias("side"), F.col("x.n").alias("n_dropped")))

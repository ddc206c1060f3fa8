"""Schema and level operators: P2, P3, P11, P13, P14, F1-F3, F5, F6."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cubeguard.functions.joins import any_level_missing, checked_broadcast, semi_filter
from cubeguard.functions.numbering import ordered_numbers
from cubeguard.sources.cubes import values_of
from cubeguard.spec import DEFAULT_SPEC, CubeSpec, col, find_totals, identify_coltypes

_MISC_FOR_COLUMNS = ("GEOniv", "WEIGHTS", "origgeo")
# A partition of a dense grid holds about so many rows, up to so many partitions.
GRID_ROWS, MAX_GRID_PARTS = 1_000_000, 100_000


def compare_colnames(cube_new: DataFrame, cube_old: DataFrame | None = None) -> DataFrame:
    """New, expired and ``_uprikk`` columns as (column, status, n_values_new, n_values_old).

    Which columns there are is schema work; how many rows hold a value is one aggregate
    for each cube (NULL for a cube that lacks the column), so a column that is there but
    empty shows.
    """
    spark = cube_new.sparkSession
    new_cols = [c for c in cube_new.columns if c not in _MISC_FOR_COLUMNS and "_uprikk" not in c]
    rows = [(c, "present") for c in new_cols]
    if cube_old is not None:
        old = set(cube_old.columns)
        rows += [(c, "new") for c in new_cols if c not in old]
        rows += [(c, "expired") for c in cube_old.columns
                 if c not in set(cube_new.columns) | set(_MISC_FOR_COLUMNS) and "_uprikk" not in c]
    rows += [(c, "uprikk") for c in cube_new.columns if c.endswith("_uprikk")]
    schema = T.StructType([T.StructField("column", T.StringType()), T.StructField("status", T.StringType())])
    out = spark.createDataFrame(rows, schema)
    for cube, name in ((cube_new, "n_values_new"), (cube_old, "n_values_old")):
        shown = [] if cube is None else list(dict.fromkeys(c for c, _ in rows if c in cube.columns))
        values = (spark.createDataFrame([], "column string, n_values bigint") if cube is None else values_of(cube, shown))
        out = out.join(F.broadcast(values.withColumnRenamed("n_values", name)), "column", "left")  # a row for each column
    return out


def _levels_long(cube: DataFrame, dims) -> DataFrame:
    """Distinct (Dimension, level) pairs of a cube, levels as text."""
    parts = [cube.select(F.lit(d).alias("Dimension"), col(d).cast("string").alias("level")).distinct()
             for d in dims]
    return reduce(DataFrame.unionByName, parts)


def _matched_levels(cube_new: DataFrame, cube_old: DataFrame | None, dims) -> DataFrame:
    """(Dimension, level, __in_new, __in_old): one null-safe full join of the distinct levels."""
    new = _levels_long(cube_new, dims).withColumn("__in_new", F.lit(1))
    old_dims = [d for d in dims if cube_old is not None and d in cube_old.columns]
    if not old_dims:
        return new.withColumn("__in_old", F.lit(None).cast("int"))
    old = _levels_long(cube_old, old_dims).withColumnRenamed("Dimension", "__d").withColumnRenamed("level", "__lvl") \
        .withColumn("__in_old", F.lit(1))
    cond = (new["Dimension"] == old["__d"]) & new["level"].eqNullSafe(old["__lvl"])
    return new.join(old, cond, "full").select(
        F.coalesce("Dimension", "__d").alias("Dimension"),
        F.when(F.col("__in_new").isNotNull(), F.col("level")).otherwise(F.col("__lvl")).alias("level"),
        "__in_new", "__in_old")


def level_changes(cube_new: DataFrame, cube_old: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """P3, long form: a row (Dimension, level, status) per new or expired
    level.  Nothing is gathered, whatever the number of levels."""
    m = _matched_levels(cube_new, cube_old, identify_coltypes(cube_new, cube_old, spec).dims_new)
    m = m.where(F.col("__in_new").isNull() | F.col("__in_old").isNull())
    return m.select("Dimension", "level", F.when(F.col("__in_new").isNotNull(), "new").otherwise("expired").alias("status"))


def compare_dimensions(cube_new: DataFrame, cube_old: DataFrame | None = None,
                       spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Per dimension of the new cube: number of levels (NULL counts as
    one), new levels and expired levels as sorted comma lists.

    For the report: a list holds all changed levels of a dimension; where
    those may be many, use :func:`level_changes`.  Output: Dimension,
    N_levels[, New_levels, Expired_levels].
    """
    dims = identify_coltypes(cube_new, cube_old, spec).dims_new
    joined = _matched_levels(cube_new, cube_old, dims)
    if cube_old is None:
        return joined.groupBy("Dimension").agg(F.count(F.lit(1)).alias("N_levels"))

    def _list(cond):
        return F.concat_ws(", ", F.array_sort(F.collect_list(F.when(cond, F.coalesce(F.col("level"), F.lit("NA"))))))

    return (joined.groupBy("Dimension").agg(
        F.count_if(F.col("__in_new").isNotNull()).alias("N_levels"),
        _list(F.col("__in_new").isNotNull() & F.col("__in_old").isNull()).alias("New_levels"),
        _list(F.col("__in_new").isNull() & F.col("__in_old").isNotNull()).alias("Expired_levels")))


def ranked_levels(df: DataFrame, columns) -> DataFrame:
    """(column number, level as text, rank): the distinct levels of all ``columns``, each numbered from 0.

    One scan for all columns, distinct levels combined map-side; a NULL is a level.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), col(c).cast("string").alias("level")) for i, c in enumerate(columns)])
    levels = df.select(F.explode(pairs).alias("x")).select("x.i", "x.level").distinct()
    numbered = ordered_numbers(levels, ["i", "level"], "__no")
    first = numbered.groupBy(F.col("i").alias("__i")).agg(F.min("__no").alias("__first"))
    return (numbered.join(F.broadcast(first), F.col("i") == F.col("__i"))  # a row for each column
            .select("i", "level", (F.col("__no") - F.col("__first")).alias("rank")))


def get_all_combinations(df: DataFrame, columns) -> DataFrame:
    """Dense grid, the product of the distinct levels of ``columns`` (NULL is a level).

    Levels are ranked once (:func:`ranked_levels`).  A grid row is a number in mixed
    radix, one digit for each column: rows come from a range, their digits by division
    and remainder, and each digit is joined to its column's ranks.  So the grid is dealt
    evenly whatever the columns, and no column's levels are gathered.  Only the number
    of levels of each column comes to the driver.
    """
    columns = list(columns)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Column(s) ({', '.join(missing)}) not found in data")
    spark = df.sparkSession
    levels = ranked_levels(df, columns)
    sizes = {r["i"]: r["n"] for r in levels.groupBy("i").agg((F.max("rank") + 1).alias("n")).collect()}
    total = 1
    for i in range(len(columns)):
        total *= sizes.get(i, 0)
    if total >= 1 << 63:
        raise ValueError("the grid has more than 2 ** 63 rows")
    parts = max(spark.sparkContext.defaultParallelism, min(total // GRID_ROWS, MAX_GRID_PARTS))
    grid, stride = spark.range(0, total, 1, parts).withColumnRenamed("id", "__cell"), total
    for i, c in enumerate(columns):
        stride //= max(sizes.get(i, 0), 1)
        digit = F.expr(f"`__cell` div {stride}L")
        own = levels.where(F.col("i") == i).select(F.col("rank").alias("__rank"), F.col("level").cast(df.schema[c].dataType).alias(f"__level{i}"))
        grid = grid.join(checked_broadcast(own), digit % F.lit(max(sizes.get(i, 0), 1)) == F.col("__rank")).drop("__rank")
    return grid.select(*[F.col(f"__level{i}").alias(c) for i, c in enumerate(columns)])


def melt(df: DataFrame, id_cols, value_cols, variable: str = "variable", value: str = "value") -> DataFrame:
    """Measures to (name, value) rows."""
    return df.select(*[col(c) for c in id_cols],
                     *[col(v).cast("double").alias(v) for v in value_cols]).unpivot(
        [col(c) for c in id_cols], [col(v) for v in value_cols], variable, value)


def dcast(df: DataFrame, index, pivot_col: str, values, value_cols, agg: str = "sum") -> DataFrame:
    """Levels to columns named ``<value>_<level>``, with an explicit level list (no extra job)."""
    fn = {"sum": F.sum, "first": F.first, "max": F.max}[agg]
    value_cols = [value_cols] if isinstance(value_cols, str) else list(value_cols)
    wide = df.groupBy(*[col(i) for i in index]).pivot(pivot_col, list(values)).agg(*[fn(col(v)).alias(v) for v in value_cols])
    spark_name = (lambda level, v: f"{level}_{v}") if len(value_cols) > 1 else (lambda level, v: f"{level}")
    return wide.select(*[col(i) for i in index], *[col(spark_name(level, v)).alias(f"{v}_{level}") for level in values for v in value_cols])


def duplicate_keys(df: DataFrame, dims) -> DataFrame:
    """Keys (``dims``) held by more than one row, with their number ``n``.

    The comparison joins on the key, so a key held twice would multiply its
    rows; this is the check to run first.  NULL levels count as levels.
    """
    return df.groupBy(*[col(d) for d in dims]).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def filter_cube(cube_new: DataFrame, cube_old: DataFrame, which: str = "new",
                spec: CubeSpec = DEFAULT_SPEC, level_bound: int | None = None) -> DataFrame:
    """keep rows whose level of every common dimension exists in the other cube.

    ``which="new"`` filters the new cube against the old one and vice
    versa.  Dimensions without new/expired levels are left unchanged by the
    semi join, so no data-dependent plan is needed.  Dimensions present in one
    cube only are not filtered (they are handled by totals / aggregation).
    """
    roles = identify_coltypes(cube_new, cube_old, spec)
    target, ref = (cube_new, cube_old) if which == "new" else (cube_old, cube_new)
    return semi_filter(target, ref, roles.commondims, level_bound=level_bound)


def get_complete_strata(df: DataFrame, by, type: str = "censored", valuecolumn: str | None = None,
                        flag: str = "SPVFLAGG") -> DataFrame:
    """keep strata (``by`` without GEO) that have no censored / missing rows.

    The strata with a bad row are found by a grouped aggregate (combined
    map-side, so a hot stratum is never gathered in one task) and removed by
    a null-safe anti join; that table has one row per bad stratum, and AQE
    broadcasts it when its runtime size allows.
    """
    by = [b for b in by if b != "GEO"]
    if type == "missing" and (valuecolumn is None or valuecolumn not in df.columns):
        raise ValueError("When type = 'missing', a valid column name must be provided to the value argument")
    bad = (col(flag) != 0) if type == "censored" else col(valuecolumn).isNull()
    if not by:  # one stratum, the whole table: anti join on a constant key
        any_bad = df.where(bad).select(F.lit(1).alias("__k")).limit(1)  # at most one row
        return (df.withColumn("__k", F.lit(1)).join(F.broadcast(any_bad), "__k", "left_anti")
                .drop("__k"))
    bad_strata = (df.where(bad).groupBy(*[col(b) for b in by]).agg(F.count(F.lit(1)).alias("__n"))
                  .select(*[col(b).alias(f"__s{i}") for i, b in enumerate(by)]))
    cond = None
    for i, b in enumerate(by):
        e = col(b).eqNullSafe(F.col(f"__s{i}"))
        cond = e if cond is None else cond & e
    return df.join(bad_strata, cond, "left_anti")


def flag_rows(cube_new: DataFrame | None, cube_old: DataFrame | None, flag: str = "newrow",
              spec: CubeSpec = DEFAULT_SPEC, constants: dict | None = None,
              level_bound: int | None = None) -> DataFrame:
    """``newrow`` / ``exprow`` = 1 when any common dimension's level is
    absent in the other cube; for dimensions on this side only, 1 unless the
    row is that dimension's total (no total: 1 for every row).

    ``constants`` ({dim: level}) names dimensions that hold one known level
    in the flagged cube (added totals); they need no join.  ``level_bound``
    bounds the other cube's level-key table (from its profile); without it
    the table is counted before it is broadcast.
    """
    if flag not in ("newrow", "exprow"):
        raise ValueError("flag must be 'newrow' or 'exprow'")
    if flag == "newrow" and cube_new is None:
        raise ValueError("cube_new cannot be None when flag = 'newrow'")
    if flag == "newrow" and cube_old is None:
        return cube_new.withColumn("newrow", F.lit(1))
    if cube_new is None or cube_old is None:
        raise ValueError("cube_new and cube_old cannot be None when flag = 'exprow'")
    roles = identify_coltypes(cube_new, cube_old, spec)
    dt, ref, own = ((cube_new, cube_old, roles.newdims) if flag == "newrow"
                    else (cube_old, cube_new, roles.expdims))
    out = any_level_missing(dt, ref, roles.commondims, flag, constants, level_bound)
    if own:
        totals = find_totals(dt, own, spec)
        for d in own:
            t = totals.get(d)
            not_total = F.lit(True) if t is None else ~col(d).eqNullSafe(F.lit(t))
            out = out.withColumn(flag, F.when((F.col(flag) == 0) & not_total, 1).otherwise(F.col(flag)))
    return out


def district_scope(df: DataFrame, parents: dict, flag: str = "SPVFLAGG", period: str = "AAR",
                   child_level: str = "B") -> DataFrame:
    """the city rows and district rows, in periods that have at least one
    uncensored district row."""
    scope = df.where(F.col("GEO").cast("bigint").isin([int(k) for k in parents]) | (F.col("GEOniv") == child_level))
    # the distinct periods are bounded by the number of periods
    periods = scope.where((F.col("GEOniv") == child_level) & (col(flag) == 0)).select(period).distinct()
    return scope.join(periods, period, "left_semi")

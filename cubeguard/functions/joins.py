"""Join helpers: size-checked broadcast and null-safe semi/anti filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Lookup tables above this size are joined with a shuffle instead.  This is a
# choice of the plan only: the result is the same either way.
MAX_BROADCAST_BYTES = 64 << 20
# Where only a bound on the rows is known: keys and fences take at most so much.
KEY_BYTES = 128
MAX_BROADCAST_ROWS = MAX_BROADCAST_BYTES // KEY_BYTES

_size_cache: dict = {}


def _bytes(df: DataFrame) -> int:
    """Size of a table's rows: 16 bytes a row, 8 a column, and its texts and lists."""
    more = [F.sum(F.octet_length(F.col(f"`{c}`"))) for c, t in df.dtypes if t == "string"]
    more += [F.sum(F.size(F.col(f"`{c}`"))) * KEY_BYTES for c, t in df.dtypes if t.startswith(("array", "map"))]
    row = df.agg(F.count(F.lit(1)), *more).first()
    return row[0] * (16 + 8 * len(df.columns)) + sum(x or 0 for x in row[1:])


def checked_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast a lookup table only after checking its size in bytes.

    Measuring a lookup (area parameters, code maps, control tables) is one
    cheap job and is remembered per session and plan.  Beyond ``max_bytes`` the
    table is returned unhinted, so Spark uses a shuffle join (and AQE may still
    broadcast it from runtime statistics).
    """
    return F.broadcast(df) if _bytes_once(df) <= max_bytes else df


def _bytes_once(df: DataFrame) -> int:
    """The size of a table, measured once per session and plan."""
    try:
        from cubeguard.session import session_id
        key = (session_id(df.sparkSession), df.semanticHash())
    except Exception:  # pragma: no cover - older clients
        return _bytes(df)
    if key not in _size_cache:
        _size_cache[key] = _bytes(df)
    return _size_cache[key]


_SEP = "\u0001"
_NULL = "\u0000"


def _level_key(dim: str, c) -> F.Column:
    """Composite key 'dim<SEP>level' (NULL level encoded, so NULL matches NULL)."""
    return F.concat(F.lit(dim + _SEP), F.coalesce(c.cast("string"), F.lit(_NULL)))


def level_keys(ref: DataFrame, dims) -> DataFrame:
    """Distinct (dimension, level) keys of ``ref`` for all ``dims`` in ONE table.

    Every per-dimension lookup joins this same table on a key expression (no
    per-dimension filter that Catalyst could push down and so split into
    separate plans), so Spark builds it with one scan, one aggregate and one
    broadcast, and reuses that exchange for every dimension.  The table is
    bounded by the total number of levels of the dimensions.
    """
    keys = F.array(*[_level_key(d, F.col(f"`{d}`")) for d in dims])
    return ref.select(F.explode(keys).alias("__key")).distinct()


def _split_constants(dims, constants):
    constants = constants or {}
    return [d for d in dims if d not in constants], {d: v for d, v in constants.items() if d in dims}


def _constant_present(ref: DataFrame, d: str, value):
    """EXISTS (ref row with level ``value`` of ``d``) as a scalar subquery."""
    return ref.where(F.col(f"`{d}`").eqNullSafe(F.lit(value))).exists()


def _broadcast_levels(keys: DataFrame, level_bound: int | None) -> DataFrame:
    """Hint the level-key table for broadcast when its size is proven small:
    by ``level_bound`` (from a profile) or else by a counted check.  Without
    the hint the static plan of a distinct over a large scan is a sort-merge
    join, and the cube would be shuffled before AQE could switch."""
    if level_bound is None:
        return checked_broadcast(keys)
    return F.broadcast(keys) if level_bound <= MAX_BROADCAST_ROWS else keys


def missing_levels(df: DataFrame, ref: DataFrame, dims) -> DataFrame:
    """(dimension, level) keys of ``df`` that ``ref`` lacks: two map-side combined distincts and one anti join of keys."""
    return level_keys(df, dims).join(level_keys(ref, dims), "__key", "left_anti")


def _level_table(df: DataFrame, ref: DataFrame, dims, level_bound: int | None) -> tuple[DataFrame, bool]:
    """A table of level keys to look rows of ``df`` up in, and whether it holds the levels that are missing.

    The levels of ``ref`` are broadcast where they are proven small, by ``level_bound``
    (from a profile) or a counted check.  Beyond that, the levels of ``df`` that ``ref``
    lacks are taken: versions of a cube differ in few levels, however many they have, so
    this table is broadcast behind its own check and the cube stays where it is.  Only
    where the missing levels are too many as well is a dimension joined by a shuffle.
    """
    keys = level_keys(ref, dims)
    small = _bytes_once(keys) <= MAX_BROADCAST_BYTES if level_bound is None else level_bound <= MAX_BROADCAST_ROWS
    if small:
        return _broadcast_levels(keys, level_bound), False
    return checked_broadcast(missing_levels(df, ref, dims)), True


def semi_filter(df: DataFrame, ref: DataFrame, dims, how: str = "left_semi", constants: dict | None = None,
                level_bound: int | None = None) -> DataFrame:
    """Keep (``left_semi``) or drop (``left_anti``) rows whose level of each
    dim appears among the distinct levels of ``ref``; NULL matches NULL.

    Each dimension is one lookup in one table of level keys (:func:`_level_table`),
    so the cube itself is not shuffled.
    ``constants`` names dimensions that hold a single known level in ``df``;
    they are answered by an EXISTS subquery instead of a join.
    """
    dims, consts = _split_constants(list(dims), constants)
    out = df
    for d, v in consts.items():
        present = _constant_present(ref, d, v)
        out = out.where(present if how == "left_semi" else ~present)
    if not dims:
        return out
    keys, missing = _level_table(df, ref, dims, level_bound)
    if missing:
        how = {"left_semi": "left_anti", "left_anti": "left_semi"}[how]
    for d in dims:
        k = keys.select(F.col("__key").alias(f"__k_{d}"))
        out = out.join(k, _level_key(d, out[d]) == k[f"__k_{d}"], how)
    return out


def any_level_missing(df: DataFrame, ref: DataFrame, dims, flag: str, constants: dict | None = None,
                      level_bound: int | None = None) -> DataFrame:
    """Add ``flag`` = 1 when the row's level of any dim is absent in ``ref``."""
    dims, consts = _split_constants(list(dims), constants)
    markers = [~_constant_present(ref, d, v) for d, v in consts.items()]
    out = df
    keys, missing = _level_table(df, ref, dims, level_bound) if dims else (None, False)
    for i, d in enumerate(dims):
        m = f"__m{i}"
        k = keys.select(F.col("__key").alias(f"__k{i}"), F.lit(1).alias(m))
        out = out.join(k, _level_key(d, out[d]) == k[f"__k{i}"], "left").drop(f"__k{i}")
        markers.append(F.col(m).isNotNull() if missing else F.col(m).isNull())
    cond = reduce(lambda a, b: a | b, markers) if markers else F.lit(False)
    out = out.withColumn(flag, F.when(cond, 1).otherwise(0))
    return out.drop(*[f"__m{i}" for i in range(len(dims))])

"""Row numbers without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LOW = (1 << 33) - 1


def ordered_numbers(df: DataFrame, order, name: str) -> DataFrame:
    """Add ``name``: the 0-based number of each row in the order of the columns ``order``.

    Rows are dealt by ranges of the order and sorted within their partition; a row's
    number is its place there plus the rows of the partitions before.  The placed
    rows are written once, as counting and reading must see the same ranges; only a
    count for each partition comes to the driver.  NULLs come first; rows that tie
    are numbered in any order, so ``order`` should be a key.
    """
    from cubeguard.session import materialize
    by = [F.col(f"`{c}`") for c in order]
    place = F.monotonically_increasing_id()  # partition number << 33 | place in the partition
    placed = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__place", place)
    placed = materialize(placed, "numbered")
    part = F.shiftright("__place", 33).cast("int")
    counts = placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    before, starts = 0, []
    for p, n in sorted(counts):
        starts.append((p, before))
        before += n
    offsets = F.broadcast(df.sparkSession.createDataFrame(starts, "__p int, __start bigint"))
    out = placed.join(offsets, part == F.col("__p"))
    return out.withColumn(name, F.col("__start") + F.col("__place").bitwiseAND(F.lit(_LOW))).drop("__place", "__p", "__start")


def occurrence_numbers(df: DataFrame, key, order, name: str) -> DataFrame:
    """Add ``name``: the 0-based number of a row among the rows of its ``key``, in the order of ``order``
    and then of all columns (NULLs first; NULL keys are equal).

    Keys held once, the usual case, get 0 without being moved by the numbering.  Of the
    others, equal rows are combined map-side and numbered together, and a key's rows are
    put in order within buckets of the first order column's magnitude, whose sizes are
    added up: a hot key is spread over its buckets, never gathered in one task.
    """
    from pyspark.sql import Window

    from cubeguard.functions.quantile import magnitude
    cols = [F.col(f"`{c}`") for c in df.columns]
    d = df.select("*", F.struct(*[F.col(f"`{k}`") for k in key]).alias("__k"))  # a struct's NULLs are equal
    many = d.groupBy("__k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__k")
    once = d.join(many, "__k", "left_anti").select(*cols, F.lit(0).cast("bigint").alias(name))
    g = d.join(many, "__k", "left_semi").groupBy("__k", *cols).agg(F.count(F.lit(1)).alias("__n"))
    g = g.withColumn("__b", F.coalesce(magnitude(F.col(f"`{order[0]}`").cast("double")), F.lit(-(1 << 40))))
    rest = [c for c in df.columns if c not in order]
    inside = Window.partitionBy("__k", "__b").orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in [*order, *rest]]) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    buckets = g.groupBy("__k", "__b").agg(F.sum("__n").alias("__m"))
    before = Window.partitionBy("__k").orderBy("__b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    buckets = buckets.select("__k", "__b", (F.sum("__m").over(before) - F.col("__m")).alias("__off"))
    g = g.withColumn("__at", F.sum("__n").over(inside) - F.col("__n")).join(buckets, ["__k", "__b"])
    first = F.col("__off") + F.col("__at")
    return once.unionByName(g.select(*cols, F.explode(F.sequence(first, first + F.col("__n") - 1)).alias(name)))

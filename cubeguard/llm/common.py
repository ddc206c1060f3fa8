"""Helpers shared by the training-data operators: shared storage, components."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the contracts: [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which all executors share.

    Where it is unset, a local master (as in tests) gets a scratch folder; on
    a cluster that would lose rows silently, so it is an error there.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path is None:
        context = spark.sparkContext
        if context.getCheckpointDir() is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
        path = context.getCheckpointDir()
    return path


def store(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs no recomputation of what is here.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`store` that nothing reads any more."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
    for parent in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(parent)
        path.getFileSystem(conf).delete(path, True)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node on an edge; root is the smallest id reachable.

    Alternates large-star and small-star steps. Each step takes the smallest
    neighbour by a map-side combined aggregate and joins it back, so a hub with
    a third of all edges is never gathered in one task: the aggregate is dealt
    anew before the join, since AQE splits a join of two plain shuffles only.
    Every round is written to the shared folder; only a checksum comes back.
    """
    def low_high(df):
        return (df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .where(F.col("u") != F.col("v")).distinct())

    def nearest(df):
        return df.groupBy("u").agg(F.min("v").alias("m")).repartition("u", "m")

    cur = store(low_high(edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))))
    mark = None
    for _ in range(max_rounds):
        sum_ = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(sum_) == mark or not sum_[0]:
            break
        mark = tuple(sum_)
        both = cur.union(cur.select("v", "u"))
        # Large star: each larger neighbour of u is tied to u's smallest one.
        big = (both.join(nearest(both), "u").select(F.col("v"), F.least("u", "m").alias("m"), F.col("u"))
               .where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")))
        big = low_high(big)
        # Small star: u and its smaller neighbours are tied to the smallest one.
        near = nearest(big)
        tied = big.join(near, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = store(low_high(tied.union(near.select("u", F.col("m").alias("v")))))
        drop_stored(cur)
        cur = nxt
    else:
        raise RuntimeError("components did not settle")
    out = cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return out.union(cur.select(F.col("v").alias("node"), F.col("v").alias("root"))).groupBy("node").agg(F.min("root").alias("root"))


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors once per application, as --py-files would."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="llm-code-")) / f"{root.name}.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in root.rglob("*.py"):
                z.write(f, f.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(target))
        _SHIPPED.add(app)


_IN_USE = None


def use_alone(memory) -> None:
    """Python workers outlive a stage: forget what another operator remembers in this one."""
    global _IN_USE
    if _IN_USE is not None and _IN_USE is not memory:
        _IN_USE.forget()
    _IN_USE = memory

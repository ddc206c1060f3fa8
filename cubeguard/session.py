"""Session helpers for tests and the benchmark.

Library operators never create or configure a session: they take the
caller's.  Only tests and ``bench.py`` build a local one here.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "cubeguard") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def session_id(spark: SparkSession) -> str:
    """Identifier of the running application (classic or Connect)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared, fault-tolerant folder and is
    used as is; without it this is an error, as each executor would write to
    its own disk.  Only a local master (tests) gets a scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="cubeguard-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Cut the lineage of a reused intermediate by writing it as a table.

    The table is written as parquet under the shared folder named by
    ``spark.checkpoint.dir`` (never a machine-local folder on a cluster,
    never ``localCheckpoint``) and read back, so a lost executor does not
    lose it, the plan is computed once, and later scans of it get column
    pruning and filter pushdown.
    """
    return df.sparkSession.read.parquet(_write(df, name))


def _write(df: DataFrame, name: str) -> str:
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/cubeguard/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    _WRITTEN.setdefault(session_id(spark), []).append(path)
    return path


def case_sensitive(df: DataFrame, name: str = "table") -> DataFrame:
    """The rows of ``df``, written once, in a session of their own that tells names apart by case.

    For results with two columns that differ only in case, which a session that takes
    them for one cannot write.  Settings of the caller's session are taken over; the
    session itself is not changed.
    """
    spark = df.sparkSession
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.caseSensitive", "true")
    return own.read.parquet(_write(df, name))


_WRITTEN: dict = {}


def release(spark: SparkSession) -> int:
    """Delete the tables that :func:`materialize` wrote in this application; returns how many.

    To be called when no result that reads them is needed any more, at the latest at
    the end of a job: tables stay until then, as lazy results read them.
    """
    from cubeguard.sources import fixtures
    paths = _WRITTEN.pop(session_id(spark), [])
    fixtures.forget(session_id(spark))
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    return len(paths)

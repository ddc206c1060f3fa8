"""Sinks K1-K3: check tables and flagged-cube dumps.

Operators never write; these do.  Output goes to
``<out>/<cube>/<check>/datetag=<tag>/`` so versions sit side by side instead
of being moved to an archive folder.

A table is committed in one step: its files are written to a folder of their own
below ``_versions``, and then the small file ``_current``, which names that folder,
is replaced by one rename.  Readers go through ``_current``, so they see the old
table or the new one, whole, also while a writer runs or after it failed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cubeguard.functions.exprs import qc_round
from cubeguard.spec import DEFAULT_SPEC, col

_CURRENT, _VERSIONS = "_current", "_versions"


def _hadoop(spark: SparkSession, path: str):
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), conf), p.getFileSystem(conf)


def commit_table(df: DataFrame, path: str, fmt: str = "parquet", **options) -> str:
    """Write ``df`` aside and make it the table at ``path`` by one rename; returns the folder written."""
    spark = df.sparkSession
    name = uuid.uuid4().hex
    folder = f"{path}/{_VERSIONS}/{name}"
    df.write.options(**options).format(fmt).save(folder)
    jvm, context, fs = _hadoop(spark, path)
    new, final = (jvm.org.apache.hadoop.fs.Path(f"{path}/{x}") for x in (f"{_CURRENT}.{name}", _CURRENT))
    out = fs.create(new, True)
    try:
        out.write(bytearray(name.encode()))
    finally:
        out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context.rename(new, final, how)
    return folder


def committed_path(spark: SparkSession, path: str) -> str:
    """The folder of the table that is committed at ``path``."""
    jvm, _, fs = _hadoop(spark, path)
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(f"{path}/{_CURRENT}"))
    try:
        return f"{path}/{_VERSIONS}/{bytes(stream.readAllBytes()).decode()}"
    finally:
        stream.close()


def drop_old_versions(spark: SparkSession, path: str) -> int:
    """Delete the folders of earlier or failed writes; returns how many."""
    jvm, _, fs = _hadoop(spark, path)
    keep = committed_path(spark, path).rsplit("/", 1)[-1]
    old = [s.getPath() for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/{_VERSIONS}")) if s.getPath().getName() != keep]
    for p in old:
        fs.delete(p, True)
    return len(old)


def save_table(df: DataFrame, out: str, cubename: str, check: str, datetag: str) -> str:
    """K1/K3: a check table as ';'-separated CSV with header; returns the folder of its files."""
    return commit_table(df, f"{out}/{cubename}/{check}/datetag={datetag}", "csv", sep=";", header="true", emptyValue='""')


def read_table(spark: SparkSession, out: str, cubename: str, check: str, datetag: str, schema=None) -> DataFrame:
    """A saved check table, as text or with the given schema."""
    reader = spark.read.options(sep=";", header="true", emptyValue="")
    path = committed_path(spark, f"{out}/{cubename}/{check}/datetag={datetag}")
    return (reader if schema is None else reader.schema(schema)).csv(path)


def dump_name(kind: str, new_name: str, new_tag: str, old_name: str | None = None,
              old_tag: str | None = None) -> str:
    """K2 file names: newflag_/oldflag_<cube>_<tag>, compare_<cube>_<a>_vs_[<old>_]<b>."""
    if kind == "newcube_flag":
        return f"newflag_{new_name}_{new_tag}"
    if kind == "oldcube_flag":
        return f"oldflag_{old_name}_{old_tag}"
    if kind == "comparecube":
        if old_name == new_name:
            return f"compare_{new_name}_{new_tag}_vs_{old_tag}"
        return f"compare_{new_name}_{new_tag}_vs_{old_name}_{old_tag}"
    raise ValueError(f"unknown dump {kind}")


def save_dump(df: DataFrame | None, out: str, name: str, fmt: str = "parquet", cluster_by=None) -> str | None:
    """K2: a flagged cube / comparison cube after publication rounding.

    Rows are dealt by ranges of the cube key (``cluster_by``; the dimensions, period
    first) and sorted, so there is one file for each range, whatever the periods, and a
    filter on period or area reads the files that hold it only.
    """
    if df is None:
        return None
    by = cluster_by or sorted([d for d in DEFAULT_SPEC.dims if d in df.columns], key=lambda d: (d != DEFAULT_SPEC.period, d != DEFAULT_SPEC.geo))
    rows = qc_round(df)
    if by:
        rows = rows.repartitionByRange(*[col(c) for c in by]).sortWithinPartitions(*[col(c) for c in by])
    options = {"sep": ";", "header": "true"} if fmt == "csv" else {}
    return commit_table(rows, f"{out}/{name}", fmt, **options)


def save_dumps(result, out: str, new_ref, old_ref=None,
               dumps=("newcube_flag", "oldcube_flag", "comparecube"), fmt: str = "parquet") -> dict:
    """K2 for a comparison result (``plans.comparison.CompareResult``): each
    requested dump that exists is rounded and written; returns name -> folder of its files."""
    written = {}
    for kind in dumps:
        df = getattr(result, kind, None)
        if df is None:
            continue
        name = dump_name(kind, new_ref.name, new_ref.datetag,
                         old_ref.name if old_ref else None, old_ref.datetag if old_ref else None)
        written[name] = save_dump(df, out, name, fmt)
    return written

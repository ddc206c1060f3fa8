"""Cube readers: S3-S8 (version lookup, typed parquet / CSV read, renames).

File listing goes through the Hadoop FileSystem of the session, so the
same code lists local folders, HDFS or object stores.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubeguard.spec import DEFAULT_SPEC, CubeSpec, col, get_cubedatetag, get_cubename

# Measures that are integral codes (read as BIGINT)
INTEGRAL_MEASURES = ("SPVFLAGG",)
# Uncensored counts that must not be in a geo-uncensored file
FORBIDDEN_OUTCOLS = ("TELLER", "NEVNER", "sumTELLER", "sumNEVNER")


@dataclass
class CubeRef:
    """Lineage carried beside a cube DataFrame (the reference's attributes)."""

    path: str
    filename: str
    filetype: str
    version: str
    renamed: list = field(default_factory=list)

    @property
    def name(self) -> str:
        return get_cubename(self.filename)

    @property
    def datetag(self) -> str:
        return get_cubedatetag(self.filename)


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of ``folder`` (Hadoop FileSystem listing, so
    local folders, HDFS and object stores work alike)."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(p))


def find_cube(spark: SparkSession, cubename: str, root: str) -> str:
    """S3: path of a cube version.  ``root/QC`` first: one hit wins, several
    hits -> the single parquet one; none -> ``root/DATERT/csv``.  Ambiguous
    or absent -> error."""
    def hits(folder):
        return [f for f in list_files(spark, folder) if re.search(re.escape(cubename), f.rsplit("/", 1)[-1])]
    qc = hits(f"{root}/QC")
    if len(qc) == 1:
        return qc[0]
    if len(qc) > 1:
        pq = [f for f in qc if f.endswith(".parquet")]
        if len(pq) == 1:
            return pq[0]
    if not qc:
        qc = hits(f"{root}/DATERT/csv")
        if len(qc) == 1:
            return qc[0]
    if len(qc) > 1:
        raise ValueError("> 1 file with the same name found:\n" + "\n".join(f"- {f}" for f in qc))
    raise FileNotFoundError(f"{cubename} not found in QC or DATERT, check spelling")


def typed_column(c: str, spec: CubeSpec = DEFAULT_SPEC, dtype: str = "string"):
    """S5/S6 type rule for one column: string dimensions as text, integral
    codes (numeric dimensions, SPVFLAGG) as BIGINT, everything else as
    DOUBLE; a value that does not parse becomes NULL (``try_cast``).

    A column that has its type already (``dtype``) is left as it is, so
    filters on it reach the parquet scan.
    """
    integral = c in spec.numeric_dims or c in INTEGRAL_MEASURES
    target = "string" if c in spec.string_dims else "bigint" if integral else "double"
    if dtype == target:
        return col(c)
    if target == "string" or dtype in ("tinyint", "smallint", "int") or (dtype, target) == ("float", "double"):
        return col(c).cast(target).alias(c)  # widens, or names the value
    text = col(c).cast("string")
    value = text.try_cast("double")
    # integral text is read as it is: a code beyond 2 ** 53 is no double
    return (value if target == "double" else F.coalesce(text.try_cast("bigint"), value.try_cast("bigint"))).alias(c)


def find_by_datetag(spark: SparkSession, folders, datetag: str, cubename: str | None = None) -> list[str]:
    """Files carrying ``datetag`` in the first folder that has any
    (e.g. the parquet folder before the CSV folder); when several remain, the
    ones whose name contains ``cubename``."""
    hits: list[str] = []
    for folder in folders:
        hits = [f for f in list_files(spark, folder) if datetag in f.rsplit("/", 1)[-1]]
        if hits:
            break
    if len(hits) > 1 and cubename:
        hits = [f for f in hits if cubename in f.rsplit("/", 1)[-1]]
    return hits


def type_columns(df: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Apply :func:`typed_column` to every column."""
    return df.select(*[typed_column(c, spec, dtype) for c, dtype in df.dtypes])


def rename_columns(df: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> tuple[DataFrame, list]:
    """Apply the rename map; returns the DataFrame and the (old, new) pairs."""
    pairs = [(o, n) for o, n in spec.rename.items() if o in df.columns]
    if pairs:
        df = df.withColumnsRenamed(dict(pairs))
    return df, pairs


def read_cube(spark: SparkSession, path: str, version: str = "New",
              spec: CubeSpec = DEFAULT_SPEC) -> tuple[DataFrame, CubeRef]:
    """Typed read of a cube file (parquet or ';'-separated CSV) with renames."""
    if version not in ("New", "Old"):
        raise ValueError("version must be 'New' or 'Old'")
    if path.endswith(".parquet") or not path.endswith(".csv"):
        raw = spark.read.parquet(path)
    else:
        raw = read_csv_strings(spark, path)
    df, pairs = rename_columns(raw, spec)
    df = type_columns(df, spec)
    filename = path.rstrip("/").rsplit("/", 1)[-1]
    filetype = "QC" if "/QC/" in path else ("ALLVIS" if "/DATERT/csv/" in path else "Other")
    return df, CubeRef(path=path, filename=filename, filetype=filetype, version=version, renamed=pairs)


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """S6: ';'-separated UTF-8 CSV with header, every column as text."""
    return (spark.read.option("header", True).option("sep", ";").option("encoding", "UTF-8")
            .option("inferSchema", False).csv(path))


def values_of(df: DataFrame, columns) -> DataFrame:
    """(column, n_values): how many rows hold a value in each of the columns, by one aggregate."""
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, n_values bigint")
    counts = [F.struct(F.lit(c).alias("column"), F.count(col(c)).alias("n_values")) for c in columns]
    return df.agg(F.array(*counts).alias("x")).select(F.explode("x").alias("x")).select("x.column", "x.n_values")


def renamed_columns_report(df: DataFrame, ref: CubeRef) -> DataFrame:
    """The renamed columns of a read as (original, new, n_values) rows, n_values the rows that hold a value."""
    original = F.lit(None).cast("string")
    for o, n in ref.renamed:
        original = F.when(F.col("column") == n, o).otherwise(original)
    return values_of(df, [n for _, n in ref.renamed]).select(original.alias("original"), F.col("column").alias("new"), "n_values")


def forbidden_outcols(df: DataFrame, ref: CubeRef) -> DataFrame:
    """Uncensored count columns present in a geo-uncensored file, as (column, n_values) rows."""
    checked = ref.version == "New" and "ikkegeoprikket_" in ref.filename
    return values_of(df, [c for c in df.columns if checked and c in FORBIDDEN_OUTCOLS])


def load_pair(spark: SparkSession, cube_new: str, root: str, cube_old: str | None = None,
              recode_new: bool = False, recode_old: bool = False, codemap: DataFrame | None = None,
              popinfo: DataFrame | None = None, spec: CubeSpec = DEFAULT_SPEC):
    """Find and read the new (and old) cube, recode area codes, add geo
    parameters.  Returns ((new, new_ref), (old, old_ref) or None)."""
    from cubeguard.operators.geo import add_geoparams, recode_geo
    from cubeguard.spec import check_readfiles_args
    check_readfiles_args(cube_new, cube_old, recode_new, recode_old)

    def one(name, recode, version):
        df, ref = read_cube(spark, find_cube(spark, name, root), version, spec)
        if recode and codemap is not None:
            df = recode_geo(df, codemap)
        if popinfo is not None:
            df = add_geoparams(df, popinfo)
        return df, ref
    new = one(cube_new, recode_new, "New")
    old = one(cube_old, recode_old, "Old") if cube_old else None
    return new, old


def convert_coltype(df: DataFrame, columns, fmt: str) -> DataFrame:
    """Cast columns to numeric / integer / character (factor = text).

    Digit-only text becomes a number; anything else that does not parse
    becomes NULL (``try_cast``).
    """
    target = {"numeric": "double", "integer": "bigint", "character": "string", "factor": "string"}.get(fmt)
    if target is None:
        raise ValueError("format must be factor, numeric, integer or character")
    conv = {}
    for c in columns:
        text = col(c).cast("string")
        conv[c] = text if target == "string" else text.try_cast("double").try_cast(target)
    return df.withColumns(conv)

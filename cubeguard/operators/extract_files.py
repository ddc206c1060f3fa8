"""C11: the extract report from files, for all cubes in one plan.

Extracts and cubes are each read by one scan, whatever their number and although their
columns differ: a row carries its file's key and takes each column by its name in that
file.  Extract and cube are linked by the control table and the date tag of the file
names; every check is keyed by the extract.  What differs between files is data here,
never a plan of its own: a dimension that one side lacks is NULL on both, and the
dimensions and measures of a cube are a row of a small table.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeguard.functions.joins import checked_broadcast
from cubeguard.operators import extracts as one
from cubeguard.session import materialize
from cubeguard.sources.cubes import find_by_datetag, typed_column
from cubeguard.spec import DATETAG_PATTERN, DEFAULT_SPEC, CubeSpec, col, identify_coltypes

# A CSV file has at most so many columns.
MAX_COLUMNS = 128
_ID = "([^/]+_" + DATETAG_PATTERN + ")"
_ALL = "\u0002"


def _tagged(path: F.Column) -> F.Column:
    """The file or folder that carries a date tag in a path."""
    return F.regexp_extract(path, ".*/([^/]+_" + DATETAG_PATTERN + r"[^/]*)(?:/[^/]*)?$", 1)


def _cube_id(path: F.Column) -> F.Column:
    """name_datetag of the file or folder that carries a date tag in a path."""
    return F.regexp_extract(path, ".*/" + _ID + r"[^/]*(?:/[^/]*)?$", 1)


def csv_columns(spark, paths) -> int:
    """How many columns the widest line of ';'-separated files may have, ``MAX_COLUMNS`` at most: schemas of
    more than about a hundred columns are evaluated row by row without generated code."""
    lines = spark.read.text(paths)
    marks = F.length("value") - F.length(F.replace("value", F.lit(";"), F.lit("")))
    return min((lines.agg(F.max(marks)).first()[0] or 0) + 1, MAX_COLUMNS)


def _csv_rows(spark, paths, marker) -> tuple[DataFrame, DataFrame]:
    """(rows, headers) of CSV files, both by file path: the headers are the rows that ``marker`` accepts."""
    n = csv_columns(spark, paths)
    schema = ", ".join(f"_c{i} string" for i in range(n))
    raw = spark.read.schema(schema).options(sep=";", header="false", encoding="UTF-8").csv(paths)
    # only the first value can follow a byte order mark
    values = F.array(F.regexp_replace("_c0", "^\ufeff", ""), *[F.col(f"_c{i}") for i in range(1, n)])
    rows = raw.select(F.col("_metadata.file_path").alias("path"), values.alias("values"))
    heads = rows.where(marker(F.col("values"))).select(F.col("path").alias("__p"), F.array_compact("values").alias("names"))
    return rows.where(~F.coalesce(marker(F.col("values")), F.lit(False))), heads


def _with_names(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """Rows with the names in their file's header, and with what its path tells (read once a file)."""
    heads = heads.select("*", _tagged(F.col("__p")).alias("tagged"), _cube_id(F.col("__p")).alias("cube"))
    return rows.join(checked_broadcast(heads), F.col("path") == F.col("__p")).drop("__p")


def read_csv_by_name(spark, paths, marker) -> DataFrame:
    """(file path, ``names``, ``values``, ``tagged``, ``cube``) of the rows of many ';'-separated CSV files with headers of their own.

    A file's header is its row that ``marker`` (a Column over ``values``) accepts.  It is
    joined to the file's rows, so columns go by name in each file; one scan for all.
    """
    return _with_names(*_csv_rows(spark, paths, marker))


def _named(name: str) -> F.Column:
    """The value of the column ``name`` in a row of :func:`read_csv_by_name`, NULL where the file has no such column."""
    at = F.array_position("names", name)
    return F.when(at > 0, F.element_at("values", F.when(at > 0, at).otherwise(1).cast("int")))


def read_extract_files(spark, paths, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """S9 for files of different columns: Friskvik (the file or folder with the date tag), ``__edims`` (its dimensions),
    ``__stored`` (whether it has stored filters), ETAB, the dimensions, MEIS."""
    rows = read_csv_by_name(spark, paths, lambda v: F.array_contains(v, "MEIS"))
    out = rows.select(F.col("tagged").alias("Friskvik"), F.array_intersect("names", F.array(*[F.lit(d) for d in spec.dims])).alias("__edims"),
                      F.array_contains("names", "ETAB").alias("__stored"), _named("ETAB").alias("ETAB"), *[_named(c).alias(c) for c in (*spec.dims, "MEIS")])
    return out.select("Friskvik", "__edims", "__stored", "ETAB", *[typed_column(c, spec, "string") for c in (*spec.dims, "MEIS")])


def read_cube_files(spark, files: dict, spec: CubeSpec = DEFAULT_SPEC) -> tuple[DataFrame, DataFrame]:
    """S10/S4 for many cubes: (rows with ``__cube``, a row for each cube with its file, dimensions and measures).

    ``files``: cube id -> path.  Parquet files and folders are one scan with merged
    columns, CSV files another; renames are applied column by column.
    """
    parquet = {k: p for k, p in files.items() if not p.endswith(".csv")}
    csv = {k: p for k, p in files.items() if p.endswith(".csv")}
    back = {}
    for old, new in spec.rename.items():
        back.setdefault(new, [new]).append(old)
    parts, columns = [], {}
    if parquet:
        raw = spark.read.option("mergeSchema", True).parquet(*parquet.values())
        columns |= {k: spark.read.parquet(p).columns for k, p in parquet.items()}  # footers only
        types = dict(raw.dtypes)
        names = list(dict.fromkeys(spec.rename.get(c, c) for c in raw.columns))
        value = {n: reduce(F.coalesce, [typed_column(c, spec, types[c]) if n == c else typed_as(c, n, spec, types[c]) for c in back.get(n, [n]) if c in types]) for n in names}
        parts.append(raw.select(_cube_id(F.col("_metadata.file_path")).alias("__cube"), *[v.alias(n) for n, v in value.items()]))
    if csv:
        plain, heads = _csv_rows(spark, list(csv.values()), lambda v: F.array_contains(v, spec.geo))
        rows = _with_names(plain, heads)
        held = heads.join(plain.select("path").distinct(), F.col("path") == F.col("__p"))  # a header for each file that has rows
        heads = {r[0]: r[1] for r in held.select(_cube_id(F.col("path")), "names").distinct().collect()}
        columns |= heads
        names = list(dict.fromkeys(spec.rename.get(c, c) for _, h in sorted(heads.items()) for c in h))
        text = {n: reduce(F.coalesce, [_named(c) for c in back.get(n, [n])]) for n in names}
        rows = rows.select(F.col("cube").alias("__cube"), *[v.alias(n) for n, v in text.items()])
        parts.append(rows.select("__cube", *[typed_column(n, spec, "string") for n in names]))
    cubes = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    info = []
    for k, cols in columns.items():
        roles = identify_coltypes([spec.rename.get(c, c) for c in cols], spec=spec)
        info.append((k, files[k].rstrip("/").rsplit("/", 1)[-1], roles.dims_new, [v for v in roles.vals_new if not re.search(r"RATE.n|SPVFLAGG", v)]))
    return cubes, spark.createDataFrame(info, "__cube string, Kube string, __cdims array<string>, __cvals array<string>")


def typed_as(c: str, name: str, spec: CubeSpec, dtype: str) -> F.Column:
    """Column ``c`` with the type that ``name`` has."""
    integral = name in spec.numeric_dims or name == spec.flag
    target = "string" if name in spec.string_dims else "bigint" if integral else "double"
    return col(c).cast("string").try_cast(target)


def _fixed_level(dim: str, indicator: F.Column):
    if dim not in one.EXPIRED_DIM_LEVEL:
        return None
    level = F.lit(one.EXPIRED_DIM_LEVEL[dim])
    if dim in one.EXPIRED_DIM_EXCEPTIONS:
        names, other = one.EXPIRED_DIM_EXCEPTIONS[dim]
        level = F.when(indicator.isin(*sorted(names)), F.lit(other)).otherwise(level)
    return level.cast("string")


def _key(cube, dim: str, level) -> F.Column:
    return F.concat(cube, F.lit("\u0001" + dim + "\u0001"), F.coalesce(level, F.lit("\u0000")))


def filter_cubes_to_extracts(cubes: DataFrame, extracts: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """F4 for all cubes and extracts: (Friskvik, cube row) pairs.

    ``extracts`` is linked already (``__cube``, ``__common``, ``__cdims``).  An extract asks
    for its levels of a common dimension, for the configured level of one that it lacks,
    and for any level of one that it lacks without such a level.
    """
    dims = [d for d in spec.dims if d != spec.period and d in cubes.columns]
    shape, literals = one.filter_shape(F.coalesce(F.trim("ETAB"), F.lit("")))
    shapes = sorted(r[0] for r in extracts.select(shape.alias("s")).distinct().collect() if r[0])
    number = F.array_position(F.array(*[F.lit(x) for x in shapes]).cast("array<string>"), shape).cast("int")
    stored = F.filter(F.collect_set(F.struct(number.alias("shape"), literals.alias("lits"))), lambda f: f["shape"] > 0)
    filters = extracts.groupBy(F.col("Friskvik").alias("__f")).agg(F.array_sort(stored).alias("__fs"))
    ex = extracts.join(checked_broadcast(filters), F.col("Friskvik") == F.col("__f")).withColumn("__x", F.struct("Friskvik", F.col("__fs").alias("filters")))
    ind = one.indicator_of(F.col("Friskvik"))
    asks = []
    for d in dims:
        fixed = _fixed_level(d, ind)
        lacking = F.lit(_ALL) if fixed is None else fixed
        level = F.when(F.array_contains("__common", d), F.coalesce(col(d).cast("string"), F.lit("\u0000"))).when(
            F.array_contains("__cdims", d), lacking).otherwise(F.lit("\u0000"))
        asks.append(_key(F.col("__cube"), d, level))
    lookup = ex.select(F.explode(F.array(*asks)).alias("__key"), "__x").groupBy("__key").agg(F.collect_set("__x").alias("__ex"))
    lookup = checked_broadcast(lookup)
    out, none = cubes, F.array().cast(lookup.schema["__ex"].dataType)
    anywhere = [d for d in dims if _fixed_level(d, ind) is None]
    for k, d in enumerate(dims):
        level = lookup.select(F.col("__key").alias(f"__k{k}"), F.col("__ex").alias(f"__e{k}"))
        out = out.join(level, _key(F.col("__cube"), d, col(d).cast("string")) == F.col(f"__k{k}"), "left")
        here = F.coalesce(F.col(f"__e{k}"), none)
        if d in anywhere:
            level = lookup.select(F.col("__key").alias(f"__a{k}"), F.col("__ex").alias(f"__o{k}"))
            out = out.join(level, _key(F.col("__cube"), d, F.lit(_ALL)) == F.col(f"__a{k}"), "left")
            here = F.array_union(here, F.coalesce(F.col(f"__o{k}"), none))
        # most areas are in no extract: a row that none asks for goes no further
        out = out.withColumn("__matching", here if k == 0 else F.array_intersect("__matching", here)).where(F.size("__matching") > 0)
        out = out.drop(f"__k{k}", f"__e{k}", f"__a{k}", f"__o{k}")
    matching = F.col("__matching")

    def passes(x):
        def holds(f):
            ok = F.lit(False)
            for k, text in enumerate(shapes, 1):
                ok = F.when(f["shape"] == k, one.etab_predicate(text, f["lits"])).otherwise(ok)
            return F.coalesce(ok, F.lit(False))
        return F.forall(x["filters"], holds)
    names = F.transform(F.filter(matching, passes), lambda x: x["Friskvik"])
    return out.select(*[col(c) for c in cubes.columns], F.explode(names).alias("Friskvik"))


def check_extract_files(spark, extract_paths, cube_folders, spec_folder: str, control: DataFrame, published: DataFrame,
                        profile: str, geolevel: str, year, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """C11 + C7 for all extract files and cubes: the report of :func:`~cubeguard.operators.extracts.check_friskvik`.

    An extract's cube is the file that has the name of its control row and the extract's
    date tag (the first of ``cube_folders`` that has the tag); its spec file likewise.  An
    extract without a control row, or whose cube is not found, is ``not_loaded``.  Only
    file names, headers and the links (one for each extract file) come to the driver.
    """
    ex = materialize(read_extract_files(spark, extract_paths, spec), "extract_rows")  # small, and read by every check
    ctrl = control.where((F.col("PROFILTYPE") == profile) & (F.col("MODUS") == geolevel) & (F.col("AARGANG").cast("string") == str(year)))
    ids = (ex.select("Friskvik").distinct().withColumn("__ind", one.indicator_of(F.col("Friskvik")))
           .withColumn("__tag", F.regexp_extract("Friskvik", DATETAG_PATTERN, 0))
           .join(ctrl.select(F.col("INDIKATOR").alias("__ind"), "KUBE_NAVN", "Periode_bm", "Periode_nn", "Enhet"), "__ind", "left"))
    files, specs = {}, {}
    for r in ids.where(F.col("KUBE_NAVN").isNotNull()).select("KUBE_NAVN", "__tag").distinct().collect():
        cube = f"{r['KUBE_NAVN']}_{r['__tag']}"
        found = [p for p in find_by_datetag(spark, cube_folders, r["__tag"], r["KUBE_NAVN"]) if p.rsplit("/", 1)[-1].startswith(cube)]
        spec_files = [p for p in find_by_datetag(spark, [spec_folder], r["__tag"], r["KUBE_NAVN"]) if p.rsplit("/", 1)[-1].startswith(cube)]
        if len(found) == 1:
            files[cube] = found[0]
        if len(spec_files) == 1:
            specs[cube] = spec_files[0]
    text = ", ".join(f"{c} string" for c in one.REPORT_COLS)
    if not files:
        rows = [F.col("Friskvik")] + [F.lit("not_loaded" if c == "ALT_OK" else None).cast("string").alias(c) for c in one.REPORT_COLS[1:]]
        return ids.select(*rows) if extract_paths else spark.createDataFrame([], text)
    cubes, info = read_cube_files(spark, files, spec)
    info = F.broadcast(info)  # a row for each cube file
    ids = ids.withColumn("__cube", F.concat_ws("_", "KUBE_NAVN", "__tag")).join(info, "__cube", "left")
    loaded = F.col("Kube").isNotNull()
    link = checked_broadcast(ids.where(loaded).select("Friskvik", "__cube", "__cdims"))
    ex = materialize(ex.join(link, "Friskvik").withColumn("__common", F.array_intersect("__edims", "__cdims")), "linked_rows")
    # the cubes are scanned once; the rows that extracts ask for are few, and read by every check
    cf = materialize(filter_cubes_to_extracts(cubes, ex, spec), "asked_rows")
    common = checked_broadcast(ex.select(F.col("Friskvik").alias("__f"), "__common").distinct())
    dims = [d for d in spec.dims if d in cubes.columns]
    vals = [v for v in identify_coltypes(cubes.drop("__cube"), spec=spec).vals_new if not re.search(r"RATE.n|SPVFLAGG", v)]
    # pairing: a dimension that only one side has is NULL on both
    shared = lambda df: df.withColumns({d: F.when(F.array_contains("__common", d), col(d)) for d in dims})
    e_key = shared(ex).select("Friskvik", *[col(d) for d in dims], "MEIS")
    c_key = shared(cf.join(common, F.col("Friskvik") == F.col("__f"))).drop("__f", "__common", "__cube")
    pairs = one._paired(e_key, c_key, dims, spec.period, spec).groupBy(F.col("__key").alias("Friskvik")).agg(one._mask_agg(spec.flag), *one._match_aggs(vals))
    ex_side = ex.groupBy("Friskvik").agg(one._levels_agg(ex, "ETAB", "FRISKVIK_ETAB"), one._levels_agg(ex, spec.period, "FRISKVIK_AAR"), F.max(spec.period).alias("__emax"), F.max("__stored").alias("__stored"))
    cube_side = cf.groupBy("Friskvik").agg(*[one._levels_agg(cf, d, f"KUBE_{d}") for d in ("KJONN", "ALDER", "UTDANN", "INNVKAT", "LANDBAK")],
                                           F.max(spec.period).alias("__cmax"))
    ref = spark.createDataFrame([], "__cube string, ref string")
    if specs:
        rows = read_csv_by_name(spark, list(specs.values()), lambda v: F.array_contains(v, "Kolonne") & F.array_contains(v, "Innhold"))
        ref = (rows.select(F.col("cube").alias("__cube"), _named("Kolonne").alias("k"), _named("Innhold").alias("ref"))
               .where(F.col("k") == "REFVERDI_VP").groupBy("__cube").agg(F.max("ref").alias("ref")))
    pub = published.select(F.col("file").alias("__cube")).distinct().withColumn("__pub", F.lit(True))
    rep = ids
    for part, key in ((ex_side, "Friskvik"), (cube_side, "Friskvik"), (pairs, "Friskvik"), (ref, "__cube"), (pub, "__cube")):
        rep = rep.join(part, key, "left")
    own = lambda v: F.array_contains("__cvals", v)
    match = F.array_compact(F.array(*[F.when(F.col(f"__m_{v}") & own(v), F.lit(v)) for v in vals]))
    differ = F.array_compact(F.array(*[F.when(~F.col(f"__m_{v}") & own(v), F.lit(v)) for v in vals]))
    paired = F.col("__badgeo").isNotNull()
    blank = lambda c, t: F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), F.lit(t)).otherwise(F.col(c).cast("string"))
    if_loaded = lambda c: F.when(loaded, c)
    has = lambda d: F.when(F.array_contains("__cdims", d), F.col(f"KUBE_{d}")).alias(f"KUBE_{d}")
    rep = rep.select(
        "Friskvik", "Kube", if_loaded(F.when(F.col("__pub"), "TRUE").otherwise("FALSE")).alias("FIL_I_STATBANK"), F.when(F.col("__stored"), F.col("FRISKVIK_ETAB")).alias("FRISKVIK_ETAB"),
        *[has(d) for d in ("KJONN", "ALDER", "UTDANN", "INNVKAT", "LANDBAK")], "FRISKVIK_AAR",
        if_loaded(F.when(F.col("__emax") == F.col("__cmax"), "Yes").otherwise("!!NO!!")).alias("SISTE_AAR"),
        if_loaded(blank("Periode_bm", "!! empty")).alias("Periode_bm"), if_loaded(blank("Periode_nn", "!! empty")).alias("Periode_nn"),
        F.when(paired, one._mask_text(F.col("__badgeo"))).alias("IDENTISK_PRIKKING"),
        F.when(paired, F.when(F.size(match) == 0, "!!NO MATCH!!").otherwise(F.concat_ws(", ", match))).alias("MATCHER_KOLONNE"),
        F.when(paired, F.concat_ws(", ", differ)).alias("Different_kubecol"), if_loaded(blank("Enhet", "!!MISSING")).alias("Enhet"),
        if_loaded(F.coalesce("ref", F.lit("!! MISSING from SPECS-file"))).alias("REFVERDI_VP"), loaded.alias("__loaded"))
    rep = rep.withColumn("VALID_kombo", F.when(F.col("__loaded"), one.valid_combination(F.col("Enhet"), F.col("REFVERDI_VP"), F.col("MATCHER_KOLONNE"))))
    alert = reduce(lambda a, b: a | b, [F.coalesce(F.col(c).contains("!!"), F.lit(False)) for c in one.CHECKED_FOR_ALERTS])
    return rep.withColumn("ALT_OK", F.when(~F.col("__loaded"), "not_loaded").when(alert, "!! KANSKJE IKKE !!").otherwise("Ja")).select(*one.REPORT_COLS)

"""Downstream extracts vs their source cube: F4, A12, C7-C13, S9-S11.

The reference loops over extract files one by one.  Here all extracts of
a cube are ONE DataFrame with the extract's file name in ``Friskvik``; every
check is a grouped aggregate or join keyed by it, and the report is one
row per extract.  Extracts and cube rows are matched by key (T9), not by
row position.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeguard.functions.joins import _level_key, checked_broadcast
from cubeguard.functions.numbering import occurrence_numbers
from cubeguard.spec import DEFAULT_SPEC, CubeSpec, DATETAG_PATTERN, col, identify_coltypes, select_outlier_pri

# Level of an expired dimension the cube is fixed at, per
# dimension, with exceptions per indicator (T8: the intended behaviour)
EXPIRED_DIM_LEVEL = {"INNVKAT": 0, "LANDBAK": 0, "UTDANN": 0}
EXPIRED_DIM_EXCEPTIONS = {
    "LANDBAK": ({"Innvand_0_17", "INNVAND_barn"}, 100),
    "UTDANN": ({"UTDANNING_NH", "UTDANN_HOY"}, 23),
}
# Report columns in order
REPORT_COLS = ("Friskvik", "Kube", "ALT_OK", "FIL_I_STATBANK", "FRISKVIK_ETAB", "KUBE_KJONN", "KUBE_ALDER",
               "KUBE_UTDANN", "KUBE_INNVKAT", "KUBE_LANDBAK", "FRISKVIK_AAR", "SISTE_AAR", "Periode_bm",
               "Periode_nn", "IDENTISK_PRIKKING", "MATCHER_KOLONNE", "Different_kubecol", "Enhet",
               "REFVERDI_VP", "VALID_kombo")
CHECKED_FOR_ALERTS = ("SISTE_AAR", "Periode_bm", "Periode_nn", "IDENTISK_PRIKKING", "MATCHER_KOLONNE",
                      "VALID_kombo")
TOLERANCE = 1.5e-8

# The stored filters' words: literals (or marks in their place), operators and names, and nothing else.
_FILTER_WORD = re.compile(r"""\s*(?:(?P<mark>\#[ids]\#)|(?P<number>-?\d+(?:\.\d+)?)|(?P<text>"[^"]*"|'[^']*')|(?P<op>%in%|[=!<>]=|&&?|\|\|?|[<>!(),])
    |(?P<name>[^\W\d][\w.]*))""", re.X)


def indicator_of(filename: F.Column) -> F.Column:
    """Indicator name: the file name without ``_<datetag>`` and extension."""
    return F.regexp_replace(filename, "_" + DATETAG_PATTERN + r".*$", "")


# The literals of a stored filter: text, and numbers that are no part of a name.
_LITERAL = r"""("[^"]*"|'[^']*'|(?<![\w.])-?\d+(?:\.\d+)?(?![\w.]))"""
# A literal's mark in a shape by its kind: text, decimal number, integer.
_MARKS = ((r"""^["']""", "#s#"), (r"\.", "#d#"), ("", "#i#"))


def filter_shape(text: F.Column) -> tuple:
    """(shape, literals) of stored filters: a shape has a mark ``#i#``, ``#d#`` or ``#s#`` in place of
    each literal, so filters that differ by their literals only have one shape."""
    literals = F.regexp_extract_all(text, F.lit(_LITERAL), 1)
    between = F.split(text, _LITERAL, -1)
    mark = lambda x: F.when(x.rlike(_MARKS[0][0]), _MARKS[0][1]).when(x.rlike(_MARKS[1][0]), _MARKS[1][1]).otherwise(_MARKS[2][1])
    shape = F.concat(F.array_join(F.zip_with(F.slice(between, 1, F.size(literals)), literals, lambda b, x: F.concat(b, mark(x))), ""),
                     F.element_at(between, -1))
    plain = F.transform(literals, lambda x: F.when(x.rlike(_MARKS[0][0]), F.substring(x, F.lit(2), F.length(x) - 2)).otherwise(x))
    return shape, plain


def etab_predicate(text: str, literals: F.Column | None = None) -> F.Column:
    """a stored filter (``GEO > 0 & !is.na(RATE) & KJONN %in% c(1, 2)``) as a Column.

    The text may hold comparisons of a column with a literal, ``%in% c(...)``,
    ``is.na(column)``, ``!``, ``&``, ``|`` and brackets; anything else, such as
    a function call, is an error.  Columns are built from it directly, so no
    part of it is ever evaluated as SQL.  In the place of literals a shape
    (:func:`filter_shape`) has marks, which stand for ``literals`` in their order.
    """
    words, at, marks = [], 0, 0
    while text[at:].strip():
        m = _FILTER_WORD.match(text, at)
        if m is None:
            raise ValueError(f"unsupported filter text: {text!r}")
        words.append((m.lastgroup, m.group(m.lastgroup)))
        at = m.end()
    words.append(("end", ""))
    words.reverse()

    def take(kind=None, *values):
        if (kind and words[-1][0] != kind) or (values and words[-1][1] not in values):
            raise ValueError(f"unsupported filter text: {text!r}")
        return words.pop()[1]

    def literal():
        nonlocal marks
        if words[-1][0] == "mark" and literals is not None:
            value = literals[marks]
            marks += 1
            return value.cast({"i": "bigint", "d": "double", "s": "string"}[take()[1]])
        if words[-1][0] == "number":
            value = take()
            return F.lit(float(value) if "." in value else int(value))
        return F.lit(take("text")[1:-1])

    def many(part, *ops):
        out = part()
        while words[-1][1] in ops:
            out = out & part() if take()[0] == "&" else out | part()
        return out

    def one():
        if words[-1] == ("op", "!"):
            take()
            return ~one()
        if words[-1] == ("op", "("):
            take()
            out = either()
            take("op", ")")
            return out
        name = take("name")
        if name == "TRUE" and (words[-1][0] == "end" or words[-1][1] in ("&", "&&", "|", "||", ")")):
            return F.lit(True)
        if words[-1] == ("op", "("):
            if name != "is.na":
                raise ValueError(f"unsupported filter text: {text!r}")
            take()
            name = take("name")
            take("op", ")")
            return col(name).isNull()
        op = take("op", "%in%", "==", "!=", "<", ">", "<=", ">=")
        if op == "%in%":
            take("name", "c")
            take("op", "(")
            values = [literal()]
            while take("op", ",", ")") == ",":
                values.append(literal())
            return reduce(lambda a, b: a | b, [col(name) == v for v in values])
        value = literal()
        return {"==": col(name) == value, "!=": col(name) != value, "<": col(name) < value, ">": col(name) > value,
                "<=": col(name) <= value, ">=": col(name) >= value}[op]

    def either():
        return many(lambda: many(one, "&", "&&"), "|", "||")

    out = either()
    take("end")
    return out


def read_extracts(spark, paths, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """All extract CSV files in one scan; ``Friskvik`` = file name.

    ETAB (the stored filter text) stays text; other columns follow the cube
    type rule.
    """
    from cubeguard.sources.cubes import typed_column
    raw = (spark.read.option("header", True).option("sep", ";").csv(paths)
           .select("*", F.col("_metadata.file_name").alias("Friskvik")))
    sel = [F.col("Friskvik")] + ([F.col("ETAB")] if "ETAB" in raw.columns else [])
    sel += [typed_column(c, spec, dtype) for c, dtype in raw.dtypes if c not in ("Friskvik", "ETAB")]
    return raw.select(*sel)


def filter_cube_to_extracts(cube: DataFrame, extracts: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """F4 for all extracts at once: (Friskvik, cube row) pairs.

    Each extract's stored filter (ETAB) is applied, the cube is restricted
    to the extract's levels of every common dimension but the period, and
    dimensions the extract lacks are fixed at their configured level.
    """
    roles = identify_coltypes(extracts.drop("Friskvik"), cube, spec)
    dims = [d for d in roles.commondims if d != spec.period]
    # Which extracts have a level, for all dimensions in one lookup; a row then
    # appears once for each extract that has all of its levels, never before.
    # A list is bounded by the number of extracts, the lookup by their levels.
    # An extract goes with its stored filters: the numbers of their shapes and their literals.
    shapes, ex = [], extracts.withColumn("__x", F.struct("Friskvik"))
    if "ETAB" in extracts.columns:
        # only the shapes come to the driver, however many filters there are
        shape, literals = filter_shape(F.coalesce(F.trim("ETAB"), F.lit("")))
        shapes = sorted(r[0] for r in extracts.select(shape.alias("s")).distinct().collect() if r[0])
    if shapes:
        number = F.array_position(F.array(*[F.lit(x) for x in shapes]), shape).cast("int")
        stored = F.filter(F.collect_set(F.struct(number.alias("shape"), literals.alias("lits"))), lambda f: f["shape"] > 0)
        filters = extracts.groupBy(F.col("Friskvik").alias("__f")).agg(F.array_sort(stored).alias("__fs"))
        ex = (extracts.join(checked_broadcast(filters), F.col("Friskvik") == F.col("__f"))
              .withColumn("__x", F.struct("Friskvik", F.col("__fs").alias("filters"))))
    out, matching = cube, None
    if dims:
        keys = F.explode(F.array(*[_level_key(d, col(d)) for d in dims]))
        lookup = checked_broadcast(ex.select(keys.alias("__key"), "__x").groupBy("__key").agg(F.collect_set("__x").alias("__ex")))
        for k, d in enumerate(dims):
            level = lookup.select(F.col("__key").alias(f"__k{k}"), F.col("__ex").alias(f"__e{k}"))
            out = out.join(level, _level_key(d, col(d)) == F.col(f"__k{k}"))
            matching = F.col(f"__e{k}") if matching is None else F.array_intersect(matching, F.col(f"__e{k}"))
    else:
        matching = ex.agg(F.array_sort(F.collect_set("__x"))).scalar()  # bounded by the number of extracts
    if shapes:
        # each shape is one predicate, evaluated on a row's extracts before the row is repeated for them
        def passes(x):
            def holds(f):
                ok = F.lit(False)
                for k, shape in enumerate(shapes, 1):
                    ok = F.when(f["shape"] == k, etab_predicate(shape, f["lits"])).otherwise(ok)
                return F.coalesce(ok, F.lit(False))
            return F.forall(x["filters"], holds)
        matching = F.filter(matching, passes)
    out = out.select(*[col(c) for c in cube.columns], F.explode(F.array_distinct(F.transform(matching, lambda x: x["Friskvik"]))).alias("Friskvik"))
    ind = indicator_of(F.col("Friskvik"))
    for d in roles.expdims:
        if d in EXPIRED_DIM_LEVEL:
            level = F.lit(EXPIRED_DIM_LEVEL[d])
            if d in EXPIRED_DIM_EXCEPTIONS:
                names, lv = EXPIRED_DIM_EXCEPTIONS[d]
                level = F.when(ind.isin(*sorted(names)), F.lit(lv)).otherwise(level)
            out = out.where(col(d) == level)
    return out


def _levels_agg(df: DataFrame, dim: str, alias: str):
    """A12 aggregate: sorted distinct levels as a comma list (NULL when absent)."""
    if dim not in df.columns:
        return F.lit(None).cast("string").alias(alias)
    return F.concat_ws(", ", F.array_sort(F.collect_set(F.coalesce(col(dim).cast("string"), F.lit("NA"))))) \
        .alias(alias)


def unique_levels(df: DataFrame, dim: str, key: str = "Friskvik") -> DataFrame:
    """Sorted distinct levels of ``dim`` as a comma list per extract
    (NULL when the column is absent)."""
    return df.groupBy(key).agg(_levels_agg(df, dim, dim))


def last_year_check(extracts: DataFrame, cube_f: DataFrame, period: str = "AAR") -> DataFrame:
    """Does the extract's last period equal the cube's last period?"""
    e = extracts.groupBy("Friskvik").agg(F.max(period).alias("__e"))
    c = cube_f.groupBy(F.col("Friskvik").alias("__f")).agg(F.max(period).alias("__c"))
    j = e.join(c, e["Friskvik"] == c["__f"], "left")
    return j.select("Friskvik", F.when(F.col("__e") == F.col("__c"), "Yes").otherwise("!!NO!!").alias("SISTE_AAR"))


def _paired(extracts: DataFrame, cube_f: DataFrame, dims, period: str, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Extract rows and cube rows of the extract's periods, matched by key.

    A key that is held several times pairs as a multiset: its n-th extract row by MEIS
    with its n-th cube row by the measures (the outlier measure first), NULLs first on
    both sides; what one side holds more often stays without a partner.
    """
    years = extracts.select(F.col("Friskvik").alias("__fy"), F.col(period).alias("__y")).distinct()
    c = cube_f.join(years, (F.col("Friskvik") == F.col("__fy")) & (col(period) == F.col("__y")), "left_semi")
    keys = ["Friskvik"] + list(dims)
    c = occurrence_numbers(c, keys, pairing_order(cube_f, spec), "__occ")
    e = occurrence_numbers(extracts.select(*[col(k) for k in keys], "MEIS"), keys, ["MEIS"], "__occ")
    # the cube may have a measure of that name as well
    e = e.select(*[col(k).alias(f"__e_{k}") for k in keys], F.col("MEIS").alias("__meis"), F.col("__occ").alias("__e_occ"))
    cond = reduce(lambda a, b: a & b, [c[k].eqNullSafe(e[f"__e_{k}"]) for k in keys])
    j = c.withColumn("__in_cube", F.lit(True)).join(e.withColumn("__in_ext", F.lit(True)), cond & (F.col("__occ") == F.col("__e_occ")), "full")
    key = F.coalesce(F.col("Friskvik"), F.col("__e_Friskvik")).alias("__key")
    geo = F.coalesce(F.col("GEO"), F.col("__e_GEO")) if "GEO" in dims else F.lit(None)
    return j.select("*", key, geo.alias("__geo"))


def pairing_order(cube: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> list:
    """The cube's measures in the order in which rows of one key are paired."""
    roles = identify_coltypes(cube.drop("Friskvik"), spec=spec)
    best = select_outlier_pri(cube.drop("Friskvik"), roles=roles, spec=spec)
    return sorted(roles.vals_new, key=lambda v: v != best)


def _mask_differs(flag: str) -> F.Column:
    """Whether a paired row's censoring differs, or one side lacks it."""
    same = (F.col("__in_cube").isNotNull() & F.col("__in_ext").isNotNull()
            & (F.col("__meis").isNull() == (col(flag) > 0)))
    return ~F.coalesce(same, F.lit(False))


def mask_areas(extracts: DataFrame, cube_f: DataFrame, dims, period: str = "AAR", flag: str = "SPVFLAGG") -> DataFrame:
    """C9, long form: a row (Friskvik, GEO) per area whose censoring differs."""
    p = _paired(extracts, cube_f, dims, period).where(_mask_differs(flag))
    return p.select(F.col("__key").alias("Friskvik"), F.col("__geo").cast("bigint").alias("GEO")).distinct()


def _mask_agg(flag: str):
    """C9 aggregate over paired rows: sorted GEO codes whose censoring differs."""
    bad_geo = F.when(_mask_differs(flag), F.col("__geo").cast("bigint").cast("string"))
    return F.array_sort(F.collect_set(bad_geo)).alias("__badgeo")


def _mask_text(badgeo: F.Column) -> F.Column:
    return F.when(F.coalesce(F.size(badgeo), F.lit(0)) == 0, "Yes") \
        .otherwise(F.concat(F.lit("!!NO!! Diff for GEO: "), F.concat_ws(", ", badgeo)))


def compare_censoring_mask(extracts: DataFrame, cube_f: DataFrame, dims, period: str = "AAR",
                           flag: str = "SPVFLAGG") -> DataFrame:
    """Is the extract's value missing exactly where the cube is censored?"""
    p = _paired(extracts, cube_f, dims, period)
    g = p.groupBy(F.col("__key").alias("Friskvik")).agg(_mask_agg(flag))
    return g.select("Friskvik", _mask_text(F.col("__badgeo")).alias("IDENTISK_PRIKKING"))


def compare_values(extracts: DataFrame, cube_f: DataFrame, dims, cube_values, period: str = "AAR",
                   tol: float = TOLERANCE) -> DataFrame:
    """Which cube measures equal the extract's MEIS on every row
    (relative tolerance ``tol``, NULL equals NULL)?"""
    p = _paired(extracts, cube_f, dims, period)
    g = p.groupBy(F.col("__key").alias("Friskvik")).agg(*_match_aggs(cube_values, tol))
    return g.select("Friskvik", *_match_texts(cube_values))


def _match_aggs(cube_values, tol: float = TOLERANCE):
    """C10 aggregates over paired rows: per cube measure, equal on every row?"""
    aggs = []
    for v in cube_values:
        a, b = F.col("__meis"), col(v).cast("double")
        close = F.abs(a - b) <= F.lit(tol) * F.greatest(F.abs(a), F.abs(b), F.lit(1.0))
        eq = (F.col("__in_cube").isNotNull() & F.col("__in_ext").isNotNull()
              & ((a.isNull() & b.isNull()) | F.coalesce(close, F.lit(False))))
        aggs.append(F.bool_and(F.coalesce(eq, F.lit(False))).alias(f"__m_{v}"))
    return aggs


def _match_texts(cube_values):
    match = F.array_compact(F.array(*[F.when(F.col(f"__m_{v}"), F.lit(v)) for v in cube_values]))
    diff = F.array_compact(F.array(*[F.when(~F.col(f"__m_{v}"), F.lit(v)) for v in cube_values]))
    return [F.when(F.size(match) == 0, F.lit("!!NO MATCH!!")).otherwise(F.concat_ws(", ", match))
            .alias("MATCHER_KOLONNE"), F.concat_ws(", ", diff).alias("Different_kubecol")]


def valid_combination(enhet: F.Column, refverdi: F.Column, matches: F.Column) -> F.Column:
    """Unit '(ak..)', reference P/D and a MEIS match: all three or none."""
    is_ak = F.coalesce(enhet.rlike(r"\([ak,]+\)"), F.lit(False))
    is_pd = F.coalesce(refverdi.isin("P", "D"), F.lit(False))
    is_meis = F.coalesce(F.array_contains(F.split(matches, ", "), "MEIS"), F.lit(False))
    all_ = is_ak & is_pd & is_meis
    none_ = ~(is_ak | is_pd | is_meis)
    return F.when(all_ | none_, "Yes").otherwise("!! No!!")


def check_friskvik(extracts: DataFrame, cube: DataFrame, cube_filename: str, control: DataFrame,
                   spec_table: DataFrame, published: DataFrame, profile: str, geolevel: str, year,
                   spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """One report row per extract (all columns text).

    ``control`` = control table FRISKVIK (PROFILTYPE, AARGANG, MODUS,
    INDIKATOR, KUBE_NAVN, Periode_bm, Periode_nn, Enhet); extracts whose
    indicator has no control row for ``cube_filename``'s cube are not
    loaded and get ALT_OK = "not_loaded" (T29).  ``published`` lists the
    published cube ids (name_datetag, T31).
    """
    from cubeguard.spec import get_cubefilename, get_cubename
    cubename = get_cubename(cube_filename)
    ctrl = control.where((F.col("PROFILTYPE") == profile) & (F.col("MODUS") == geolevel)
                         & (F.col("AARGANG").cast("string") == str(year)))
    ids = extracts.select("Friskvik").distinct().withColumn("__ind", indicator_of(F.col("Friskvik")))
    ids = ids.join(ctrl.select(F.col("INDIKATOR").alias("__ind"), "KUBE_NAVN", "Periode_bm", "Periode_nn", "Enhet"),
                   "__ind", "left")
    loaded_ids = ids.where(F.col("KUBE_NAVN") == cubename).select("Friskvik")
    ex = extracts.join(loaded_ids, "Friskvik", "left_semi")
    roles = identify_coltypes(ex.drop("Friskvik"), cube, spec)
    dims = roles.commondims
    cube_f = filter_cube_to_extracts(cube, ex, spec)
    kubevals = [v for v in roles.vals_old if not re.search(r"RATE.n|SPVFLAGG", v)]
    # three grouped aggregates keyed by the extract: extract side, cube side,
    # and the key-matched pairs (C8-C10, A12 in one pass each)
    ex_side = ex.groupBy("Friskvik").agg(_levels_agg(ex, "ETAB", "FRISKVIK_ETAB"),
                                         _levels_agg(ex, spec.period, "FRISKVIK_AAR"),
                                         F.max(spec.period).alias("__emax"))
    cube_side = cube_f.groupBy("Friskvik").agg(
        *[_levels_agg(cube_f, d, f"KUBE_{d}") for d in ("KJONN", "ALDER", "UTDANN", "INNVKAT", "LANDBAK")],
        F.max(spec.period).alias("__cmax"))
    pairs = _paired(ex, cube_f, dims, spec.period).groupBy(F.col("__key").alias("Friskvik")).agg(
        _mask_agg(spec.flag), *_match_aggs(kubevals))
    pairs = pairs.select("Friskvik", _mask_text(F.col("__badgeo")).alias("IDENTISK_PRIKKING"),
                         *_match_texts(kubevals))
    rep = ids.select("Friskvik", "KUBE_NAVN", "Periode_bm", "Periode_nn", "Enhet")
    for p in (ex_side, cube_side, pairs):
        rep = rep.join(p, "Friskvik", "left")
    rep = rep.withColumn("SISTE_AAR", F.when(F.col("KUBE_NAVN") == cubename, F.when(
        F.col("__emax") == F.col("__cmax"), "Yes").otherwise("!!NO!!")))
    ref = spec_table.where(F.col("Kolonne") == "REFVERDI_VP").agg(F.max("Innhold")).scalar()
    pub = published.where(F.col("file") == get_cubefilename(cube_filename)).agg(F.count(F.lit(1)) > 0).scalar()
    loaded = F.col("KUBE_NAVN") == cubename
    missing = lambda c, text: F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""),
                                     F.lit(text)).otherwise(F.col(c).cast("string"))
    rep = rep.select(
        "Friskvik",
        F.when(loaded, F.lit(cube_filename)).alias("Kube"),
        F.when(loaded, F.when(pub, "TRUE").otherwise("FALSE")).alias("FIL_I_STATBANK"),
        "FRISKVIK_ETAB", "KUBE_KJONN", "KUBE_ALDER", "KUBE_UTDANN", "KUBE_INNVKAT", "KUBE_LANDBAK",
        "FRISKVIK_AAR", "SISTE_AAR",
        F.when(loaded, missing("Periode_bm", "!! empty")).alias("Periode_bm"),
        F.when(loaded, missing("Periode_nn", "!! empty")).alias("Periode_nn"),
        "IDENTISK_PRIKKING", "MATCHER_KOLONNE", "Different_kubecol",
        F.when(loaded, missing("Enhet", "!!MISSING")).alias("Enhet"),
        F.when(loaded, F.coalesce(ref, F.lit("!! MISSING from SPECS-file"))).alias("REFVERDI_VP"),
        loaded.alias("__loaded"))
    rep = rep.withColumn("VALID_kombo", F.when(F.col("__loaded"), valid_combination(
        F.col("Enhet"), F.col("REFVERDI_VP"), F.col("MATCHER_KOLONNE"))))
    alert = reduce(lambda a, b: a | b, [F.coalesce(F.col(c).contains("!!"), F.lit(False)) for c in CHECKED_FOR_ALERTS])
    rep = rep.withColumn("ALT_OK", F.when(~F.coalesce(F.col("__loaded"), F.lit(False)), "not_loaded")
                         .when(alert, "!! KANSKJE IKKE !!").otherwise("Ja"))
    return rep.select(*REPORT_COLS)

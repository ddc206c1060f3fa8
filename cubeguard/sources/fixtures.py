"""Cube fixtures derived from the driver tables.

The QC operators work on statistical cubes.  These builders derive a *new*
and an *old* version of such a cube from the TPC-H-like driver tables, so
every registered query reads the given tables and its work grows with them:

* base = lineitem JOIN orders JOIN customer JOIN nation (every lineitem row);
* area levels: L = 0 (country), F = regionkey + 1, K = 100*(regionkey+1) +
  nationkey, B = 100*K + segment index (1..4) for nations 0..3 (the four
  "cities"; segment 5 is left out so part of each city is "unknown"),
  V = 100000000 + suppkey (one area per supplier, so the cube grows with the
  tables);
* AAR = order year as ``YYYY_YYYY``; KJONN 0 total / 1 status F / 2 status O;
  ALDER = line-number bands 1_2, 3_4, 5_7 and total 1_7;
* TELLER = returned quantity, NEVNER = quantity, RATE = 1000*TELLER/NEVNER,
  RATE.n = rows; SPVFLAGG = 1 when TELLER <= 20, then the measures are NULL
  and TELLER_uprikk keeps the value;
* new cube: all lines, extra dim INNVKAT (0 total, 1/2 = supplier parity);
* old cube: the earlier version, which did not yet hold the lines with the
  highest discount (0.10) nor the latest year, with extra dim UTDANN (0
  total, 1..5 = order priority) and the highest nation under an outdated
  municipality code (current + 1000), so the code map has work to do;
* WEIGHTS (geo parameters) = number of customers in the area.

Plan shape: the wide join, dealt by rows, is aggregated once to the finest
cell grain (partial aggregation before the shuffle).  The cells of a supplier are dealt
by it, so its totals are added up where its cells are, and only the cells of
the other areas, whose number does not grow with the tables, are shuffled
after their expansion to levels.  Partitions go by rows, not by bytes: cells
take few bytes as parquet, and a split of them would be far too many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture design
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
CITY_NATIONS = (0, 1, 2, 3)
SUPPLIER_CODE = 100_000_000
SUPPLIER_WEIGHT = 10.0
DISTRICT_SEGMENTS = (1, 2, 3, 4)
SUPPRESSION_LIMIT = 20
OLD_MAX_DISCOUNT = 0.095
OLD_CODE_OFFSET = 1000
AGE_BANDS = (("1_2", 1, 2), ("3_4", 3, 4), ("5_7", 5, 7))
AGE_TOTAL = "1_7"
# a partition holds about so many lines, or the cells made of them
LINES_PER_PART = 500_000
# and where lines and cells are dealt, about so many: a task that deals its rows to
# more than 200 partitions sorts them in memory first, so they are no more than need be
LINES_PER_DEAL = 1_250_000
# municipality code -> name of the four cities (nations 0..3)
CITY_PARENTS = {100: "NATION_0", 201: "NATION_1", 302: "NATION_2", 403: "NATION_3"}
# county / municipality pair that covers the same area in the OO comparison
OO_PAIR = (1, 100)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _segment_index(c):
    expr = None
    for i, s in enumerate(SEGMENTS, start=1):
        expr = F.when(c == s, i) if expr is None else expr.when(c == s, i)
    return expr


def partitions_for(spark: SparkSession, sf_dir: str, per_part: int | None = None) -> int:
    """Partitions that follow the number of lines (a parquet row count, answered from file metadata)."""
    key = _memo_key(spark, sf_dir, "lines")
    if key not in _MEMO:
        _MEMO[key] = table(spark, sf_dir, "lineitem").count()
    return max(spark.sparkContext.defaultParallelism, -(-_MEMO[key] // (per_part or LINES_PER_PART)))


def fine_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finest-grain aggregate of the base join (one shuffle, map-side combine)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag",
        "l_linestatus", "l_discount")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    na = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    # orders are placed first (orders x customer x nation, the shuffle by
    # customer key moves orders only), then lineitem joins on the order key:
    # the wide lineitem side is shuffled once
    oc = (od.join(cu, od.o_custkey == cu.c_custkey)
          .join(na, cu.c_nationkey == na.n_nationkey)
          .select("o_orderkey", "o_orderdate", "o_orderpriority", "c_mktsegment", "n_nationkey", "n_regionkey"))
    # beyond a partition a core they are dealt by rows, so that a task sorts
    # and combines no more lines where the session's shuffle partitions are
    # few; below that Spark deals them as finely, and may broadcast the orders
    parts = partitions_for(spark, sf_dir, LINES_PER_DEAL)
    if parts > spark.sparkContext.defaultParallelism:
        li, oc = li.repartition(parts, "l_orderkey"), oc.repartition(parts, "o_orderkey")
    base = li.join(oc, li.l_orderkey == oc.o_orderkey)
    band = None
    for label, lo, hi in AGE_BANDS:
        cond = F.col("l_linenumber").between(lo, hi)
        band = F.when(cond, label) if band is None else band.when(cond, label)
    areas = [F.col("n_regionkey").cast("bigint").alias("r"), F.col("n_nationkey").cast("bigint").alias("n"),
             _segment_index(F.col("c_mktsegment")).cast("bigint").alias("s"), F.lit(None).cast("bigint").alias("v")]
    none = [F.lit(None).cast("bigint").alias(c) for c in "rns"]
    supplier = none + [(F.lit(SUPPLIER_CODE) + F.col("l_suppkey")).cast("bigint").alias("v")]
    rows = base.select("*", F.explode(F.array(F.struct(*areas), F.struct(*supplier))).alias("area"))
    return (rows.select(
        "area.*", F.year("o_orderdate").alias("y"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(2).cast("bigint").alias("kj"),
        band.alias("band"),
        (F.col("l_suppkey") % 2 + 1).cast("bigint").alias("innv"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("utd"),
        (F.col("l_discount") < OLD_MAX_DISCOUNT).alias("in_old"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0).alias("q_r"),
        F.col("l_quantity").alias("q"))
        .groupBy("r", "n", "s", "v", "y", "kj", "band", "innv", "utd", "in_old")
        .agg(F.sum("q_r").alias("t"), F.sum("q").alias("nv"), F.count(F.lit(1)).alias("cnt")))


def _geo_array(renamed: bool):
    k = F.lit(100) * (F.col("r") + 1) + F.col("n")
    if renamed:
        k = F.when(F.col("renamed"), k + OLD_CODE_OFFSET).otherwise(k)
    b = (F.lit(100) * (F.lit(100) * (F.col("r") + 1) + F.col("n")) + F.col("s"))
    is_district = F.col("n").isin(*CITY_NATIONS) & F.col("s").isin(*DISTRICT_SEGMENTS)
    return F.filter(F.array(F.when(F.col("v").isNull(), F.lit(0).cast("bigint")), (F.col("r") + 1).cast("bigint"),
                            k.cast("bigint"), F.when(is_district, b.cast("bigint")), F.col("v")), lambda x: x.isNotNull())


def _with_totals(cells: DataFrame, extra_dim: str, extra_src: str) -> DataFrame:
    """Cells (with their ``GEO``) added up to the rows of a cube, its totals included."""
    expanded = (cells
                .select("*", F.explode(F.array(F.lit(0).cast("bigint"), F.col("kj"))).alias("KJONN"))
                .select("*", F.explode(F.array(F.lit(AGE_TOTAL), F.col("band"))).alias("ALDER"))
                .select("*", F.explode(F.array(F.lit(0).cast("bigint"), F.col(extra_src))).alias(extra_dim)))
    return (expanded.groupBy("GEO", F.concat_ws("_", F.col("y").cast("string"), F.col("y").cast("string")).alias("AAR"), "KJONN", "ALDER", extra_dim)
            .agg(F.sum("t").alias("TELLER_uprikk"), F.sum("nv").alias("NEVNER_uprikk"),
                 F.sum("cnt").alias("RATE_n_uprikk")))


def _cube_from_cells(cells: DataFrame, extra_dim: str, extra_src: str, parts: int, renamed_nation=None) -> DataFrame:
    grain = ["y", "kj", "band", extra_src]
    sums = [F.sum(c).alias(c) for c in ("t", "nv", "cnt")]
    areas = cells.where(F.col("v").isNull())
    if renamed_nation is not None:
        areas = areas.withColumn("renamed", F.col("n") == renamed_nation)
    areas = areas.select(F.explode(_geo_array(renamed_nation is not None)).alias("GEO"), *grain, "t", "nv", "cnt")
    # a supplier's cells come together before they are expanded: no shuffle follows
    suppliers = (cells.where(F.col("v").isNotNull()).select(F.col("v").alias("GEO"), *grain, "t", "nv", "cnt")
                 .repartition(parts, "GEO").groupBy("GEO", *grain).agg(*sums))
    cube = _with_totals(areas, extra_dim, extra_src).unionByName(_with_totals(suppliers, extra_dim, extra_src))
    censored = F.col("TELLER_uprikk") <= SUPPRESSION_LIMIT
    return cube.select(
        "GEO", "AAR", "KJONN", "ALDER", extra_dim,
        F.when(~censored, F.col("TELLER_uprikk")).alias("TELLER"),
        F.when(~censored, F.col("NEVNER_uprikk")).alias("NEVNER"),
        F.when(~censored, F.round(F.lit(1000.0) * F.col("TELLER_uprikk") / F.col("NEVNER_uprikk"), 6)).alias("RATE"),
        F.when(~censored, F.col("RATE_n_uprikk").cast("double")).alias("RATE.n"),
        F.when(censored, 1).otherwise(0).cast("bigint").alias("SPVFLAGG"),
        F.col("TELLER_uprikk"))


def new_cube_raw(spark: SparkSession, sf_dir: str, cells: DataFrame | None = None) -> DataFrame:
    """New cube as read (before geo recoding and geo parameters)."""
    cells = fine_cells(spark, sf_dir) if cells is None else cells
    return _cube_from_cells(cells, "INNVKAT", "innv", partitions_for(spark, sf_dir, LINES_PER_DEAL))


def old_cube_raw(spark: SparkSession, sf_dir: str, cells: DataFrame | None = None) -> DataFrame:
    """Old cube as read: earlier lines only, no latest year, one outdated code."""
    cells = fine_cells(spark, sf_dir) if cells is None else cells
    latest = cells.agg(F.max("y")).scalar()
    cells = cells.where(F.col("in_old") & (F.col("y") < latest))
    return _cube_from_cells(cells, "UTDANN", "utd", partitions_for(spark, sf_dir, LINES_PER_DEAL), renamed_nation_key(spark, sf_dir))


def renamed_nation_key(spark: SparkSession, sf_dir: str):
    """Nation whose municipality code is outdated in the old cube (the highest key).

    Returned as a Column-free scalar sub-select so the plan stays lazy.
    """
    return _scalar(table(spark, sf_dir, "nation").agg(F.max("n_nationkey").cast("bigint")))


def _scalar(one_row: DataFrame):
    """Scalar subquery of a one-row, one-column DataFrame (stays lazy)."""
    return one_row.scalar()


def popinfo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geo parameters (GEO, GEOniv, WEIGHTS): number of customers per area, a
    fixed weight per supplier."""
    cu = table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment")
    na = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    c = (cu.join(na, cu.c_nationkey == na.n_nationkey)
         .select(F.col("n_regionkey").cast("bigint").alias("r"), F.col("n_nationkey").cast("bigint").alias("n"),
                 _segment_index(F.col("c_mktsegment")).cast("bigint").alias("s"))
         .groupBy("r", "n", "s").agg(F.count(F.lit(1)).alias("cnt")))
    is_district = F.col("n").isin(*CITY_NATIONS) & F.col("s").isin(*DISTRICT_SEGMENTS)
    levels = F.filter(F.array(
        F.struct(F.lit(0).cast("bigint").alias("GEO"), F.lit("L").alias("GEOniv")),
        F.struct((F.col("r") + 1).cast("bigint").alias("GEO"), F.lit("F").alias("GEOniv")),
        F.struct((F.lit(100) * (F.col("r") + 1) + F.col("n")).cast("bigint").alias("GEO"), F.lit("K").alias("GEOniv")),
        F.when(is_district, F.struct(
            (F.lit(100) * (F.lit(100) * (F.col("r") + 1) + F.col("n")) + F.col("s")).cast("bigint").alias("GEO"),
            F.lit("B").alias("GEOniv")))), lambda x: x.isNotNull())
    suppliers = table(spark, sf_dir, "supplier").select(
        (F.lit(SUPPLIER_CODE) + F.col("s_suppkey")).cast("bigint").alias("GEO"), F.lit("V").alias("GEOniv"),
        F.lit(SUPPLIER_WEIGHT).alias("WEIGHTS"))
    return (c.select(F.explode(levels).alias("g"), "cnt")
            .groupBy(F.col("g.GEO").alias("GEO"), F.col("g.GEOniv").alias("GEOniv"))
            .agg(F.sum("cnt").cast("double").alias("WEIGHTS")).unionByName(suppliers))


def georecode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code map (old, current) for the renamed municipality."""
    na = table(spark, sf_dir, "nation")
    top = na.agg(F.max("n_nationkey").alias("n"))
    return (na.join(top, na.n_nationkey == top.n)
            .select(((F.lit(100) * (F.col("n_regionkey") + 1) + F.col("n_nationkey")) + OLD_CODE_OFFSET)
                    .cast("bigint").alias("old"),
                    (F.lit(100) * (F.col("n_regionkey") + 1) + F.col("n_nationkey")).cast("bigint").alias("current")))


def small_area_threshold(spark: SparkSession, sf_dir: str) -> float:
    """Small-municipality threshold: all customers / 25 (scales with sf).

    A parquet row count (answered from file metadata), taken once per
    session and input folder.
    """
    key = _memo_key(spark, sf_dir, "threshold")
    if key not in _MEMO:
        _MEMO[key] = table(spark, sf_dir, "customer").count() / 25.0
    return _MEMO[key]


_MEMO: dict = {}


def _memo_key(spark: SparkSession, sf_dir: str, kind: str):
    """Fixture tables are written once per session and input folder; the
    key includes the input files' sizes and times, so changed inputs are
    rebuilt."""
    conf = spark._jsc.hadoopConfiguration()
    stamp = []
    for name in ("lineitem", "orders", "customer", "nation", "supplier"):
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        st = p.getFileSystem(conf).getFileStatus(p)
        stamp.append((st.getLen(), st.getModificationTime()))
    from cubeguard.session import session_id
    return (session_id(spark), sf_dir, kind, tuple(stamp))


def forget(session: str) -> None:
    """Forget the tables of a session, so they are derived again when asked for."""
    for key in [k for k in _MEMO if k[0] == session]:
        del _MEMO[key]


def fixture_pair(spark: SparkSession, sf_dir: str, materialize: bool = True):
    if not materialize:
        return _fixture_pair(spark, sf_dir, False)
    key = _memo_key(spark, sf_dir, "pair")
    if key not in _MEMO:
        _MEMO[key] = _fixture_pair(spark, sf_dir, True)
    return _MEMO[key]


def _fixture_pair(spark: SparkSession, sf_dir: str, materialize: bool = True):
    """S1 on the fixtures: (newcube, oldcube) after geo recoding (old only)
    and geo parameters, plus the small-area threshold.

    The checks scan a cube many times (level lists, profiles, both sides of
    joins).  A real cube is a file; here it is derived from the raw tables,
    so it is materialized once with a reliable checkpoint and the checks
    scan that instead of re-running the raw join.
    """
    from cubeguard.operators.geo import add_geoparams, recode_geo
    from cubeguard.session import materialize as _mat
    pop = popinfo(spark, sf_dir)
    cells = fixture_cells(spark, sf_dir) if materialize else None
    new = add_geoparams(new_cube_raw(spark, sf_dir, cells), pop)
    old = add_geoparams(recode_geo(old_cube_raw(spark, sf_dir, cells), georecode(spark, sf_dir)), pop)
    if materialize:
        new, old = _mat(new, "newcube"), _mat(old, "oldcube")
    return new, old, small_area_threshold(spark, sf_dir)


def fixture_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The finest-grain cell table, written once per session."""
    from cubeguard.session import materialize as _mat
    key = _memo_key(spark, sf_dir, "cells")
    if key not in _MEMO:
        _MEMO[key] = _mat(fine_cells(spark, sf_dir), "cells")
    return _MEMO[key]


def fixture_new(spark: SparkSession, sf_dir: str, materialize: bool = True) -> DataFrame:
    """The new cube alone (after geo parameters), materialized once per session."""
    if materialize:
        pair = _MEMO.get(_memo_key(spark, sf_dir, "pair"))
        if pair is not None:
            return pair[0]
        key = _memo_key(spark, sf_dir, "new")
        if key not in _MEMO:
            _MEMO[key] = _fixture_new(spark, sf_dir, True)
        return _MEMO[key]
    return _fixture_new(spark, sf_dir, False)


def _fixture_new(spark: SparkSession, sf_dir: str, materialize: bool = True) -> DataFrame:
    from cubeguard.operators.geo import add_geoparams
    from cubeguard.session import materialize as _mat
    cells = fixture_cells(spark, sf_dir) if materialize else None
    new = add_geoparams(new_cube_raw(spark, sf_dir, cells), popinfo(spark, sf_dir))
    return _mat(new, "newcube") if materialize else new


# ------------------------------------------------------------ control tables
# Fixed values of the fixture design: the cube name and its control rows
CUBE_NAME = "LINEITEM_RETURNS"
NEW_DATETAG = "2025-01-01-00-00"
OLD_DATETAG = "2024-01-01-00-00"
CONTROL_LIMIT = 25


def control_kuber(spark: SparkSession) -> DataFrame:
    """Control table KUBER: censoring limits per cube (one literal row)."""
    return spark.createDataFrame(
        [(CUBE_NAME, float(CONTROL_LIMIT), float(CONTROL_LIMIT), None, None)],
        "KUBE_NAVN string, PRIKK_T double, PRIKK_N double, Stata_PRIKK_T double, Stata_PRIKK_N double")


def spec_table(spark: SparkSession) -> DataFrame:
    """Spec file rows (Tabell, Kolonne, Innhold) with the additive sets."""
    rows = [("KUBER", "PRIKK_T", str(SUPPRESSION_LIMIT)),
            ("KUBER", "Stata_naboprKJONN", "{1,2,0}"),
            ("KUBER", "Stata_naboprALDER", "{1_2,3_4,5_7,1_7}"),
            ("KUBER", "Stata_naboprINNVKAT", "{1,2,0}"),
            ("KUBER", "Stata_naboprUTDANN", ""),
            ("FILGRUPPER", "Stata_naboprKJONN", "{9}")]
    return spark.createDataFrame(rows, "Tabell string, Kolonne string, Innhold string")


def with_suppression_bookkeeping(cube: DataFrame, parts: int | None = None) -> DataFrame:
    """pvern = 1 for censored cells; prikket_ok = 1 for the uncensored cell
    with the smallest TELLER_uprikk (lowest KJONN on ties) among the KJONN
    set {1,2,0} of the same other dimensions, when that set has a censored
    cell.  With ``parts`` those sets are dealt over so many partitions."""
    from pyspark.sql import Window
    others = [c for c in ("GEO", "AAR", "ALDER", "INNVKAT") if c in cube.columns]
    w_all = Window.partitionBy(*others)
    w_rank = Window.partitionBy(*others).orderBy(
        F.when(F.col("SPVFLAGG") == 0, 0).otherwise(1), F.col("TELLER_uprikk"), F.col("KJONN"))
    pvern = F.when(F.col("SPVFLAGG") == 1, 1).otherwise(0)
    out = (cube if parts is None else cube.repartition(parts, *others)).withColumn("pvern", pvern)
    out = out.withColumns({"__has": F.max("pvern").over(w_all), "__rn": F.row_number().over(w_rank)})
    ok = F.when((F.col("__has") == 1) & (F.col("__rn") == 1) & (F.col("SPVFLAGG") == 0), 1).otherwise(0)
    return out.withColumn("prikket_ok", ok).drop("__has", "__rn")


def population_cubes(new: DataFrame, old: DataFrame):
    """C5 inputs: the population cube (new version, INNVKAT total) and the
    growth cube computed from the old version (UTDANN total), TELLER =
    returned quantity; the growth cube's last period has no successor."""
    from pyspark.sql import Window
    befolk = (new.where(F.col("INNVKAT") == 0)
              .select("GEO", "AAR", "KJONN", "ALDER", F.col("TELLER_uprikk").alias("TELLER")))
    base = (old.where(F.col("UTDANN") == 0)
            .select("GEO", "AAR", "KJONN", "ALDER", F.col("TELLER_uprikk").alias("T")))
    w = Window.partitionBy("GEO", "KJONN", "ALDER").orderBy("AAR")
    befvekst = base.withColumn("TELLER", F.lead("T").over(w) - F.col("T")).drop("T")
    return befvekst, befolk


# ------------------------------------------------------------ barometer
# Fixed values of the fixture design: indicator number per age band
BAROMETER_LPNR = {"1_2": 1, "3_4": 2, "5_7": 3, "1_7": 4}


def barometer_tables(new: DataFrame, with_lpnr: bool = False, drop_lpnr=None):
    """(barometer, indicator list) for municipalities in the latest period.

    Indicator = age band; values are RATE rounded to tens for the
    municipality, its county and the country; the barometer colours a
    municipality red / green when its unrounded RATE is above / below the
    country's, and white when censored.  Indicator codes run in the reverse
    order of the indicator numbers (code = n + 2 - LPnr).
    """
    n_ind = len(BAROMETER_LPNR)
    lp = None
    for band, n in BAROMETER_LPNR.items():
        lp = F.when(F.col("ALDER") == band, n) if lp is None else lp.when(F.col("ALDER") == band, n)
    latest = new.agg(F.max("AAR")).scalar()
    base = new.where((F.col("KJONN") == 0) & (F.col("INNVKAT") == 0) & (F.col("AAR") == latest)) \
        .select("GEO", "GEOniv", "ALDER", "RATE", "SPVFLAGG", lp.cast("bigint").alias("LPnr"),
                F.regexp_extract("AAR", r"_(\d{4})$", 1).cast("int").alias("Aar"))
    k = base.where(F.col("GEOniv") == "K")
    f = base.where(F.col("GEOniv") == "F").select(F.col("GEO").alias("__f"), F.col("LPnr").alias("__lpf"),
                                                  F.col("RATE").alias("__rf"))
    land = base.where(F.col("GEO") == 0).select(F.col("LPnr").alias("__lpl"), F.col("RATE").alias("__rl"))
    j = (k.join(f, (F.floor(F.col("GEO") / 100) == F.col("__f")) & (F.col("LPnr") == F.col("__lpf")), "left")
         .join(land, F.col("LPnr") == F.col("__lpl"), "left"))
    ind = j.select("Aar", "LPnr", F.col("LPnr").alias("corrected_LPnr"),
                   F.col("GEO").cast("string").alias("Sted_kode"),
                   F.explode(F.array(F.lit("BOKMAAL"), F.lit("NYNORSK"))).alias("SpraakId"),
                   F.round("RATE", -1).alias("Verdi_lavesteGeonivaa"),
                   F.round("__rf", -1).alias("Verdi_mellomGeonivaa"),
                   F.round("__rl", -1).alias("Verdi_referansenivaa"))
    bar_cols = [F.col("GEO").cast("string").alias("stedskode_string"), F.col("GEO").alias("stedskode_numeric"),
                (F.lit(n_ind + 2) - F.col("LPnr")).alias("indikator_kodet")]
    if with_lpnr:
        bar_cols.append(F.col("LPnr"))
    bar = j.select(*bar_cols,
                   F.when(F.col("RATE") > F.col("__rl"), 1).alias("roede"),
                   F.when(F.col("RATE") < F.col("__rl"), 1).alias("groenne"),
                   F.when(F.col("SPVFLAGG") != 0, 1).alias("hvitMprikk"))
    if drop_lpnr is not None:
        bar = bar.where(F.col("indikator_kodet") != n_ind + 2 - drop_lpnr)
    return bar, ind


# ------------------------------------------------------------ extracts
PROFILE, GEOLEVEL = "FHP", "K"
INDICATORS = ("RETURNS_TOTAL", "RETURNS_MEN", "RETURNS_COUNT", "RETURNS_UNKNOWN")
SECOND_CUBE = "LINEITEM_TOTAL"


def extract_name(indicator: str) -> str:
    return f"{indicator}_{NEW_DATETAG}.csv"


def extracts_from_cube(new: DataFrame) -> DataFrame:
    """Downstream extracts of the new cube: municipalities, last 3 periods.

    * RETURNS_TOTAL: both sexes, all ages; MEIS = RATE (matches);
    * RETURNS_MEN: sex 1, all ages, stored filter ``GEO > 0``; MEIS = RATE
      with the highest municipality's value altered by +1;
    * RETURNS_COUNT: both sexes, ages 3_4; MEIS = TELLER, and also masked
      for the lowest municipality code (censoring differs);
    * RETURNS_UNKNOWN: as RETURNS_TOTAL but its indicator has no control row.
    """
    years = new.agg(F.max(F.regexp_extract("AAR", r"^(\d{4})", 1).cast("int"))).scalar()
    base = new.where((F.col("GEOniv") == "K") & (F.col("INNVKAT") == 0)
                     & (F.regexp_extract("AAR", r"^(\d{4})", 1).cast("int") > years - 3))
    kmax = base.agg(F.max("GEO")).scalar()
    kmin = base.agg(F.min("GEO")).scalar()

    def pick(indicator, kj, alder, meis, etab=None):
        return (base.where((F.col("KJONN") == kj) & (F.col("ALDER") == alder))
                .select(F.lit(extract_name(indicator)).alias("Friskvik"), F.lit(etab).cast("string").alias("ETAB"),
                        "GEO", "AAR", "KJONN", "ALDER", meis.alias("MEIS")))
    e1 = pick("RETURNS_TOTAL", 0, "1_7", F.col("RATE"))
    e2 = pick("RETURNS_MEN", 1, "1_7", F.when(F.col("GEO") == kmax, F.col("RATE") + 1).otherwise(F.col("RATE")),
              "GEO > 0")
    e3 = pick("RETURNS_COUNT", 0, "3_4", F.when(F.col("GEO") == kmin, F.lit(None)).otherwise(F.col("TELLER")))
    e4 = pick("RETURNS_UNKNOWN", 0, "1_7", F.col("RATE"))
    return e1.unionByName(e2).unionByName(e3).unionByName(e4)


def fixture_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extracts written once per session (real extracts are files that
    are read once; the report scans them several times)."""
    from cubeguard.session import materialize as _mat
    key = _memo_key(spark, sf_dir, "extracts")
    if key not in _MEMO:
        _MEMO[key] = _mat(extracts_from_cube(fixture_new(spark, sf_dir)), "extracts")
    return _MEMO[key]


def control_friskvik(spark: SparkSession) -> DataFrame:
    """Control table FRISKVIK (literal rows, one per indicator)."""
    rows = [("FHP", "2025", "K", "RETURNS_TOTAL", CUBE_NAME, "2001", "2001", "per 1000 (ak)"),
            ("FHP", "2025", "K", "RETURNS_MEN", CUBE_NAME, None, "2001", "per 1000"),
            ("FHP", "2025", "K", "RETURNS_COUNT", CUBE_NAME, "2001", "2001", None),
            ("OVP", "2025", "K", "RETURNS_UNKNOWN", CUBE_NAME, "2001", "2001", "antall")]
    return spark.createDataFrame(rows, "PROFILTYPE string, AARGANG string, MODUS string, INDIKATOR string, "
                                       "KUBE_NAVN string, Periode_bm string, Periode_nn string, Enhet string")


def control_two_cubes(spark: SparkSession) -> DataFrame:
    """Control table FRISKVIK with an indicator of a second cube."""
    more = spark.createDataFrame([("FHP", "2025", "K", "RETURNS_BAND", SECOND_CUBE, "2001", None, "antall")], control_friskvik(spark).schema)
    return control_friskvik(spark).unionByName(more)


def published_files(spark: SparkSession) -> DataFrame:
    """Published cube ids (name_datetag)."""
    return spark.createDataFrame([(f"{CUBE_NAME}_{NEW_DATETAG}",)], "file string")


def cube_spec_rows(spark: SparkSession) -> DataFrame:
    """Spec file of the cube (Tabell, Kolonne, Innhold) incl. REFVERDI_VP."""
    return spec_table(spark).unionByName(
        spark.createDataFrame([("KUBER", "REFVERDI_VP", "P")], "Tabell string, Kolonne string, Innhold string"))


# ------------------------------------------------------------ lookup sources

def code_tables(spark: SparkSession, sf_dir: str):
    """(municipality codes, county codes) with (oldCode, currentCode): the
    highest nation's municipality and the highest region's county carry an
    outdated code, every other code maps to itself."""
    na = table(spark, sf_dir, "nation")
    top_n = na.agg(F.max("n_nationkey")).scalar()
    top_r = na.agg(F.max("n_regionkey")).scalar()
    k = (F.lit(100) * (F.col("n_regionkey") + 1) + F.col("n_nationkey")).cast("bigint")
    kommune = na.select(F.when(F.col("n_nationkey") == top_n, k + OLD_CODE_OFFSET).otherwise(k).alias("oldCode"),
                        k.alias("currentCode"))
    f = (F.col("n_regionkey") + 1).cast("bigint")
    fylke = na.select(F.when(F.col("n_regionkey") == top_r, f + 10).otherwise(f).alias("oldCode"),
                      f.alias("currentCode")).distinct()
    return kommune, fylke


def file_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control table FILGRUPPER derived from the nations: one file group per
    nation with its table dimensions; the highest nation's group has expired."""
    na = table(spark, sf_dir, "nation")
    top_n = na.agg(F.max("n_nationkey")).scalar()
    return na.select(
        F.concat(F.lit("FG_"), F.col("n_nationkey").cast("string")).alias("FILGRUPPE"),
        F.when(F.col("n_nationkey") % 2 == 0, "INNVKAT").otherwise("UTDANN").alias("TAB1"),
        F.when(F.col("n_regionkey") == 0, "SEGMENT").alias("TAB2"),
        F.when(F.col("n_nationkey") == top_n, "OLDTAB").alias("TAB3"),
        F.lit("2000-01-01 00:00:00").cast("timestamp").alias("VERSJONFRA"),
        F.when(F.col("n_nationkey") == top_n, F.lit("2001-01-01 00:00:00"))
        .otherwise(F.lit("2099-01-01 00:00:00")).cast("timestamp").alias("VERSJONTIL"))


GEO_REGISTER_LEVEL = {"L": "land", "F": "fylke", "K": "kommune", "B": "bydel"}


def geo_register(spark: SparkSession, sf_dir: str, year: str = "2025") -> DataFrame:
    """Code register tblGeo (code, level, validTO) from the area parameters."""
    lv = None
    for k, v in GEO_REGISTER_LEVEL.items():
        lv = F.when(F.col("GEOniv") == k, v) if lv is None else lv.when(F.col("GEOniv") == k, v)
    return popinfo(spark, sf_dir).select(F.col("GEO").alias("code"), lv.alias("level"), F.lit(year).alias("validTO"))

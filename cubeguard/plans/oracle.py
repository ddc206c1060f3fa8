"""DuckDB oracle SQL for the registered queries.

Each oracle rebuilds the fixture cubes from the driver tables in plain SQL
(``FIXTURE_CTES``) and then states the check the way the reference defines
it.  Names, types and rounding match the Spark queries column by column.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixtures

_SEG = ("CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3 "
        "WHEN 'HOUSEHOLD' THEN 4 WHEN 'MACHINERY' THEN 5 END")

FIXTURE_CTES = f"""
fx_base AS (
    SELECT CAST(na.n_regionkey AS BIGINT) AS r, CAST(na.n_nationkey AS BIGINT) AS n,
           CAST({_SEG} AS BIGINT) AS s, l.l_suppkey AS sup,
           year(o.o_orderdate) AS y,
           CAST(CASE WHEN l.l_linestatus = 'F' THEN 1 ELSE 2 END AS BIGINT) AS kj,
           CASE WHEN l.l_linenumber BETWEEN 1 AND 2 THEN '1_2'
                WHEN l.l_linenumber BETWEEN 3 AND 4 THEN '3_4'
                WHEN l.l_linenumber BETWEEN 5 AND 7 THEN '5_7' END AS band,
           CAST(l.l_suppkey % 2 + 1 AS BIGINT) AS innv,
           CAST(substr(o.o_orderpriority, 1, 1) AS BIGINT) AS utd,
           l.l_discount < 0.095 AS in_old,
           CASE WHEN l.l_returnflag = 'R' THEN l.l_quantity ELSE 0.0 END AS q_r,
           l.l_quantity AS q
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation na ON c.c_nationkey = na.n_nationkey
),
fx_cells AS (
  SELECT r, n, s, v, y, kj, band, innv, utd, in_old,
         sum(q_r) AS t, sum(q) AS nv, count(*) AS cnt
  FROM (SELECT * EXCLUDE (sup), NULL::BIGINT AS v FROM fx_base
        UNION ALL BY NAME
        SELECT * EXCLUDE (sup, r, n, s), NULL::BIGINT AS r, NULL::BIGINT AS n, NULL::BIGINT AS s,
               CAST(100000000 + sup AS BIGINT) AS v FROM fx_base) b
  GROUP BY ALL
),
fx_maxnation AS (SELECT max(n_nationkey) AS mn FROM nation),
fx_maxyear AS (SELECT max(year(o_orderdate)) AS my FROM orders),
fx_new_long AS (
  SELECT g.GEO, CAST(y AS VARCHAR) || '_' || CAST(y AS VARCHAR) AS AAR, k.KJONN, a.ALDER, e.INNVKAT, t, nv, cnt
  FROM fx_cells,
       unnest([CASE WHEN v IS NULL THEN CAST(0 AS BIGINT) END, r + 1, 100 * (r + 1) + n,
               CASE WHEN n IN (0, 1, 2, 3) AND s IN (1, 2, 3, 4) THEN 100 * (100 * (r + 1) + n) + s END, v]) AS g(GEO),
       unnest([CAST(0 AS BIGINT), kj]) AS k(KJONN),
       unnest(['1_7', band]) AS a(ALDER),
       unnest([CAST(0 AS BIGINT), innv]) AS e(INNVKAT)
  WHERE g.GEO IS NOT NULL
),
fx_old_long AS (
  SELECT g.GEO, CAST(y AS VARCHAR) || '_' || CAST(y AS VARCHAR) AS AAR, k.KJONN, a.ALDER, e.UTDANN, t, nv, cnt
  FROM (SELECT * FROM fx_cells WHERE in_old AND y < (SELECT my FROM fx_maxyear)) c,
       unnest([CASE WHEN v IS NULL THEN CAST(0 AS BIGINT) END, r + 1,
               100 * (r + 1) + n + CASE WHEN n = (SELECT mn FROM fx_maxnation) THEN 1000 ELSE 0 END,
               CASE WHEN n IN (0, 1, 2, 3) AND s IN (1, 2, 3, 4) THEN 100 * (100 * (r + 1) + n) + s END, v]) AS g(GEO),
       unnest([CAST(0 AS BIGINT), kj]) AS k(KJONN),
       unnest(['1_7', band]) AS a(ALDER),
       unnest([CAST(0 AS BIGINT), utd]) AS e(UTDANN)
  WHERE g.GEO IS NOT NULL
),
fx_new_raw AS (
  SELECT GEO, AAR, KJONN, ALDER, INNVKAT,
         CASE WHEN tu > 20 THEN tu END AS TELLER, CASE WHEN tu > 20 THEN nu END AS NEVNER,
         CASE WHEN tu > 20 THEN round(1000.0 * tu / nu, 6) END AS RATE,
         CASE WHEN tu > 20 THEN CAST(cu AS DOUBLE) END AS "RATE.n",
         CAST(CASE WHEN tu <= 20 THEN 1 ELSE 0 END AS BIGINT) AS SPVFLAGG, tu AS TELLER_uprikk
  FROM (SELECT GEO, AAR, KJONN, ALDER, INNVKAT, sum(t) AS tu, sum(nv) AS nu, sum(cnt) AS cu
        FROM fx_new_long GROUP BY ALL) x
),
fx_old_raw AS (
  SELECT GEO, AAR, KJONN, ALDER, UTDANN,
         CASE WHEN tu > 20 THEN tu END AS TELLER, CASE WHEN tu > 20 THEN nu END AS NEVNER,
         CASE WHEN tu > 20 THEN round(1000.0 * tu / nu, 6) END AS RATE,
         CASE WHEN tu > 20 THEN CAST(cu AS DOUBLE) END AS "RATE.n",
         CAST(CASE WHEN tu <= 20 THEN 1 ELSE 0 END AS BIGINT) AS SPVFLAGG, tu AS TELLER_uprikk
  FROM (SELECT GEO, AAR, KJONN, ALDER, UTDANN, sum(t) AS tu, sum(nv) AS nu, sum(cnt) AS cu
        FROM fx_old_long GROUP BY ALL) x
),
fx_popinfo AS (
  SELECT GEO, GEOniv, CAST(sum(cnt) AS DOUBLE) AS WEIGHTS FROM (
    SELECT g.GEO, g.GEOniv, cnt FROM (
      SELECT CAST(na.n_regionkey AS BIGINT) AS r, CAST(na.n_nationkey AS BIGINT) AS n,
             CAST({_SEG} AS BIGINT) AS s, count(*) AS cnt
      FROM customer c JOIN nation na ON c.c_nationkey = na.n_nationkey GROUP BY ALL) cc,
      unnest([{{'GEO': CAST(0 AS BIGINT), 'GEOniv': 'L'}}, {{'GEO': r + 1, 'GEOniv': 'F'}},
              {{'GEO': 100 * (r + 1) + n, 'GEOniv': 'K'}},
              CASE WHEN n IN (0, 1, 2, 3) AND s IN (1, 2, 3, 4)
                   THEN {{'GEO': 100 * (100 * (r + 1) + n) + s, 'GEOniv': 'B'}} END]) AS u(g)
    WHERE g IS NOT NULL) z
  GROUP BY ALL
  UNION ALL SELECT CAST(100000000 + s_suppkey AS BIGINT), 'V', 10.0 FROM supplier
),
fx_georecode AS (
  SELECT CAST(100 * (n_regionkey + 1) + n_nationkey + 1000 AS BIGINT) AS old,
         CAST(100 * (n_regionkey + 1) + n_nationkey AS BIGINT) AS current
  FROM nation WHERE n_nationkey = (SELECT mn FROM fx_maxnation)
),
fx_thr AS (SELECT count(*) / 25.0 AS thr FROM customer),
newcube AS (
  SELECT x.*, coalesce(p.GEOniv,
           CASE WHEN length(CAST(x.GEO AS VARCHAR)) IN (1, 2) THEN 'F'
                WHEN length(CAST(x.GEO AS VARCHAR)) IN (3, 4) THEN 'K'
                WHEN length(CAST(x.GEO AS VARCHAR)) IN (5, 6) THEN 'B'
                WHEN length(CAST(x.GEO AS VARCHAR)) IN (9, 10) THEN 'V' END) AS GEOniv,
         coalesce(p.WEIGHTS, 0.0) AS WEIGHTS
  FROM fx_new_raw x LEFT JOIN fx_popinfo p ON x.GEO = p.GEO
),
oldcube AS (
  SELECT x.* EXCLUDE (GEO, origgeo), x.GEO, x.origgeo, coalesce(p.GEOniv,
           CASE WHEN length(CAST(x.GEO AS VARCHAR)) IN (1, 2) THEN 'F'
                WHEN length(CAST(x.GEO AS VARCHAR)) IN (3, 4) THEN 'K'
                WHEN length(CAST(x.GEO AS VARCHAR)) IN (5, 6) THEN 'B'
                WHEN length(CAST(x.GEO AS VARCHAR)) IN (9, 10) THEN 'V' END) AS GEOniv,
         coalesce(p.WEIGHTS, 0.0) AS WEIGHTS
  FROM (SELECT o.* EXCLUDE (GEO), coalesce(m.current, o.GEO) AS GEO, o.GEO AS origgeo
        FROM fx_old_raw o LEFT JOIN fx_georecode m ON o.GEO = m.old) x
  LEFT JOIN fx_popinfo p ON x.GEO = p.GEO
)"""

NEW_DIMS = ["GEO", "AAR", "KJONN", "ALDER", "INNVKAT"]
OLD_DIMS = ["GEO", "AAR", "KJONN", "ALDER", "UTDANN"]
VALS = ["TELLER", "NEVNER", "RATE", "RATE.n", "SPVFLAGG", "TELLER_uprikk"]


def q(name: str) -> str:
    return f'"{name}"'


def with_fixtures(*ctes: str, select: str) -> str:
    parts = [FIXTURE_CTES.strip()] + [c.strip() for c in ctes if c]
    return "WITH " + ",\n".join(parts) + "\n" + select


def fences_sql(src: str, val: str, strata: list[str], prefix: str = "") -> str:
    """Weighted fences (X1) as windows over ``src``; adds prefixed columns."""
    g = ", ".join(strata)
    v = q(val)
    w = f"CASE WHEN {v} IS NOT NULL AND WEIGHTS > 0 THEN CAST(WEIGHTS AS DOUBLE) ELSE 0.0 END"
    p = prefix

    def qt(pp):
        return (f"CASE WHEN __tot > 0 THEN (min(CASE WHEN {v} IS NOT NULL AND __cum >= __tot * {pp} THEN {v} END) "
                f"OVER (PARTITION BY {g}) + min(CASE WHEN {v} IS NOT NULL AND __cum > __tot * {pp} THEN {v} END) "
                f"OVER (PARTITION BY {g})) / 2.0 END")
    inner = (f"SELECT *, sum({w}) OVER (PARTITION BY {g} ORDER BY {v} ASC NULLS LAST "
             f"RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS __cum, "
             f"sum({w}) OVER (PARTITION BY {g}) AS __tot FROM {src}")
    mid = (f"SELECT * EXCLUDE (__cum, __tot), "
           f"CASE WHEN GEOniv IS NOT NULL THEN min({v}) OVER (PARTITION BY {g}) END AS {p}MIN, "
           f"CASE WHEN GEOniv IS NOT NULL THEN {qt('0.25')} END AS {p}wq25, "
           f"CASE WHEN GEOniv IS NOT NULL THEN {qt('0.5')} END AS {p}wq50, "
           f"CASE WHEN GEOniv IS NOT NULL THEN {qt('0.75')} END AS {p}wq75, "
           f"CASE WHEN GEOniv IS NOT NULL THEN max({v}) OVER (PARTITION BY {g}) END AS {p}MAX "
           f"FROM ({inner}) i")
    outer = (f"SELECT *, {p}wq25 - 1.5 * ({p}wq75 - {p}wq25) AS {p}LOW, "
             f"{p}wq75 + 1.5 * ({p}wq75 - {p}wq25) AS {p}HIGH FROM ({mid}) m")
    return (f"SELECT *, CASE WHEN {v} > {p}HIGH OR {v} < {p}LOW THEN 1 ELSE 0 END AS {p}OUTLIER "
            f"FROM ({outer}) o")


def change_sql(src: str, val: str, series: list[str]) -> str:
    v = q(val)
    g = ", ".join(series)
    prev = (f"last_value({v} IGNORE NULLS) OVER (PARTITION BY {g} ORDER BY AAR "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    return (f"SELECT *, 100.0 * ({v} / CASE WHEN __prev = 0 THEN (SELECT min({v}) FROM {src} WHERE {v} <> 0) / 2.0 "
            f"ELSE __prev END - 1.0) AS change_{val} FROM (SELECT *, {prev} AS __prev FROM {src}) s")


# Common dimensions after the totals of the other cube's dims are added
COMMON = ["GEO", "AAR", "KJONN", "ALDER", "INNVKAT", "UTDANN"]
STRATA = ["GEOniv", "KJONN", "ALDER", "INNVKAT", "UTDANN"]
SERIES = ["GEO", "KJONN", "ALDER", "INNVKAT", "UTDANN"]


def _split(src: str) -> str:
    return (f"SELECT * EXCLUDE (GEOniv), CASE WHEN GEOniv = 'K' AND WEIGHTS < (SELECT thr FROM fx_thr) "
            f"AND NOT (CAST(GEO AS VARCHAR) LIKE '%99') THEN 'k' ELSE GEOniv END AS GEOniv FROM {src}")


def _flag(src_cte: str, val: str = "RATE") -> str:
    a = change_sql(f"({_split(src_cte)})", val, SERIES)
    # change_sql references the source twice; use a CTE name instead
    return a


C1_CTES = [
    # Level V is left out; C2: each cube gets the other cube's extra dimension at its total (0)
    "c1_new AS (SELECT *, CAST(0 AS BIGINT) AS UTDANN FROM newcube WHERE GEOniv IS DISTINCT FROM 'V')",
    "c1_old AS (SELECT * EXCLUDE (origgeo), CAST(0 AS BIGINT) AS INNVKAT FROM oldcube WHERE GEOniv IS DISTINCT FROM 'V')",
    # F3
    "c1_newrow AS (SELECT *, CASE WHEN " + " OR ".join(
        f"{d} NOT IN (SELECT DISTINCT {d} FROM c1_old)" for d in COMMON) + " THEN 1 ELSE 0 END AS newrow FROM c1_new)",
    "c1_exprow AS (SELECT *, CASE WHEN " + " OR ".join(
        f"{d} NOT IN (SELECT DISTINCT {d} FROM c1_new)" for d in COMMON) + " THEN 1 ELSE 0 END AS exprow FROM c1_old)",
    # G3 split
    "c1_nsplit AS (" + _split("c1_newrow") + ")",
    "c1_osplit AS (" + _split("c1_exprow") + ")",
    # W1 change
    "c1_nchg AS (" + change_sql("c1_nsplit", "RATE", SERIES) + ")",
    "c1_ochg AS (" + change_sql("c1_osplit", "RATE", SERIES) + ")",
    # W2 fences on value and change
    "c1_nf1 AS (" + fences_sql("c1_nchg", "RATE", STRATA) + ")",
    "c1_nflag AS (" + fences_sql("c1_nf1", "change_RATE", STRATA, "change_") + ")",
    "c1_of1 AS (" + fences_sql("c1_ochg", "RATE", STRATA) + ")",
    "c1_oflag AS (" + fences_sql("c1_of1", "change_RATE", STRATA, "change_") + ")",
    # W4
    "c1_newflag AS (SELECT n.*, o.OUTLIER AS PREV_OUTLIER, "
    "CASE WHEN n.OUTLIER = 1 AND (o.OUTLIER IS NULL OR o.OUTLIER = 0) THEN 1 ELSE 0 END AS NEW_OUTLIER, "
    "o.change_OUTLIER AS change_PREV_OUTLIER, "
    "CASE WHEN n.change_OUTLIER = 1 AND (o.change_OUTLIER IS NULL OR o.change_OUTLIER = 0) THEN 1 ELSE 0 END "
    "AS change_NEW_OUTLIER FROM c1_nflag n LEFT JOIN c1_oflag o ON "
    + " AND ".join(f"n.{d} IS NOT DISTINCT FROM o.{d}" for d in COMMON) + ")",
]


def _comparecube_select() -> str:
    keys = ", ".join(f"coalesce(n.{d}, o.{d}) AS {d}" for d in COMMON)
    vals = ", ".join(f"n.{q(v)} AS {q(v + '_new')}, o.{q(v)} AS {q(v + '_old')}" for v in VALS)
    return (f"SELECT n.GEOniv, n.newrow, {keys}, {vals} FROM c1_newflag n "
            f"FULL OUTER JOIN (SELECT * FROM c1_oflag WHERE exprow = 0) o ON "
            + " AND ".join(f"n.{d} IS NOT DISTINCT FROM o.{d}" for d in COMMON))


def _diffs_select(src: str) -> str:
    cols = []
    diffs = []
    for v in VALS:
        n, o = q(v + "_new"), q(v + "_old")
        cols.append(f"CASE WHEN {n} IS NULL AND {o} IS NULL THEN 0.0 ELSE CAST({n} - {o} AS DOUBLE) END AS {q(v + '_diff')}")
        diffs.append(q(v + "_diff"))
        if v not in ("SPVFLAGG", "RATE.n"):
            cols.append(f"CASE WHEN {n} IS NULL AND {o} IS NULL THEN 1.0 "
                        f"ELSE CAST({n} AS DOUBLE) / nullif(CAST({o} AS DOUBLE), 0) END AS {q(v + '_reldiff')}")
    anyd = " OR ".join(f"coalesce(abs({d}) > 0.1, false)" for d in diffs)
    return f"SELECT *, CASE WHEN {anyd} THEN 1 ELSE 0 END AS any_diffs FROM (SELECT *, {', '.join(cols)} FROM {src}) d"


COMPARECUBE_CTES = C1_CTES + [
    "c1_cc0 AS (" + _comparecube_select() + ")",
    "comparecube AS (" + _diffs_select("c1_cc0") + ")",
]


def rnd(expr: str, digits: int) -> str:
    """Half-even rounding identical to the Spark side."""
    # "+ 0.0" turns a rounded negative zero into 0.0, as Spark's bround does
    if digits == 0:
        return f"(round_even({expr}, 0) + 0.0)"
    return f"(round_even(({expr}) * {float(10 ** digits)}, 0) / {float(10 ** digits)} + 0.0)"


def qc_round_sql(name: str) -> str | None:
    from cubeguard.spec import rounding_digits
    return rounding_digits(name)


GEO_LABEL_SQL = ("CASE WHEN GEOniv = 'L' THEN 'Land' WHEN GEOniv = 'F' THEN 'Fylke' "
                 "WHEN GEOniv = 'K' THEN 'Kommune' WHEN GEOniv = 'k' THEN 'Kommune' "
                 "WHEN GEOniv = 'B' THEN 'Bydel' WHEN GEOniv = 'V' THEN 'Levekaar' END")


def _rounded_cc(src: str) -> str:
    """comparecube rows with newrow = 0, publication rounding, level labels."""
    from cubeguard.plans.oracle import qc_round_sql as _d
    cols_sql = []
    for v in VALS:
        for suffix in ("_new", "_old", "_diff", "_reldiff"):
            name = v + suffix
            if suffix == "_reldiff" and v in ("SPVFLAGG", "RATE.n"):
                continue
            d = _d(name)
            cols_sql.append(f"{rnd(q(name), d) if d is not None else q(name)} AS {q(name)}")
    return f"SELECT {GEO_LABEL_SQL} AS GEOniv, {', '.join(cols_sql)} FROM {src} WHERE newrow = 0"


def a9_sql() -> str:
    from cubeguard.spec import rounding_digits
    unions = []
    for i, v in enumerate(VALS):
        rel = q(v + "_reldiff") if v not in ("SPVFLAGG", "RATE.n") else "CAST(NULL AS DOUBLE)"
        ds = 10 ** rounding_digits(v + "_diff")
        rs = 10 ** rounding_digits(v + "_reldiff")
        unions.append(f"SELECT GEOniv, '{v}' AS Value, {i} AS vord, CAST({q(v + '_new')} AS DOUBLE) AS new, "
                      f"CAST({q(v + '_old')} AS DOUBLE) AS old, {q(v + '_diff')} AS diff, {rel} AS rel, "
                      f"CAST({ds} AS BIGINT) AS ds, CAST({rs} AS BIGINT) AS rs FROM a9_r")
    st = "diff <> 0 AND new IS NOT NULL AND old IS NOT NULL"

    def mean3(c, sc):
        num = (f"sum(CASE WHEN {st} AND {c} IS NOT NULL THEN CAST(round({c} * {sc}) AS BIGINT) * "
               f"CAST(greatest(1000 / {sc}, 1) AS BIGINT) END)")
        den = f"(count(CASE WHEN {st} THEN {c} END) * CAST(max(greatest({sc} / 1000, 1)) AS BIGINT))"
        return f"(round_even(CAST({num} AS BIGINT) / {den}, 0) / 1000.0)"
    body = f"""
    SELECT CASE WHEN grouping(GEOniv) = 1 THEN 'TOTAL' ELSE GEOniv END AS GEOniv, Value,
           count(*) FILTER (WHERE diff = 0) AS Identical,
           count(*) FILTER (WHERE diff <> 0) AS Different,
           count(*) FILTER (WHERE new IS NULL AND old IS NOT NULL) AS New_prikk,
           count(*) FILTER (WHERE new IS NOT NULL AND old IS NULL) AS Expired_prikk,
           {mean3("diff", "ds")} AS Mean_diff,
           {rnd(f"min(CASE WHEN {st} THEN diff END)", 3)} AS Min_diff,
           {rnd(f"max(CASE WHEN {st} THEN diff END)", 3)} AS Max_diff,
           {mean3("rel", "rs")} AS Mean_reldiff,
           {rnd(f"min(CASE WHEN {st} THEN rel END)", 3)} AS Min_reldiff,
           {rnd(f"max(CASE WHEN {st} THEN rel END)", 3)} AS Max_reldiff
    FROM a9_long
    GROUP BY GROUPING SETS ((Value, vord), (GEOniv, Value, vord))
    HAVING grouping(GEOniv) = 1 OR GEOniv IS NOT NULL"""
    return with_fixtures(*COMPARECUBE_CTES, "a9_r AS (" + _rounded_cc("comparecube") + ")",
                         "a9_long AS (" + " UNION ALL ".join(unions) + ")", select=body)

"""Oracle SQL per registered query key."""

from __future__ import annotations

from cubeguard.plans import oracle as o

ORACLES: dict[str, str] = {}


def _build():
    ORACLES["c1_comparecube"] = o.with_fixtures(*o.COMPARECUBE_CTES, select="SELECT * FROM comparecube")
    ORACLES["a9_summary"] = o.a9_sql()


_build()


# ---------------------------------------------------------------- helpers
W = o.with_fixtures
R = o.rnd
LABEL = o.GEO_LABEL_SQL
NEWD = "GEO, AAR, KJONN, ALDER, INNVKAT"
OLDD = "GEO, AAR, KJONN, ALDER, UTDANN"
COMMON = "GEO, AAR, KJONN, ALDER, INNVKAT, UTDANN"
CITIES = {100: "NATION_0", 201: "NATION_1", 302: "NATION_2", 403: "NATION_3"}
SPLIT = ("CASE WHEN GEOniv = 'K' AND WEIGHTS < (SELECT thr FROM fx_thr) "
         "AND NOT (CAST(GEO AS VARCHAR) LIKE '%99') THEN 'k' ELSE GEOniv END")
KOMMUNE = ("CASE WHEN GEO IN (100, 201, 302, 403) OR GEOniv = 'B' OR GEOniv = 'Bydel' THEN CASE "
           + " ".join(f"WHEN CAST(GEO AS VARCHAR) LIKE '{k}%' THEN '{v}'" for k, v in CITIES.items())
           + " END END")


def in_other(dims, other):
    return " AND ".join(f"{d} IN (SELECT {d} FROM {other})" for d in dims)


def not_in_other(dims, other):
    return " OR ".join(f"{d} NOT IN (SELECT {d} FROM {other})" for d in dims)


def _more():
    new_cols = ["GEO", "AAR", "KJONN", "ALDER", "INNVKAT", "TELLER", "NEVNER", "RATE", "RATE.n", "SPVFLAGG"]
    listed = [(c, "present") for c in new_cols] + [("INNVKAT", "new"), ("UTDANN", "expired"), ("TELLER_uprikk", "uprikk")]
    held = lambda c, cube, missing: "CAST(NULL AS BIGINT)" if c == missing else f"(SELECT count({o.q(c)}) FROM {cube})"
    ORACLES["p2_compare_columns"] = W(select=" UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{s}' AS status, {held(c, 'newcube', 'UTDANN')} AS n_values_new, {held(c, 'oldcube', 'INNVKAT')} AS n_values_old"""
        for c, s in listed))
    dims = ["GEO", "AAR", "KJONN", "ALDER", "INNVKAT"]
    nl = " UNION ".join(f"SELECT '{d}' AS Dimension, CAST({d} AS VARCHAR) AS level FROM newcube" for d in dims)
    ol = " UNION ".join(f"SELECT '{d}' AS Dimension, CAST({d} AS VARCHAR) AS level FROM oldcube"
                        for d in dims if d != "INNVKAT")
    p3 = (
        f"p3_n AS ({nl})", f"p3_o AS ({ol})",
        """p3_j AS (SELECT coalesce(n.Dimension, o.Dimension) AS Dimension,
                   CASE WHEN n.Dimension IS NOT NULL THEN n.level ELSE o.level END AS level,
                   n.Dimension IS NOT NULL AS in_new, o.Dimension IS NOT NULL AS in_old
            FROM p3_n n FULL OUTER JOIN p3_o o ON n.Dimension = o.Dimension AND n.level IS NOT DISTINCT FROM o.level)""")
    ORACLES["p3_level_changes"] = W(*p3, select="""
      SELECT Dimension, level, CASE WHEN in_new THEN 'new' ELSE 'expired' END AS status FROM p3_j WHERE NOT (in_new AND in_old)""")
    ORACLES["p3_compare_dimensions"] = W(*p3,
        select="""SELECT Dimension, count(*) FILTER (WHERE in_new) AS N_levels,
          coalesce(array_to_string(list_sort(list(coalesce(level, 'NA')) FILTER (WHERE in_new AND NOT in_old)), ', '), '') AS New_levels,
          coalesce(array_to_string(list_sort(list(coalesce(level, 'NA')) FILTER (WHERE in_old AND NOT in_new)), ', '), '') AS Expired_levels
          FROM p3_j WHERE Dimension IN ('GEO','AAR','KJONN','ALDER','INNVKAT') GROUP BY Dimension""")
    ORACLES["g1_recode_geo"] = W(select="SELECT * FROM oldcube")
    ORACLES["g1_recode_report"] = W(select="""
      SELECT count(DISTINCT m.old) AS recoded_codes,
             count(*) FILTER (WHERE CAST(coalesce(m.current, o.GEO) AS VARCHAR) LIKE '%99') AS rows_on_99_codes
      FROM fx_old_raw o LEFT JOIN fx_georecode m ON o.GEO = m.old""")
    ORACLES["g2_geo_params"] = W(select="SELECT * FROM newcube")
    ORACLES["g3_split_small"] = W(select=f"SELECT {NEWD}, {SPLIT} AS GEOniv, WEIGHTS FROM newcube")
    ORACLES["g4_labels"] = W(f"g4 AS (SELECT GEO, {SPLIT} AS GEOniv FROM newcube)", select=f"""
      SELECT {LABEL} AS GEOniv, count(*) AS n_rows, count(DISTINCT GEO) AS n_codes FROM g4 GROUP BY 1""")
    ORACLES["g5_parent"] = W(select=f"""
      SELECT * FROM (SELECT {NEWD}, GEOniv, {KOMMUNE} AS KOMMUNE FROM newcube) WHERE KOMMUNE IS NOT NULL""")
    ORACLES["f1_common_levels"] = W(select="SELECT * FROM newcube WHERE "
                                    + in_other(["GEO", "AAR", "KJONN", "ALDER"], "oldcube"))
    ORACLES["f1_common_levels_old"] = W(select="SELECT * FROM oldcube WHERE "
                                        + in_other(["GEO", "AAR", "KJONN", "ALDER"], "newcube"))
    ORACLES["f2_complete_strata"] = W(select="""
      SELECT * EXCLUDE (nb) FROM (SELECT *, sum(CASE WHEN SPVFLAGG <> 0 THEN 1 ELSE 0 END)
        OVER (PARTITION BY AAR, KJONN, ALDER, INNVKAT) AS nb FROM newcube) WHERE nb = 0""")
    ORACLES["f2_complete_strata_missing"] = W(select="""
      SELECT * EXCLUDE (nb) FROM (SELECT *, sum(CASE WHEN RATE IS NULL THEN 1 ELSE 0 END)
        OVER (PARTITION BY AAR, ALDER) AS nb FROM newcube WHERE GEOniv IN ('L', 'F')) WHERE nb = 0""")
    ORACLES["f2_complete_strata_missing_all"] = W(select="""
      SELECT * EXCLUDE (nb) FROM (SELECT *, sum(CASE WHEN RATE IS NULL THEN 1 ELSE 0 END)
        OVER (PARTITION BY AAR, KJONN, ALDER, INNVKAT) AS nb FROM newcube) WHERE nb = 0""")
    c4 = ["GEO", "AAR", "KJONN", "ALDER"]
    ORACLES["f3_flag_new"] = W(select=f"""
      SELECT {NEWD}, CASE WHEN {not_in_other(c4, 'oldcube')} THEN 1 WHEN INNVKAT <> 0 THEN 1 ELSE 0 END AS newrow
      FROM newcube""")
    ORACLES["f3_flag_expired"] = W(select=f"""
      SELECT {OLDD}, CASE WHEN {not_in_other(c4, 'newcube')} THEN 1 WHEN UTDANN <> 0 THEN 1 ELSE 0 END AS exprow
      FROM oldcube""")
    ORACLES["a1_collapse_total"] = W(select="SELECT * FROM newcube WHERE KJONN = 0")
    ORACLES["a1_collapse_mean"] = W(select=f"""
      SELECT GEO, AAR, KJONN, 'Total' AS ALDER, INNVKAT, coalesce(sum(TELLER), 0.0) AS TELLER,
             {R('avg(NEVNER)', 6)} AS NEVNER, {R('avg(RATE)', 9)} AS RATE, {R('avg("RATE.n")', 6)} AS "RATE.n",
             arg_min(SPVFLAGG, ALDER) AS SPVFLAGG, coalesce(sum(TELLER_uprikk), 0.0) AS TELLER_uprikk,
             arg_min(GEOniv, ALDER) AS GEOniv, arg_min(WEIGHTS, ALDER) AS WEIGHTS
      FROM newcube WHERE ALDER <> '1_7' GROUP BY GEO, AAR, KJONN, INNVKAT""")
    ORACLES["a2_collapse_multi"] = W("""a2_s1 AS (
      SELECT GEO, AAR, KJONN, 'Total' AS ALDER, INNVKAT, coalesce(sum(TELLER), 0.0) AS TELLER,
             avg(NEVNER) AS NEVNER, avg(RATE) AS RATE, avg("RATE.n") AS "RATE.n",
             arg_min(SPVFLAGG, ALDER) AS SPVFLAGG, coalesce(sum(TELLER_uprikk), 0.0) AS TELLER_uprikk,
             arg_min(GEOniv, ALDER) AS GEOniv, arg_min(WEIGHTS, ALDER) AS WEIGHTS
      FROM newcube WHERE ALDER <> '1_7' AND INNVKAT <> 0 GROUP BY GEO, AAR, KJONN, INNVKAT)""", select=f"""
      SELECT GEO, AAR, KJONN, ALDER, 'Total' AS INNVKAT, coalesce(sum(TELLER), 0.0) AS TELLER,
             {R('avg(NEVNER)', 6)} AS NEVNER, {R('avg(RATE)', 9)} AS RATE, {R('avg("RATE.n")', 6)} AS "RATE.n",
             arg_min(SPVFLAGG, INNVKAT) AS SPVFLAGG, coalesce(sum(TELLER_uprikk), 0.0) AS TELLER_uprikk,
             arg_min(GEOniv, INNVKAT) AS GEOniv, arg_min(WEIGHTS, INNVKAT) AS WEIGHTS
      FROM a2_s1 GROUP BY GEO, AAR, KJONN, ALDER""")
    CC = o.COMPARECUBE_CTES
    ORACLES["c4_any_diffs"] = W(*CC, select="""
      SELECT GEOniv, count(*) FILTER (WHERE any_diffs = 1) AS n_any_diffs, count(*) AS n_rows
      FROM comparecube GROUP BY GEOniv""")
    ORACLES["w1_change"] = W(*o.C1_CTES, select=f"SELECT {COMMON}, RATE, change_RATE FROM c1_newflag")
    f = "MIN, wq25, wq50, wq75, MAX, LOW, HIGH"
    ORACLES["w2_weighted_fences"] = W(*o.C1_CTES, select=f"SELECT DISTINCT GEOniv, KJONN, ALDER, INNVKAT, UTDANN, {f} FROM c1_newflag")
    cf = ", ".join("change_" + x.strip() for x in f.split(","))
    ORACLES["w2_change_fences"] = W(*o.C1_CTES, select=f"SELECT DISTINCT GEOniv, KJONN, ALDER, INNVKAT, UTDANN, {cf} FROM c1_newflag")
    ORACLES["w3_flag_outliers_old"] = W(*o.C1_CTES, select=f"SELECT {COMMON}, GEOniv, exprow, OUTLIER, change_OUTLIER FROM c1_oflag")
    ORACLES["w4_new_outlier"] = W(*o.C1_CTES, select=f"""SELECT {COMMON}, newrow, OUTLIER, PREV_OUTLIER, NEW_OUTLIER,
      change_OUTLIER, change_PREV_OUTLIER, change_NEW_OUTLIER FROM c1_newflag""")

    # A3
    a3_ctes = ["a3_nf AS (SELECT * FROM newcube WHERE " + in_other(c4, "oldcube") + ")",
               "a3_of AS (SELECT * FROM oldcube WHERE " + in_other(c4, "a3_nf") + ")"]

    def a3(keys):
        k = ", ".join(keys)
        kk = ", ".join(f"coalesce(n.{x}, o.{x}) AS {x}" for x in keys)
        on = " AND ".join(f"n.{x} IS NOT DISTINCT FROM o.{x}" for x in keys)
        return W(*a3_ctes, select=f"""
          SELECT *, N_new - N_old AS Absolute, {R('CAST(N_new AS DOUBLE) / nullif(CAST(N_old AS DOUBLE), 0)', 3)} AS Relative
          FROM (SELECT {kk}, coalesce(n.N_new, 0) AS N_new, coalesce(o.N_old, 0) AS N_old
                FROM (SELECT {k}, count(*) AS N_new FROM a3_nf WHERE INNVKAT = 0 GROUP BY {k}) n
                FULL OUTER JOIN (SELECT {k}, count(*) AS N_old FROM a3_of WHERE UTDANN = 0 GROUP BY {k}) o ON {on}) x""")
    ORACLES["a3_censoring"] = a3(["SPVFLAGG"])
    ORACLES["a3_censoring_by_sex"] = a3(["SPVFLAGG", "KJONN"])
    cols = "GEO, AAR, KJONN, ALDER, TELLER, NEVNER, RATE, \"RATE.n\", SPVFLAGG, TELLER_uprikk"
    ORACLES["a4_censoring_series"] = W(f"""a4_b AS (
        SELECT {cols}, 'New' AS cube FROM newcube WHERE NOT (CAST(GEO AS VARCHAR) LIKE '%99')
        UNION ALL SELECT {cols}, 'Old' AS cube FROM oldcube WHERE NOT (CAST(GEO AS VARCHAR) LIKE '%99'))""",
        """a4_p AS (SELECT cube, CAST(sum(CASE WHEN SPVFLAGG <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS N_censored
                   FROM a4_b GROUP BY cube, GEO, KJONN, ALDER)""",
        f"""a4_h AS (SELECT cube, N_censored, count(*) AS N FROM a4_p GROUP BY ALL)""",
        f"""a4_s AS (SELECT *, {R('100.0 * N / sum(N) OVER (PARTITION BY cube)', 1)} AS Proportion FROM a4_h)""",
        select="""SELECT N_censored, max(N) FILTER (WHERE cube = 'New') AS N_New,
                  max(Proportion) FILTER (WHERE cube = 'New') AS Proportion_New,
                  max(N) FILTER (WHERE cube = 'Old') AS N_Old,
                  max(Proportion) FILTER (WHERE cube = 'Old') AS Proportion_Old FROM a4_s GROUP BY N_censored""")
    ORACLES["a4_censoring_series_new"] = W(
        """a4_p AS (SELECT CAST(sum(CASE WHEN SPVFLAGG <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS N_censored
                   FROM newcube GROUP BY GEO, KJONN, ALDER, INNVKAT)""",
        "a4_h AS (SELECT N_censored, count(*) AS N FROM a4_p GROUP BY ALL)",
        select=f"SELECT *, {R('100.0 * N / sum(N) OVER ()', 1)} AS Proportion FROM a4_h")
    ORACLES["a5_coverage_geolevel"] = W(f"a5 AS (SELECT GEO, AAR, SPVFLAGG, {SPLIT} AS GEOniv FROM newcube)", select=f"""
      SELECT *, {R('100.0 * Gets_data / Total_codes', 1)} AS Coverage_pct FROM (
        SELECT GEOniv, AAR, count(DISTINCT GEO) AS Total_codes,
               count(DISTINCT CASE WHEN SPVFLAGG = 0 THEN GEO END) AS Gets_data FROM a5 GROUP BY GEOniv, AAR) x""")
    ORACLES["a6_coverage_geocode"] = W(select=f"""
      SELECT *, {R('100.0 * Uncensored / Total_rows', 1)} AS Coverage_pct,
             {R('100.0 * Censored / Total_rows', 1)} AS Censored_pct FROM (
        SELECT GEO, AAR, count(SPVFLAGG) AS Total_rows, count(*) FILTER (WHERE SPVFLAGG = 0) AS Uncensored,
               count(*) FILTER (WHERE SPVFLAGG > 0) AS Censored FROM newcube GROUP BY GEO, AAR) x WHERE Censored > 0""")

    def a7(filt, hi, lo, kommune=False):
        gd = ("KOMMUNE, " if kommune else "") + "AAR, KJONN, ALDER, INNVKAT"
        kcol = f", {KOMMUNE} AS KOMMUNE" if kommune else ""
        return W(f"a7 AS (SELECT *, {LABEL} AS lab{kcol} FROM newcube WHERE {filt})", select=f"""
          SELECT {gd}, {R('hi', 0)} AS {hi}, {R('lo', 0)} AS {lo}, {R('hi - lo', 0)} AS Absolute,
                 {R('hi / nullif(lo, 0)', 3)} AS Relative FROM (
            SELECT {gd}, sum(TELLER_uprikk) FILTER (WHERE lab = '{hi}') AS hi,
                   sum(TELLER_uprikk) FILTER (WHERE lab = '{lo}') AS lo FROM a7 GROUP BY {gd}) x""")
    ORACLES["a7_geolevel_fl"] = a7("GEOniv IN ('L', 'F')", "Land", "Fylke")
    ORACLES["a7_geolevel_fk"] = a7("GEOniv IN ('F', 'K')", "Fylke", "Kommune")
    ORACLES["a7_geolevel_bk"] = a7("GEO IN (100, 201, 302, 403) OR GEOniv = 'B'", "Kommune", "Bydel", True)
    ORACLES["a7_geolevel_oo"] = a7("GEO IN (1, 100)", "Fylke", "Kommune")

    def a8(kind, top=None):
        bad = "CASE WHEN value IS NULL THEN 1 ELSE 0 END" if kind == "missing" else \
              "CASE WHEN SPVFLAGG <> 0 THEN 1 ELSE 0 END"
        return W(
            "a8_s AS (SELECT * FROM newcube WHERE GEO IN (100, 201, 302, 403) OR GEOniv = 'B')",
            f"""a8_d AS (SELECT *, {KOMMUNE} AS KOMMUNE FROM a8_s
                       WHERE AAR IN (SELECT AAR FROM a8_s WHERE GEOniv = 'B' AND SPVFLAGG = 0))""",
            """a8_l AS (SELECT KOMMUNE, GEOniv, GEO, AAR, KJONN, ALDER, INNVKAT, SPVFLAGG, 'TELLER_uprikk' AS TARGET,
                              CAST(TELLER_uprikk AS DOUBLE) AS value FROM a8_d
                       UNION ALL SELECT KOMMUNE, GEOniv, GEO, AAR, KJONN, ALDER, INNVKAT, SPVFLAGG, 'NEVNER',
                              CAST(NEVNER AS DOUBLE) FROM a8_d)""",
            f"""a8_c AS (SELECT * FROM (SELECT *, sum({bad}) OVER (PARTITION BY KOMMUNE, TARGET, AAR, KJONN, ALDER, INNVKAT) AS nb
                       FROM a8_l) WHERE nb = 0)""",
            f"""a8_r AS (SELECT KOMMUNE, AAR, KJONN, ALDER, INNVKAT, TARGET, k AS Kommune_value, b AS Bydel_value,
                       CASE WHEN b = 0 AND k = 0 THEN NULL ELSE {R('100.0 * (1.0 - b / nullif(k, 0))', 2)} END AS UNKNOWN_pct
                FROM (SELECT KOMMUNE, AAR, KJONN, ALDER, INNVKAT, TARGET,
                        CASE WHEN count(*) FILTER (WHERE GEOniv = 'K') > 0 THEN coalesce(sum(value) FILTER (WHERE GEOniv = 'K'), 0.0) END AS k,
                        CASE WHEN count(*) FILTER (WHERE GEOniv = 'B') > 0 THEN coalesce(sum(value) FILTER (WHERE GEOniv = 'B'), 0.0) END AS b
                      FROM a8_c GROUP BY ALL) x)""",
            select="SELECT * FROM a8_r" if top is None else f"""
                   SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY KOMMUNE, TARGET
                   ORDER BY UNKNOWN_pct DESC NULLS LAST, AAR, KJONN, ALDER, INNVKAT) AS rn FROM a8_r) WHERE rn <= {top}""")
    ORACLES["a8_unknown_district"] = a8("missing")
    ORACLES["a8_unknown_district_censored"] = a8("censored")
    ORACLES["w8_topn"] = a8("missing", 50)

    # A10
    vals = ["TELLER_uprikk", "NEVNER", "RATE", "RATE.n", "SPVFLAGG"]

    def qcr(name, expr):
        d = o.qc_round_sql(name)
        return R(expr, d) if d is not None else expr

    def a10_cols(year):
        out = []
        for v in vals:
            dv = o.q(v + "_diff")
            cond = f"{R(dv, 1)} <> 0"
            n = f"count(*) FILTER (WHERE {cond})"
            s = f"sum({dv}) FILTER (WHERE {cond})"
            if year:
                n_e = f"CASE WHEN {n} > 0 THEN {n} END"
                s_e = f"CASE WHEN {n} > 0 THEN {s} END"
            else:
                n_e, s_e = n, f"coalesce({s}, 0.0)"
            nd = o.qc_round_sql(v + "_ndiff")
            n_e = f"CAST({R(n_e, nd)} AS BIGINT)" if nd is not None else n_e
            out.append(f"{n_e} AS {o.q(v + '_ndiff')}")
            out.append(f"{qcr(v + '_sumdiff', s_e)} AS {o.q(v + '_sumdiff')}")
        return ", ".join(out)
    ORACLES["a10_diffvals"] = W(*CC, select=f"SELECT 'TOTAL' AS AAR, {a10_cols(False)} FROM comparecube WHERE newrow = 0")
    ORACLES["a10_diffvals_by_year"] = W(*CC, select=f"SELECT AAR, {a10_cols(True)} FROM comparecube WHERE newrow = 0 GROUP BY AAR")
    ORACLES["a11_uncensored_small"] = W(select="""
      SELECT *, 'TELLER' AS rule, CAST(25 AS DOUBLE) AS "limit", true AS rule_checked FROM newcube
        WHERE SPVFLAGG = 0 AND TELLER_uprikk <= 25
      UNION ALL
      SELECT *, 'NEVNER' AS rule, CAST(25 AS DOUBLE) AS "limit", true AS rule_checked FROM newcube
        WHERE SPVFLAGG = 0 AND NEVNER <= 25""")
    bk = """a13 AS (SELECT *, CASE WHEN has = 1 AND rn = 1 AND SPVFLAGG = 0 THEN 1 ELSE 0 END AS prikket_ok FROM (
        SELECT *, max(pvern) OVER (PARTITION BY GEO, AAR, ALDER, INNVKAT) AS has,
               row_number() OVER (PARTITION BY GEO, AAR, ALDER, INNVKAT
                 ORDER BY CASE WHEN SPVFLAGG = 0 THEN 0 ELSE 1 END, TELLER_uprikk, KJONN) AS rn
        FROM (SELECT *, CASE WHEN SPVFLAGG = 1 THEN 1 ELSE 0 END AS pvern FROM newcube) p) q)"""
    sets = {"KJONN": "{1,2,0}", "ALDER": "{1_2,3_4,5_7,1_7}", "INNVKAT": "{1,2,0}"}
    parts = []
    for dname, label in sets.items():
        levels_ = ", ".join(f"'{x}'" for x in label.strip("{}").split(","))
        rest = [x for x in ["GEO", "AAR", "KJONN", "ALDER", "INNVKAT"] if x != dname]
        sel = ", ".join(f"'{label}' AS {x}" if x == dname else f"CAST({x} AS VARCHAR) AS {x}"
                        for x in ["GEO", "AAR", "KJONN", "ALDER", "INNVKAT"])
        parts.append(f"""SELECT {sel} FROM a13 WHERE CAST({dname} AS VARCHAR) IN ({levels_})
                         GROUP BY {', '.join(rest)} HAVING sum(pvern) > 0 AND sum(prikket_ok) = 1""")
    areas = "g7_areas AS (SELECT DISTINCT GEO, GEOniv FROM newcube)"

    def links(pair, divisor):
        up = "0" if pair == "LF" else f"c.GEO // {divisor}"
        return (f"SELECT '{pair}' AS pair, p.GEO AS parent, c.GEO AS child FROM g7_areas c JOIN g7_areas p "
                f"ON p.GEOniv = '{pair[0]}' AND c.GEOniv = '{pair[1]}' AND p.GEO = {up}")
    divisors = {"LF": 1, "FK": 100, "KB": 100, "BV": 10_000, "KV": 1_000_000}
    ORACLES["g7_area_parents"] = W(areas, select=" UNION ALL ".join(links(p, d) for p, d in divisors.items()))
    sets_ = ("g7_sets AS (SELECT pair, '{' || parent || ',' || string_agg(CAST(child AS VARCHAR), ',' ORDER BY child) || '}' AS set_label, "
             "list_append(list(child), parent) AS members FROM ("
             + " UNION ALL ".join(links(p, d) for p, d in divisors.items() if p != "KV") + ") l GROUP BY pair, parent)")
    ORACLES["g7_area_sets"] = W(areas, sets_, select="SELECT pair, set_label FROM g7_sets")
    parts.append("""SELECT set_label AS GEO, AAR, CAST(KJONN AS VARCHAR) AS KJONN, ALDER, CAST(INNVKAT AS VARCHAR) AS INNVKAT
        FROM a13 JOIN (SELECT set_label, unnest(members) AS m FROM g7_sets) s ON a13.GEO = s.m
        GROUP BY set_label, AAR, KJONN, ALDER, INNVKAT HAVING sum(pvern) > 0 AND sum(prikket_ok) = 1""")
    ORACLES["a13_suppression_attack"] = W(bk, areas, sets_, select=" UNION ALL ".join(parts))
    ORACLES["a17_diff_trend"] = W(*CC, f"""a17_d AS (SELECT {LABEL} AS GEOniv, AAR, RATE_diff, RATE_reldiff FROM comparecube
                                       WHERE newrow = 0 AND SPVFLAGG_new = 0 AND SPVFLAGG_old = 0)""",
        """a17_l AS (SELECT GEOniv, AAR, 'Absolute' AS variable, RATE_diff AS value FROM a17_d
                    UNION ALL SELECT GEOniv, AAR, 'Relative', RATE_reldiff FROM a17_d)""",
        """a17_g AS (SELECT * FROM (SELECT DISTINCT GEOniv FROM a17_l)
                    CROSS JOIN (SELECT DISTINCT AAR FROM a17_l)
                    CROSS JOIN (SELECT DISTINCT variable FROM a17_l))""",
        f"""a17_s AS (SELECT GEOniv, AAR, variable, count(value) AS n, min(value) AS mn,
                    quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS md,
                    quantile_cont(value, 0.75) AS q3, max(value) AS mx FROM a17_l
                    WHERE NOT ((variable = 'Absolute' AND value = 0) OR (variable = 'Relative' AND value = 1))
                    GROUP BY ALL)""",
        select=f"""SELECT g.GEOniv, g.AAR, g.variable, coalesce(s.n, 0) AS n, {R('s.mn', 4)} AS "min",
                   {R('s.q1', 4)} AS q1, {R('s.md', 4)} AS median, {R('s.q3', 4)} AS q3, {R('s.mx', 4)} AS "max"
                   FROM a17_g g LEFT JOIN a17_s s ON g.GEOniv IS NOT DISTINCT FROM s.GEOniv AND g.AAR IS NOT DISTINCT FROM s.AAR
                   AND g.variable = s.variable""")
    ORACLES["w5_denominator_change"] = W(
        "w5 AS (SELECT * FROM newcube WHERE GEOniv IN ('K', 'B') AND KJONN = 0 AND ALDER = '1_7' AND INNVKAT = 0 AND NEVNER IS NOT NULL)",
        select=f"""SELECT GEO, AAR, ALDER, NEVNER, sumNEVNER_max, sumNEVNER_last,
           {R('NEVNER / nullif(sumNEVNER_last, 0)', 2)} AS sumNEVNER_vs_last,
           {R('NEVNER / nullif(sumNEVNER_max, 0)', 2)} AS sumNEVNER_vs_max FROM (
           SELECT *, max(NEVNER) OVER (PARTITION BY GEO, KJONN, ALDER, INNVKAT) AS sumNEVNER_max,
                  last_value(NEVNER IGNORE NULLS) OVER (PARTITION BY GEO, KJONN, ALDER, INNVKAT ORDER BY AAR
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS sumNEVNER_last FROM w5) x""")
    befolk = "c5_bf AS (SELECT GEO, AAR, KJONN, ALDER, TELLER_uprikk AS TELLER FROM newcube WHERE INNVKAT = 0)"
    ORACLES["w6_growth"] = W(befolk, select="""SELECT *, lead(TELLER) OVER (PARTITION BY GEO, KJONN, ALDER ORDER BY AAR)
                                               - TELLER AS BEFVEKST_BEFOLK FROM c5_bf""")
    ORACLES["c5_growth_reconcile"] = W(
        befolk,
        """c5_bv AS (SELECT GEO, AAR, KJONN, ALDER, lead(T) OVER (PARTITION BY GEO, KJONN, ALDER ORDER BY AAR) - T AS TELLER
                    FROM (SELECT GEO, AAR, KJONN, ALDER, TELLER_uprikk AS T FROM oldcube WHERE UTDANN = 0) z)""",
        "c5_bf2 AS (SELECT * FROM c5_bf WHERE " + in_other(["GEO", "AAR", "KJONN", "ALDER"], "c5_bv") + ")",
        """c5_g AS (SELECT *, lead(TELLER) OVER (PARTITION BY GEO, KJONN, ALDER ORDER BY AAR) - TELLER AS BEFVEKST_BEFOLK
                   FROM c5_bf2)""",
        select="""SELECT * FROM (SELECT v.GEO, v.AAR, v.KJONN, v.ALDER, v.TELLER AS BEFVEKST_BEFVEKST, g.BEFVEKST_BEFOLK,
                  v.TELLER - g.BEFVEKST_BEFOLK AS diff
                  FROM c5_bv v LEFT JOIN c5_g g ON v.GEO = g.GEO AND v.AAR = g.AAR AND v.KJONN = g.KJONN AND v.ALDER = g.ALDER)
                  WHERE AAR <> (SELECT max(AAR) FROM c5_bv) AND diff IS DISTINCT FROM 0""")


_more()


def _plots():
    NF = o.C1_CTES
    ORACLES["a14_boxplot"] = W(*NF, select="""
      SELECT GEOniv, KJONN, ALDER, INNVKAT, UTDANN, wq25, wq50, wq75, count(RATE) AS N_obs,
             min(RATE) FILTER (WHERE RATE >= LOW) AS MINABOVELOW, max(RATE) FILTER (WHERE RATE <= HIGH) AS MAXBELOWHIGH
      FROM c1_newflag WHERE GEOniv IS NOT NULL GROUP BY GEOniv, KJONN, ALDER, INNVKAT, UTDANN, wq25, wq50, wq75
      HAVING count(RATE) >= 3""")
    ORACLES["a14_boxplot_change"] = W(*NF, select="""
      SELECT GEOniv, KJONN, ALDER, INNVKAT, UTDANN, change_wq25, change_wq50, change_wq75, count(change_RATE) AS N_obs,
             min(change_RATE) FILTER (WHERE change_RATE >= change_LOW) AS MINABOVELOW,
             max(change_RATE) FILTER (WHERE change_RATE <= change_HIGH) AS MAXBELOWHIGH
      FROM c1_newflag WHERE GEOniv IS NOT NULL
      GROUP BY GEOniv, KJONN, ALDER, INNVKAT, UTDANN, change_wq25, change_wq50, change_wq75
      HAVING count(change_RATE) >= 3""")
    ORACLES["a14_boxplot_points"] = W(*NF, select="""
      SELECT GEOniv, KJONN, ALDER, INNVKAT, UTDANN, CAST(GEO AS VARCHAR) || '''' || right(AAR, 2) AS label, RATE AS yval
      FROM c1_newflag WHERE GEOniv IS NOT NULL AND NEW_OUTLIER = 1""")

    def w7(v, change):
        extra = (f"HAVING min({v}) < -10 OR max({v}) > 20" if change else "")
        by = "GEO, KJONN, ALDER, INNVKAT, UTDANN"
        return W(*NF, f"""w7_d AS (SELECT *, CAST(substr(AAR, 6, 4) AS INTEGER) AS AARh FROM c1_newflag
                          WHERE GEOniv IS NOT NULL AND {v} IS NOT NULL)""",
                 f"""w7_s AS (SELECT {by}, CAST(sum(NEW_OUTLIER) AS BIGINT) AS n_outlier, count({v}) AS n_obs,
                            0.5 * (max({v}) + min({v})) AS y_middle FROM w7_d GROUP BY {by} {extra})""",
                 f"""w7_p AS (SELECT *, CAST(floor((row_number() OVER (ORDER BY {by}) - 1) / 25) + 1 AS INTEGER) AS page
                            FROM w7_s WHERE n_outlier > 0 AND n_obs > 0)""",
                 select=f"""SELECT p.*, d.AARh, d.{v} AS yval, round_even(d.TELLER_uprikk, 0) AS tv,
                   d.{'change_OUTLIER' if change else 'OUTLIER'} AS ol,
                   CASE WHEN d.{'change_OUTLIER' if change else 'OUTLIER'} = 0 THEN 'Normal'
                        WHEN d.{'change_OUTLIER' if change else 'OUTLIER'} = 1
                             AND d.{'change_NEW_OUTLIER' if change else 'NEW_OUTLIER'} = 0 THEN 'Previous outlier'
                        WHEN d.{'change_OUTLIER' if change else 'OUTLIER'} = 1 THEN 'New outlier' END AS ollabel
                   FROM w7_p p JOIN w7_d d USING ({by})""")
    ORACLES["w7_series"] = w7("RATE", False)
    w7c = w7("change_RATE", True).replace("sum(NEW_OUTLIER)", "sum(change_NEW_OUTLIER)")
    ORACLES["w7_series_change"] = w7c
    ORACLES["a15_trend"] = W(*NF,
        "a15_s AS (SELECT * FROM c1_newflag WHERE (GEO IN (100, 201, 302, 403) OR GEOniv = 'B') AND RATE IS NOT NULL)",
        f"""a15_d AS (SELECT *, {KOMMUNE} AS KOMMUNE FROM a15_s
                    WHERE AAR IN (SELECT AAR FROM a15_s WHERE GEOniv = 'B' AND SPVFLAGG = 0))""",
        """a15_t AS (
          SELECT KOMMUNE, AAR, KJONN, ALDER, INNVKAT, UTDANN, CAST(sum(CAST(RATE * WEIGHTS AS DECIMAL(38,6))) AS DOUBLE) / nullif(sum(WEIGHTS), 0) AS y,
                 'Kommune' AS type FROM a15_d WHERE GEOniv = 'K' AND AAR IN (SELECT AAR FROM a15_d WHERE GEOniv = 'B')
          GROUP BY KOMMUNE, AAR, KJONN, ALDER, INNVKAT, UTDANN
          UNION ALL
          SELECT KOMMUNE, AAR, KJONN, ALDER, INNVKAT, UTDANN, CAST(sum(CAST(RATE * WEIGHTS AS DECIMAL(38,6))) AS DOUBLE) / nullif(sum(WEIGHTS), 0) AS y,
                 'Vektet bydel' AS type FROM a15_d WHERE GEOniv = 'B' GROUP BY KOMMUNE, AAR, KJONN, ALDER, INNVKAT, UTDANN)""",
        select=f"""SELECT * EXCLUDE (y), {R('y', 6)} AS y FROM (SELECT *, count(*) OVER (PARTITION BY KOMMUNE, type, KJONN, ALDER, INNVKAT, UTDANN) AS N
                   FROM a15_t) WHERE N > 1""")
    blocks = []
    for dim, filt in (("Total", "KJONN = 0 AND ALDER = '1_7' AND INNVKAT = 0"),
                      ("KJONN", "ALDER = '1_7' AND INNVKAT = 0"),
                      ("ALDER", "KJONN = 0 AND INNVKAT = 0"),
                      ("INNVKAT", "KJONN = 0 AND ALDER = '1_7'")):
        level = "'total'" if dim == "Total" else f"CAST({dim} AS VARCHAR)"
        for p in ("RATE", "TELLER_uprikk", "NEVNER"):
            blocks.append(f"SELECT '{dim}' AS by_dim, {level} AS level, AAR, '{p}' AS PARAMETER, "
                          f"CAST({p} AS DOUBLE) AS yvalue FROM newcube WHERE GEO = 0 AND {filt} AND {p} IS NOT NULL")
    ORACLES["a16_country"] = W(select="SELECT *, CAST(split_part(AAR, '_', 1) AS INTEGER) AS AARx FROM ("
                               + " UNION ALL ".join(blocks) + ")")
    # means of means in the order of the dimensions: ALDER first, then INNVKAT
    def means(block):
        one = "SELECT AAR, ALDER, INNVKAT, KJONN, CAST(RATE AS DOUBLE) AS RATE, TELLER_uprikk AS T, CAST(NEVNER AS DOUBLE) AS N FROM newcube " \
              "WHERE GEO = 0 AND ALDER <> '1_7' AND INNVKAT <> 0" + ("" if block == "KJONN" else " AND KJONN = 0")
        for d in ("ALDER", "INNVKAT"):
            if d != block:
                rest = ", ".join(x for x in ("ALDER", "INNVKAT", "KJONN") if x != d)
                one = f"SELECT AAR, 'Total' AS {d}, {rest}, avg(RATE) AS RATE, coalesce(sum(T), 0.0) AS T, avg(N) AS N FROM ({one}) z GROUP BY AAR, {rest}"
        level = "'total'" if block == "Total" else f"CAST({block} AS VARCHAR)"
        return " UNION ALL ".join(f"SELECT '{block}' AS by_dim, {level} AS level, AAR, '{p}' AS PARAMETER, {R(c, 6)} AS yvalue FROM ({one}) z WHERE {c} IS NOT NULL"
                                  for p, c in (("RATE", "RATE"), ("TELLER_uprikk", "T"), ("NEVNER", "N")))
    ORACLES["a16_country_means"] = W(select="SELECT *, CAST(split_part(AAR, '_', 1) AS INTEGER) AS AARx FROM ("
                                     + " UNION ALL ".join(means(b) for b in ("Total", "KJONN", "ALDER", "INNVKAT")) + ")")
    ORACLES["k4_plot_files"] = W(*NF, """k4 AS (SELECT DISTINCT GEOniv, KJONN, ALDER, INNVKAT, UTDANN, wq25, wq50, wq75
                                      FROM c1_newflag WHERE GEOniv IS NOT NULL)""",
        select="""SELECT CAST(KJONN AS VARCHAR) AS suffix, count(DISTINCT (ALDER, INNVKAT, UTDANN)) AS n_panels,
                  concat('KJONN==', chr(39), KJONN, chr(39)) AS predicate FROM k4 GROUP BY KJONN""")

    # barometer
    base = """c6_b AS (SELECT GEO, GEOniv, ALDER, RATE, SPVFLAGG,
                CAST(CASE ALDER WHEN '1_2' THEN 1 WHEN '3_4' THEN 2 WHEN '5_7' THEN 3 WHEN '1_7' THEN 4 END AS BIGINT) AS LPnr,
                CAST(substr(AAR, 6, 4) AS INTEGER) AS Aar
              FROM newcube WHERE KJONN = 0 AND INNVKAT = 0 AND AAR = (SELECT max(AAR) FROM newcube))"""
    j = """c6_j AS (SELECT k.*, f.RATE AS rf, l.RATE AS rl FROM (SELECT * FROM c6_b WHERE GEOniv = 'K') k
              LEFT JOIN (SELECT * FROM c6_b WHERE GEOniv = 'F') f ON floor(k.GEO / 100) = f.GEO AND k.LPnr = f.LPnr
              LEFT JOIN (SELECT * FROM c6_b WHERE GEO = 0) l ON k.LPnr = l.LPnr)"""
    ind = """c6_i AS (SELECT Aar, LPnr, LPnr AS corrected_LPnr, CAST(GEO AS VARCHAR) AS Sted_kode, s.SpraakId,
                round(RATE, -1) AS Verdi_lavesteGeonivaa, round(rf, -1) AS Verdi_mellomGeonivaa,
                round(rl, -1) AS Verdi_referansenivaa FROM c6_j, (VALUES ('BOKMAAL'), ('NYNORSK')) s(SpraakId))"""
    bar = """c6_bar AS (SELECT CAST(GEO AS VARCHAR) AS stedskode_string, GEO AS stedskode_numeric, LPnr,
                CASE WHEN RATE > rl THEN 1 END AS roede, CASE WHEN RATE < rl THEN 1 END AS groenne,
                CASE WHEN SPVFLAGG <> 0 THEN 1 END AS hvitMprikk FROM c6_j)"""

    def c6(valcol):
        return W(base, j, ind, bar, select=f"""
          SELECT b.*, i.Aar, i.Verdi_lavesteGeonivaa, i.Verdi_mellomGeonivaa, i.Verdi_referansenivaa
          FROM c6_bar b LEFT JOIN (SELECT * FROM c6_i WHERE SpraakId = 'BOKMAAL') i
            ON b.stedskode_string = i.Sted_kode AND b.LPnr = i.LPnr
          WHERE i.{valcol} = i.Verdi_referansenivaa
            AND (b.roede IS NOT NULL OR b.groenne IS NOT NULL OR b.hvitMprikk IS NOT NULL)""")
    ORACLES["c6_barometer"] = c6("Verdi_lavesteGeonivaa")
    ORACLES["c6_barometer_fylke"] = c6("Verdi_mellomGeonivaa")
    ORACLES["c6_barometer_missing"] = W(base, j, ind, bar, select="""
      SELECT DISTINCT LPnr FROM c6_i WHERE SpraakId = 'BOKMAAL'
        AND LPnr NOT IN (SELECT LPnr FROM c6_bar WHERE LPnr <> 1)""")


_plots()


def _extracts():
    tag = "2025-01-01-00-00"
    exb = """ex_b AS (SELECT * FROM newcube WHERE GEOniv = 'K' AND INNVKAT = 0
               AND CAST(substr(AAR, 1, 4) AS INTEGER) > (SELECT max(CAST(substr(AAR, 1, 4) AS INTEGER)) FROM newcube) - 3)"""
    ex = f"""ex AS (
      SELECT 'RETURNS_TOTAL_{tag}.csv' AS Friskvik, CAST(NULL AS VARCHAR) AS ETAB, GEO, AAR, KJONN, ALDER, RATE AS MEIS
        FROM ex_b WHERE KJONN = 0 AND ALDER = '1_7'
      UNION ALL SELECT 'RETURNS_MEN_{tag}.csv', 'GEO > 0', GEO, AAR, KJONN, ALDER,
        CASE WHEN GEO = (SELECT max(GEO) FROM ex_b) THEN RATE + 1 ELSE RATE END FROM ex_b WHERE KJONN = 1 AND ALDER = '1_7'
      UNION ALL SELECT 'RETURNS_COUNT_{tag}.csv', NULL, GEO, AAR, KJONN, ALDER,
        CASE WHEN GEO = (SELECT min(GEO) FROM ex_b) THEN NULL ELSE TELLER END FROM ex_b WHERE KJONN = 0 AND ALDER = '3_4'
      UNION ALL SELECT 'RETURNS_UNKNOWN_{tag}.csv', NULL, GEO, AAR, KJONN, ALDER, RATE FROM ex_b WHERE KJONN = 0 AND ALDER = '1_7')"""
    cf = """cf AS (SELECT c.*, f.Friskvik FROM newcube c JOIN (SELECT DISTINCT Friskvik, GEO FROM ex) f ON c.GEO = f.GEO
      WHERE EXISTS (SELECT 1 FROM ex e WHERE e.Friskvik = f.Friskvik AND e.KJONN = c.KJONN)
        AND EXISTS (SELECT 1 FROM ex e WHERE e.Friskvik = f.Friskvik AND e.ALDER = c.ALDER)
        AND c.INNVKAT = 0)"""
    pairs = """pr AS (SELECT c.*, e.Friskvik AS e_f, e.MEIS, c.Friskvik IS NOT NULL AS in_cube, e.Friskvik IS NOT NULL AS in_ext,
        coalesce(c.Friskvik, e.Friskvik) AS k, coalesce(c.GEO, e.GEO) AS g
      FROM (SELECT * FROM cf WHERE EXISTS (SELECT 1 FROM ex y WHERE y.Friskvik = cf.Friskvik AND y.AAR = cf.AAR)) c
      FULL OUTER JOIN ex e ON c.Friskvik = e.Friskvik AND c.GEO = e.GEO AND c.AAR = e.AAR AND c.KJONN = e.KJONN
        AND c.ALDER = e.ALDER)"""
    ORACLES["f4_cube_to_extract"] = W(exb, ex, cf, select="SELECT * FROM cf")
    c8 = """SELECT e.Friskvik, CASE WHEN e.m = c.m THEN 'Yes' ELSE '!!NO!!' END AS SISTE_AAR
            FROM (SELECT Friskvik, max(AAR) AS m FROM ex GROUP BY 1) e
            LEFT JOIN (SELECT Friskvik, max(AAR) AS m FROM cf GROUP BY 1) c ON e.Friskvik = c.Friskvik"""
    ORACLES["c8_last_year"] = W(exb, ex, cf, select=c8)
    c9 = """SELECT i.Friskvik, CASE WHEN b.gl IS NULL THEN 'Yes' ELSE '!!NO!! Diff for GEO: ' || b.gl END AS IDENTISK_PRIKKING
            FROM (SELECT DISTINCT Friskvik FROM ex) i LEFT JOIN (
              SELECT k AS Friskvik, array_to_string(list_sort(list(DISTINCT CAST(g AS VARCHAR))), ', ') AS gl FROM pr
              WHERE NOT coalesce(in_cube AND in_ext AND ((MEIS IS NULL) = (SPVFLAGG > 0)), false) GROUP BY k) b
            ON i.Friskvik = b.Friskvik"""
    ORACLES["c9_mask_match"] = W(exb, ex, cf, pairs, select=c9)
    ORACLES["c9_mask_areas"] = W(exb, ex, cf, pairs, select="""
      SELECT DISTINCT k AS Friskvik, CAST(g AS BIGINT) AS GEO FROM pr
      WHERE NOT coalesce(in_cube AND in_ext AND ((MEIS IS NULL) = (SPVFLAGG > 0)), false)""")
    vals = ["TELLER", "NEVNER", "RATE", "TELLER_uprikk"]

    def eq(v):
        return (f"bool_and(coalesce(in_cube AND in_ext AND ((MEIS IS NULL AND {v} IS NULL) OR "
                f"coalesce(abs(MEIS - {v}) <= 1.5e-8 * greatest(abs(MEIS), abs({v}), 1.0), false)), false)) AS m_{v}")
    mlist = "list_filter([" + ", ".join(f"CASE WHEN m_{v} THEN '{v}' END" for v in vals) + "], lambda x: x IS NOT NULL)"
    dlist = "list_filter([" + ", ".join(f"CASE WHEN NOT m_{v} THEN '{v}' END" for v in vals) + "], lambda x: x IS NOT NULL)"
    c10 = f"""SELECT Friskvik, CASE WHEN len({mlist}) = 0 THEN '!!NO MATCH!!' ELSE array_to_string({mlist}, ', ') END AS MATCHER_KOLONNE,
                array_to_string({dlist}, ', ') AS Different_kubecol
              FROM (SELECT k AS Friskvik, {', '.join(eq(v) for v in vals)} FROM pr GROUP BY k) z"""
    ORACLES["c10_measure_match"] = W(exb, ex, cf, pairs, select=c10)

    # The n-th row of a key on one side pairs with the n-th on the other
    four = "GEO, AAR, KJONN, ALDER"
    mb = f"""mk_b AS (SELECT {four}, RATE AS MEIS FROM newcube WHERE GEOniv = 'K' AND KJONN = 0 AND ALDER = '1_7'
               AND AAR IN (SELECT AAR FROM ex_b WHERE KJONN = 0 AND ALDER = '1_7'))"""
    me = f"""mk_e AS (SELECT 'ALL.csv' AS Friskvik, * FROM mk_b
      UNION ALL SELECT 'CHANGED.csv', * REPLACE (CASE WHEN GEO = (SELECT max(GEO) FROM ex_b) AND MEIS > 0 THEN MEIS + 1 ELSE MEIS END AS MEIS) FROM mk_b
      UNION ALL SELECT 'ONCE.csv', {four}, max(MEIS) FROM mk_b GROUP BY {four})"""
    mc = f"""mk_c AS (SELECT c.* EXCLUDE (INNVKAT), f.Friskvik FROM newcube c, (SELECT DISTINCT Friskvik FROM mk_e) f
      WHERE c.KJONN = 0 AND c.ALDER = '1_7' AND EXISTS (SELECT 1 FROM mk_e e WHERE e.Friskvik = f.Friskvik AND e.GEO = c.GEO)
        AND EXISTS (SELECT 1 FROM mk_e e WHERE e.Friskvik = f.Friskvik AND e.AAR = c.AAR))"""
    order = ", ".join(f"{o.q(v)} ASC NULLS FIRST" for v in ["RATE", "TELLER", "NEVNER", "RATE.n", "SPVFLAGG", "TELLER_uprikk"])
    mp = f"""pr AS (SELECT c.*, e.MEIS, c.Friskvik IS NOT NULL AS in_cube, e.Friskvik IS NOT NULL AS in_ext,
        coalesce(c.Friskvik, e.Friskvik) AS k, coalesce(c.GEO, e.GEO) AS g
      FROM (SELECT *, row_number() OVER (PARTITION BY Friskvik, {four} ORDER BY {order}) AS occ FROM mk_c) c
      FULL OUTER JOIN (SELECT *, row_number() OVER (PARTITION BY Friskvik, {four} ORDER BY MEIS ASC NULLS FIRST) AS occ FROM mk_e) e
        ON c.Friskvik = e.Friskvik AND c.GEO = e.GEO AND c.AAR = e.AAR AND c.KJONN = e.KJONN AND c.ALDER = e.ALDER AND c.occ = e.occ)"""
    ORACLES["c10_repeated_keys"] = W(exb, mb, me, mc, mp, select=c10.replace(", CASE WHEN m_TELLER_uprikk THEN 'TELLER_uprikk' END", "")
                                     .replace(", CASE WHEN NOT m_TELLER_uprikk THEN 'TELLER_uprikk' END", ""))
    ORACLES["c9_repeated_keys"] = W(exb, mb, me, mc, mp, select="""
      SELECT DISTINCT k AS Friskvik, CAST(g AS BIGINT) AS GEO FROM pr
      WHERE NOT coalesce(in_cube AND in_ext AND ((MEIS IS NULL) = (SPVFLAGG > 0)), false)""")

    def ul(src, d, alias):
        return (f"SELECT Friskvik, array_to_string(list_sort(list(DISTINCT coalesce(CAST({d} AS VARCHAR), 'NA'))), ', ') "
                f"AS {alias} FROM {src} GROUP BY Friskvik")
    ORACLES["a12_unique_levels"] = W(exb, ex, cf, select=f"""
      SELECT a.Friskvik, a.ALDER, k.KJONN FROM ({ul('cf', 'ALDER', 'ALDER')}) a JOIN ({ul('cf', 'KJONN', 'KJONN')}) k
        ON a.Friskvik = k.Friskvik""")
    # The report on the loaded extracts (control rows of profile FHP, level K, year 2025)
    ctrl = """ctrl AS (SELECT * FROM (VALUES
        ('FHP', '2025', 'K', 'RETURNS_TOTAL', 'LINEITEM_RETURNS', '2001', '2001', 'per 1000 (ak)'),
        ('FHP', '2025', 'K', 'RETURNS_MEN', 'LINEITEM_RETURNS', NULL, '2001', 'per 1000'),
        ('FHP', '2025', 'K', 'RETURNS_COUNT', 'LINEITEM_RETURNS', '2001', '2001', NULL),
        ('OVP', '2025', 'K', 'RETURNS_UNKNOWN', 'LINEITEM_RETURNS', '2001', '2001', 'antall'))
        t(PROFILTYPE, AARGANG, MODUS, INDIKATOR, KUBE_NAVN, Periode_bm, Periode_nn, Enhet)
        WHERE PROFILTYPE = 'FHP' AND MODUS = 'K' AND AARGANG = '2025')"""
    ids = f"""ids AS (SELECT i.Friskvik, c.KUBE_NAVN, c.Periode_bm, c.Periode_nn, c.Enhet,
                 coalesce(c.KUBE_NAVN = 'LINEITEM_RETURNS', false) AS loaded
               FROM (SELECT DISTINCT Friskvik FROM ex_all) i
               LEFT JOIN ctrl c ON regexp_replace(i.Friskvik, '_[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}-[0-9]{{2}}-[0-9]{{2}}.*$', '') = c.INDIKATOR)"""
    ex_all = ex.replace("ex AS (", "ex_all AS (", 1)
    ex_loaded = "ex AS (SELECT * FROM ex_all WHERE Friskvik IN (SELECT Friskvik FROM ids WHERE loaded))"
    rep = f"""rep AS (SELECT i.Friskvik, i.loaded,
        CASE WHEN i.loaded THEN 'LINEITEM_RETURNS_{tag}.parquet' END AS Kube,
        CASE WHEN i.loaded THEN 'TRUE' END AS FIL_I_STATBANK,
        fe.FRISKVIK_ETAB, kk.KUBE_KJONN, ka.KUBE_ALDER, CAST(NULL AS VARCHAR) AS KUBE_UTDANN, ki.KUBE_INNVKAT,
        CAST(NULL AS VARCHAR) AS KUBE_LANDBAK, fa.FRISKVIK_AAR, c8.SISTE_AAR,
        CASE WHEN i.loaded THEN CASE WHEN i.Periode_bm IS NULL OR trim(i.Periode_bm) = '' THEN '!! empty' ELSE i.Periode_bm END END AS Periode_bm,
        CASE WHEN i.loaded THEN CASE WHEN i.Periode_nn IS NULL OR trim(i.Periode_nn) = '' THEN '!! empty' ELSE i.Periode_nn END END AS Periode_nn,
        c9.IDENTISK_PRIKKING, c10.MATCHER_KOLONNE, c10.Different_kubecol,
        CASE WHEN i.loaded THEN CASE WHEN i.Enhet IS NULL OR trim(i.Enhet) = '' THEN '!!MISSING' ELSE i.Enhet END END AS Enhet,
        CASE WHEN i.loaded THEN 'P' END AS REFVERDI_VP
      FROM ids i
      LEFT JOIN ({ul('ex', 'ETAB', 'FRISKVIK_ETAB')}) fe ON i.Friskvik = fe.Friskvik
      LEFT JOIN ({ul('ex', 'AAR', 'FRISKVIK_AAR')}) fa ON i.Friskvik = fa.Friskvik
      LEFT JOIN ({ul('cf', 'KJONN', 'KUBE_KJONN')}) kk ON i.Friskvik = kk.Friskvik
      LEFT JOIN ({ul('cf', 'ALDER', 'KUBE_ALDER')}) ka ON i.Friskvik = ka.Friskvik
      LEFT JOIN ({ul('cf', 'INNVKAT', 'KUBE_INNVKAT')}) ki ON i.Friskvik = ki.Friskvik
      LEFT JOIN ({c8}) c8 ON i.Friskvik = c8.Friskvik
      LEFT JOIN ({c9}) c9 ON i.Friskvik = c9.Friskvik
      LEFT JOIN ({c10}) c10 ON i.Friskvik = c10.Friskvik)"""
    vk = """CASE WHEN loaded THEN CASE WHEN (isak AND ispd AND ismeis) OR NOT (isak OR ispd OR ismeis) THEN 'Yes' ELSE '!! No!!' END END"""
    ORACLES["c7_extract_report"] = W(exb, ex_all, ctrl, ids, ex_loaded, cf, pairs, rep, select=f"""
      SELECT Friskvik, Kube,
        CASE WHEN NOT loaded THEN 'not_loaded'
             WHEN coalesce(contains(SISTE_AAR, '!!'), false) OR coalesce(contains(Periode_bm, '!!'), false)
               OR coalesce(contains(Periode_nn, '!!'), false) OR coalesce(contains(IDENTISK_PRIKKING, '!!'), false)
               OR coalesce(contains(MATCHER_KOLONNE, '!!'), false) OR coalesce(contains(VALID_kombo, '!!'), false)
             THEN '!! KANSKJE IKKE !!' ELSE 'Ja' END AS ALT_OK,
        FIL_I_STATBANK, FRISKVIK_ETAB, KUBE_KJONN, KUBE_ALDER, KUBE_UTDANN, KUBE_INNVKAT, KUBE_LANDBAK, FRISKVIK_AAR,
        SISTE_AAR, Periode_bm, Periode_nn, IDENTISK_PRIKKING, MATCHER_KOLONNE, Different_kubecol, Enhet, REFVERDI_VP,
        VALID_kombo FROM (
        SELECT *, {vk} AS VALID_kombo FROM (
          SELECT *, coalesce(regexp_matches(Enhet, '\\([ak,]+\\)'), false) AS isak,
                 coalesce(REFVERDI_VP IN ('P', 'D'), false) AS ispd,
                 coalesce(list_contains(string_split(MATCHER_KOLONNE, ', '), 'MEIS'), false) AS ismeis FROM rep) r) v""")


_extracts()


def _sources():
    ORACLES["s6_read_csv"] = W(select="SELECT * FROM fx_new_raw")
    ORACLES["s3_find_read"] = W(select="SELECT * FROM fx_new_raw")
    ORACLES["l1_codemap"] = W(select="""
      SELECT * FROM (
        SELECT CASE WHEN n_nationkey = (SELECT max(n_nationkey) FROM nation) THEN 100 * (n_regionkey + 1) + n_nationkey + 1000
                    ELSE 100 * (n_regionkey + 1) + n_nationkey END AS old,
               CAST(100 * (n_regionkey + 1) + n_nationkey AS BIGINT) AS current FROM nation
        UNION ALL
        SELECT DISTINCT CASE WHEN n_regionkey = (SELECT max(n_regionkey) FROM nation) THEN n_regionkey + 1 + 10
                             ELSE n_regionkey + 1 END, CAST(n_regionkey + 1 AS BIGINT) FROM nation)
      WHERE old IS NOT NULL AND old <> current""")
    ORACLES["l2_popinfo"] = W(select="""
      SELECT GEO, GEOniv, CAST(TELLER_uprikk AS DOUBLE) AS WEIGHTS FROM newcube
      WHERE ALDER = '1_7' AND KJONN = 0 AND INNVKAT = 0
        AND AAR = (SELECT max(AAR) FROM newcube WHERE ALDER = '1_7' AND KJONN = 0 AND INNVKAT = 0)
      UNION ALL SELECT * FROM (VALUES (CAST(81 AS BIGINT), 'H', 0.0), (82, 'H', 0.0), (83, 'H', 0.0), (84, 'H', 0.0))""")
    ORACLES["l3_dimlist"] = W(select="""
      SELECT DISTINCT dim FROM (
        SELECT unnest([CASE WHEN n_nationkey % 2 = 0 THEN 'INNVKAT' ELSE 'UTDANN' END,
                       CASE WHEN n_regionkey = 0 THEN 'SEGMENT' END]) AS dim FROM nation
        WHERE n_nationkey <> (SELECT max(n_nationkey) FROM nation)
        UNION ALL SELECT unnest(['GEO', 'AAR', 'ALDER', 'KJONN', 'UTDANN', 'INNVKAT', 'LANDBAK'])) d
      WHERE dim IS NOT NULL""")
    ORACLES["l4_validgeo"] = W(select="""
      SELECT GEO FROM fx_popinfo WHERE GEOniv IN ('F', 'K', 'B') UNION ALL SELECT CAST(0 AS BIGINT)""")
    cols = []
    keep = ["GEOniv", "newrow", "GEO", "AAR", "KJONN", "ALDER", "INNVKAT", "UTDANN", "any_diffs"]
    for v in o.VALS:
        for suffix in ("_new", "_old", "_diff", "_reldiff"):
            if suffix == "_reldiff" and v in ("SPVFLAGG", "RATE.n"):
                continue
            name = v + suffix
            d = o.qc_round_sql(name)
            expr = o.q(name) if d is None else R(o.q(name), d)
            if v == "SPVFLAGG" and suffix in ("_new", "_old"):
                expr = f"CAST({R('CAST(' + o.q(name) + ' AS DOUBLE)', d)} AS BIGINT)"
            cols.append(f"{expr} AS {o.q(name)}")
    ORACLES["p10_round"] = W(*o.COMPARECUBE_CTES, select=f"SELECT {', '.join(keep)}, {', '.join(cols)} FROM comparecube")
    ORACLES["p11_grid"] = W(select="""
      SELECT * FROM (SELECT DISTINCT GEOniv FROM newcube) CROSS JOIN (SELECT DISTINCT AAR FROM newcube)
        CROSS JOIN (SELECT DISTINCT KJONN FROM newcube)""")
    ORACLES["s1_load_pair"] = ORACLES["c1_comparecube"]
    ORACLES["s1_load_only"] = W(select="SELECT * FROM oldcube")
    ORACLES["k2_dump"] = ORACLES["p10_round"]
    ORACLES["k1_check_table"] = ORACLES["a5_coverage_geolevel"]
    ORACLES["k3_extract_report"] = ORACLES["c7_extract_report"]
    tag, none = "2024-01-01-00-00", "CAST(NULL AS VARCHAR)"
    equal = lambda v: f"bool_and((RATE IS NULL AND {v} IS NULL) OR coalesce(abs(RATE - {v}) <= 1.5e-8 * greatest(abs(RATE), abs({v}), 1.0), false))"
    listed = lambda yes: ("array_to_string(list_filter([" + ", ".join(
        f"CASE WHEN {'' if yes else 'NOT '}{equal(v)} THEN '{v}' END" for v in ("TELLER", "RATE", "NEVNER", "TELLER_uprikk")) + "], lambda x: x IS NOT NULL), ', ')")
    second = W("b2 AS (SELECT * FROM newcube WHERE GEOniv = 'K' AND KJONN = 2 AND ALDER = '1_2' AND INNVKAT = 0)", select=f"""
      SELECT 'RETURNS_BAND_{tag}.csv' AS Friskvik, 'LINEITEM_TOTAL_{tag}.csv' AS Kube, '!! KANSKJE IKKE !!' AS ALT_OK, 'FALSE' AS FIL_I_STATBANK,
        {none} AS FRISKVIK_ETAB, '2' AS KUBE_KJONN, '1_2' AS KUBE_ALDER, {none} AS KUBE_UTDANN, {none} AS KUBE_INNVKAT, {none} AS KUBE_LANDBAK,
        array_to_string(list_sort(list(DISTINCT AAR)), ', ') AS FRISKVIK_AAR, 'Yes' AS SISTE_AAR, '2001' AS Periode_bm, '!! empty' AS Periode_nn,
        CASE WHEN bool_and((RATE IS NULL) = (SPVFLAGG > 0)) THEN 'Yes' END AS IDENTISK_PRIKKING, {listed(True)} AS MATCHER_KOLONNE,
        {listed(False)} AS Different_kubecol, 'antall' AS Enhet, '!! MISSING from SPECS-file' AS REFVERDI_VP, 'Yes' AS VALID_kombo FROM b2""")
    ORACLES["c11_extract_files"] = f"SELECT * FROM ({ORACLES['c7_extract_report']}) a UNION ALL BY NAME SELECT * FROM ({second}) b"
    ORACLES["s7_renamed_columns"] = W(select="""
      SELECT 'antall' AS original, 'TELLER' AS new, count(TELLER) AS n_values FROM newcube
      UNION ALL SELECT 'Crude', 'RATE', count(RATE) FROM newcube""")
    ORACLES["s8_forbidden_columns"] = W(select="""
      SELECT 'TELLER' AS "column", count(TELLER) AS n_values FROM newcube UNION ALL SELECT 'NEVNER', count(NEVNER) FROM newcube""")
    ORACLES["p9_convert_types"] = W(select="""
      SELECT CAST(GEO AS VARCHAR) AS GEO, AAR, KJONN, ALDER, INNVKAT, CAST(NULL AS BIGINT) AS period, GEO AS code, CAST(KJONN AS DOUBLE) AS sex,
             CAST(TELLER AS BIGINT) AS "count", GEOniv FROM newcube""")
    ORACLES["l5_refresh"] = (f"SELECT 'validgeo' AS lookup, GEO AS code FROM ({ORACLES['l4_validgeo']}) a "
                             f"UNION ALL SELECT 'popinfo', GEO FROM ({ORACLES['l2_popinfo']}) b "
                             f"UNION ALL SELECT 'georecode', old FROM ({ORACLES['l1_codemap']}) c")
    four = ["GEO", "AAR", "KJONN", "ALDER"]
    held = lambda cube, flag, extra: (
        f"SELECT *, row_number() OVER (PARTITION BY {', '.join(four)} ORDER BY {extra}) AS rn, "
        f"count(*) OVER (PARTITION BY {', '.join(four)}) AS held FROM (SELECT *, CASE WHEN "
        + " OR ".join(f"{d} NOT IN (SELECT {d} FROM {'oldcube' if cube == 'newcube' else 'newcube'} WHERE GEOniv IS DISTINCT FROM 'V')" for d in four)
        + f" THEN 1 ELSE 0 END AS {flag} FROM {cube} WHERE GEOniv IS DISTINCT FROM 'V') z")
    first = lambda cols: ", ".join(f"{o.q(c)} ASC NULLS FIRST" for c in cols)
    fm_new = "fm_new AS (" + held("newcube", "newrow", first([*o.VALS, "GEOniv", "WEIGHTS", "newrow"])) + ")"
    fm_old = "fm_old AS (" + held("oldcube", "exprow", first(["exprow", *o.VALS])) + ")"
    keys = ", ".join(f"coalesce(n.{d}, o.{d}) AS {d}" for d in four)
    vals = ", ".join(f"n.{o.q(v)} AS {o.q(v + '_new')}, o.{o.q(v)} AS {o.q(v + '_old')}" for v in o.VALS)
    on = " AND ".join(f"n.{d} IS NOT DISTINCT FROM o.{d}" for d in four)
    cc = (f"fm_cc AS (SELECT n.GEOniv, n.newrow, {keys}, {vals} FROM (SELECT * FROM fm_new WHERE rn = 1) n "
          f"FULL OUTER JOIN (SELECT * FROM fm_old WHERE rn = 1 AND exprow = 0) o ON {on})")
    ORACLES["c1_first_match"] = W(fm_new, fm_old, cc, select=o._diffs_select("fm_cc"))
    ORACLES["c1_dropped_rows"] = W(fm_new, fm_old, select=f"""
      SELECT DISTINCT {', '.join(four)}, 'new' AS side, held - 1 AS n_dropped FROM fm_new WHERE held > 1
      UNION ALL SELECT DISTINCT {', '.join(four)}, 'old', held - 1 FROM fm_old WHERE held > 1""")
    ORACLES["c1_duplicate_keys"] = W(select="""
      SELECT GEO, AAR, KJONN, ALDER, count(*) AS n FROM newcube GROUP BY ALL HAVING count(*) > 1""")


_sources()


def _strategies():
    f = "MIN, wq25, wq50, wq75, MAX, LOW, HIGH"
    cf = ", ".join("change_" + x.strip() for x in f.split(","))
    ORACLES["w2_weighted_fences_range"] = W(*o.C1_CTES, select=f"""
      SELECT DISTINCT GEOniv, KJONN, ALDER, INNVKAT, UTDANN, {f}, {cf} FROM c1_newflag""")


_strategies()

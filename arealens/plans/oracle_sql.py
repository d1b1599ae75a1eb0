"""DuckDB SQL building blocks for the oracles.

The fixture views are inlined as CTEs (the driver registers only the base
tables).  Helpers produce SQL text for the recurring steps (roll-up, rolling
mean, intervals) straight from their formulas; they share nothing with the
Spark implementation except the formulas themselves.
"""

from __future__ import annotations

FX = {
    "fx_area": """
SELECT c_custkey AS datazone,
       'S12' || lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS ca,
       'S08' || lpad(CAST(n_regionkey AS VARCHAR), 6, '0') AS hb,
       'S00000001' AS scotland
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "fx_prepared": """
SELECT CAST(year(o_orderdate) AS INT) AS year, o_custkey AS datazone,
       CAST(1 + o_orderkey % 2 AS INT) AS sex_grp,
       CAST(least(floor((o_orderkey * 7 % 101) / 5) + 1, 19) AS INT) AS age_grp,
       CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS DOUBLE) AS numerator,
       CAST(count(*) AS DOUBLE) AS denominator
FROM orders GROUP BY 1, 2, 3, 4""",
    "fx_counts": """
SELECT code, count(*) AS n FROM (SELECT ca AS code FROM fx_area UNION ALL SELECT hb FROM fx_area
                                  UNION ALL SELECT scotland FROM fx_area) GROUP BY 1""",
    "fx_population": """
SELECT y.year, a.code, s.sex_grp, g.age_grp, CAST(40 * a.n AS DOUBLE) AS denominator
FROM fx_counts a,
     (SELECT DISTINCT year FROM fx_prepared) y,
     (SELECT DISTINCT sex_grp FROM fx_prepared) s,
     (SELECT DISTINCT age_grp FROM fx_prepared) g""",
    "fx_population_total": """
SELECT y.year, a.code, CAST(20 * a.n AS DOUBLE) AS denominator
FROM fx_counts a, (SELECT DISTINCT year FROM fx_prepared) y""",
    "fx_episode": """
SELECT user_id AS link_no, CAST(CAST(ts AS DATE) AS VARCHAR) AS cis_marker, event_id AS uri,
       CAST(ts AS DATE) AS admission_date,
       CAST(ts AS DATE) + CAST(floor(value / 60) AS INT) AS discharge_date,
       CAST((user_id * 13) % 101 AS INT) AS age, CAST(1 + user_id % 2 AS INT) AS sex_grp,
       CAST(user_id % 27 AS INT) AS pc7,
       CASE event_type WHEN 'purchase' THEN 'C34' WHEN 'error' THEN 'I21' WHEN 'click' THEN 'J44'
            WHEN 'view' THEN 'K25' ELSE 'F10' END || CAST(event_id % 10 AS VARCHAR) AS main_condition,
       event_type
FROM events""",
    "fx_postcode": """
SELECT n_nationkey AS pc7,
       'S12' || lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS ca,
       'S08' || lpad(CAST(n_regionkey AS VARCHAR), 6, '0') AS hb
FROM nation""",
}

DIAG_STEMS = ["C34", "I21", "J44", "K25", "F10", "X85", "Y09", "W01"]


def _other_condition(k: int) -> str:
    stems = ", ".join(f"'{s}'" for s in DIAG_STEMS)
    return (f"[{stems}][CAST((uri * {k + 2} + {k}) % {len(DIAG_STEMS)} AS INT) + 1] "
            f"|| CAST((uri + {k}) % 10 AS VARCHAR) AS other_condition_{k}")


FX["fx_episode_wide"] = ("SELECT *, " + ", ".join(_other_condition(k) for k in range(1, 6))
                         + " FROM fx_episode")

FX["fx_simd"] = """
SELECT datazone, pop, simd_rank, ca, hb,
       CASE WHEN 5*cum <= tot THEN 1 WHEN 5*cum <= 2*tot THEN 2 WHEN 5*cum <= 3*tot THEN 3
            WHEN 5*cum <= 4*tot THEN 4 ELSE 5 END AS sc_quin,
       CASE WHEN 5*cum_hb <= tot_hb THEN 1 WHEN 5*cum_hb <= 2*tot_hb THEN 2 WHEN 5*cum_hb <= 3*tot_hb THEN 3
            WHEN 5*cum_hb <= 4*tot_hb THEN 4 ELSE 5 END AS hb_quin,
       CASE WHEN 5*cum_ca <= tot_ca THEN 1 WHEN 5*cum_ca <= 2*tot_ca THEN 2 WHEN 5*cum_ca <= 3*tot_ca THEN 3
            WHEN 5*cum_ca <= 4*tot_ca THEN 4 ELSE 5 END AS ca_quin
FROM (SELECT *, sum(pop) OVER (ORDER BY simd_rank) AS cum, sum(pop) OVER () AS tot,
             sum(pop) OVER (PARTITION BY hb ORDER BY simd_rank) AS cum_hb, sum(pop) OVER (PARTITION BY hb) AS tot_hb,
             sum(pop) OVER (PARTITION BY ca ORDER BY simd_rank) AS cum_ca, sum(pop) OVER (PARTITION BY ca) AS tot_ca
      FROM (SELECT a.datazone, 100 + a.datazone % 400 AS pop, a.ca, a.hb,
                   row_number() OVER (ORDER BY c_acctbal, c_custkey) AS simd_rank
            FROM customer JOIN fx_area a ON c_custkey = a.datazone))"""
FX["fx_depr_lookup"] = """
SELECT s.datazone, y.year, s.pop, s.ca, s.hb, s.sc_quin, s.hb_quin, s.ca_quin
FROM fx_simd s, (SELECT DISTINCT year FROM fx_prepared) y"""
QUINT_SCHEMES = [("'S00000001'", "sc_quin"), ("hb", "sc_quin"), ("hb", "hb_quin"),
                 ("ca", "sc_quin"), ("ca", "ca_quin")]


def quintile_rollup_sql(src: str, keys, measures, totals: bool = True) -> str:
    """Five (area, quintile scheme) roll-ups, plus Total rows, nulls dropped after totals."""
    k = ", ".join(keys)
    m = ", ".join(measures)
    union = " UNION ALL ".join(
        f"SELECT {a} AS code, CAST({q} AS VARCHAR) AS quintile, '{q}' AS quint_type, {k}, {m} FROM {src}"
        for a, q in QUINT_SCHEMES)
    aggs = ", ".join(f"CAST(coalesce(sum({x}), 0) AS DOUBLE) AS {x}" for x in measures)
    det = f"SELECT code, quint_type, {k}, quintile, {aggs} FROM ({union}) GROUP BY code, quint_type, {k}, quintile"
    if not totals:
        return f"SELECT * FROM ({det}) WHERE code IS NOT NULL AND quintile IS NOT NULL"
    tot = (f"SELECT code, quint_type, {k}, 'Total' AS quintile, {aggs} FROM ({union}) "
           f"GROUP BY code, quint_type, {k}")
    return f"SELECT * FROM ({det} UNION ALL {tot}) WHERE code IS NOT NULL AND quintile IS NOT NULL"


FX["fx_depr_population"] = (
    "SELECT code, quint_type, year, quintile, denominator FROM ("
    + quintile_rollup_sql("(SELECT year, ca, hb, sc_quin, hb_quin, ca_quin, CAST(pop AS DOUBLE) AS denominator "
                          "FROM fx_depr_lookup)", ["year"], ["denominator"]) + ")")

ORDER = ["fx_area", "fx_prepared", "fx_counts", "fx_population", "fx_population_total",
         "fx_episode", "fx_episode_wide", "fx_postcode", "fx_simd", "fx_depr_lookup",
         "fx_depr_population"]


def with_fx(*ctes: tuple[str, str], body: str) -> str:
    """``WITH <fixtures>, <ctes> <body>``."""
    parts = [f"{name} AS ({FX[name]})" for name in ORDER]
    parts += [f"{name} AS ({sql})" for name, sql in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


def r6(expr: str, alias: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) AS {alias}"


def rollup_sql(src: str, levels, keys, measures=("numerator", "denominator")) -> str:
    """Sum ``measures`` of ``src`` into each level column as ``code``."""
    k = ", ".join(keys)
    sel = ", ".join(measures)
    union = "\nUNION ALL\n".join(f"SELECT {lvl} AS code, {k}, {sel} FROM {src}" for lvl in levels)
    aggs = ", ".join(f"CAST(coalesce(sum({m}), 0) AS DOUBLE) AS {m}" for m in measures)
    return f"SELECT code, {k}, {aggs} FROM ({union}) GROUP BY code, {k}"


def rolling_sql(src: str, part, n: int, cols=("numerator", "denominator"),
                required: str = "denominator", shift: int = 0, other=()) -> str:
    p = ", ".join(part)
    win = f"(PARTITION BY {p} ORDER BY year ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    exprs = [f"CASE WHEN count({c}) OVER {win} = {n} THEN avg({c}) OVER {win} END AS {c}" for c in cols]
    keep = [c for c in part] + list(other)
    inner = f"SELECT {', '.join(keep)}, year, {', '.join(exprs)} FROM {src}"
    return (f"SELECT {', '.join(keep)}, CAST(year - {shift} AS INT) AS year, {', '.join(cols)} "
            f"FROM ({inner}) WHERE {required} IS NOT NULL")


def time_fix(n: int) -> int:
    return 0 if n < 3 else (1 if n == 3 else 2)


def nz(x: str) -> str:
    """NaN/NULL -> 0 in DuckDB."""
    return f"coalesce(CASE WHEN isnan({x}) THEN NULL ELSE {x} END, 0)"


def nonan(x: str) -> str:
    return f"(CASE WHEN isnan({x}) THEN NULL ELSE {x} END)"


def percent_sql(n: str = "numerator", d: str = "denominator", round_ci: bool = True) -> str:
    """rate, lowci, upci (Wilson, clamped) as select expressions."""
    rate = f"({n} / nullif({d}, 0) * 100)"
    root = f"sqrt(1.96*1.96 + 4*{n}*(1 - {rate}/100))"
    den = f"(2*({d} + 1.96*1.96))"
    low = nonan(f"((2*{n} + 1.96*1.96 - 1.96*{root}) / nullif({den}, 0) * 100)")
    up = nonan(f"((2*{n} + 1.96*1.96 + 1.96*{root}) / nullif({den}, 0) * 100)")
    lr = f"round_even({low}, 2)" if round_ci else low
    ur = f"round_even({up}, 2)" if round_ci else up
    return (f"{rate} AS rate, CASE WHEN {low} < 0 THEN 0 ELSE {lr} END AS lowci, "
            f"CASE WHEN {up} > 100 THEN 100 ELSE {ur} END AS upci")


def byar_lower(n: str) -> str:
    return f"({n} * pow(1 - 1/nullif(9*{n}, 0) - 1.96/nullif(3*sqrt({n}), 0), 3))"


def byar_upper(n: str) -> str:
    return f"(({n} + 1) * pow(1 - 1/(9*({n} + 1)) + 1.96/(3*sqrt({n} + 1)), 3))"


def crude_sql(k: float, n: str = "numerator", d: str = "denominator") -> str:
    return (f"{n} / nullif({d}, 0) * {k} AS rate, {byar_lower(n)} / nullif({d}, 0) * {k} AS lowci, "
            f"{byar_upper(n)} / nullif({d}, 0) * {k} AS upci")


def finalise_sql(src: str, extra: str = "") -> str:
    """rate/lowci/upci null/NaN -> 0, lowci < 0 -> 0."""
    return (f"SELECT * REPLACE ({nz('rate')} AS rate, "
            f"CASE WHEN {nz('lowci')} < 0 THEN 0 ELSE {nz('lowci')} END AS lowci, "
            f"{nz('upci')} AS upci) FROM {src} {extra}")


def labels_sql(year_type: str, n: int, y: str = "year") -> str:
    """trend_axis, def_period expressions (reference layout, corrected 5-year opening)."""
    tf = time_fix(n)
    s = lambda e: f"CAST({e} AS VARCHAR)"
    yy = lambda e: f"substr(CAST({e} AS VARCHAR), 3, 2)"
    if "snapshot" in year_type:
        return f"{s(y)} AS trend_axis, {s(y)} || ' {year_type}' AS def_period"
    if year_type == "survey" or (year_type == "calendar" and tf == 0 and n != 2):
        return f"{s(y)} AS trend_axis, {s(y)} || ' {year_type} year' AS def_period"
    if year_type == "calendar" and n == 2:
        return (f"{s(y + '-1')} || '-' || {s(y)} AS trend_axis, "
                f"{s(y + '-1')} || ' to ' || {s(y)} || ' calendar years; 2-year aggregates' AS def_period")
    if year_type == "calendar":
        return (f"{s(f'{y}-{tf}')} || '-' || {s(f'{y}+{tf}')} AS trend_axis, "
                f"{s(f'{y}-{tf}')} || ' to ' || {s(f'{y}+{tf}')} || "
                f"' calendar years; {n}-year aggregates' AS def_period")
    if tf == 0 and n != 2:
        axis = f"{s(y)} || '/' || {yy(f'{y}+1')}"
        return f"{axis} AS trend_axis, {axis} || ' {year_type} year' AS def_period"
    if n == 2:
        first = f"{s(f'{y}-1')} || '/' || {yy(y)}"
        last = f"{s(y)} || '/' || {yy(f'{y}+1')}"
        return (f"{first} || '-' || {last} AS trend_axis, {first} || ' to ' || {last} || "
                f"' {year_type} years; 2-year aggregates' AS def_period")
    first = f"{s(f'{y}-{tf}')} || '/' || {yy(f'{y}-{tf}+1')}"
    last = f"{s(f'{y}+{tf}')} || '/' || {yy(f'{y}+{tf}+1')}"
    return (f"{first} || '-' || {last} AS trend_axis, {first} || ' to ' || {last} || "
            f"' {year_type} years; {n}-year aggregates' AS def_period")


INDICATOR_SELECT = ("code, CAST({ind} AS INT) AS ind_id, CAST(year AS INT) AS year, "
                    + r6("numerator", "numerator") + ", " + r6("rate", "rate") + ", "
                    + r6("lowci", "lowci") + ", " + r6("upci", "upci") + ", def_period, trend_axis")

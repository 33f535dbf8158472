"""DuckDB views over the given tables, inlined as common table expressions."""

VIEWS = {
    "smart_raw": """
SELECT CAST(l.l_shipdate AS DATE) AS date,
       printf('SN%08d', l.l_partkey) AS serial_number,
       p.p_type AS model,
       CASE WHEN p.p_size % 17 = 0 THEN NULL ELSE CAST(p.p_size AS BIGINT) * 400000000000 END AS capacity_bytes,
       CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' AND l.l_quantity >= 47 AND l.l_linenumber >= 4 THEN 1 ELSE 0 END AS failure,
       CASE WHEN l.l_linenumber = 7 THEN NULL WHEN l.l_quantity >= 45 THEN (CAST(l.l_quantity AS BIGINT) - 44) * 40 ELSE 0 END AS smart_5_raw,
       CAST(FLOOR(l.l_extendedprice) AS BIGINT) AS smart_9_raw,
       CASE WHEN CAST(l.l_quantity AS BIGINT) % 10 = 0 THEN NULL WHEN l.l_quantity >= 48 THEN CAST(l.l_quantity AS BIGINT) - 47 ELSE 0 END AS smart_187_raw,
       CAST(l.l_linenumber AS BIGINT) - 1 AS smart_188_raw,
       CASE WHEN l.l_quantity = 50 AND l.l_linenumber = 1 THEN 120 ELSE 20 + CAST(l.l_quantity AS BIGINT) % 30 END AS smart_194_raw,
       CASE WHEN l.l_returnflag = 'R' AND l.l_quantity >= 40 THEN (CAST(l.l_quantity AS BIGINT) - 39) * 8 ELSE 0 END AS smart_197_raw,
       CASE WHEN l.l_returnflag = 'R' AND l.l_quantity >= 45 THEN CAST(l.l_quantity AS BIGINT) - 44 ELSE 0 END AS smart_198_raw,
       l.l_suppkey % 5 AS smart_199_raw,
       CAST(l.l_quantity AS BIGINT) * 1000000 AS smart_241_raw,
       CAST(l.l_quantity AS BIGINT) * 2000000 AS smart_242_raw,
       l.l_orderkey, l.l_linenumber, l.l_suppkey
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "smart_daily": """
SELECT date, serial_number, model, capacity_bytes, failure, smart_5_raw, smart_9_raw, smart_187_raw, smart_188_raw, smart_194_raw, smart_197_raw, smart_198_raw, smart_199_raw, smart_241_raw, smart_242_raw
FROM (SELECT r.*, ROW_NUMBER() OVER (PARTITION BY date, serial_number ORDER BY l_orderkey, l_linenumber, l_suppkey, smart_9_raw) AS rn FROM smart_raw r) t WHERE rn = 1""",
    "smart_surv": """
SELECT * REPLACE (DATE '1992-01-01' + CAST((date_diff('day', DATE '1992-01-01', date) * (1 + CAST(substr(serial_number, 3) AS BIGINT) % 97)) // 97 AS INTEGER) AS date) FROM smart_daily""",
    "lives": """
SELECT serial_number, model, MIN(date) AS first_seen, MAX(date) AS last_seen,
       CAST(MAX(date) - MIN(date) + 1 AS INTEGER) AS lifetime_days, MAX(failure) AS failed
FROM smart_surv GROUP BY serial_number, model""",
    "engine": """
SELECT user_id AS engine_id,
       ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS cycle,
       value AS sensor_2, event_id % 100 + 0.5e0 AS sensor_3, 518.67e0 AS sensor_1,
       600e0 + 0.25e0 * ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) + value / 1000e0 AS sensor_4,
       550e0 - 0.10e0 * ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sensor_7
FROM events""",
    "rul": """
SELECT *, MAX(cycle) OVER (PARTITION BY engine_id) - cycle AS RUL FROM engine""",
}

NEEDS = {
    "smart_raw": [],
    "smart_daily": ["smart_raw"],
    "smart_surv": ["smart_raw", "smart_daily"],
    "lives": ["smart_raw", "smart_daily", "smart_surv"],
    "engine": [],
    "rul": ["engine"],
}


def over(view: str, query: str, recursive: bool = False) -> str:
    """``query`` with ``view`` and what it needs in front; the query may open with more CTEs."""
    ctes = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in [*NEEDS[view], view])
    head = "WITH RECURSIVE " if recursive else "WITH "
    body = query.strip()
    if body.upper().startswith("WITH "):
        return f"{head}{ctes},\n{body[5:]}"
    return f"{head}{ctes}\n{body}"


def half_up(value: str, places: int) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(28,10)), {places}) AS DOUBLE)"


def rate(part: str, whole: str, per: str = "100e0", places: int = 4) -> str:
    return half_up(f"{per} * {part} / {whole}", places)

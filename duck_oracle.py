"""DuckDB oracle SQL for every registered query.

Written independently of the Spark plans: timestamps are checked by a
parse/format round trip (``try_strptime`` + ``strftime``), uniqueness by a
window count, normalisation by parsing, so agreement is a real cross-check.
The landing fixtures are the same derivations as ``landfall.sources.fixtures``.
"""

from __future__ import annotations

LOAD_DT = "2022-09-11"
LOAD_TS = "2022-09-12 01:00:00"

# Violation texts of the reference.
MSG_NOT_NULL = "{c}列未通过[非空检查]"
MSG_INT = "{c}列未通过[数据格式校验-数值格式] errValue->"
MSG_TS = "{c}列未通过[数据格式校验-时间格式] errValue->"
MSG_ENUM = "{c}列未通过[枚举值检查] errValue->"
MSG_UNIQUE = "主键未通过[唯一性校验]"
MSG_MISALIGNED = "错行数据"

TS_V2 = ("%Y-%m-%d %H:%M:%S", "%m/%d/%Y %H:%M:%S", "%Y-%m-%d")
TS_V1 = ("%Y-%m-%d %H:%M:%S", "%Y/%m/%d %H:%M:%S", "%Y-%m-%d")

# (column, check, not_null, enum_range) as configured in the metadata fixture.
ORDER_RULES = [("order_id", "int", False, None), ("cust_id", "int", False, None),
               ("status", "", True, "F,O,P"), ("total_price", "", False, None),
               ("order_ts", "timestamp", False, None), ("priority", "", False, None)]
ORDER_KEYS = ["order_id"]
ORDER_PK_RULES = [("order_id", "int", False, None)]
LINEITEM_RULES = [("l_orderkey", "int", False, None), ("l_partkey", "int", False, None),
                  ("l_suppkey", "int", False, None), ("l_linenumber", "int", False, None),
                  ("l_quantity", "", False, None), ("l_extendedprice", "", False, None),
                  ("l_discount", "", False, None), ("l_tax", "", False, None),
                  ("l_returnflag", "", False, "A,N,R"), ("l_linestatus", "", False, "F,O"),
                  ("l_shipdate", "timestamp", False, None)]
LINEITEM_KEYS = ["l_orderkey", "l_linenumber"]
CUSTOMER_RULES = [("c_custkey", "int", False, None), ("c_name", "", True, None), ("c_nationkey", "int", False, None),
                  ("c_acctbal", "", False, None),
                  ("c_mktsegment", "", False, "AUTOMOBILE,BUILDING,FURNITURE,HOUSEHOLD,MACHINERY")]
CUSTOMER_KEYS = ["c_custkey"]
EVENT_RULES = [("event_id", "int", False, None), ("ts", "timestamp", False, None), ("user_id", "int", False, None),
               ("event_type", "", True, "click,view,error,purchase,signup"), ("value", "", False, None),
               ("props", "", False, None)]
EVENT_KEYS = ["event_id"]

ORDER_COLS = [r[0] for r in ORDER_RULES]


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --------------------------------------------------------------------------- landing fixtures

LANDED_ORDERS = f"""
lo_b AS (
  SELECT o_orderkey % 97 AS m, CAST(o_orderkey AS VARCHAR) AS k, CAST(o_custkey AS VARCHAR) AS cust,
         o_orderstatus AS st, CAST(o_totalprice AS VARCHAR) AS price, CAST(o_orderdate AS VARCHAR) AS ts,
         o_orderpriority AS prio
  FROM orders),
lo_d AS (
  SELECT CASE WHEN m = 8 THEN NULL ELSE k END AS order_id,
         CASE WHEN m = 8 THEN NULL WHEN m IN (3, 10) THEN concat('c', cust) ELSE cust END AS cust_id,
         CASE WHEN m = 8 THEN NULL WHEN m = 1 THEN '' WHEN m IN (2, 10) THEN 'X' ELSE st END AS status,
         CASE WHEN m IN (7, 8) THEN NULL ELSE price END AS total_price,
         CASE WHEN m = 8 THEN NULL
              WHEN m = 4 THEN concat(substr(ts, 6, 2), '/', substr(ts, 9, 2), '/', substr(ts, 1, 4), ' ', substr(ts, 12, 8))
              WHEN m = 5 THEN substr(ts, 1, 10)
              WHEN m = 6 THEN '2022-02-30'
              ELSE ts END AS order_ts,
         CASE WHEN m IN (7, 8) THEN NULL ELSE prio END AS priority,
         m
  FROM lo_b),
landed_orders AS (
  SELECT order_id, cust_id, status, total_price, order_ts, priority, '{LOAD_DT}' AS load_dt FROM lo_d
  UNION ALL
  SELECT order_id, cust_id, status, total_price, order_ts, priority, '{LOAD_DT}' AS load_dt FROM lo_d WHERE m = 9
  UNION ALL
  SELECT 'order_id', 'cust_id', 'status', 'total_price', 'order_ts', 'priority', '{LOAD_DT}')"""

LANDED_ORDERS_PK = f"""
landed_orders_pk AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, '{LOAD_DT}' AS load_dt FROM orders WHERE o_orderkey % 50 = 0)"""

LANDED_ORDERS_PK_DIRTY = f"""
landed_orders_pk_dirty AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, '{LOAD_DT}' AS load_dt FROM orders WHERE o_orderkey % 50 = 0
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), '{LOAD_DT}' FROM orders WHERE o_orderkey % 5000 = 0
  UNION ALL SELECT 'x1', '{LOAD_DT}'
  UNION ALL SELECT 'order_id', '{LOAD_DT}')"""

LANDED_LINEITEM = f"""
landed_lineitem AS (
  SELECT {", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c, *_ in LINEITEM_RULES)}, '{LOAD_DT}' AS load_dt
  FROM lineitem)"""

LANDED_CUSTOMER = f"""
landed_customer AS (
  SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
         CASE WHEN c_custkey % 53 = 1 THEN '' ELSE c_name END AS c_name,
         CASE WHEN c_custkey % 53 = 2 THEN concat('n', CAST(c_nationkey AS VARCHAR))
              ELSE CAST(c_nationkey AS VARCHAR) END AS c_nationkey,
         CAST(c_acctbal AS VARCHAR) AS c_acctbal,
         CASE WHEN c_custkey % 53 = 3 THEN lower(c_mktsegment) ELSE c_mktsegment END AS c_mktsegment,
         '{LOAD_DT}' AS load_dt
  FROM customer)"""

LANDED_EVENTS = f"""
landed_events AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         CASE WHEN event_id % 41 = 1 THEN strftime(ts, '%Y-%m-%d')
              WHEN event_id % 41 = 2 THEN strftime(ts, '%m/%d/%Y %H:%M:%S')
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts,
         CASE WHEN event_id % 41 = 4 THEN '-1' ELSE CAST(user_id AS VARCHAR) END AS user_id,
         CASE WHEN event_id % 41 = 3 THEN 'unknown' ELSE event_type END AS event_type,
         CAST(value AS VARCHAR) AS value,
         props,
         '{LOAD_DT}' AS load_dt
  FROM events)"""


# --------------------------------------------------------------------------- checks

def present(c: str) -> str:
    return f"({c} IS NOT NULL AND {c} <> '')"


def ts_ok(c: str, formats=TS_V2) -> str:
    return "(" + " OR ".join(f"coalesce(strftime(try_strptime({c}, '{f}'), '{f}') = {c}, false)"
                             for f in formats) + ")"


def ts_out(c: str) -> str:
    """v2 rewrite of a passing timestamp value."""
    return (f"CASE WHEN {present(c)} AND {ts_ok(c)} THEN "
            f"(CASE WHEN length({c}) = 10 THEN {c} || ' 00:00:00' "
            f"WHEN {c} LIKE '%/%' THEN strftime(strptime({c}, '%m/%d/%Y %H:%M:%S'), '%Y-%m-%d %H:%M:%S') "
            f"ELSE {c} END) ELSE {c} END")


def date_out(c: str) -> str:
    return (f"CASE WHEN {present(c)} AND {ts_ok(c)} AND {c} LIKE '%/%' "
            f"THEN strftime(strptime({c}, '%m/%d/%Y %H:%M:%S'), '%Y-%m-%d %H:%M:%S') ELSE {c} END")


def msg(c: str, check: str, profile: str = "v2", enum_range: str | None = None) -> str:
    if check == "not_null":
        blank = f"({c} IS NULL OR {c} = '')" if profile == "v1" else f"{c} = ''"
        return f"CASE WHEN {blank} THEN {_q(MSG_NOT_NULL.format(c=c))} END"
    if check == "int":
        return f"CASE WHEN {present(c)} AND NOT regexp_full_match({c}, '[0-9]*') THEN {_q(MSG_INT.format(c=c))} || {c} END"
    if check in ("timestamp", "date"):
        fmts = TS_V1 if profile == "v1" else TS_V2
        return f"CASE WHEN {present(c)} AND NOT {ts_ok(c, fmts)} THEN {_q(MSG_TS.format(c=c))} || {c} END"
    if check == "enum":
        members = ", ".join(_q(x) for x in enum_range.split(","))
        return (f"CASE WHEN {present(c)} AND {c} NOT IN ({members}) "
                f"THEN {_q(MSG_ENUM.format(c=c))} || {c} || {_q(',range->' + enum_range)} END")
    raise ValueError(check)


def header_filtered(src: str, cols) -> str:
    cond = " AND ".join(f"{c} IS NOT DISTINCT FROM {_q(c)}" for c in cols)
    return f"SELECT * FROM {src} WHERE NOT ({cond})"


def validated(src: str, rules, keys, profile: str = "v2") -> str:
    """Landing columns (normalised), load_dt, flag."""
    cols = [r[0] for r in rules]
    msgs = []
    for c, check, not_null, enum_range in rules:
        if not_null:
            msgs.append(msg(c, "not_null", profile))
        if check:
            msgs.append(msg(c, check, profile))
        if enum_range is not None:
            msgs.append(msg(c, "enum", profile, enum_range))
    if keys:
        msgs.append(f"CASE WHEN __n > 1 THEN {_q(MSG_UNIQUE)} END")
    if profile == "v2":
        msgs.append(f"CASE WHEN {' OR '.join(c + ' IS NULL' for c in cols)} THEN {_q(MSG_MISALIGNED)} END")
    outs = [(ts_out(c) if (check == "timestamp" and profile == "v2") else
             date_out(c) if (check == "date" and profile == "v2") else c) + f" AS {c}"
            for c, check, *_ in rules]
    n = f", count(*) OVER (PARTITION BY {', '.join(keys)}) AS __n" if keys else ""
    return (f"SELECT {', '.join(outs)}, load_dt, concat_ws('||', {', '.join(msgs)}) AS flag "
            f"FROM (SELECT *{n} FROM ({header_filtered(src, cols)}) h) x")


def any_value(cols) -> str:
    return f"coalesce({', '.join(cols)}) IS NOT NULL"


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def cte(name: str, body: str) -> str:
    return f"\n{name} AS ({body})"


# --------------------------------------------------------------------------- queries

def _orders_checks(checks_wanted, profile="v2") -> str:
    msgs = ", ".join(msg(c, k, profile, dict((r[0], r[3]) for r in ORDER_RULES).get(c)) for c, k in checks_wanted)
    return (with_(LANDED_ORDERS, cte("hf", header_filtered("landed_orders", ORDER_COLS)))
            + f"SELECT * FROM (SELECT {', '.join(ORDER_COLS)}, concat_ws('||', {msgs}) AS violation FROM hf) "
              f"WHERE violation <> ''")


def _orders_v(profile="v2") -> str:
    return with_(LANDED_ORDERS, cte("v", validated("landed_orders", ORDER_RULES, ORDER_KEYS, profile)))


def _typed_orders(stg_pk_src: str) -> str:
    """ODS rows of the orders file (clean rows, hard-delete flag, casts, audit columns)."""
    return (with_(LANDED_ORDERS, LANDED_ORDERS_PK,
                  cte("v", validated("landed_orders", ORDER_RULES, ORDER_KEYS)),
                  cte("pv", validated(stg_pk_src, ORDER_PK_RULES, ORDER_KEYS)),
                  cte("stg", f"SELECT {', '.join(ORDER_COLS)} FROM v WHERE flag = ''"),
                  cte("pk", "SELECT DISTINCT order_id FROM pv WHERE flag = ''"))
            + f"""SELECT TRY_CAST(s.order_id AS BIGINT) AS order_id, TRY_CAST(s.cust_id AS BIGINT) AS cust_id,
       s.status, TRY_CAST(s.total_price AS DECIMAL(20,4)) AS total_price,
       TRY_CAST(s.order_ts AS TIMESTAMP) AS order_ts, s.priority,
       CAST(CASE WHEN p.order_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS etl_is_hard_del,
       TIMESTAMP '{LOAD_TS}' AS etl_created_ts, TIMESTAMP '{LOAD_TS}' AS etl_modified_ts, '{LOAD_DT}' AS load_dt
FROM stg s LEFT JOIN pk p ON s.order_id = p.order_id""")


def _customer_v() -> str:
    return with_(LANDED_CUSTOMER, cte("v", validated("landed_customer", CUSTOMER_RULES, CUSTOMER_KEYS)))


def _events_v() -> str:
    return with_(LANDED_EVENTS, cte("v", validated("landed_events", EVENT_RULES, EVENT_KEYS)))


CUSTOMER_COLS = [r[0] for r in CUSTOMER_RULES]
EVENT_COLS = [r[0] for r in EVENT_RULES]

ODS_CUSTOMER = (_customer_v() + f"""SELECT TRY_CAST(c_custkey AS BIGINT) AS c_custkey, c_name,
       TRY_CAST(c_nationkey AS INTEGER) AS c_nationkey, TRY_CAST(c_acctbal AS DOUBLE) AS c_acctbal, c_mktsegment,
       CAST(0 AS INTEGER) AS etl_is_hard_del, TIMESTAMP '{LOAD_TS}' AS etl_created_ts,
       TIMESTAMP '{LOAD_TS}' AS etl_modified_ts, '{LOAD_DT}' AS load_dt
FROM v WHERE flag = ''""")

ODS_EVENTS = (_events_v() + f"""SELECT TRY_CAST(event_id AS BIGINT) AS event_id, TRY_CAST(ts AS TIMESTAMP) AS ts,
       TRY_CAST(user_id AS INTEGER) AS user_id, TRY_CAST(value AS DOUBLE) AS value, props,
       CAST(0 AS INTEGER) AS etl_is_hard_del, TIMESTAMP '{LOAD_TS}' AS etl_created_ts,
       TIMESTAMP '{LOAD_TS}' AS etl_modified_ts, '{LOAD_DT}' AS load_dt, event_type
FROM v WHERE flag = ''""")

HF = with_(LANDED_ORDERS, cte("hf", header_filtered("landed_orders", ORDER_COLS)))
OC = ", ".join(ORDER_COLS)


def _multi_table() -> str:
    ctes = [LANDED_ORDERS, LANDED_ORDERS_PK, LANDED_CUSTOMER, LANDED_EVENTS,
            cte("vo", validated("landed_orders", ORDER_RULES, ORDER_KEYS)),
            cte("pv", validated("landed_orders_pk", ORDER_PK_RULES, ORDER_KEYS)),
            cte("vc", validated("landed_customer", CUSTOMER_RULES, CUSTOMER_KEYS)),
            cte("ve", validated("landed_events", EVENT_RULES, EVENT_KEYS))]
    parts = []
    for name, v, cols in (("ORDERS", "vo", ORDER_COLS), ("CUSTOMER", "vc", CUSTOMER_COLS),
                          ("EVENTS", "ve", EVENT_COLS)):
        parts.append(f"SELECT '{name}' AS file_name, 'stg' AS layer, count(*) AS row_count FROM {v} WHERE flag = ''")
        parts.append(f"SELECT '{name}', 'rej', count(*) FROM {v} WHERE flag <> '' AND {any_value(cols)}")
        parts.append(f"SELECT '{name}', 'ods', count(*) FROM {v} WHERE flag = ''")
    parts.append("SELECT 'ORDERS', 'ods_hard_deleted', count(*) FROM vo WHERE flag = '' AND order_id IN "
                 "(SELECT order_id FROM pv WHERE flag = '')")
    parts.append("SELECT 'CUSTOMER', 'ods_hard_deleted', count(*) FROM vc WHERE false")
    parts.append("SELECT 'EVENTS', 'ods_hard_deleted', count(*) FROM ve WHERE false")
    return with_(*ctes) + "\nUNION ALL\n".join(parts)


LANDED_ORDERS_CSV = f"""
landed_orders_csv AS (
  SELECT {", ".join(f"coalesce({c}, '') AS {c}" for c in ORDER_COLS)}, load_dt FROM landed_orders)"""


def _typed_orders_from_csv() -> str:
    """ODS of orders after a CSV round trip: every null field reads back as ''."""
    return (with_(LANDED_ORDERS, LANDED_ORDERS_PK, LANDED_ORDERS_CSV,
                  cte("v", validated("landed_orders_csv", ORDER_RULES, ORDER_KEYS)),
                  cte("pv", validated("landed_orders_pk", ORDER_PK_RULES, ORDER_KEYS)),
                  cte("stg", f"SELECT {', '.join(ORDER_COLS)} FROM v WHERE flag = ''"),
                  cte("pk", "SELECT DISTINCT order_id FROM pv WHERE flag = ''"))
            + f"""SELECT TRY_CAST(s.order_id AS BIGINT) AS order_id, TRY_CAST(s.cust_id AS BIGINT) AS cust_id,
       s.status, TRY_CAST(s.total_price AS DECIMAL(20,4)) AS total_price,
       TRY_CAST(s.order_ts AS TIMESTAMP) AS order_ts, s.priority,
       CAST(CASE WHEN p.order_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS etl_is_hard_del,
       TIMESTAMP '{LOAD_TS}' AS etl_created_ts, TIMESTAMP '{LOAD_TS}' AS etl_modified_ts, '{LOAD_DT}' AS load_dt
FROM stg s LEFT JOIN pk p ON s.order_id = p.order_id""")


ODS_LINEITEM = (with_(LANDED_LINEITEM, cte("v", validated("landed_lineitem", LINEITEM_RULES, LINEITEM_KEYS)))
                + f"""SELECT TRY_CAST(l_orderkey AS BIGINT) AS l_orderkey, TRY_CAST(l_partkey AS BIGINT) AS l_partkey,
       TRY_CAST(l_suppkey AS BIGINT) AS l_suppkey, TRY_CAST(l_linenumber AS INTEGER) AS l_linenumber,
       TRY_CAST(l_quantity AS DOUBLE) AS l_quantity, TRY_CAST(l_extendedprice AS DECIMAL(20,4)) AS l_extendedprice,
       TRY_CAST(l_discount AS DOUBLE) AS l_discount, TRY_CAST(l_tax AS DECIMAL(20,4)) AS l_tax,
       l_returnflag, l_linestatus, TRY_CAST(l_shipdate AS TIMESTAMP) AS l_shipdate,
       CAST(0 AS INTEGER) AS etl_is_hard_del, TIMESTAMP '{LOAD_TS}' AS etl_created_ts,
       TIMESTAMP '{LOAD_TS}' AS etl_modified_ts, '{LOAD_DT}' AS load_dt
FROM v WHERE flag = ''""")


def _castable() -> str:
    """Present values of the typed columns that do not cast."""
    types = (("order_id", "BIGINT"), ("cust_id", "BIGINT"), ("total_price", "DECIMAL(20,4)"), ("order_ts", "TIMESTAMP"))
    return _orders_v() + " UNION ALL ".join(
        f"SELECT order_id, '{c}' AS column_name, {c} AS value FROM v WHERE {c} <> '' AND TRY_CAST({c} AS {t}) IS NULL"
        for c, t in types)


def _violation_summary() -> str:
    """Counts by the text of the flag."""
    told = [(c, check, text.format(c=c)) for c, check, text in (
        ("status", "not_null", MSG_NOT_NULL), ("order_id", "int", MSG_INT), ("cust_id", "int", MSG_INT),
        ("order_ts", "timestamp", MSG_TS), ("status", "enum", MSG_ENUM))]
    told += [(None, "unique", MSG_UNIQUE), (None, "misaligned", MSG_MISALIGNED)]
    each = " UNION ALL ".join(
        f"SELECT {_q(c) if c else 'CAST(NULL AS VARCHAR)'} AS column_name, '{k}' AS check_name, "
        f"count(*) AS violation_count FROM v WHERE contains(flag, {_q(m)})" for c, k, m in told)
    return _orders_v() + f"SELECT * FROM ({each}) x WHERE violation_count > 0"


def _ods_added_field() -> str:
    """The date before the field: validated without it, null in the table; the date after: as always."""
    cols = ", ".join(c for c in ORDER_COLS if c != "priority")
    rules = [r for r in ORDER_RULES if r[0] != "priority"]
    earlier = (with_(LANDED_ORDERS, LANDED_ORDERS_PK, cte("v", validated(f"(SELECT {cols}, load_dt FROM landed_orders)", rules, ORDER_KEYS)),
                     cte("pv", validated("landed_orders_pk", ORDER_PK_RULES, ORDER_KEYS)),
                     cte("stg", f"SELECT {cols} FROM v WHERE flag = ''"),
                     cte("pk", "SELECT DISTINCT order_id FROM pv WHERE flag = ''"))
               + f"""SELECT TRY_CAST(s.order_id AS BIGINT) AS order_id, TRY_CAST(s.cust_id AS BIGINT) AS cust_id,
       s.status, TRY_CAST(s.total_price AS DECIMAL(20,4)) AS total_price,
       TRY_CAST(s.order_ts AS TIMESTAMP) AS order_ts, CAST(NULL AS VARCHAR) AS priority,
       CAST(CASE WHEN p.order_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS etl_is_hard_del,
       TIMESTAMP '{LOAD_TS}' AS etl_created_ts, TIMESTAMP '{LOAD_TS}' AS etl_modified_ts, '2022-09-10' AS load_dt
FROM stg s LEFT JOIN pk p ON s.order_id = p.order_id""")
    return f"SELECT * FROM ({earlier}) e UNION ALL BY NAME SELECT * FROM ({_typed_orders('landed_orders_pk')}) x"


def _load_ledger() -> str:
    """Audit counts of each file; stages done (the orders file has a key feed too) and failed (one, of the events file)."""
    parts = []
    for name, v, cols, done, failed in (("ORDERS", "vo", ORDER_COLS, 3, 0), ("CUSTOMER", "vc", CUSTOMER_COLS, 2, 0),
                                        ("EVENTS", "ve", EVENT_COLS, 2, 1)):
        parts.append(f"""SELECT '{LOAD_DT}' AS load_dt, '{name}' AS file_name, CAST({done} AS BIGINT) AS done,
       CAST({failed} AS BIGINT) AS failed, count(*) AS total, CAST(count_if(flag = '') AS BIGINT) AS clean,
       CAST(count_if(flag <> '' AND {any_value(cols)}) AS BIGINT) AS rejected,
       CAST(count_if(flag <> '' AND NOT ({any_value(cols)})) AS BIGINT) AS blank FROM {v}""")
    return with_(LANDED_ORDERS, LANDED_CUSTOMER, LANDED_EVENTS, cte("vo", validated("landed_orders", ORDER_RULES, ORDER_KEYS)),
                 cte("vc", validated("landed_customer", CUSTOMER_RULES, CUSTOMER_KEYS)),
                 cte("ve", validated("landed_events", EVENT_RULES, EVENT_KEYS))) + "\nUNION ALL\n".join(parts)


CSV_LINES = """
SELECT CASE WHEN m = 3 THEN NULL WHEN m = 4 THEN '  ' ELSE k END AS order_id,
       CASE m WHEN 0 THEN c WHEN 1 THEN 'x"y,z' WHEN 2 THEN c WHEN 5 THEN '' END AS cust_id,
       CASE WHEN m IN (0, 2, 5) THEN st END AS status,
       CASE m WHEN 0 THEN 'a,b' WHEN 2 THEN '' WHEN 5 THEN '' END AS note, '2022-09-11' AS load_dt
FROM (SELECT o_orderkey % 6 AS m, CAST(o_orderkey AS VARCHAR) AS k, CAST(o_custkey AS VARCHAR) AS c,
             o_orderstatus AS st FROM orders) o"""


def oracle_sql() -> dict[str, str]:
    clean = lambda v, cols: f"SELECT {', '.join(cols)} FROM {v} WHERE flag = ''"
    return {
        "dq_header_filter": HF + "SELECT * FROM hf",
        "dq_misaligned": HF + f"SELECT {OC}, {_q(MSG_MISALIGNED)} AS violation FROM hf "
                              f"WHERE {' OR '.join(c + ' IS NULL' for c in ORDER_COLS)}",
        "dq_not_null": _orders_checks([("status", "not_null")]),
        "dq_not_null_v1": _orders_checks([("status", "not_null")], "v1"),
        "dq_integer": _orders_checks([("order_id", "int"), ("cust_id", "int")]),
        "dq_timestamp": _orders_checks([("order_ts", "timestamp")]),
        "dq_timestamp_v1": _orders_checks([("order_ts", "timestamp")], "v1"),
        "dq_date": HF + f"SELECT order_id, order_ts AS order_ts_raw, {date_out('order_ts')} AS order_ts, "
                        f"{msg('order_ts', 'date')} AS violation FROM hf",
        "dq_enum": _orders_checks([("status", "enum")]),
        "dq_normalise_ts": HF + f"SELECT order_id, order_ts AS order_ts_raw, {ts_out('order_ts')} AS order_ts FROM hf",
        "dq_duplicate_keys": HF + "SELECT order_id, count(*) AS dup_count FROM hf GROUP BY order_id HAVING count(*) > 1",
        "dq_unique": with_(LANDED_LINEITEM, cte("v", validated("landed_lineitem", LINEITEM_RULES, LINEITEM_KEYS)))
                     + "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, flag FROM v WHERE flag <> ''",
        "dq_flag": _orders_v() + "SELECT * FROM v",
        "dq_castable": _castable(),
        "violation_summary": _violation_summary(),
        "split_clean": _orders_v() + clean("v", ORDER_COLS),
        "split_reject": _orders_v() + f"SELECT {OC}, flag FROM v WHERE flag <> '' AND {any_value(ORDER_COLS)}",
        "split_reject_v1": _orders_v("v1") + f"SELECT {OC}, flag FROM v WHERE flag <> ''",
        "split_blank": _orders_v() + f"SELECT {OC}, flag FROM v WHERE flag <> '' AND NOT ({any_value(ORDER_COLS)})",
        "load_audit": _orders_v() + f"""SELECT CAST(count(*) AS BIGINT) AS total,
       CAST(count_if(flag = '') AS BIGINT) AS clean,
       CAST(count_if(flag <> '' AND {any_value(ORDER_COLS)}) AS BIGINT) AS rejected,
       CAST(count_if(flag <> '' AND NOT ({any_value(ORDER_COLS)})) AS BIGINT) AS blank FROM v""",
        "ods_hard_delete": with_(LANDED_ORDERS, LANDED_ORDERS_PK,
                                 cte("v", validated("landed_orders", ORDER_RULES, ORDER_KEYS)),
                                 cte("pv", validated("landed_orders_pk", ORDER_PK_RULES, ORDER_KEYS)))
                           + f"""SELECT s.*, CAST(CASE WHEN p.order_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS etl_is_hard_del
FROM ({clean('v', ORDER_COLS)}) s LEFT JOIN (SELECT DISTINCT order_id FROM pv WHERE flag = '') p
ON s.order_id = p.order_id""",
        "ods_no_delete_feed": _customer_v() + f"SELECT {', '.join(CUSTOMER_COLS)}, CAST(0 AS INTEGER) AS etl_is_hard_del "
                                              f"FROM v WHERE flag = ''",
        "ods_conform": _typed_orders("landed_orders_pk"),
        "ods_load_delta": f"SELECT x.* REPLACE (d.load_dt AS load_dt) FROM ({_typed_orders('landed_orders_pk')}) x, "
                          f"(VALUES ('2022-09-10'), ('{LOAD_DT}')) d(load_dt)",
        "ods_load_full": ODS_CUSTOMER,
        "ods_load_by_key": ODS_EVENTS,
        "sink_static_overwrite": _orders_v() + clean("v", ORDER_COLS),
        "src_csv_landing": with_(LANDED_ORDERS) + "SELECT "
                           + ", ".join(f"coalesce({c}, '') AS {c}" for c in ORDER_COLS) + ", load_dt FROM landed_orders",
        "src_csv_lines": CSV_LINES,
        "src_partition_read": with_(LANDED_ORDERS) + "SELECT * FROM landed_orders",
        "e2e_orders": _typed_orders("landed_orders_pk"),
        "e2e_pk_feed": with_(LANDED_ORDERS_PK_DIRTY,
                             cte("pv", validated("landed_orders_pk_dirty", ORDER_PK_RULES, ORDER_KEYS)))
                       + "SELECT order_id, flag FROM pv WHERE flag = '' "
                         "UNION ALL SELECT order_id, flag FROM pv WHERE flag <> '' AND order_id IS NOT NULL",
        "e2e_multi_table": _multi_table(),
        "e2e_v1_validate_only": _orders_v("v1") + f"SELECT {OC}, flag FROM v WHERE flag <> ''",
        "e2e_csv_landing": _typed_orders_from_csv(),
        "e2e_csv_table_landing": _typed_orders_from_csv(),
        "e2e_table_landing": ODS_EVENTS,
        "e2e_lineitem": ODS_LINEITEM,
        "sink_publish_layers": _orders_v() + f"SELECT 'stg' AS layer, {OC}, '' AS flag FROM v WHERE flag = '' UNION ALL "
                               f"SELECT 'rej', {OC}, flag FROM v WHERE flag <> '' AND {any_value(ORDER_COLS)}",
        "e2e_default_flags": _orders_v() + "SELECT layer, d.load_dt, row_count FROM (VALUES ('2022-09-10'), "
                             f"('{LOAD_DT}')) d(load_dt), (SELECT 'stg' AS layer, count(*) AS row_count FROM v WHERE flag = '' "
                             "UNION ALL SELECT 'ods', count(*) FROM v WHERE flag = '' UNION ALL "
                             f"SELECT 'rej', count(*) FROM v WHERE flag <> '' AND {any_value(ORDER_COLS)}) x",
        "ods_added_field": _ods_added_field(),
        "load_ledger": _load_ledger(),
        "ods_hard_delete_bucketed": _typed_orders("landed_orders_pk"),
        "e2e_csv_other_header": _typed_orders_from_csv(),
    }

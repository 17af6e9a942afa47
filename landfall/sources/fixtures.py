"""Landing data and metadata used by tests, the bench and ``__spark_entry__``.

Landing frames are *derived from the given tables* with DataFrame operations
(so they grow with the scale factor); the defects are injected by a modulus of
the source key. The same derivations are written as SQL in ``duck_oracle.py`` for
the DuckDB check. Metadata fixtures are small inline rows, as in production
where metadata is a few rows per file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD_DT = "2022-09-11"
ORDER_COLUMNS = ["order_id", "cust_id", "status", "total_price", "order_ts", "priority"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(c: str):
    return F.col(c).cast("string")


def landed_orders(spark: SparkSession, sf_dir: str, load_dt: str = LOAD_DT) -> DataFrame:
    """Dirty all-string landing copy of ``orders`` (defects by ``o_orderkey % 97``)."""
    o = _table(spark, sf_dir, "orders")
    b = o.select((F.col("o_orderkey") % 97).alias("m"), _s("o_orderkey").alias("k"), _s("o_custkey").alias("cust"),
                 F.col("o_orderstatus").alias("st"), _s("o_totalprice").alias("price"),
                 _s("o_orderdate").alias("ts"), F.col("o_orderpriority").alias("prio"))
    m, ts, null = F.col("m"), F.col("ts"), F.lit(None).cast("string")
    d = b.select(
        F.when(m == 8, null).otherwise(F.col("k")).alias("order_id"),
        F.when(m == 8, null).when(m.isin(3, 10), F.concat(F.lit("c"), F.col("cust"))).otherwise(F.col("cust"))
         .alias("cust_id"),
        F.when(m == 8, null).when(m == 1, F.lit("")).when(m.isin(2, 10), F.lit("X")).otherwise(F.col("st"))
         .alias("status"),
        F.when(m.isin(7, 8), null).otherwise(F.col("price")).alias("total_price"),
        F.when(m == 8, null)
         .when(m == 4, F.concat(F.substring(ts, 6, 2), F.lit("/"), F.substring(ts, 9, 2), F.lit("/"),
                                F.substring(ts, 1, 4), F.lit(" "), F.substring(ts, 12, 8)))
         .when(m == 5, F.substring(ts, 1, 10))
         .when(m == 6, F.lit("2022-02-30"))
         .otherwise(ts).alias("order_ts"),
        F.when(m.isin(7, 8), null).otherwise(F.col("prio")).alias("priority"),
        m)
    cols = ORDER_COLUMNS
    body = d.select(*cols, F.lit(load_dt).alias("load_dt"))
    again = d.where(m == 9).select(*cols, F.lit(load_dt).alias("load_dt"))
    return body.unionAll(again).unionAll(header_row(spark, cols, load_dt))


def header_row(spark: SparkSession, columns, load_dt: str = LOAD_DT) -> DataFrame:
    """A stray header line inside the data (DQ-1 must drop it)."""
    return spark.range(1).select(*[F.lit(c).alias(c) for c in columns], F.lit(load_dt).alias("load_dt"))


def landed_orders_pk(spark: SparkSession, sf_dir: str, load_dt: str = LOAD_DT, dirty: bool = False) -> DataFrame:
    """Delete-key feed: every 50th order key. ``dirty`` adds a header row, doubled keys
    (every 5000th order) and a non-numeric key."""
    o = _table(spark, sf_dir, "orders")
    feed = o.where(F.col("o_orderkey") % 50 == 0).select(_s("o_orderkey").alias("order_id"),
                                                          F.lit(load_dt).alias("load_dt"))
    if not dirty:
        return feed
    doubled = o.where(F.col("o_orderkey") % 5000 == 0).select(_s("o_orderkey").alias("order_id"),
                                                               F.lit(load_dt).alias("load_dt"))
    bad = spark.range(1).select(F.lit("x1").alias("order_id"), F.lit(load_dt).alias("load_dt"))
    return feed.unionAll(doubled).unionAll(bad).unionAll(header_row(spark, ["order_id"], load_dt))


LINEITEM_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def landed_lineitem(spark: SparkSession, sf_dir: str, load_dt: str = LOAD_DT) -> DataFrame:
    """Unmodified ``lineitem`` as all-string landing data (its keys repeat naturally)."""
    li = _table(spark, sf_dir, "lineitem")
    return li.select(*[_s(c).alias(c) for c in LINEITEM_COLUMNS], F.lit(load_dt).alias("load_dt"))


CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def landed_customer(spark: SparkSession, sf_dir: str, load_dt: str = LOAD_DT) -> DataFrame:
    """``customer`` as landing data; defects by ``c_custkey % 53``."""
    c = _table(spark, sf_dir, "customer")
    m = F.col("c_custkey") % 53
    return c.select(
        _s("c_custkey").alias("c_custkey"),
        F.when(m == 1, F.lit("")).otherwise(F.col("c_name")).alias("c_name"),
        F.when(m == 2, F.concat(F.lit("n"), _s("c_nationkey"))).otherwise(_s("c_nationkey")).alias("c_nationkey"),
        _s("c_acctbal").alias("c_acctbal"),
        F.when(m == 3, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        F.lit(load_dt).alias("load_dt"))


EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def landed_events(spark: SparkSession, sf_dir: str, load_dt: str = LOAD_DT) -> DataFrame:
    """``events`` as landing data at second precision; defects by ``event_id % 41``."""
    e = _table(spark, sf_dir, "events")
    m = F.col("event_id") % 41
    iso = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return e.select(
        _s("event_id").alias("event_id"),
        F.when(m == 1, F.date_format("ts", "yyyy-MM-dd"))
         .when(m == 2, F.date_format("ts", "MM/dd/yyyy HH:mm:ss")).otherwise(iso).alias("ts"),
        F.when(m == 4, F.lit("-1")).otherwise(_s("user_id")).alias("user_id"),
        F.when(m == 3, F.lit("unknown")).otherwise(F.col("event_type")).alias("event_type"),
        _s("value").alias("value"),
        F.col("props"),
        F.lit(load_dt).alias("load_dt"))


# --------------------------------------------------------------------------- metadata

INTERFACE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("source_system", T.StringType()),
    T.StructField("status", T.IntegerType()), T.StructField("deleted", T.BooleanType())])

FILE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("interface_id", T.LongType()),
    T.StructField("name", T.StringType()), T.StructField("file_alias", T.StringType()),
    T.StructField("file_type", T.StringType()), T.StructField("tab_comment_cn", T.StringType()),
    T.StructField("load_solution", T.StringType()), T.StructField("full_delta", T.StringType()),
    T.StructField("if_physical_deletion", T.StringType()), T.StructField("load_key", T.StringType())])

FIELD_SCHEMA = T.StructType([
    T.StructField("file_id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("field_alias", T.StringType()), T.StructField("field_type", T.StringType()),
    T.StructField("value_range", T.StringType()), T.StructField("index", T.IntegerType()),
    T.StructField("primary_key", T.StringType()), T.StructField("business_key", T.StringType()),
    T.StructField("fields_comment_en", T.StringType()), T.StructField("fields_comment_cn", T.StringType()),
    T.StructField("if_enum_field", T.StringType()), T.StructField("if_not_null", T.StringType())])

LOAD_LIST_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType(), False), T.StructField("load_file_name", T.StringType(), False),
    T.StructField("drop_create_table_flag", T.BooleanType(), False),
    T.StructField("generate_tableddl_flag", T.BooleanType(), False),
    T.StructField("on_line", T.BooleanType(), False)])

INTERFACE_ROWS = [
    (1, "CRM", 3, False),
    (2, "ERP", 3, False),
    (3, "OLD", 1, False),     # inactive status
    (4, "GONE", 3, True),     # deleted
]

FILE_ROWS = [
    (10, 1, "ORDERS", None, "CSV", "orders, daily", "incremental", "Delta", "Y", None),
    (11, 1, "CUSTOMER_RAW", "CUSTOMER", "CSV", "customer master", "full", "Full", "N", None),
    (12, 2, "EVENTS", "", "PARQUET", "events by type", "full delete full load by key", "Full", "N", "EVENT_TYPE"),
    (13, 2, "LINEITEM", None, "CSV", None, "incremental", "Delta", "N", None),
    (14, 3, "ORPHAN", None, "CSV", "inactive interface", "incremental", "Delta", "N", None),
    (15, 4, "DELETED", None, "CSV", "deleted interface", "incremental", "Delta", "N", None),
    (16, 1, "TWICE", None, "CSV", "first copy", "full", "Full", "N", None),
    (17, 2, "TWICE", None, "CSV", "second copy", "full", "Full", "N", None),
]

# (file_id, name, alias, type, range, index, pk, bk, comment_en, comment_cn, enum, not_null)
FIELD_ROWS = [
    (10, "ORDER_ID", None, "INT8", None, 1, "Y", "N", "order id.", "订单号", "N", "N"),
    (10, "CUST_ID", "", "int8", None, 2, "N", "N", "customer, key", "客户", "N", "N"),
    (10, "STATUS", None, "varchar", "F,O,P", 3, "N", "N", "status `code'", "状态", "Y", "Y"),
    (10, "TOTAL_PRICE", None, "numeric", None, 4, "N", "N", "price/{amount}$", None, "N", "N"),
    (10, "ORDER_TS", None, "timestamp", None, 5, "N", "N", "order time", "下单时间", "N", "N"),
    (10, "PRIORITY", None, "varchar", None, 6, "N", "N", "priority\\level", "优先级", "N", "N"),
    (11, "CUSTKEY", "C_CUSTKEY", "int8", None, 1, "N", "Y", "customer key", "客户号", "N", "N"),
    (11, "C_NAME", None, "varchar", None, 2, "N", "N", "name", "名称", "N", "Y"),
    (11, "C_NATIONKEY", None, "int4", None, 3, "N", "N", "nation", "国家", "N", "N"),
    (11, "C_ACCTBAL", None, "float8", None, 4, "N", "N", "balance", "余额", "N", "N"),
    (11, "C_MKTSEGMENT", None, "varchar", "AUTOMOBILE,BUILDING,FURNITURE,HOUSEHOLD,MACHINERY", 5,
     "N", "N", "segment", "细分", "Y", "N"),
    (12, "EVENT_ID", "", "int2vector", None, 1, "Y", "N", "event id", "事件号", "N", "N"),
    (12, "TS", None, "time_stamp", None, 2, "N", "N", "event time", "时间", "N", "N"),
    (12, "USER_ID", None, "_int4", None, 3, "N", "N", "user", "用户", "N", "N"),
    (12, "EVENT_TYPE", None, "varchar", "click,view,error,purchase,signup", 4, "N", "N", "type", "类型", "Y", "Y"),
    (12, "VALUE", None, "float4", None, 5, "N", "N", "value", "值", "N", "N"),
    (12, "PROPS", None, "text", None, 6, "N", "N", "properties", "属性", "N", "N"),
    (13, "L_ORDERKEY", None, "int8", None, 1, "Y", "N", "order", "订单", "N", "N"),
    (13, "L_PARTKEY", None, "int8range", None, 2, "N", "N", "part", "零件", "N", "N"),
    (13, "L_SUPPKEY", None, "int4range", None, 3, "N", "N", "supplier", "供应商", "N", "N"),
    (13, "L_LINENUMBER", None, "int4", None, 4, "Y", "N", "line", "行号", "N", "N"),
    (13, "L_QUANTITY", None, "float4", None, 5, "N", "N", "quantity", "数量", "N", "N"),
    (13, "L_EXTENDEDPRICE", None, "money", None, 6, "N", "N", "price", "价格", "N", "N"),
    (13, "L_DISCOUNT", None, "float8", None, 7, "N", "N", "discount", "折扣", "N", "N"),
    (13, "L_TAX", None, "numeric", None, 8, "N", "N", "tax", "税", "N", "N"),
    (13, "L_RETURNFLAG", None, "varchar", "A,N,R", 9, "N", "N", "return flag", "退货", "Y", "N"),
    (13, "L_LINESTATUS", None, "varchar", "F,O", 10, "N", "N", "line status", "状态", "Y", "N"),
    (13, "L_SHIPDATE", None, "datetime2", None, 11, "N", "N", "ship date", "发货", "N", "N"),
    (14, "A", None, "varchar", None, 1, "Y", "N", "a", "a", "N", "N"),
    (15, "A", None, "varchar", None, 1, "Y", "N", "a", "a", "N", "N"),
    (16, "ID", None, "_int2", None, 1, "Y", "N", "id", "编号", "N", "N"),
    (16, "SMALL", None, "int2", None, 2, "N", "N", "small", "小", "N", "N"),
    (16, "FLAG_COL", None, "bool", None, 3, "N", "N", "flag", "标志", "N", "N"),
    (16, "DAY", None, "date", None, 4, "N", "N", "day", "日", "N", "N"),
    (16, "TZ", None, "timestamptz", None, 5, "N", "N", "zoned", "时区", "N", "N"),
    (16, "DT", None, "datetime", None, 6, "N", "N", "datetime", "日期时间", "N", "N"),
    (16, "AMOUNT", None, "money", None, 7, "N", "N", "amount", "金额", "N", "N"),
    (17, "ID", None, "int4", None, 1, "N", "Y", "id", "编号", "N", "N"),
]

LOAD_LIST_ROWS = [
    (1, "ORDERS", True, True, True),
    (2, "CUSTOMER", False, True, True),
    (3, "EVENTS", True, False, True),
    (4, "LINEITEM", True, True, False),
]


def metadata_frames(spark: SparkSession) -> dict:
    """The four metadata tables as DataFrames (stand-ins for the JDBC source)."""
    return {
        "interface": spark.createDataFrame(INTERFACE_ROWS, INTERFACE_SCHEMA),
        "interface_file": spark.createDataFrame(FILE_ROWS, FILE_SCHEMA),
        "interface_field": spark.createDataFrame(FIELD_ROWS, FIELD_SCHEMA),
        "load_file_list": spark.createDataFrame(LOAD_LIST_ROWS, LOAD_LIST_SCHEMA),
    }

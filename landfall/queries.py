"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the given tables (through the landing fixtures derived from
them) over whole tables. Queries that exercise sinks write to fresh folders
under the session's shared checkpoint folder and read the result back.
The metadata comes from the inline metadata fixture (a few rows per file, as
in production); metadata-only plans are covered by the unit tests.
"""

from __future__ import annotations

import dataclasses
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall import spec as S
from landfall.functions import checks
from landfall.operators import ods as O
from landfall.operators import sinks
from landfall.operators.split import blank_rows, clean_rows, load_audit, reject_rows
from landfall.operators.validate import (FLAG, VIOLATIONS, drop_header_rows, duplicate_keys, validate, violation_of,
                                         violation_summary)
from landfall.plans import metadata as M
from landfall.plans import schema as SC
from landfall.plans.ledger import load_summary, read_ledger
from landfall.plans.load import LoadError, run_load
from landfall.session import scratch_path
from landfall.sources import fixtures as fx
from landfall.sources import landing as L

LOAD_DT = fx.LOAD_DT
EARLIER = "2022-09-10"
LOAD_TS = "2022-09-12 01:00:00"
COLS = fx.ORDER_COLUMNS


def _spec(spark: SparkSession, name: str, profile: str = "v2") -> S.FileSpec:
    meta = fx.metadata_frames(spark)
    return M.file_specs(meta, [name])[0]


def _rules(spark: SparkSession, name: str = "ORDERS") -> dict:
    return _spec(spark, name).rule_map()


def _landed(spark, sf_dir):
    lo = fx.landed_orders(spark, sf_dir)
    return lo, drop_header_rows(lo, COLS)


def _violations(spark, sf_dir, checks_wanted, profile="v2") -> DataFrame:
    """Header-filtered landed orders whose listed checks fail, with the joined messages."""
    _, rows = _landed(spark, sf_dir)
    rules = _rules(spark)
    msgs = [violation_of(rules[c], k, profile) for c, k in checks_wanted]
    v = checks.render_flag(msgs)
    return rows.select(*COLS, v.alias("violation")).where(F.col("violation") != "")


# --------------------------------------------------------------------------- step 1: checks

def dq_header_filter(spark, sf_dir):
    _, rows = _landed(spark, sf_dir)
    return rows


def dq_misaligned(spark, sf_dir):
    _, rows = _landed(spark, sf_dir)
    msg = S.MESSAGES["native"]["misaligned"]
    return rows.where(checks.any_null(COLS)).select(*COLS, F.lit(msg).alias("violation"))


def dq_not_null(spark, sf_dir):
    return _violations(spark, sf_dir, [("status", "not_null")])


def dq_not_null_v1(spark, sf_dir):
    return _violations(spark, sf_dir, [("status", "not_null")], profile="v1")


def dq_integer(spark, sf_dir):
    return _violations(spark, sf_dir, [("order_id", "int"), ("cust_id", "int")])


def dq_timestamp(spark, sf_dir):
    return _violations(spark, sf_dir, [("order_ts", "timestamp")])


def dq_timestamp_v1(spark, sf_dir):
    return _violations(spark, sf_dir, [("order_ts", "timestamp")], profile="v1")


def dq_enum(spark, sf_dir):
    return _violations(spark, sf_dir, [("status", "enum")])


def dq_date(spark, sf_dir):
    """order_ts declared as a date: same acceptance, slash layout rewritten, no time padding."""
    _, rows = _landed(spark, sf_dir)
    rule = S.ColumnRule("order_ts", check="date", declared_type="date")
    return rows.select("order_id", F.col("order_ts").alias("order_ts_raw"),
                       checks.output_value(rule, S.V2).alias("order_ts"),
                       violation_of(rule, "date").alias("violation"))


def dq_normalise_ts(spark, sf_dir):
    _, rows = _landed(spark, sf_dir)
    rule = _rules(spark)["order_ts"]
    return rows.select("order_id", F.col("order_ts").alias("order_ts_raw"),
                       checks.output_value(rule, S.V2).alias("order_ts"))


# --------------------------------------------------------------------------- step 2: uniqueness, flag

def dq_duplicate_keys(spark, sf_dir):
    _, rows = _landed(spark, sf_dir)
    return duplicate_keys(rows, ["order_id"])


def dq_unique(spark, sf_dir):
    """Uniqueness of (l_orderkey, l_linenumber) over the whole of lineitem, with every rule of the file."""
    spec = _spec(spark, "LINEITEM")
    v = validate(fx.landed_lineitem(spark, sf_dir), spec.rules, spec.keys)
    return v.where(F.col(FLAG) != "").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", FLAG)


def _validated_orders(spark, sf_dir, profile="v2"):
    spec = _spec(spark, "ORDERS", profile)
    return spec, validate(fx.landed_orders(spark, sf_dir), spec.rules, spec.keys, profile)


def dq_flag(spark, sf_dir):
    _, v = _validated_orders(spark, sf_dir)
    return v


def dq_castable(spark, sf_dir):
    """Values that the ODS cast would turn into null (after the timestamp rewrite), one row each."""
    spec = _spec(spark, "ORDERS")
    profile = dataclasses.replace(S.V2, check_castable=True)
    v = validate(fx.landed_orders(spark, sf_dir), spec.rules, spec.keys, profile, structured=True)
    each = v.select("order_id", F.explode(VIOLATIONS).alias("x")).where("x.check = 'castable'")
    return each.select("order_id", F.col("x.column").alias("column_name"),
                       F.substring_index("x.message", "errValue->", -1).alias("value"))


def violation_summary_q(spark, sf_dir):
    """Violations of the landed orders per column and check."""
    spec = _spec(spark, "ORDERS")
    return violation_summary(validate(fx.landed_orders(spark, sf_dir), spec.rules, spec.keys, structured=True))


# --------------------------------------------------------------------------- step 3: split, audit

def split_clean(spark, sf_dir):
    spec, v = _validated_orders(spark, sf_dir)
    return clean_rows(v, spec.columns)


def split_reject(spark, sf_dir):
    spec, v = _validated_orders(spark, sf_dir)
    return reject_rows(v, spec.columns)


def split_reject_v1(spark, sf_dir):
    spec, v = _validated_orders(spark, sf_dir, "v1")
    return reject_rows(v, spec.columns, "v1")


def split_blank(spark, sf_dir):
    spec, v = _validated_orders(spark, sf_dir)
    return blank_rows(v, spec.columns)


def load_audit_q(spark, sf_dir):
    spec, v = _validated_orders(spark, sf_dir)
    return load_audit(v, spec.columns)


# --------------------------------------------------------------------------- step 6: ODS

def _stage_orders(spark, sf_dir, dirty_pk=False):
    spec, v = _validated_orders(spark, sf_dir)
    stg = clean_rows(v, spec.columns)
    pk_v = validate(fx.landed_orders_pk(spark, sf_dir, dirty=dirty_pk), spec.key_rules(), spec.keys)
    return spec, stg, clean_rows(pk_v, list(spec.keys))


def ods_hard_delete(spark, sf_dir):
    spec, stg, pk = _stage_orders(spark, sf_dir)
    return O.mark_hard_deletes(stg, pk, spec.keys)


def ods_no_delete_feed(spark, sf_dir):
    spec = _spec(spark, "CUSTOMER")
    v = validate(fx.landed_customer(spark, sf_dir), spec.rules, spec.keys)
    return O.without_delete_feed(clean_rows(v, spec.columns))


def ods_conform(spark, sf_dir):
    spec, stg, pk = _stage_orders(spark, sf_dir)
    stg = stg.withColumn("load_dt", F.lit(LOAD_DT))
    return O.stage_to_ods(stg, SC.layer_schema(spec, "ods"), spec.keys, pk, LOAD_TS)


def _scratch_dbs(spark) -> dict:
    tag = uuid.uuid4().hex[:8]
    return {k: f"lf_{tag}_{k}" for k in ("ldg", "stg", "rej", "ods")}


def _landing_fixtures(spark, sf_dir, dirty_pk=False):
    frames = {("ORDERS", False): lambda: fx.landed_orders(spark, sf_dir),
              ("ORDERS", True): lambda: fx.landed_orders_pk(spark, sf_dir, dirty=dirty_pk),
              ("CUSTOMER", False): lambda: fx.landed_customer(spark, sf_dir),
              ("EVENTS", False): lambda: fx.landed_events(spark, sf_dir),
              ("LINEITEM", False): lambda: fx.landed_lineitem(spark, sf_dir)}
    return lambda spec, pk: frames[(spec.file_name, pk)]()


def _load(spark, sf_dir, files, dirty_pk=False, stages=("validate", "ods")):
    dbs = _scratch_dbs(spark)
    root = scratch_path(spark, "warehouse")
    res = run_load(spark, fx.metadata_frames(spark), LOAD_DT, files=files, databases=dbs, warehouse_root=root,
                   landing=_landing_fixtures(spark, sf_dir, dirty_pk), load_ts=LOAD_TS, stages=stages)
    return dbs, res


def ods_load_delta(spark, sf_dir):
    """Two dates are loaded, the second at first without its orders of status F; its re-load overwrites that date only."""
    dbs, root, meta = _scratch_dbs(spark), scratch_path(spark, "warehouse"), fx.metadata_frames(spark)
    landed = lambda day: lambda spec, pk: (fx.landed_orders_pk if pk else fx.landed_orders)(spark, sf_dir, day)
    partial = lambda spec, pk: landed(LOAD_DT)(spec, pk) if pk else landed(LOAD_DT)(spec, pk).where("status <> 'F'")
    for day, source in (("2022-09-10", landed("2022-09-10")), (LOAD_DT, partial), (LOAD_DT, landed(LOAD_DT))):
        run_load(spark, meta, day, files=["ORDERS"], databases=dbs, warehouse_root=root, landing=source, load_ts=LOAD_TS,
                 drop_create=[False])
    return spark.table(f"{dbs['ods']}.crm_orders")


def ods_load_full(spark, sf_dir):
    dbs, _ = _load(spark, sf_dir, ["CUSTOMER"])
    return spark.table(f"{dbs['ods']}.crm_customer")


def ods_load_by_key(spark, sf_dir):
    dbs, _ = _load(spark, sf_dir, ["EVENTS"])
    return spark.table(f"{dbs['ods']}.erp_events")


# --------------------------------------------------------------------------- step 7: sinks, sources

def sink_static_overwrite(spark, sf_dir):
    """Write every landed row into the staging partition, then overwrite it with the clean rows."""
    spec, v = _validated_orders(spark, sf_dir)
    dbs = _scratch_dbs(spark)
    SC.create_databases(spark, dbs, scratch_path(spark, "warehouse"))
    table = f"{dbs['stg']}.orders"
    cols = ", ".join(f"`{c}` STRING" for c in spec.columns)
    spark.sql(f"CREATE TABLE {table} ({cols}, `load_dt` STRING) USING ORC PARTITIONED BY (load_dt)")
    sinks.overwrite_partition(spark, v, table, "load_dt", LOAD_DT, spec.columns)
    sinks.overwrite_partition(spark, clean_rows(v, spec.columns), table, "load_dt", LOAD_DT, spec.columns)
    return L.read_table_for_date(spark, table, LOAD_DT).select(*spec.columns)


def src_csv_landing(spark, sf_dir):
    """landed_orders written as CSV files (header per file) and read back as landing data."""
    path = scratch_path(spark, "landing_csv")
    (fx.landed_orders(spark, sf_dir).write.option("header", True).option("emptyValue", "")
       .partitionBy("load_dt").csv(path))
    return L.for_load_date(L.read_landing_csv(spark, path, COLS), LOAD_DT)


LINE_COLUMNS = ["order_id", "cust_id", "status", "note"]


def src_csv_lines(spark, sf_dir):
    """Whole, short, long, empty and blank CSV lines derived from orders, read back: no line is lost."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    k, c, st = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderstatus")
    m = F.col("o_orderkey") % 6
    line = (F.when(m == 0, F.concat(k, F.lit(","), c, F.lit(","), st, F.lit(',"a,b"')))
             .when(m == 1, F.concat(k, F.lit(',"x\\"y,z"')))
             .when(m == 2, F.concat(k, F.lit(","), c, F.lit(","), st, F.lit(",,extra")))
             .when(m == 3, F.lit("")).when(m == 4, F.lit("  "))
             .otherwise(F.concat(k, F.lit(",,"), st, F.lit(","))))
    path = scratch_path(spark, "landing_lines")
    o.select(line.alias("value"), F.lit(LOAD_DT).alias("load_dt")).write.partitionBy("load_dt").text(path)
    return L.read_landing_csv(spark, path, LINE_COLUMNS, header=False, load_dt=LOAD_DT)


def src_partition_read(spark, sf_dir):
    """Two load dates in one partitioned table; only one is read (PartitionFilters)."""
    path = scratch_path(spark, "landing_parquet")
    lo = fx.landed_orders(spark, sf_dir)
    lo.unionByName(lo.withColumn("load_dt", F.lit("2022-09-10"))).write.partitionBy("load_dt").parquet(path)
    return L.read_landing(spark, path, "parquet", COLS, load_dt=LOAD_DT)


# --------------------------------------------------------------------------- step 8: end to end

def e2e_orders(spark, sf_dir):
    dbs, _ = _load(spark, sf_dir, ["ORDERS"])
    return L.read_table_for_date(spark, f"{dbs['ods']}.crm_orders", LOAD_DT)


def e2e_pk_feed(spark, sf_dir):
    """The validated delete-key feed (dirty variant): staged keys and rejected keys with flags."""
    dbs, _ = _load(spark, sf_dir, ["ORDERS"], dirty_pk=True, stages=("validate",))
    stg = L.read_table_for_date(spark, f"{dbs['stg']}.crm_orders_pk", LOAD_DT).select("order_id", F.lit("").alias(FLAG))
    rej = L.read_table_for_date(spark, f"{dbs['rej']}.ldg_crm_orders_pk", LOAD_DT).select("order_id", FLAG)
    return stg.unionByName(rej)


def e2e_multi_table(spark, sf_dir):
    """Orders, customer and events loaded together; row counts per file and layer."""
    dbs, _ = _load(spark, sf_dir, ["ORDERS", "CUSTOMER", "EVENTS"])
    parts = []
    for name, table in (("ORDERS", "crm_orders"), ("CUSTOMER", "crm_customer"), ("EVENTS", "erp_events")):
        layers = {"stg": L.read_table_for_date(spark, f"{dbs['stg']}.{table}", LOAD_DT),
                  "rej": L.read_table_for_date(spark, f"{dbs['rej']}.ldg_{table}_rej", LOAD_DT),
                  "ods": spark.table(f"{dbs['ods']}.{table}"),
                  "ods_hard_deleted": spark.table(f"{dbs['ods']}.{table}").where(F.col("etl_is_hard_del") == 1)}
        for layer, df in layers.items():
            parts.append(df.agg(F.count(F.lit(1)).alias("row_count"))
                           .select(F.lit(name).alias("file_name"), F.lit(layer).alias("layer"), "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def e2e_v1_validate_only(spark, sf_dir):
    """The older job: profile v1, validate and split only; the reject table of the day."""
    dbs = _scratch_dbs(spark)
    run_load(spark, fx.metadata_frames(spark), LOAD_DT, files=["ORDERS"], databases=dbs,
             warehouse_root=scratch_path(spark, "warehouse"), landing=_landing_fixtures(spark, sf_dir),
             profile="v1", stages=("validate",))
    return L.read_table_for_date(spark, f"{dbs['rej']}.ldg_crm_orders_rej", LOAD_DT).drop("load_dt")


def e2e_csv_landing(spark, sf_dir):
    """Landing CSV folders (header line per file) read by the load job itself -> ODS."""
    dbs = _scratch_dbs(spark)
    landing_root = scratch_path(spark, "landing")
    for df, folder in ((fx.landed_orders(spark, sf_dir), "crm_orders"),
                       (fx.landed_orders_pk(spark, sf_dir), "crm_orders_pk")):
        (df.write.option("header", True).option("emptyValue", "").partitionBy("load_dt")
           .csv(f"{landing_root}/CRM/{folder}"))
    run_load(spark, fx.metadata_frames(spark), LOAD_DT, files=["ORDERS"], databases=dbs,
             warehouse_root=scratch_path(spark, "warehouse"), landing_root=landing_root, load_ts=LOAD_TS)
    return L.read_table_for_date(spark, f"{dbs['ods']}.crm_orders", LOAD_DT)


def e2e_csv_table_landing(spark, sf_dir):
    """CSV files in the folders of the landing tables (partitions not in the catalog), loaded with default flags -> ODS."""
    dbs, root, meta = _scratch_dbs(spark), scratch_path(spark, "warehouse"), fx.metadata_frames(spark)
    run_load(spark, meta, LOAD_DT, files=["ORDERS"], databases=dbs, warehouse_root=root, create_only=True)
    for df, table in ((fx.landed_orders(spark, sf_dir), "crm_orders"), (fx.landed_orders_pk(spark, sf_dir), "crm_orders_pk")):
        (df.write.option("header", True).option("emptyValue", "").partitionBy("load_dt")
           .csv(L.table_storage(spark, f"{dbs['ldg']}.{table}")[1], mode="append"))
    run_load(spark, meta, LOAD_DT, files=["ORDERS"], databases=dbs, warehouse_root=root, load_ts=LOAD_TS)
    return L.read_table_for_date(spark, f"{dbs['ods']}.crm_orders", LOAD_DT)


def e2e_table_landing(spark, sf_dir):
    """Non-CSV landing: rows inserted into the landing table, loaded with default flags -> ODS by key."""
    dbs = _scratch_dbs(spark)
    root = scratch_path(spark, "warehouse")
    meta = fx.metadata_frames(spark)
    run_load(spark, meta, LOAD_DT, files=["EVENTS"], databases=dbs, warehouse_root=root, create_only=True)
    sinks.overwrite_dynamic(fx.landed_events(spark, sf_dir), f"{dbs['ldg']}.erp_events")
    run_load(spark, meta, LOAD_DT, files=["EVENTS"], databases=dbs, warehouse_root=root, load_ts=LOAD_TS)
    return spark.table(f"{dbs['ods']}.erp_events")


def e2e_lineitem(spark, sf_dir):
    """The whole of lineitem loaded end to end (composite key, every numeric ODS type) -> ODS."""
    dbs, _ = _load(spark, sf_dir, ["LINEITEM"])
    return L.read_table_for_date(spark, f"{dbs['ods']}.erp_lineitem", LOAD_DT)


# --------------------------------------------------------------------------- step 9: publication, change, recovery

def sink_publish_layers(spark, sf_dir):
    """Both layers of one write, as published: staging rows and rejects with their flag."""
    dbs, _ = _load(spark, sf_dir, ["ORDERS"], stages=("validate",))
    stg = L.read_table_for_date(spark, f"{dbs['stg']}.crm_orders", LOAD_DT).select(F.lit("stg").alias("layer"), *COLS, F.lit("").alias(FLAG))
    rej = L.read_table_for_date(spark, f"{dbs['rej']}.ldg_crm_orders_rej", LOAD_DT).select(F.lit("rej").alias("layer"), *COLS, FLAG)
    return stg.unionByName(rej)


def e2e_default_flags(spark, sf_dir):
    """Two dates and the first again, all with default flags: rows per layer and date."""
    dbs, root, meta = _scratch_dbs(spark), scratch_path(spark, "warehouse"), fx.metadata_frames(spark)
    for day in (EARLIER, LOAD_DT, EARLIER):
        run_load(spark, meta, day, files=["ORDERS"], databases=dbs, warehouse_root=root, load_ts=LOAD_TS,
                 landing=lambda spec, pk, day=day: (fx.landed_orders_pk if pk else fx.landed_orders)(spark, sf_dir, day))
    tables = {"stg": "crm_orders", "rej": "ldg_crm_orders_rej", "ods": "crm_orders"}
    parts = [spark.table(f"{dbs[layer]}.{t}").groupBy("load_dt").agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(layer).alias("layer"), "load_dt", "row_count") for layer, t in tables.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def ods_added_field(spark, sf_dir):
    """A field that the metadata gains between two dates: earlier rows keep null in it, no row is lost."""
    dbs, root, meta = _scratch_dbs(spark), scratch_path(spark, "warehouse"), fx.metadata_frames(spark)
    fields = meta["interface_field"]
    before = {**meta, "interface_field": fields.where(~((F.col("file_id") == 10) & (F.col("name") == "PRIORITY")))}
    for day, m, gone in ((EARLIER, before, ["priority"]), (LOAD_DT, meta, [])):
        run_load(spark, m, day, files=["ORDERS"], databases=dbs, warehouse_root=root, load_ts=LOAD_TS,
                 landing=lambda spec, pk, day=day, gone=gone: fx.landed_orders_pk(spark, sf_dir, day) if pk
                 else fx.landed_orders(spark, sf_dir, day).drop(*gone))
    return spark.table(f"{dbs['ods']}.crm_orders")


def load_ledger(spark, sf_dir):
    """Three files, one failing; the resumed run does what is missing. The ledger's summary of the date."""
    dbs, root, led = _scratch_dbs(spark), scratch_path(spark, "warehouse"), scratch_path(spark, "ledger")
    landed, away = _landing_fixtures(spark, sf_dir), [True]

    def source(spec, pk):
        if spec.file_name == "EVENTS" and away:
            raise OSError("store is away")
        return landed(spec, pk)
    args = dict(files=["ORDERS", "CUSTOMER", "EVENTS"], databases=dbs, warehouse_root=root, landing=source, load_ts=LOAD_TS,
                ledger=led, attempts=1)
    try:
        run_load(spark, fx.metadata_frames(spark), LOAD_DT, **args)
    except LoadError:
        away.clear()
    run_load(spark, fx.metadata_frames(spark), LOAD_DT, resume=True, **args)
    return load_summary(read_ledger(spark, led)).select("load_dt", "file_name", "done", "failed", "total", "clean", "rejected", "blank")


def ods_hard_delete_bucketed(spark, sf_dir):
    """Staging bucketed by key and a delete feed above the broadcast bound: the join moves no row."""
    dbs = _scratch_dbs(spark)
    run_load(spark, fx.metadata_frames(spark), LOAD_DT, files=["ORDERS"], databases=dbs, warehouse_root=scratch_path(spark, "warehouse"),
             landing=_landing_fixtures(spark, sf_dir), load_ts=LOAD_TS, staging_buckets=8, broadcast_limit=0)
    return L.read_table_for_date(spark, f"{dbs['ods']}.crm_orders", LOAD_DT)


def e2e_csv_other_header(spark, sf_dir):
    """CSV files whose first lines are not the column names: found out before anything is published, then read by position."""
    dbs = _scratch_dbs(spark)
    root = scratch_path(spark, "landing")
    for df, folder in ((fx.landed_orders(spark, sf_dir), "crm_orders"), (fx.landed_orders_pk(spark, sf_dir), "crm_orders_pk")):
        named = df.select(*[F.col(c).alias(c if c == "load_dt" else f"Column {c}") for c in df.columns])
        named.write.option("header", True).option("emptyValue", "").partitionBy("load_dt").csv(f"{root}/CRM/{folder}")
    run_load(spark, fx.metadata_frames(spark), LOAD_DT, files=["ORDERS"], databases=dbs,
             warehouse_root=scratch_path(spark, "warehouse"), landing_root=root, load_ts=LOAD_TS)
    return L.read_table_for_date(spark, f"{dbs['ods']}.crm_orders", LOAD_DT)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dq_header_filter": dq_header_filter,
    "dq_misaligned": dq_misaligned,
    "dq_not_null": dq_not_null,
    "dq_not_null_v1": dq_not_null_v1,
    "dq_integer": dq_integer,
    "dq_timestamp": dq_timestamp,
    "dq_timestamp_v1": dq_timestamp_v1,
    "dq_date": dq_date,
    "dq_enum": dq_enum,
    "dq_normalise_ts": dq_normalise_ts,
    "dq_duplicate_keys": dq_duplicate_keys,
    "dq_unique": dq_unique,
    "dq_flag": dq_flag,
    "dq_castable": dq_castable,
    "violation_summary": violation_summary_q,
    "split_clean": split_clean,
    "split_reject": split_reject,
    "split_reject_v1": split_reject_v1,
    "split_blank": split_blank,
    "load_audit": load_audit_q,
    "ods_hard_delete": ods_hard_delete,
    "ods_no_delete_feed": ods_no_delete_feed,
    "ods_conform": ods_conform,
    "ods_load_delta": ods_load_delta,
    "ods_load_full": ods_load_full,
    "ods_load_by_key": ods_load_by_key,
    "sink_static_overwrite": sink_static_overwrite,
    "src_csv_landing": src_csv_landing,
    "src_csv_lines": src_csv_lines,
    "src_partition_read": src_partition_read,
    "e2e_orders": e2e_orders,
    "e2e_pk_feed": e2e_pk_feed,
    "e2e_multi_table": e2e_multi_table,
    "e2e_v1_validate_only": e2e_v1_validate_only,
    "e2e_csv_landing": e2e_csv_landing,
    "e2e_csv_table_landing": e2e_csv_table_landing,
    "e2e_table_landing": e2e_table_landing,
    "e2e_lineitem": e2e_lineitem,
    "sink_publish_layers": sink_publish_layers,
    "e2e_default_flags": e2e_default_flags,
    "ods_added_field": ods_added_field,
    "load_ledger": load_ledger,
    "ods_hard_delete_bucketed": ods_hard_delete_bucketed,
    "e2e_csv_other_header": e2e_csv_other_header,
}

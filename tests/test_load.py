"""End-to-end loads at sf0.001: counts, idempotence, overwrite semantics, strategies."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from landfall.plans.load import run_load
from landfall.sources import fixtures as fx
from landfall.sources import landing as L

SF = "/root/testdata/sf0.001"
TS = "2022-09-12 01:00:00"


def dbs():
    tag = uuid.uuid4().hex[:6]
    return {k: f"t{tag}_{k}" for k in ("ldg", "stg", "rej", "ods")}


def landing(spark, overrides=None):
    frames = {("ORDERS", False): lambda: fx.landed_orders(spark, SF),
              ("ORDERS", True): lambda: fx.landed_orders_pk(spark, SF),
              ("CUSTOMER", False): lambda: fx.landed_customer(spark, SF),
              ("EVENTS", False): lambda: fx.landed_events(spark, SF)}
    frames.update(overrides or {})
    return lambda spec, pk: frames[(spec.file_name, pk)]()


@pytest.fixture(scope="module")
def loaded(spark, meta, tmp_path_factory):
    d = dbs()
    root = str(tmp_path_factory.mktemp("wh"))
    res = run_load(spark, meta, "2022-09-11", files=["ORDERS", "CUSTOMER", "EVENTS"], databases=d,
                   warehouse_root=root, landing=landing(spark), load_ts=TS, ddl_path=os.path.join(root, "ddl"))
    return d, root, {r.file_name: r for r in res}


def count(spark, table, dt="2022-09-11"):
    return L.read_table_for_date(spark, table, dt).count()


def test_audit_counts(loaded):
    _, _, res = loaded
    m = res["ORDERS"].main
    assert (m.total, m.clean, m.rejected, m.blank) == (1516, 1372, 128, 16)
    assert m.total == m.clean + m.rejected + m.blank
    assert res["ORDERS"].delete_feed.clean == res["ORDERS"].delete_feed.total
    assert [res[n].ods for n in ("ORDERS", "CUSTOMER", "EVENTS")] == ["load_date", "full", "load_key"]


def test_tables(spark, loaded):
    d, _, _ = loaded
    assert count(spark, f"{d['stg']}.crm_orders") == 1372
    assert count(spark, f"{d['rej']}.ldg_crm_orders_rej") == 128
    ods = spark.table(f"{d['ods']}.crm_orders")
    assert ods.count() == 1372 and ods.where("etl_is_hard_del = 1").count() == 27
    assert ods.where("order_ts is null").count() == 0            # normalised timestamps cast cleanly
    assert ods.select(F.max("etl_created_ts").cast("string")).first()[0] == TS


def test_rerun_is_idempotent_and_clears_rejects(spark, meta, loaded):
    d, root, _ = loaded
    run_load(spark, meta, "2022-09-11", files=["ORDERS"], databases=d, warehouse_root=root,
             landing=landing(spark), load_ts=TS, drop_create=[False])
    assert count(spark, f"{d['stg']}.crm_orders") == 1372
    assert spark.table(f"{d['ods']}.crm_orders").count() == 1372
    # A re-run whose landing has no rejects empties the reject partition (static overwrite).
    clean_only = {("ORDERS", False): lambda: fx.landed_orders(spark, SF).where(
        "order_id rlike '^[0-9]+$' and status in ('F','O','P') and cust_id rlike '^[0-9]+$' "
        "and order_ts like '____-__-__ __:__:__' and total_price is not null and priority is not null")
        .dropDuplicates(["order_id"])}
    res = run_load(spark, meta, "2022-09-11", files=["ORDERS"], databases=d, warehouse_root=root,
                   landing=landing(spark, clean_only), load_ts=TS, drop_create=[False])
    assert res[0].main.rejected == 0
    assert count(spark, f"{d['rej']}.ldg_crm_orders_rej") == 0


def test_by_key_overwrite_keeps_other_keys(spark, meta, loaded):
    d, root, _ = loaded
    before = {r["event_type"]: r["count"] for r in spark.table(f"{d['ods']}.erp_events").groupBy("event_type").count().collect()}
    only_click = {("EVENTS", False): lambda: fx.landed_events(spark, SF).where("event_type = 'click'").limit(5)}
    run_load(spark, meta, "2022-09-11", files=["EVENTS"], databases=d, warehouse_root=root,
             landing=landing(spark, only_click), load_ts=TS, drop_create=[False])
    after = {r["event_type"]: r["count"] for r in spark.table(f"{d['ods']}.erp_events").groupBy("event_type").count().collect()}
    assert after["click"] <= 5 and all(after[k] == before[k] for k in before if k != "click")


def test_full_overwrite_replaces_table(spark, meta, loaded):
    d, root, _ = loaded
    few = {("CUSTOMER", False): lambda: fx.landed_customer(spark, SF).where("c_custkey in ('4', '5')")}
    run_load(spark, meta, "2022-09-11", files=["CUSTOMER"], databases=d, warehouse_root=root,
             landing=landing(spark, few), load_ts=TS, drop_create=[False])
    assert spark.table(f"{d['ods']}.crm_customer").count() == 2


def test_create_only_and_v1(spark, meta, tmp_dir):
    d = dbs()
    res = run_load(spark, meta, "2022-09-11", files=["ORDERS"], databases=d, warehouse_root=tmp_dir,
                   create_only=True)
    assert res[0].ods == "tables only" and spark.table(f"{d['stg']}.crm_orders").count() == 0
    res = run_load(spark, meta, "2022-09-11", files=["ORDERS"], databases=d, warehouse_root=tmp_dir,
                   landing=landing(spark), profile="v1", stages=("validate",))
    m = res[0].main
    assert m.total == 1516 and m.clean + m.rejected == m.total and m.blank == 16
    assert count(spark, f"{d['rej']}.ldg_crm_orders_rej") == m.rejected


def test_auto_mode_uses_load_list(spark, meta, tmp_dir):
    d = dbs()
    res = run_load(spark, meta, "2022-09-11", databases=d, warehouse_root=tmp_dir, landing=landing(spark),
                   load_ts=TS, max_parallel=3)
    assert sorted(r.file_name for r in res) == ["CUSTOMER", "EVENTS", "ORDERS"]


def test_other_dates_untouched(spark, meta, tmp_dir):
    d = dbs()
    two_days = lambda: fx.landed_orders(spark, SF).unionByName(
        fx.landed_orders(spark, SF).withColumn("load_dt", F.lit("2022-09-10")))
    src = landing(spark, {("ORDERS", False): two_days})
    for day in ("2022-09-10", "2022-09-11"):
        run_load(spark, meta, day, files=["ORDERS"], databases=d, warehouse_root=tmp_dir, landing=src, load_ts=TS,
                 drop_create=[False])
    assert count(spark, f"{d['stg']}.crm_orders", "2022-09-10") == 1372
    assert count(spark, f"{d['stg']}.crm_orders", "2022-09-11") == 1372
    # re-loading one day with an empty landing clears only that day
    empty = landing(spark, {("ORDERS", False): lambda: fx.landed_orders(spark, SF).where("false")})
    res = run_load(spark, meta, "2022-09-11", files=["ORDERS"], databases=d, warehouse_root=tmp_dir, landing=empty,
                   load_ts=TS, drop_create=[False])
    assert res[0].main.total == 0
    assert count(spark, f"{d['stg']}.crm_orders", "2022-09-11") == 0
    assert count(spark, f"{d['ods']}.crm_orders", "2022-09-11") == 0
    assert count(spark, f"{d['stg']}.crm_orders", "2022-09-10") == 1372
    assert count(spark, f"{d['ods']}.crm_orders", "2022-09-10") == 1372


def test_broadcast_and_merge_join_same_counts(spark, meta, tmp_dir):
    from landfall.plans import metadata as M
    from landfall.plans.load import validate_and_split
    d = dbs()
    run_load(spark, meta, "2022-09-11", files=["ORDERS"], databases=d, warehouse_root=tmp_dir, create_only=True)
    spec = M.file_specs(meta, ["ORDERS"], d)[0]
    for limit in (None, 0):
        m = validate_and_split(spark, fx.landed_orders(spark, SF), spec.rules, spec.keys, spec.tables.stg,
                               spec.tables.rej, "2022-09-11", broadcast_limit=limit)
        assert (m.total, m.clean, m.rejected, m.blank) == (1516, 1372, 128, 16)
        assert count(spark, spec.tables.stg) == 1372 and count(spark, spec.tables.rej) == 128


def test_cache_landing_paths(spark, meta, tmp_dir):
    from landfall.plans import metadata as M
    from landfall.plans.load import validate_and_split
    d = dbs()
    run_load(spark, meta, "2022-09-11", files=["ORDERS"], databases=d, warehouse_root=tmp_dir, create_only=True)
    spec = M.file_specs(meta, ["ORDERS"], d)[0]
    cached_before = len(spark.sparkContext._jsc.getPersistentRDDs())
    for limit in (None, 0):        # broadcast path (landing cache only) and shuffle path (both caches)
        m = validate_and_split(spark, fx.landed_orders(spark, SF), spec.rules, spec.keys, spec.tables.stg,
                               spec.tables.rej, "2022-09-11", broadcast_limit=limit, cache_landing=True)
        assert (m.total, m.clean, m.rejected, m.blank) == (1516, 1372, 128, 16)
        assert count(spark, spec.tables.stg) == 1372 and count(spark, spec.tables.rej) == 128
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == cached_before     # everything released


def test_parquet_landing_folder(spark, meta, tmp_dir):
    """EVENTS is not CSV: its landing files are read from landing_root in the given format."""
    root = os.path.join(tmp_dir, "landing")
    fx.landed_events(spark, SF).write.partitionBy("load_dt").parquet(f"{root}/ERP/erp_events")
    d = dbs()
    res = run_load(spark, meta, "2022-09-11", files=["EVENTS"], databases=d, warehouse_root=tmp_dir,
                   landing_root=root, landing_format="parquet", load_ts=TS)
    assert res[0].main.total == 1000 and res[0].extra["cache_landing"] is False
    assert spark.table(f"{d['ods']}.erp_events").count() == res[0].main.clean


def test_csv_landing_folder(spark, meta, tmp_dir):
    """ORDERS is CSV: read from landing_root without a cache of the day's rows, and the counts hold."""
    root = os.path.join(tmp_dir, "landing")
    for df, folder in ((fx.landed_orders(spark, SF), "crm_orders"), (fx.landed_orders_pk(spark, SF), "crm_orders_pk")):
        df.write.option("header", True).option("emptyValue", "").partitionBy("load_dt").csv(f"{root}/CRM/{folder}")
    d = dbs()
    res = run_load(spark, meta, "2022-09-11", files=["ORDERS"], databases=d, warehouse_root=tmp_dir,
                   landing_root=root, load_ts=TS)[0]
    assert res.extra["cache_landing"] is False
    assert res.main.total == 1516 and res.main.clean == res.main.total - res.main.rejected - res.main.blank
    assert spark.table(f"{d['ods']}.crm_orders").count() == res.main.clean

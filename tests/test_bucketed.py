"""Staging bucketed by key: one shuffle when staged, none in the delete join."""

import pytest
from pyspark.sql import functions as F

from landfall.operators import ods as O
from landfall.operators import publish as P
from landfall.operators import sinks
from landfall.plans import load as PL
from landfall.plans import metadata as M
from landfall.plans.load import run_load
from landfall.sources import fixtures as fx
from landfall.sources import landing as L

SF, DAY, TS = "/root/testdata/sf0.001", "2022-09-11", "2022-09-12 01:00:00"


@pytest.fixture()
def dbs(request):
    return {k: f"bkt_{abs(hash(request.node.name)) % 10**8}_{k}" for k in ("ldg", "stg", "rej", "ods")}


def source(spark):
    return lambda spec, pk: fx.landed_orders_pk(spark, SF) if pk else fx.landed_orders(spark, SF).repartition(6)


def load(spark, meta, dbs, root, **kw):
    return run_load(spark, meta, DAY, files=["ORDERS"], databases=dbs, warehouse_root=root, landing=source(spark), load_ts=TS, **kw)[0]


def test_no_exchange_over_staging_rows(spark, meta, dbs, tmp_dir, monkeypatch):
    plans, write = [], sinks.write_ods
    monkeypatch.setattr(PL.sinks, "write_ods", lambda s, ods, *a: (plans.append(ods._jdf.queryExecution().executedPlan().toString()),
                                                                   write(s, ods, *a))[1])
    res = load(spark, meta, dbs, tmp_dir, staging_buckets=4, broadcast_limit=0)
    assert "SortMergeJoin" in plans[0] and "Exchange" not in plans[0] and "Bucketed: true" in plans[0]
    assert (res.main.total, res.main.clean, res.main.rejected, res.main.blank) == (1516, 1372, 128, 16)
    ods = spark.table(f"{dbs['ods']}.crm_orders")
    assert ods.count() == 1372 and ods.where("etl_is_hard_del = 1").count() == 27


def test_same_rows_as_unbucketed(spark, meta, dbs, tmp_dir):
    load(spark, meta, dbs, tmp_dir + "/a", staging_buckets=5, broadcast_limit=0)
    plain = {k: v + "x" for k, v in dbs.items()}
    load(spark, meta, plain, tmp_dir + "/b")
    for db, table in (("stg", "crm_orders"), ("stg", "crm_orders_pk"), ("rej", "ldg_crm_orders_rej"), ("ods", "crm_orders")):
        a, b = (sorted(map(str, spark.table(f"{d[db]}.{table}").collect())) for d in (dbs, plain))
        assert a == b
    assert load(spark, meta, dbs, tmp_dir + "/a", broadcast_limit=0).main.clean == 1372      # a later run keeps the buckets
    assert P.buckets_of(P.table_facts(spark, f"{dbs['stg']}.crm_orders")) == P.Buckets(5, ("order_id",))


def test_one_file_per_bucket(spark, meta, dbs, tmp_dir):
    load(spark, meta, dbs, tmp_dir, staging_buckets=4)
    assert len(L.read_table_for_date(spark, f"{dbs['stg']}.crm_orders", DAY).inputFiles()) == 4
    assert "Exchange" not in spark.table(f"{dbs['stg']}.crm_orders").groupBy("order_id").count()._jdf.queryExecution().executedPlan().toString()


def test_a_small_feed_is_still_broadcast(spark, meta, dbs, tmp_dir, monkeypatch):
    plans, write = [], sinks.write_ods
    monkeypatch.setattr(PL.sinks, "write_ods", lambda s, ods, *a: (plans.append(ods._jdf.queryExecution().executedPlan().toString()),
                                                                   write(s, ods, *a))[1])
    load(spark, meta, dbs, tmp_dir, staging_buckets=4)
    assert "BroadcastHashJoin" in plans[0]


def test_a_hot_rejected_key_is_spread(spark, tmp_dir):
    """A key of half the rows, all rejects: they stay where their split says."""
    rows = spark.range(4000).repartition(8).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") % 2 == 0, "reject").otherwise("clean").alias("layer"))
    P.stage_layers(rows, "layer", tmp_dir + "/s", "parquet", P.Buckets(8, ("k",)))
    back = spark.read.parquet(tmp_dir + "/s")
    written = back.where("layer = 'reject'").select(F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).alias("task")).distinct()
    assert back.count() == 4000 and written.count() > 1


def test_bucket_count_is_bounded(spark):
    assert P.bucket_count(spark, 0, 1 << 27) == 1 and P.bucket_count(spark, 10 << 30, 1 << 27) == 80
    assert P.bucket_count(spark, 100 << 50, 1 << 20) == int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))


def test_feed_bytes_bound_the_distinct_keys(spark):
    feed = spark.createDataFrame([("键1",), ("a",), ("a",), (None,)], "k string")
    assert O.feed_bytes(feed, ["k"]) == 4 + 1 + 1 + 0 + 4 * 48
    assert O.feed_bytes(feed.limit(0), ["k"]) == 0


def test_composite_key_buckets(spark, meta, dbs, tmp_dir):
    """A delete feed on a two-column key: the tables are bucketed by both."""
    with_feed = {**meta, "interface_file": meta["interface_file"].withColumn(
        "if_physical_deletion", F.when(F.col("name") == "LINEITEM", "Y").otherwise(F.col("if_physical_deletion")))}
    lines = fx.landed_lineitem(spark, SF).dropDuplicates(["l_orderkey", "l_linenumber"])
    feed = lines.where("l_orderkey % 7 = 0").select("l_orderkey", "l_linenumber", "load_dt")
    res = run_load(spark, with_feed, DAY, files=["LINEITEM"], databases=dbs, warehouse_root=tmp_dir, load_ts=TS,
                   landing=lambda spec, pk: feed if pk else lines, staging_buckets=3, broadcast_limit=0)[0]
    spec = M.file_specs(with_feed, ["LINEITEM"], dbs)[0]
    assert P.buckets_of(P.table_facts(spark, spec.tables.stg)).columns == ("l_orderkey", "l_linenumber")
    ods = spark.table(spec.tables.ods)
    assert ods.where("etl_is_hard_del = 1").count() == feed.count() and ods.count() == res.main.clean == lines.count()

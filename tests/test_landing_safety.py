"""Landing data is never lost or misread, and a run is robust."""

import os

import pytest
from pyspark.sql import functions as F

from landfall import spec as S
from landfall.operators.sinks import write_ods
from landfall.operators.sizing import measure
from landfall.operators.validate import VIOLATIONS, duplicate_keys, drop_header_rows, repeated_keys, validate
from landfall.plans import metadata as M
from landfall.plans.load import LoadError, run_load, validate_and_split
from landfall.sources import fixtures as fx
from landfall.sources import landing as L

SF, DAY, TS = "/root/testdata/sf0.001", "2022-09-11", "2022-09-12 01:00:00"


@pytest.fixture()
def dbs(request):
    return {k: f"safe_{abs(hash(request.node.name)) % 10**8}_{k}" for k in ("ldg", "stg", "rej", "ods")}


def test_default_flags_keep_landed_rows(spark, meta, dbs, tmp_dir):
    run_load(spark, meta, DAY, files=["EVENTS"], databases=dbs, warehouse_root=tmp_dir, create_only=True)
    where = L.table_storage(spark, f"{dbs['ldg']}.erp_events")[1]
    fx.landed_events(spark, SF).write.partitionBy("load_dt").parquet(where, mode="append")
    for _ in range(2):
        res = run_load(spark, meta, DAY, files=["EVENTS"], databases=dbs, warehouse_root=tmp_dir, load_ts=TS)
        assert res[0].main.total == 1000
    assert spark.table(f"{dbs['ods']}.erp_events").count() == res[0].main.clean


def test_managed_landing_table_is_not_dropped(spark, meta, dbs, tmp_dir):
    spark.sql(f"CREATE DATABASE {dbs['ldg']} LOCATION '{tmp_dir}/managed.db'")
    fx.landed_events(spark, SF).write.partitionBy("load_dt").saveAsTable(f"{dbs['ldg']}.erp_events")
    res = run_load(spark, meta, DAY, files=["EVENTS"], databases=dbs, warehouse_root=tmp_dir, load_ts=TS)
    assert res[0].main.total == 1000 and spark.table(f"{dbs['ldg']}.erp_events").count() == 1000


def test_absent_day_is_an_error(spark, meta, dbs, tmp_dir):
    with pytest.raises(LoadError, match="no landing folder") as e:
        run_load(spark, meta, "2022-01-01", files=["ORDERS"], databases=dbs, warehouse_root=tmp_dir, load_ts=TS)
    assert isinstance(e.value.results[0].error, FileNotFoundError)


def write_lines(folder, lines):
    os.makedirs(f"{folder}/load_dt={DAY}")
    with open(f"{folder}/load_dt={DAY}/part.csv", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_no_line_is_lost(spark, tmp_dir):
    cols = ["a", "b", "c"]
    write_lines(tmp_dir + "/x", ["a,b,c", "1,2,3", "", "  ", '4,"x\\"y"', '5,"p,q"', "6,,", "7,8,9,10", '8,\\"u,v', ""])
    got = {tuple(r) for r in L.read_landing_csv(spark, tmp_dir + "/x", cols, load_dt=DAY).select(*cols).collect()}
    assert {("1", "2", "3"), (None, None, None), ("  ", None, None), ("4", 'x"y', None), ("5", "p,q", None), ("6", "", ""),
            ("7", "8", "9")} <= got
    assert L.read_landing_csv(spark, tmp_dir + "/x", cols, load_dt=DAY).count() == 9


def test_only_the_days_folder_is_listed(spark, tmp_dir):
    for day in ("2022-09-09", "2022-09-10", DAY):
        fx.landed_orders(spark, SF, day).coalesce(1).write.parquet(f"{tmp_dir}/t/load_dt={day}")
    df = L.read_landing(spark, tmp_dir + "/t", "parquet", fx.ORDER_COLUMNS, load_dt=DAY)
    assert all(f"load_dt={DAY}" in f for f in df.inputFiles()) and len(df.inputFiles()) == 1
    assert {r[0] for r in df.select("load_dt").distinct().collect()} == {DAY}
    assert "InMemoryFileIndex(1 paths)" in df._jdf.queryExecution().executedPlan().toString()


def test_repeated_keys_reads_keys_only(spark, tmp_dir):
    cols = fx.ORDER_COLUMNS
    fx.landed_orders(spark, SF).drop("load_dt").write.parquet(tmp_dir + "/o")
    df = spark.read.parquet(tmp_dir + "/o")
    # a real row whose key is the header's, twice, beside true header rows
    odd = spark.createDataFrame([("order_id", "1", "F", "1", "2", "3")] * 2 + [tuple(cols)] * 3, df.schema)
    for rows in (df, df.unionAll(odd), df.unionAll(odd.limit(1))):
        want = {r[0] for r in duplicate_keys(drop_header_rows(rows, cols), ["order_id"]).collect()}
        assert {r[0] for r in repeated_keys(rows, cols, ["order_id"]).collect()} == want
    scans = [x for x in repeated_keys(df, cols, ["order_id"])._jdf.queryExecution().executedPlan().toString().split("FileScan")[1:]]
    assert len(scans) == 2
    assert "ReadSchema: struct<order_id:string>" in scans[0] or "ReadSchema: struct<order_id:string>" in scans[1]
    pushed = [x for x in scans if "EqualNullSafe(order_id,order_id)" in x or "EqualTo(order_id,order_id)" in x]
    assert len(pushed) == 1


def test_byte_true_broadcast_bound(spark):
    keys = spark.createDataFrame([(f"键值{i:04d}",) for i in range(1000)], "k string")
    true = 1000 * (6 + 4 + 48)
    for limit, fits in ((true, True), (true - 1, False)):
        side = measure(keys, ["k"], limit)
        assert side.bytes == true and side.broadcast is fits
        side.release()


def test_no_cache_for_a_broadcast_side(spark, meta, dbs, tmp_dir):
    run_load(spark, meta, DAY, files=["ORDERS"], databases=dbs, warehouse_root=tmp_dir, create_only=True)
    spec = M.file_specs(meta, ["ORDERS"], dbs)[0]
    sc = spark.sparkContext
    before, group = len(sc._jsc.getPersistentRDDs()), "jobs-of-one-table"
    sc.setJobGroup(group, "count")
    try:
        validate_and_split(spark, fx.landed_orders(spark, SF), spec.rules, spec.keys, spec.tables.stg, spec.tables.rej, DAY)
        jobs = len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc._jsc.getPersistentRDDs()) == before
    print("jobs", jobs)
    with pytest.raises(ValueError, match="without rule"):     # before any job, and nothing stays cached
        validate_and_split(spark, fx.landed_orders(spark, SF).withColumn("more", F.lit("x")), spec.rules, spec.keys,
                           spec.tables.stg, spec.tables.rej, DAY, cache_landing=True)
    assert len(sc._jsc.getPersistentRDDs()) == before


def test_a_repeated_name_loads_once(spark, meta, dbs, tmp_dir):
    res = run_load(spark, meta, DAY, files=["CUSTOMER", "CUSTOMER"], databases=dbs, warehouse_root=tmp_dir, load_ts=TS,
                   landing=lambda spec, pk: fx.landed_customer(spark, SF))
    assert [r.file_name for r in res] == ["CUSTOMER"]


def test_one_result_per_file(spark, meta, dbs, tmp_dir):
    def source(spec, pk):
        if spec.file_name == "EVENTS":
            raise OSError("gone")
        return fx.landed_customer(spark, SF)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        with pytest.raises(LoadError, match="EVENTS: gone") as e:
            run_load(spark, meta, DAY, files=["EVENTS", "CUSTOMER"], databases=dbs, warehouse_root=tmp_dir, load_ts=TS,
                     landing=source)
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "static"
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    by = {r.file_name: r for r in e.value.results}
    assert by["CUSTOMER"].ods == "full" and by["CUSTOMER"].error is None and isinstance(by["EVENTS"].error, OSError)


def test_feeds_run_in_the_files_pool(spark, meta, dbs, tmp_dir):
    seen = []

    def source(spec, pk):
        seen.append((pk, spark.sparkContext.getLocalProperty("spark.scheduler.pool")))
        return fx.landed_orders_pk(spark, SF) if pk else fx.landed_orders(spark, SF)
    run_load(spark, meta, DAY, files=["ORDERS"], databases=dbs, warehouse_root=tmp_dir, load_ts=TS, landing=source)
    assert sorted(seen) == [(False, "landfall_crm_orders"), (True, "landfall_crm_orders")]


def test_unknown_strategy_is_refused(spark, meta):
    odd = {**meta, "interface_file": meta["interface_file"].withColumns(
        {"full_delta": F.lit("Sometimes"), "load_solution": F.lit(None).cast("string")})}
    with pytest.raises(ValueError, match="neither loaded by key"):
        M.file_specs(odd, ["ORDERS"])


def test_empty_load_key_is_refused(spark, meta, dbs, tmp_dir):
    run_load(spark, meta, DAY, files=["EVENTS"], databases=dbs, warehouse_root=tmp_dir, create_only=True)
    spec = M.file_specs(meta, ["EVENTS"], dbs)[0]
    fields = spark.table(spec.tables.ods).schema
    rows = lambda key: spark.range(1).select(*[
        (F.lit(key) if f.name == "event_type" else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
    write_ods(spark, rows("click"), spec, DAY)
    with pytest.raises(Exception, match="empty load key"):
        write_ods(spark, rows(""), spec, DAY)
    assert [r["event_type"] for r in spark.table(spec.tables.ods).collect()] == ["click"]


def test_flag_is_rendered_from_violations(spark, meta):
    spec = M.file_specs(meta, ["ORDERS"])[0]
    plain = validate(fx.landed_orders(spark, SF), spec.rules, spec.keys)
    both = validate(fx.landed_orders(spark, SF), spec.rules, spec.keys, structured=True)
    assert sorted(map(str, plain.collect())) == sorted(map(str, both.drop(VIOLATIONS).select(*plain.columns).collect()))
    assert both.where(F.size(VIOLATIONS) == 0).count() == plain.where("flag = ''").count()
    assert S.V2.check_castable is False

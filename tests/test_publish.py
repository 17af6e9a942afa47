"""One write of both layers, published together or not at all."""

import os

import pytest
from pyspark.sql import functions as F

from landfall.operators import publish as P
from landfall.operators import sinks
from landfall.plans import metadata as M
from landfall.plans.load import run_load, validate_and_split
from landfall.sources import fixtures as fx
from landfall.sources import landing as L

SF, DAY, TS = "/root/testdata/sf0.001", "2022-09-11", "2022-09-12 01:00:00"


@pytest.fixture()
def orders(spark, meta, request, tmp_dir):
    dbs = {k: f"pub_{abs(hash(request.node.name)) % 10**8}_{k}" for k in ("ldg", "stg", "rej", "ods")}
    run_load(spark, meta, DAY, files=["ORDERS"], databases=dbs, warehouse_root=tmp_dir, create_only=True)
    return M.file_specs(meta, ["ORDERS"], dbs)[0]


def split(spark, spec, landing=None, **kw):
    return validate_and_split(spark, fx.landed_orders(spark, SF) if landing is None else landing, spec.rules, spec.keys,
                              spec.tables.stg, spec.tables.rej, DAY, **kw)


def held(spark, spec):
    stg, rej = (L.read_table_for_date(spark, t, DAY) for t in (spec.tables.stg, spec.tables.rej))
    return sorted(map(str, stg.collect())), sorted(map(str, rej.collect()))


def folders(path):
    return {d for d, _, names in os.walk(path) if any(n.endswith(".orc") for n in names)}


def test_one_full_scan_and_four_jobs(spark, orders, tmp_dir):
    fx.landed_orders(spark, SF).repartition(6).write.partitionBy("load_dt").parquet(tmp_dir + "/landed")
    landing = L.read_landing(spark, tmp_dir + "/landed", "parquet", fx.ORDER_COLUMNS, load_dt=DAY)
    plans = []
    seen = P.stage_layers

    def staged(rows, layer, folder, fmt, *rest):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        seen(rows, layer, folder, fmt, *rest)
    sc = spark.sparkContext
    sc.setJobGroup("one-pass", "count")
    P.stage_layers = staged
    try:
        counts = split(spark, orders, landing)
        jobs = len(sc.statusTracker().getJobIdsForGroup("one-pass"))
    finally:
        P.stage_layers = seen
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert (counts.total, counts.clean, counts.rejected, counts.blank) == (1516, 1372, 128, 16)
    assert jobs <= 4
    scans = [x for x in plans[0].split("FileScan")[1:] if "total_price" in x.split("ReadSchema")[1].split("\n")[0]]
    assert len(plans) == 1 and len(scans) == 1
    assert "Sort" not in plans[0].split("BroadcastExchange")[0]


def test_layers_equal_the_frames(spark, orders):
    from landfall.operators.split import clean_rows, reject_rows
    from landfall.operators.validate import validate
    split(spark, orders)
    v = validate(fx.landed_orders(spark, SF), orders.rules, orders.keys)
    stg, rej = held(spark, orders)
    assert stg == sorted(map(str, clean_rows(v, orders.columns).withColumn("load_dt", F.lit(DAY)).collect()))
    assert rej == sorted(map(str, reject_rows(v, orders.columns).withColumn("load_dt", F.lit(DAY)).collect()))


def test_failed_write_changes_nothing(spark, orders, tmp_dir):
    split(spark, orders)
    before, files = held(spark, orders), folders(tmp_dir)
    bad = fx.landed_orders(spark, SF).withColumn("priority", F.when(F.col("order_id") == "1001", F.raise_error(F.lit("lost")).cast("string"))
                                                 .otherwise(F.col("priority")))
    with pytest.raises(Exception, match="lost"):
        split(spark, orders, bad)
    assert held(spark, orders) == before and folders(tmp_dir) == files


@pytest.mark.parametrize("first", [True, False])
def test_second_publication_fails_and_the_first_is_taken_back(spark, orders, monkeypatch, tmp_dir, first):
    """Whether the partitions were there before or not."""
    if not first:
        split(spark, orders)
    before, files = held(spark, orders), folders(tmp_dir)
    point, calls = P.point, []

    def failing(spark_, t, folder, shown):
        calls.append(t.table)
        if len(calls) == 2:
            raise OSError("catalog gone")
        point(spark_, t, folder, shown)
    monkeypatch.setattr(P, "point", failing)
    with pytest.raises(OSError, match="catalog gone"):
        split(spark, orders, fx.landed_orders(spark, SF).where("status = 'F'"))
    monkeypatch.setattr(P, "point", point)
    assert calls == [orders.tables.stg, orders.tables.rej, orders.tables.stg]
    assert held(spark, orders) == before and folders(tmp_dir) == files
    assert split(spark, orders).clean == 1372


def test_replaced_versions_go(spark, orders, tmp_dir):
    for _ in range(3):
        split(spark, orders)
    assert len(folders(tmp_dir)) == 2
    empty = split(spark, orders, fx.landed_orders(spark, SF).where("false"))
    assert empty.total == 0 and held(spark, orders) == ([], [])
    assert folders(tmp_dir) == set()
    assert split(spark, orders).clean == 1372


def test_static_overwrite_after_a_publication(spark, orders):
    """Other writers of the same partition still work."""
    split(spark, orders)
    rows = spark.createDataFrame([("1",) + ("x",) * 5], orders.columns)
    sinks.overwrite_partition(spark, rows, orders.tables.stg, "load_dt", DAY, orders.columns)
    assert L.read_table_for_date(spark, orders.tables.stg, DAY).count() == 1
    assert split(spark, orders).clean == 1372 and len(held(spark, orders)[0]) == 1372


def test_small_reject_files_are_compacted(spark, orders, tmp_dir, monkeypatch):
    monkeypatch.setattr(P.compacted, "__defaults__", (4, 16 << 20))
    many = fx.landed_orders(spark, SF).repartition(24)
    split(spark, orders, many)
    rejects = [f for f in L.read_table_for_date(spark, orders.tables.rej, DAY).inputFiles()]
    assert len(rejects) <= 4 and len(held(spark, orders)[1]) == 128


def test_column_named_like_the_layer(spark, tmp_dir):
    assert P.layer_name(["a", "LF_LAYER"]) == "lf_layer_"


def test_full_load_keeps_its_rows_when_the_write_fails(spark, meta, request, tmp_dir):
    dbs = {k: f"pubfull_{k}" for k in ("ldg", "stg", "rej", "ods")}
    landing = lambda spec, pk: fx.landed_customer(spark, SF)
    run_load(spark, meta, DAY, files=["CUSTOMER"], databases=dbs, warehouse_root=tmp_dir, landing=landing, load_ts=TS)
    spec = M.file_specs(meta, ["CUSTOMER"], dbs)[0]
    before = sorted(map(str, spark.table(spec.tables.ods).collect()))
    assert before
    bad = spark.table(spec.tables.ods).withColumn("c_name", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_ods(spark, bad, spec, DAY)
    assert sorted(map(str, spark.table(spec.tables.ods).collect())) == before
    # A full load may even read the table it replaces: the rows are written before it changes.
    sinks.write_ods(spark, spark.table(spec.tables.ods).where("c_custkey % 2 = 0"), spec, DAY)
    assert 0 < spark.table(spec.tables.ods).count() < len(before)


def test_reload_of_one_date_keeps_the_others(spark, meta, orders):
    for day in ("2022-09-10", DAY):
        validate_and_split(spark, fx.landed_orders(spark, SF, day), orders.rules, orders.keys, orders.tables.stg, orders.tables.rej, day)
    split(spark, orders, fx.landed_orders(spark, SF).where("status = 'F'"))
    assert L.read_table_for_date(spark, orders.tables.stg, "2022-09-10").count() == 1372
    assert 0 < L.read_table_for_date(spark, orders.tables.stg, DAY).count() < 1372


def test_working_folders_go_with_the_driver(tmp_dir):
    """A driver of its own: what it measured and did not release is gone after it ends."""
    import subprocess
    import sys
    code = (f"from landfall.session import local_session; from landfall.operators.sizing import measure\n"
            f"s = local_session(1, 1, extra={{'spark.checkpoint.dir': '{tmp_dir}/shared'}})\n"
            f"side = measure(s.range(5).selectExpr('cast(id as string) k'), ['k'])\n"
            f"import os; print('there', side.rows, len(os.listdir('{tmp_dir}/shared')))\ns.stop()")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120,
                         cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert "there 5 " in out.stdout, out.stderr[-2000:]
    assert not [d for d in os.listdir(tmp_dir + "/shared") if d.startswith("side")]

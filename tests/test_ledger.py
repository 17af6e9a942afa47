"""Records of every stage, resumed runs, retries and the order of files."""

import os

import pytest
from pyspark.sql import functions as F

from landfall.plans import load as PL
from landfall.plans.ledger import load_summary, read_ledger
from landfall.plans.load import LoadError, run_load
from landfall.sources import fixtures as fx

SF, DAY, TS = "/root/testdata/sf0.001", "2022-09-11", "2022-09-12 01:00:00"
FILES = ["ORDERS", "CUSTOMER", "EVENTS"]


@pytest.fixture()
def dbs(request):
    return {k: f"led_{abs(hash(request.node.name)) % 10**8}_{k}" for k in ("ldg", "stg", "rej", "ods")}


def source(spark, fail=lambda spec, pk: None):
    frames = {("ORDERS", False): fx.landed_orders, ("ORDERS", True): fx.landed_orders_pk,
              ("CUSTOMER", False): fx.landed_customer, ("EVENTS", False): fx.landed_events}

    def read(spec, pk):
        fail(spec, pk)
        return frames[spec.file_name, pk](spark, SF)
    return read


def states(spark, folder):
    return sorted((r["file_name"], r["stage"], r["state"]) for r in read_ledger(spark, folder).collect())


def test_every_stage_is_recorded_and_counts_add_up(spark, meta, dbs, tmp_dir):
    led = tmp_dir + "/ledger"
    res = run_load(spark, meta, DAY, files=FILES, databases=dbs, warehouse_root=tmp_dir, landing=source(spark), load_ts=TS, ledger=led)
    assert states(spark, led) == sorted([(f, s, "done") for f in FILES for s in ("validate", "ods")] + [("ORDERS", "validate_feed", "done")])
    rows = {r["file_name"]: r for r in load_summary(read_ledger(spark, led)).collect()}
    for r in res:
        got = rows[r.file_name]
        assert (got["total"], got["clean"], got["rejected"], got["blank"]) == (r.main.total, r.main.clean, r.main.rejected, r.main.blank)
        assert got["total"] == got["clean"] + got["rejected"] + got["blank"] and got["failed"] == 0
    assert {r["done"] for r in rows.values()} == {2, 3}


def test_resume_redoes_only_what_is_missing(spark, meta, dbs, tmp_dir, monkeypatch):
    led, ran = tmp_dir + "/ledger", []
    split, to_ods = PL.validate_and_split, PL.load_to_ods
    monkeypatch.setattr(PL, "validate_and_split", lambda *a, **k: (ran.append(a[4].split(".")[1]), split(*a, **k))[1])
    monkeypatch.setattr(PL, "load_to_ods", lambda s, spec, *a, **k: (ran.append("ods " + spec.file_name), to_ods(s, spec, *a, **k))[1])
    broken = {"EVENTS": True}

    def fail(spec, pk):
        if broken.get(spec.file_name):
            raise OSError("store is away")
    args = dict(files=FILES, databases=dbs, warehouse_root=tmp_dir, landing=source(spark, fail), load_ts=TS, ledger=led, attempts=1)
    with pytest.raises(LoadError) as e:
        run_load(spark, meta, DAY, **args)
    assert [r.file_name for r in e.value.results if r.error] == ["EVENTS"]
    first = {r.file_name: r for r in e.value.results}
    ran.clear()
    broken.clear()
    res = {r.file_name: r for r in run_load(spark, meta, DAY, resume=True, **args)}
    assert sorted(ran) == ["erp_events", "ods EVENTS"]
    assert res["ORDERS"].main == first["ORDERS"].main and res["ORDERS"].delete_feed == first["ORDERS"].delete_feed
    assert [res[f].ods for f in FILES] == ["load_date", "full", "load_key"]
    runs = load_summary(read_ledger(spark, led)).collect()
    assert len({r["run_id"] for r in runs}) == 1 and sum(r["total"] for r in runs) == sum(r.main.total for r in res.values())
    ran.clear()
    run_load(spark, meta, DAY, resume=True, **args)                # nothing is missing
    assert ran == []
    run_load(spark, meta, DAY, **args)                             # a new run does everything
    assert len(ran) == 7
    other = run_load(spark, meta, "2022-09-10", resume=True, **{**args, "files": ["CUSTOMER"]})   # another date: nothing to resume
    assert other[0].ods == "full"


def test_a_failed_stage_is_tried_once_more(spark, meta, dbs, tmp_dir):
    led, tries = tmp_dir + "/ledger", []

    def fail(spec, pk):
        tries.append(spec.file_name)
        if spec.file_name == "CUSTOMER" and tries.count("CUSTOMER") == 2:     # the first read is for the size
            raise OSError("executor lost")
    res = {r.file_name: r for r in run_load(spark, meta, DAY, files=["CUSTOMER", "EVENTS"], databases=dbs, warehouse_root=tmp_dir,
                                            landing=source(spark, fail), load_ts=TS, ledger=led)}
    assert res["CUSTOMER"].extra["tries"] == {"validate": 2, "ods": 1} and res["EVENTS"].extra["tries"] == {"validate": 1, "ods": 1}
    assert ("CUSTOMER", "validate", "failed") in states(spark, led) and ("CUSTOMER", "validate", "done") in states(spark, led)
    note = read_ledger(spark, led).where("state = 'failed'").first()["note"]
    assert note == "OSError: executor lost"


def test_errors_of_the_metadata_are_not_tried_again(spark, meta, dbs, tmp_dir):
    def odd(spec, pk):
        return fx.landed_customer(spark, SF).withColumn("more", F.lit("x"))
    with pytest.raises(LoadError, match="without rule") as e:
        run_load(spark, meta, DAY, files=["CUSTOMER"], databases=dbs, warehouse_root=tmp_dir, landing=odd, load_ts=TS)
    assert e.value.results[0].error is not None


def test_largest_files_begin_first(spark, meta, dbs, tmp_dir):
    """One large and two small files, one at a time: by landed bytes, not as named."""
    for name, df in (("ORDERS", fx.landed_orders(spark, SF).limit(50)), ("CUSTOMER", fx.landed_customer(spark, SF).limit(5)),
                     ("EVENTS", fx.landed_events(spark, SF))):
        df.coalesce(1).write.partitionBy("load_dt").parquet(f"{tmp_dir}/l/{name}")
    fx.landed_orders_pk(spark, SF).write.partitionBy("load_dt").parquet(f"{tmp_dir}/l/ORDERS_PK")

    def read(spec, pk):
        return spark.read.schema(", ".join(f"{c} string" for c in [*(spec.keys if pk else spec.columns), "load_dt"])).parquet(
            f"{tmp_dir}/l/{spec.file_name}{'_PK' if pk else ''}")
    size = {n: sum(os.path.getsize(f"{tmp_dir}/l/{n}/load_dt={DAY}/{f}") for f in os.listdir(f"{tmp_dir}/l/{n}/load_dt={DAY}")
                   if f.endswith(".parquet")) for n in FILES}
    res = run_load(spark, meta, DAY, files=["CUSTOMER", "ORDERS", "EVENTS"], databases=dbs, warehouse_root=tmp_dir, landing=read,
                   load_ts=TS, max_parallel=1)
    assert [r.file_name for r in res] == ["CUSTOMER", "ORDERS", "EVENTS"]              # results as named
    assert {r.file_name: r.extra["landed_bytes"] for r in res} == size
    assert [r.file_name for r in sorted(res, key=lambda r: r.extra["began"])] == ["EVENTS", "ORDERS", "CUSTOMER"]


def test_an_empty_ledger(spark, tmp_dir):
    assert read_ledger(spark, tmp_dir + "/none").count() == 0 and load_summary(read_ledger(spark, tmp_dir + "/none")).count() == 0

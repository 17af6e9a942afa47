"""CSV landing: one scan, every line kept, headers told by what they say and checked."""

import os

import pytest

from landfall.plans import metadata as M
from landfall.plans.load import run_load, validate_and_split
from landfall.sources import fixtures as fx
from landfall.sources import landing as L

SF, DAY, TS = "/root/testdata/sf0.001", "2022-09-11", "2022-09-12 01:00:00"
COLS = ["a", "b", "c"]


def write(folder, files):
    os.makedirs(f"{folder}/load_dt={DAY}")
    for i, lines in enumerate(files):
        with open(f"{folder}/load_dt={DAY}/part{i}.csv", "w") as f:
            f.write("".join(line + "\n" for line in lines))
    return folder


def rows(df):
    return sorted(map(str, df.select(*COLS).collect()))


LINES = ["1,2,3", "", "  ", "\t", '4,"x\\"y"', '5,"p,q"', "6,,", "7,8,9,10", '8,\\"u,v', ",,", '"",1,2', ' 9 , "s" ,t', '"a', "ü,中,\x0b", "a,b,x"]


def test_one_file_scan(spark, tmp_dir):
    df = L.read_landing_csv(spark, write(tmp_dir + "/x", [["a,b,c", *LINES]]), COLS, load_dt=DAY, header_by="name")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "InMemoryTableScan" not in plan


@pytest.mark.parametrize("header", ["a,b,c", "A, b ,C", '"a","b","c"'])
def test_equals_the_reader_by_position(spark, tmp_dir, header):
    path = write(tmp_dir + "/x", [[header, *LINES], ["", header, "q,r,s"], [header]])
    df = L.read_landing_csv(spark, path, COLS, load_dt=DAY, header_by="name")
    assert rows(df) == rows(L.read_landing_csv(spark, path, COLS, load_dt=DAY, header_by="position"))
    df.header_check()


@pytest.mark.parametrize("files, found", [
    ([["x,y,z", "1,2,3"]], 0),                                   # another header
    ([["a,b,c", "1,2,3"], ["1,2,3"]], 1),                        # a file without one
    ([["a,b,c", "1,2,3", "A,B,C"]], 2),                          # one inside the data
    ([["a,b,c", "a,b,c", "1,2,3"], ["4,5,6"]], 2),               # as many as files, but not one in each
])
def test_header_mismatch(spark, tmp_dir, files, found):
    path = write(tmp_dir + "/x", files)
    df = L.read_landing_csv(spark, path, COLS, load_dt=DAY, header_by="name")
    df.count()
    with pytest.raises(L.HeaderMismatch, match=f"^{found} lines"):
        df.header_check()
    by_position = rows(L.read_landing_csv(spark, path, COLS, load_dt=DAY, header_by="position"))
    assert len(by_position) == sum(len(f) - 1 for f in files)


def test_without_header_and_without_files(spark, tmp_dir):
    path = write(tmp_dir + "/x", [LINES, ["a,b,c"]])
    df = L.read_landing_csv(spark, path, COLS, header=False, load_dt=DAY)
    assert df.count() == len(LINES) + 1 and not hasattr(df, "header_check")
    os.makedirs(f"{tmp_dir}/y/load_dt={DAY}")
    empty = L.read_landing_csv(spark, tmp_dir + "/y", COLS, load_dt=DAY, header_by="name")
    assert empty.count() == 0
    empty.header_check()


def landed_csv(spark, root, header):
    from pyspark.sql import functions as F
    for df, folder in ((fx.landed_orders(spark, SF), "crm_orders"), (fx.landed_orders_pk(spark, SF), "crm_orders_pk")):
        named = df.select(*[F.col(c).alias(c if c == "load_dt" else header(c)) for c in df.columns])
        named.repartition(3).write.option("header", True).option("emptyValue", "").partitionBy("load_dt").csv(f"{root}/CRM/{folder}")
    return root


@pytest.mark.parametrize("name, header", [("same", str), ("upper", str.upper), ("other", lambda c: f"col {c}")])
def test_load_reads_each_file_from_its_second_line(spark, meta, tmp_dir, name, header):
    dbs = {k: f"csv_{name}_{k}" for k in ("ldg", "stg", "rej", "ods")}
    root = landed_csv(spark, tmp_dir + "/landing", header)
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    res = run_load(spark, meta, DAY, files=["ORDERS"], databases=dbs, warehouse_root=tmp_dir, landing_root=root, load_ts=TS)[0]
    assert res.main.total == 1516 and res.main.clean == res.main.total - res.main.rejected - res.main.blank
    assert res.delete_feed.total == res.delete_feed.clean and res.extra["tries"] == {"validate": 1, "validate_feed": 1, "ods": 1}
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before
    assert spark.table(f"{dbs['ods']}.crm_orders").count() == res.main.clean


def test_no_raw_cache(spark, meta, tmp_dir, monkeypatch):
    """Nothing is persisted: the day's rows are read again, the duplicate keys are a written table."""
    DataFrame = type(spark.range(0))
    dbs = {k: f"csv_cache_{k}" for k in ("ldg", "stg", "rej", "ods")}
    root = landed_csv(spark, tmp_dir + "/landing", str)
    kept, persist = [], DataFrame.persist
    monkeypatch.setattr(DataFrame, "persist", lambda self, *a: (kept.append(self.columns), persist(self, *a))[1])
    run_load(spark, meta, DAY, files=["ORDERS"], databases=dbs, warehouse_root=tmp_dir, landing_root=root, load_ts=TS)
    assert kept == []


def test_nothing_is_published_before_the_headers_are_checked(spark, meta, tmp_dir):
    dbs = {k: f"csv_pub_{k}" for k in ("ldg", "stg", "rej", "ods")}
    run_load(spark, meta, DAY, files=["ORDERS"], databases=dbs, warehouse_root=tmp_dir, create_only=True)
    spec = M.file_specs(meta, ["ORDERS"], dbs)[0]
    path = landed_csv(spark, tmp_dir + "/landing", lambda c: "x" + c) + "/CRM/crm_orders"
    for keys in (spec.keys, ()):
        landing = L.read_landing_csv(spark, path, spec.columns, load_dt=DAY, header_by="name")
        with pytest.raises(L.HeaderMismatch):
            validate_and_split(spark, landing, spec.rules, keys, spec.tables.stg, spec.tables.rej, DAY)
    assert spark.table(spec.tables.stg).count() == 0

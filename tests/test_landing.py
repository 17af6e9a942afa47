"""CSV landing reader: empty vs missing fields (FIXTURES.md §2.4), partition reads."""

import os

from pyspark.sql import functions as F

from landfall import spec as S
from landfall.operators.validate import validate
from landfall.sources import landing as L

CSV = "id,ts,kind\n1,a,A,EXTRA\n2,,\n3,\n4,\"x,y\",B\n5\nid,ts,kind\n"


def write_csv(root):
    d = os.path.join(root, "load_dt=2022-09-11")
    os.makedirs(d)
    with open(os.path.join(d, "part-0.csv"), "w") as f:
        f.write(CSV)
    return root


def test_empty_vs_missing(spark, tmp_dir):
    path = write_csv(os.path.join(tmp_dir, "csv"))
    df = L.read_landing_csv(spark, path, ["id", "ts", "kind"])
    rows = {r["id"]: (r["ts"], r["kind"], r["load_dt"]) for r in df.collect()}
    assert rows["1"] == ("a", "A", "2022-09-11")       # too long: kept
    assert rows["2"] == ("", "", "2022-09-11")         # empties
    assert rows["3"] == ("", None, "2022-09-11")       # short row
    assert rows["4"] == ("x,y", "B", "2022-09-11")     # quoted separator
    assert rows["5"] == (None, None, "2022-09-11")     # short row
    assert rows["id"] == ("ts", "kind", "2022-09-11")  # second header survives the reader...
    rules = [S.ColumnRule("id", check="int"), S.ColumnRule("ts"), S.ColumnRule("kind")]
    flags = {r["id"]: r["flag"] for r in validate(df, rules, ["id"]).collect()}
    assert "id" not in flags                           # ...and is dropped by the header filter
    assert flags == {"1": "", "2": "", "3": "错行数据", "4": "", "5": "错行数据"}


def test_partition_filter_reaches_scan(spark, tmp_dir):
    path = os.path.join(tmp_dir, "pq")
    df = spark.range(10).select(F.col("id").cast("string").alias("id"),
                                F.when(F.col("id") < 5, "2022-09-10").otherwise("2022-09-11").alias("load_dt"))
    df.write.partitionBy("load_dt").parquet(path)
    one = L.for_load_date(spark.read.parquet(path), "2022-09-11")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_dt" in plan and "2022-09-11" in plan
    assert sorted(r["id"] for r in one.collect()) == ["5", "6", "7", "8", "9"]


def test_other_separator(spark, tmp_dir):
    d = os.path.join(tmp_dir, "psv", "load_dt=2022-09-11")
    os.makedirs(d)
    with open(os.path.join(d, "part-0.csv"), "w") as f:
        f.write("id|ts|kind\n1|a|A\n2||\n3|\n")
    df = L.read_landing_csv(spark, os.path.join(tmp_dir, "psv"), ["id", "ts", "kind"], sep="|")
    rows = {r["id"]: (r["ts"], r["kind"]) for r in df.collect()}
    assert rows == {"1": ("a", "A"), "2": ("", ""), "3": ("", None)}

"""Hashes first, then the keys of suspects: the same duplicate keys, less moved."""

import pytest
from pyspark.sql import functions as F

from landfall.operators import validate as V
from landfall.operators.validate import duplicate_keys, duplicate_side, drop_header_rows, suspect_keys, validate
from landfall.plans import metadata as M
from landfall.sources import fixtures as fx

SF = "/root/testdata/sf0.001"
ROWS = [("1", "a", "x"), ("1", "a", "y"), ("1", "b", "x"), (None, "a", "x"), ("a", None, "x"), (None, None, "x"), (None, None, "y"),
        ("2", "", "x"), ("2", "", "x"), ("12", "3", "x"), ("1", "23", "x"), ("k", "l", "v"), ("k", "l", "v"), ("k", "l", "w")]
COLS, KEYS = ["k", "l", "v"], ["k", "l"]


def keys_of(side):
    return {(r[0], r[1]) for r in side.df.collect()}


@pytest.fixture()
def rows(spark):
    header = [tuple(COLS)] * 2
    return spark.createDataFrame(ROWS + header, "k string, l string, v string").withColumn("load_dt", F.lit("d")).repartition(4)


@pytest.mark.parametrize("one_scan", [False, True])
@pytest.mark.parametrize("limit", [None, 0])
def test_same_keys(rows, one_scan, limit):
    want = {(r["k"], r["l"]) for r in duplicate_keys(drop_header_rows(rows.drop("load_dt"), COLS), KEYS).collect()}
    assert want == {("1", "a"), (None, None), ("2", "")}
    for hash_first in (True, False, None):
        side = duplicate_side(rows, KEYS, limit=limit, one_scan=one_scan, hash_first=hash_first)
        assert keys_of(side) == want and side.rows == 3 and side.broadcast is (limit is None)
        side.release()


def test_colliding_hashes_are_only_suspects(rows, monkeypatch):
    """Every key with one hash: the keys themselves decide."""
    monkeypatch.setattr(V.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    side = duplicate_side(rows, KEYS, hash_first=True)
    assert keys_of(side) == {("1", "a"), (None, None), ("2", "")}
    side.release()


def test_clean_data_has_few_suspects(spark, monkeypatch):
    """Unique keys: nearly no row is looked at again, and the validation joins nothing."""
    lines = fx.landed_lineitem(spark, SF).dropDuplicates(["l_orderkey", "l_linenumber"])
    suspects, bits = suspect_keys(lines, ["l_orderkey", "l_linenumber"])
    assert suspects.rows < lines.count() / 100 and bits < 40
    suspects.release()
    side = duplicate_side(lines, ["l_orderkey", "l_linenumber"])
    assert side.rows == 0
    side.release()
    monkeypatch.setattr(V, "hash_bits", lambda size: 64)       # no two keys share such a hash: the keys are not grouped
    monkeypatch.setattr(V, "repeated_keys", None)
    side = duplicate_side(lines, ["l_orderkey", "l_linenumber"])
    assert side.rows == 0 and side.df.count() == 0
    side.release()


def test_only_hashes_are_shuffled(spark, tmp_dir, rows):
    rows.write.parquet(tmp_dir + "/r")
    df = spark.read.parquet(tmp_dir + "/r")
    seen, measure = [], V.measure
    try:
        V.measure = lambda frame, *a: (seen.append(frame._jdf.queryExecution().executedPlan().toString()), measure(frame, *a))[1]
        suspect_keys(df, KEYS)[0].release()
    finally:
        V.measure = measure
    exchange = [x for x in seen[0].split("\n") if "Exchange" in x]
    assert len(exchange) == 1 and "hashpartitioning(__lf_hash" in exchange[0]
    assert "ReadSchema: struct<k:string,l:string>" in seen[0]


def test_hash_width_follows_the_size():
    assert V.hash_bits(0) == 16 and V.hash_bits(1 << 24) == 30 and V.hash_bits(1 << 34) == 47 and V.hash_bits(100 << 40) == 64 and V.hash_bits(1 << 70) == 64


@pytest.mark.parametrize("limit", [None, 0])
def test_validation_is_unchanged(spark, meta, limit):
    spec = M.file_specs(meta, ["LINEITEM"])[0]
    lines = fx.landed_lineitem(spark, SF)
    want = sorted(map(str, validate(lines, spec.rules, spec.keys).collect()))
    side = duplicate_side(lines, spec.keys, limit=limit)
    assert sorted(map(str, validate(lines, spec.rules, spec.keys, duplicates=side).collect())) == want
    side.release()

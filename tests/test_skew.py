"""A key holding a third of all rows: uniqueness stays exact and the hot partition is split."""

from pyspark.sql import functions as F

from landfall import spec as S
from landfall.operators.validate import validate

RULES = [S.ColumnRule("k", check="int"), S.ColumnRule("v")]

# Small thresholds so that a 30,000-row test already counts as skewed; on a
# cluster the defaults (256MB, factor 5) apply to the same plan.
SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "800",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "100",
}


def landing(spark, n=30000):
    # one third of the rows share key "007"; one in 1000 rows is an all-null blank row
    return (spark.range(n).repartition(8)
            .select(F.when(F.col("id") % 3 == 0, F.lit("007"))
                     .when(F.col("id") % 1000 == 1, F.lit(None))
                     .otherwise(F.col("id").cast("string")).alias("k"),
                    F.when((F.col("id") % 3 != 0) & (F.col("id") % 1000 == 1), F.lit(None))
                     .otherwise(F.lit("x")).alias("v"),
                    F.lit("d").alias("load_dt")))


def test_hot_key_is_split_and_exact(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        v = validate(landing(spark), RULES, ["k"])
        counts = {r["flag"]: r["n"] for r in v.groupBy("flag").agg(F.count(F.lit(1)).alias("n")).collect()}
        rows = v.collect()
        plan = v._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, val in old.items():
            if val is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, val)
    n_hot = len(range(0, 30000, 3))
    n_blank = sum(1 for i in range(30000) if i % 1000 == 1 and i % 3 != 0)
    assert counts["主键未通过[唯一性校验]"] == n_hot
    assert counts["主键未通过[唯一性校验]||错行数据"] == n_blank       # null keys group together
    assert counts[""] == 30000 - n_hot - n_blank
    assert len(rows) == 30000
    assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan


def test_measured_side_decides_the_join(spark):
    from landfall.operators.validate import duplicate_side
    df = landing(spark, 3000)
    results = {}
    for limit, expect in ((0, "SortMergeJoin"), (1 << 30, "BroadcastHashJoin")):
        side = duplicate_side(df, ["k"], limit=limit)
        try:
            assert side.broadcast == (limit > 0)
            assert side.rows == 2                      # key "007" and the null key
            v = validate(df, RULES, ["k"], duplicates=side)
            results[limit] = sorted((tuple(r) for r in v.collect()), key=repr)
            v.collect()
            assert expect in v._jdf.queryExecution().executedPlan().toString()
        finally:
            side.release()
    assert results[0] == results[1 << 30]
    assert results[0] == sorted((tuple(r) for r in validate(df, RULES, ["k"]).collect()), key=repr)


def test_delete_side(spark):
    from landfall.operators.ods import delete_key_side, mark_hard_deletes
    stg = spark.createDataFrame([("1",), ("2",), ("3",)], "k string")
    feed = spark.createDataFrame([("2",), ("2",), ("9",)], "k string")
    for limit in (0, 1 << 20):
        side = delete_key_side(feed, ["k"], limit)
        try:
            got = {r["k"]: r["etl_is_hard_del"] for r in mark_hard_deletes(stg, None, ["k"], side).collect()}
        finally:
            side.release()
        assert side.rows == 2 and got == {"1": 0, "2": 1, "3": 0}


def test_empty_measured_sides_skip_the_join(spark):
    from landfall.operators.ods import delete_key_side, stage_to_ods
    from landfall.operators.validate import duplicate_side
    from pyspark.sql import types as T
    df = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("v"), F.lit("d").alias("load_dt"))
    side = duplicate_side(df, ["k"])
    try:
        assert side.rows == 0
        v = validate(df, RULES, ["k"], duplicates=side)
        assert "Join" not in v._jdf.queryExecution().optimizedPlan().toString()
        assert {r["flag"] for r in v.collect()} == {""}
    finally:
        side.release()
    feed = delete_key_side(df.where("false"), ["k"])
    try:
        schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType()),
                               T.StructField("etl_is_hard_del", T.IntegerType()),
                               T.StructField("etl_created_ts", T.TimestampNTZType()),
                               T.StructField("etl_modified_ts", T.TimestampNTZType()),
                               T.StructField("load_dt", T.StringType())])
        ods = stage_to_ods(df, schema, ["k"], None, "2022-09-12 01:00:00", feed)
        assert "Join" not in ods._jdf.queryExecution().optimizedPlan().toString()
        assert {r["etl_is_hard_del"] for r in ods.collect()} == {0}
    finally:
        feed.release()


def test_hot_key_is_split_inside_the_cached_plan(spark):
    """The load job's merge path: the join runs while the validated rows are cached."""
    from landfall.operators.validate import duplicate_side
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    side = None
    try:
        side = duplicate_side(landing(spark), ["k"], limit=0)
        v = validate(landing(spark), RULES, ["k"], duplicates=side).persist()
        n = v.count()
        plan = v._jdf.queryExecution().executedPlan().toString()
        v.unpersist()
    finally:
        if side is not None:
            side.release()
        for k, val in old.items():
            spark.conf.unset(k) if val is None else spark.conf.set(k, val)
    assert n == 30000 and "SortMergeJoin(skew=true)" in plan

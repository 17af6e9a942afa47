"""Table writers (SNK-1..SNK-6, ODS-3).

* Stage / reject (SNK-1..3): ``INSERT OVERWRITE ... PARTITION (load_dt='d')``
  with a literal value, so a day with no rows still empties its partition.
* ODS by load date (SNK-4) and in full (SNK-5): a staged write that the run's
  partition, or the table, is then pointed at (``publish``).
* ODS by load key (SNK-6): dynamic partition overwrite on the load-key columns
  (the session runs with dynamic partition overwrite, see ``session``).

The load job publishes staging and rejects the same way, both from one write;
``overwrite_partition`` is for other callers. All writes go through Spark's
commit protocol, so a lost executor only re-runs its tasks.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall import spec as S
from landfall.operators import publish


def _sql_literal(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def assert_not_self(source_tables: Sequence[str], target: str) -> None:
    """§7.4.8: a load never overwrites a table it reads."""
    norm = lambda t: t.replace("`", "").lower()
    if norm(target) in {norm(t) for t in source_tables if t}:
        raise ValueError(f"refusing to overwrite {target}: it is also a source of the load")


def overwrite_partition(spark: SparkSession, df: DataFrame, table: str, partition_col: str, value: str,
                        columns: Sequence[str], rebalance: bool = False) -> None:
    """SNK-1/2/3: static overwrite of one partition from ``columns`` of ``df``.

    ``rebalance`` lets AQE size the output files (for sparse outputs such as
    rejects, which would otherwise leave one tiny file per input task).
    """
    if rebalance:
        df = df.hint("rebalance")
    view = f"__lf_src_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(view)
    try:
        cols = ", ".join(f"`{c}`" for c in columns)
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (`{partition_col}` = {_sql_literal(value)}) "
                  f"SELECT {cols} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def overwrite_full(df: DataFrame, table: str) -> None:
    """SNK-5: replace the whole (unpartitioned) table."""
    df.write.insertInto(table, overwrite=True)


def as_table(df: DataFrame, table: str) -> DataFrame:
    """``df`` with the columns of ``table`` in its order; columns that only the table has are null."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[F.col(f"`{have[f.name.lower()]}`").alias(f.name) if f.name.lower() in have
                       else F.lit(None).cast(f.dataType).alias(f.name) for f in df.sparkSession.table(table).schema])


def overwrite_dynamic(df: DataFrame, table: str) -> None:
    """SNK-4 / SNK-6: replace only the partitions present in ``df``.

    ``insertInto`` ignores a per-write overwrite mode, so the session must run
    with ``spark.sql.sources.partitionOverwriteMode=dynamic`` (set by
    ``session.apply_runtime_conf``); refuse rather than wipe other partitions.
    """
    mode = df.sparkSession.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
    if mode.lower() != "dynamic":
        raise RuntimeError("dynamic partition overwrite needs spark.sql.sources.partitionOverwriteMode=dynamic")
    df.write.insertInto(table, overwrite=True)


def write_ods(spark: SparkSession, ods: DataFrame, spec: S.FileSpec, load_dt: str,
              load_date_col: str = "load_dt") -> str:
    """ODS-3: dispatch on the partition strategy; returns what was done.

    By load date and in full, the rows are written to a new folder that the
    partition or the table is then pointed at; a failed write changes nothing.
    """
    table = spec.tables.ods
    strategy = spec.partition_strategy
    if strategy == S.PART_LOAD_KEY:
        # Rebalance by the load keys: a few files per key instead of one per
        # task and key; AQE splits a key holding a large share of the rows.
        # An empty load key has no partition of its own (it would come back as
        # null), so the write fails on one instead of changing it.
        named = ods.withColumns({k: F.when(F.col(k) == "", F.raise_error(F.lit(f"empty load key {k} in {table}")).cast("string"))
                                     .otherwise(F.col(k)) for k in spec.load_keys})
        overwrite_dynamic(as_table(named, table).hint("rebalance", *spec.load_keys), table)
        return "load_key"
    by_date = strategy == S.PART_LOAD_DATE
    if not by_date and strategy != S.PART_NONE:
        raise ValueError(f"{spec.file_name}: no load strategy")
    folder = publish.version_folder(spark, table, load_dt)
    try:
        rows = ods.drop(load_date_col) if by_date else ods
        rows.write.format(publish.table_facts(spark, table)["Provider"]).save(folder)
        publish.publish(spark, [publish.Target(table, folder, *((load_date_col, load_dt) if by_date else ()))])
    except BaseException:
        publish.remove(spark, folder)
        raise
    return "load_date" if by_date else "full"

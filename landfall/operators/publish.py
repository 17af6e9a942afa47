"""Staged writes and their publication (SNK-1..5, ODS-3).

A load never writes into a folder that readers see. Its rows go to a new folder
first, all layers of one frame in a single write with one sub-folder per layer;
then the tables' partitions are pointed at the new folders. Only those catalog
changes publish anything: a job that fails, a lost driver or a refused rule
leaves every table as it was, and when the second change fails the first is
taken back, so the staging and reject rows of a date change together.

Versions lie under ``<database folder>/_versions/<table>/``. A folder that a
publication replaces is removed after it (``keep_replaced`` keeps it).
"""

from __future__ import annotations

import re
import uuid
import warnings
from dataclasses import dataclass
from typing import Optional, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.session import hadoop_path

LAYER = "lf_layer"
# Reject files beyond this number are compacted when they are small.
COMPACT_FILES = 64
COMPACT_BYTES = 16 << 20


def _literal(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Target:
    """A table, or one partition of it (``column`` = ``value``), and the staged folder it is to show."""

    table: str
    folder: str
    column: Optional[str] = None
    value: Optional[str] = None

    @property
    def partition(self) -> str:
        return f" PARTITION (`{self.column}` = {_literal(self.value)})" if self.column else ""


def table_facts(spark: SparkSession, table: str) -> dict:
    """Provider, location and the other facts of a table, from the catalog."""
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}


def version_folder(spark: SparkSession, table: str, tag: str) -> str:
    """A new folder beside the table's own, for one version of it."""
    location = table_facts(spark, table)["Location"].rstrip("/")
    parent, name = location.rsplit("/", 1)
    if "/_versions/" in location:      # the table itself was published before
        parent, name = location.split("/_versions/")[0], location.split("/_versions/")[1].split("/")[0]
    return f"{parent}/_versions/{name}/{tag}-{uuid.uuid4().hex[:12]}"


def layer_name(columns: Sequence[str]) -> str:
    """Name of the layer column beside ``columns``."""
    name, taken = LAYER, {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


@dataclass(frozen=True)
class Buckets:
    """How a table is bucketed: rows of one key lie in one file number of every folder."""

    n: int
    columns: tuple


def bucket_count(spark: SparkSession, size: int, bucket_bytes: int) -> int:
    """Buckets for ``size`` bytes; beyond the number that Spark allows they grow instead."""
    return max(1, min(int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")), -(-size // bucket_bytes)))


def buckets_of(facts: dict) -> Optional[Buckets]:
    """The bucketing of a table, from its facts."""
    if "Num Buckets" not in facts:
        return None
    columns = re.findall(r"`((?:[^`]|``)+)`", facts["Bucket Columns"])
    return Buckets(int(facts["Num Buckets"]), tuple(c.replace("``", "`") for c in columns))


def stage_layers(rows: DataFrame, layer: str, folder: str, fmt: str = "orc", buckets: Optional[Buckets] = None,
                 bucketed_layer: str = "clean") -> None:
    """Write ``rows`` once, in a sub-folder for each value of the column ``layer``; rows where it is null are not written.

    Needs no sort: the session keeps one open file per layer
    (``spark.sql.maxConcurrentOutputFileWriters``). With ``buckets`` the rows of
    ``bucketed_layer`` are dealt out by key first, one task a bucket; the others
    go where their input split says, so a key with many rejects is no hot task.
    """
    rows = rows.where(F.col(layer).isNotNull())
    if buckets is None:
        rows.write.partitionBy(layer).format(fmt).save(folder)
        return
    n = F.lit(buckets.n)
    task = F.when(F.col(layer) == bucketed_layer, F.pmod(F.hash(*buckets.columns), n)).otherwise(F.pmod(F.spark_partition_id(), n))
    name = f"lf_staged_{uuid.uuid4().hex}"
    (rows.repartitionById(buckets.n, task.cast("int")).write.partitionBy(layer).bucketBy(buckets.n, *buckets.columns)
     .option("path", folder).format(fmt).saveAsTable(name))
    rows.sparkSession.sql(f"DROP TABLE {name}")     # only the catalog entry; the files stay


def layer_folder(spark: SparkSession, folder: str, name: str, layer: str) -> str:
    """The sub-folder of one layer, made if no row had that layer."""
    path = f"{folder}/{name}={layer}"
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        fs.mkdirs(p)
    return path


def compacted(spark: SparkSession, folder: str, fmt: str, most_files: int = COMPACT_FILES,
              small: int = COMPACT_BYTES) -> str:
    """``folder``, or a rewrite of it in files of advisory size when it holds many small ones."""
    fs, p = hadoop_path(spark, folder)
    held = fs.getContentSummary(p)
    if held.getFileCount() <= most_files or held.getLength() >= small * held.getFileCount():
        return folder
    target = f"{folder}-compact"
    spark.read.format(fmt).load(folder).hint("rebalance").write.format(fmt).save(target)
    remove(spark, folder)
    return target


def remove(spark: SparkSession, folder: str) -> None:
    fs, p = hadoop_path(spark, folder)
    if fs.exists(p):
        fs.delete(p, True)


def _shown(spark: SparkSession, t: Target) -> Optional[str]:
    """The folder that a target shows now; None for a partition that is not there."""
    if not t.column:
        return table_facts(spark, t.table)["Location"]
    if not spark.sql(f"SHOW PARTITIONS {t.table}{t.partition}").collect():
        return None
    told = [(r["col_name"], r["data_type"]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {t.table}{t.partition}").collect()]
    return next(v for k, v in told if k == "Location")   # the partition's facts come before the table's


def point(spark: SparkSession, t: Target, folder: Optional[str], shown: Optional[str]) -> None:
    """Make a target show ``folder`` (None: drop the partition, whose files are left)."""
    if folder is None:
        spark.sql(f"ALTER TABLE {t.table} DROP IF EXISTS{t.partition}")
    elif t.column and shown is None:
        spark.sql(f"ALTER TABLE {t.table} ADD{t.partition} LOCATION {_literal(folder)}")
    else:
        spark.sql(f"ALTER TABLE {t.table}{t.partition} SET LOCATION {_literal(folder)}")


def publish(spark: SparkSession, targets: Sequence[Target], keep_replaced: bool = False) -> None:
    """Point all targets at their folders, or none: when one cannot be changed, those before it are set back."""
    shown = [_shown(spark, t) for t in targets]
    done: list = []
    try:
        for t, old in zip(targets, shown):
            point(spark, t, t.folder, old)
            done.append((t, old))
    except BaseException:
        for t, old in reversed(done):
            point(spark, t, old, t.folder)
        raise
    if keep_replaced:
        return
    for t, old in zip(targets, shown):
        if old is not None and _path(spark, old) != _path(spark, t.folder):
            try:
                remove(spark, old)
            except Exception as e:      # the tables are right; only files that nothing shows are left
                warnings.warn(f"replaced folder {old} is left: {e}")


def _path(spark: SparkSession, folder: str) -> str:
    return hadoop_path(spark, folder)[1].toUri().getPath()

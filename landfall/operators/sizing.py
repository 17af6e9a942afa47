"""Size-checked join sides.

The small side of the uniqueness join (duplicate keys) and of the hard-delete
join (distinct delete-feed keys) is materialised first and measured: its rows
and the UTF-8 bytes of its key columns, in the same job that fills the cache. It is
broadcast only when that measured size is under the limit; otherwise the join
stays a shuffle join (sort-merge, hot keys split by AQE). Deciding before the
join is planned avoids shuffling the big side only to find the small side fits
in a broadcast.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import Optional, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from landfall.session import hadoop_path, remove_at_exit, scratch_path

# Per-row overhead added to the key bytes when estimating a broadcast
# (UnsafeRow header, null bits, offsets, hash-table slot).
ROW_OVERHEAD_BYTES = 48


def broadcast_limit(spark, limit: Optional[int] = None) -> int:
    """Byte bound for a broadcast: the caller's, else the session's join threshold."""
    if limit is not None:
        return int(limit)
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    try:
        return int(raw)
    except ValueError:  # e.g. "10MB"
        units = {"b": 1, "kb": 1 << 10, "k": 1 << 10, "mb": 1 << 20, "m": 1 << 20, "gb": 1 << 30, "g": 1 << 30}
        num = raw.rstrip("bBkKmMgG")
        return int(float(num) * units[raw[len(num):].lower() or "b"])


def leaf_bytes(df: DataFrame) -> int:
    """Bytes of what a frame reads, from the planner's file listing (partition filters applied)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


@dataclass
class SizedSide:
    df: DataFrame
    rows: int
    bytes: int
    broadcast: bool
    folder: Optional[str]     # None: nothing was written

    def for_join(self) -> DataFrame:
        """The side with its join hint: broadcast under the limit, sort-merge above it."""
        return F.broadcast(self.df) if self.broadcast else self.df.hint("merge")

    def release(self) -> None:
        """Remove the written table, once no frame that reads it is used any more."""
        if self.folder is None:
            return
        fs, path = hadoop_path(self.df.sparkSession, self.folder)
        fs.delete(path, True)


def measure(df: DataFrame, columns: Sequence[str], limit: Optional[int] = None) -> SizedSide:
    """Write ``df`` to the shared folder, observing its rows and key bytes, and
    decide on broadcast from those numbers. A lost executor costs a reread."""
    spark = df.sparkSession
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in columns), F.lit(0))
    obs = Observation(f"size_{uuid.uuid4().hex[:12]}")
    folder = scratch_path(spark, "side")
    df.observe(obs, F.count(F.lit(1)).alias("n"),
               F.coalesce(F.sum(width), F.lit(0)).cast("bigint").alias("b")).write.parquet(folder)
    remove_at_exit(spark, folder)
    m = obs.get
    rows, key_bytes = int(m["n"]), int(m["b"])
    size = key_bytes + rows * ROW_OVERHEAD_BYTES
    lim = broadcast_limit(spark, limit)
    written = spark.read.schema(df.schema).parquet(folder)
    return SizedSide(written, rows, size, broadcast=0 <= size <= lim and lim > 0, folder=folder)

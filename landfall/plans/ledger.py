"""Load ledger (SPL-4, AGG-2): what every stage of every file did, kept beyond the job.

One small file per record, in a folder of its own, so that stages of many files
(and of other applications) can be recorded at the same time. A run is all
stages of one call; a resumed run goes on under the id of the last one of its
date and leaves out the stages that are recorded as done.
"""

from __future__ import annotations

import datetime as _dt
import threading
import uuid
from dataclasses import dataclass
from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.session import hadoop_path

SCHEMA = ("run_id string, file_name string, load_dt string, stage string, state string, total bigint, clean bigint, "
          "rejected bigint, blank bigint, note string, seconds double, recorded_at timestamp_ntz")


@dataclass
class SplitCounts:
    total: int
    clean: int
    rejected: int
    blank: int


@dataclass
class Finished:
    """A stage that a run has done: its counts (validation) or what it wrote (ODS)."""

    counts: Optional[SplitCounts]
    note: str


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Every record; an empty frame when nothing was recorded yet."""
    fs, path = hadoop_path(spark, folder)
    if not fs.exists(path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(folder)


def load_summary(ledger: DataFrame) -> DataFrame:
    """Per date and file the latest run: its stages done and failed, and the counts of its main feed.

    A run whose main feed was validated has total = clean + rejected + blank.
    """
    last = ledger.groupBy("load_dt", "file_name").agg(F.max_by("run_id", F.struct("recorded_at", "run_id")).alias("run_id"))
    main = (F.col("stage") == "validate") & (F.col("state") == "done")
    return (ledger.join(last, ["load_dt", "file_name", "run_id"]).groupBy("load_dt", "file_name", "run_id").agg(
        F.count_if(F.col("state") == "done").alias("done"), F.count_if(F.col("state") == "failed").alias("failed"),
        *[F.max(F.when(main, F.col(c))).alias(c) for c in ("total", "clean", "rejected", "blank")],
        F.max("recorded_at").alias("recorded_at")))


class Ledger:
    """The records of one run."""

    def __init__(self, spark: SparkSession, folder: str, load_dt: str, resume: bool = False):
        self.spark, self.folder, self.load_dt = spark, folder.rstrip("/"), load_dt
        self.run_id = f"{_dt.datetime.now(_dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        self.done: dict = {}
        self.lock = threading.Lock()
        if resume:
            self._take_up()

    def _take_up(self) -> None:
        """Go on with the last run of the date: a few records per file."""
        rows = read_ledger(self.spark, self.folder).where(F.col("load_dt") == self.load_dt)
        last = rows.agg(F.max("run_id")).first()[0]    # ids begin with their time
        if last is None:
            return
        self.run_id = last
        for r in rows.where((F.col("run_id") == last) & (F.col("state") == "done")).collect():
            counts = SplitCounts(r["total"], r["clean"], r["rejected"], r["blank"]) if r["total"] is not None else None
            self.done[r["file_name"], r["stage"]] = Finished(counts, r["note"])

    def finished(self, file_name: str, stage: str) -> Optional[Finished]:
        return self.done.get((file_name, stage))

    def record(self, file_name: str, stage: str, state: str, counts: Optional[SplitCounts] = None, note: str = "",
               seconds: float = 0.0) -> None:
        c = counts or SplitCounts(None, None, None, None)
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        row = (self.run_id, file_name, self.load_dt, stage, state, c.total, c.clean, c.rejected, c.blank, note, seconds, now)
        frame = self.spark.createDataFrame([row], SCHEMA).coalesce(1)
        frame.write.parquet(f"{self.folder}/{self.load_dt}/{self.run_id}/{uuid.uuid4().hex}")
        if state == "done":
            with self.lock:
                self.done[file_name, stage] = Finished(counts, note)

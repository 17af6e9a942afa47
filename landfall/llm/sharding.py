"""Operator 10, sharding by fixed virtual slots.

Records are hashed by content into a fixed number of virtual slots, the bytes
of each slot are summed, and a slot-to-shard map is stored as a versioned
table. Version 0 deals the slots out round robin; rebalancing edits the latest
version by moving slots from the fullest to the emptiest shard, and stores the
edited map as the next version. Data moves only with its slot.

The law kept is ``bytes``: sizes near equal. Equal texts share a slot, so they
share a shard. A slot larger than half a shard's fair share is split into
sub-slots by text; only a text whose rows are together larger than a shard's
fair share is cut further, by id and number among the rows of that id (one shard
cannot hold it under this law).

Only per-slot sums (``slots`` of them, and the sub-slots of large ones) and the
texts above a shard's share (fewer than ``shards``) reach the driver; the map
joined back is bounded by the same numbers.

Defined cases: a null text has no bytes and the crc of an empty text; a null id
comes after every id; an empty table gives an empty result and an untouched
map; columns other than the two named ones are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from landfall.llm.common import from_id_key, id_key, materialise, small_table, table
from landfall.session import scratch_path

SLOTS = 4096
SHARDS = 8
SUBS = 64            # sub-slots of a large slot
BIN_ROWS = 1000      # least rows of a position bin
RUN = 100_000        # rows alike in id and text that are numbered together
_MAP = "version int, slot int, sub int, shard int"
_BINS = "slot int, sub int, bin int, shard int, at long"


def _rebalanced(sizes: dict, shard_of: dict, shards: int, tolerance: float = 1e-4) -> dict:
    """Edit a map: move the unit that best closes the gap from the fullest to the emptiest shard, until none does."""
    shard_of = dict(shard_of)
    load, members = [0] * shards, [[] for _ in range(shards)]
    for unit, shard in shard_of.items():
        load[shard] += sizes.get(unit, 0)
        if sizes.get(unit, 0):
            members[shard].append((sizes[unit], unit))
    fair = max(1.0, sum(load) / shards)
    while True:
        top, low = max(range(shards), key=load.__getitem__), min(range(shards), key=load.__getitem__)
        gap = load[top] - load[low]
        movable = [m for m in members[top] if m[0] < gap]
        if gap <= tolerance * fair or not movable:
            return shard_of
        moved = min(movable, key=lambda m: (abs(gap - 2 * m[0]), m[1]))
        members[top].remove(moved)
        members[low].append(moved)
        shard_of[moved[1]] = low
        load[top] -= moved[0]
        load[low] += moved[0]


def latest_map(spark: SparkSession, path: str) -> tuple[int, dict]:
    rows = spark.read.schema(_MAP).parquet(path)
    version = rows.agg(F.max("version")).first()[0]
    return version, {(r.slot, r.sub): r.shard for r in rows.where(F.col("version") == version).collect()}


def store_map(spark: SparkSession, path: str, version: int, shard_of: dict) -> None:
    rows = [(version, slot, sub, shard) for (slot, sub), shard in sorted(shard_of.items())]
    small_table(spark, rows, _MAP).write.mode("append").parquet(path)


def numbered(records: DataFrame, texts: list) -> DataFrame:
    """The records, those of ``texts`` that are alike in id and text numbered from 1 (``nth``).

    They are counted, and their count is dealt out in runs of ``RUN``: rows that
    share id and text never meet in one task.
    """
    if not texts:
        return records
    columns = [c for c in records.columns if c != "nth"]
    counted = records.where(F.col("th").isin(texts)).groupBy(*columns).agg(F.count("*").alias("rows"))
    runs = counted.withColumn("first", F.explode(F.sequence(F.lit(1).cast("long"), "rows", F.lit(RUN).cast("long")))).repartition("id", "first")
    each = runs.withColumn("nth", F.explode(F.sequence("first", F.least(F.col("first") + RUN - 1, "rows"))))
    return records.where(~F.col("th").isin(texts)).unionByName(each.select(*columns, "nth"))


def slotted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS,
            shards: int = SHARDS) -> tuple[DataFrame, list]:
    """The records with their slot and sub-slot (a working table), and the bytes and rows of each."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    records = docs.select(id_key(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                          F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("th"))
    records = materialise(records.select("*", F.pmod("th", F.lit(slots)).cast("int").alias("slot"), F.lit(1).cast("long").alias("nth")), "slots")
    sums = records.groupBy("slot").agg(F.sum("size").alias("size")).collect()
    total = sum(r["size"] for r in sums)
    large = [r["slot"] for r in sums if 2 * shards * r["size"] > total]  # fewer than 2 * shards
    sub = F.lit(0)
    if large:
        sub = F.when(F.col("slot").isin(large), F.pmod(F.xxhash64("th"), F.lit(SUBS))).otherwise(sub)
        texts = records.where(F.col("slot").isin(large)).groupBy("slot", "th").agg(F.sum("size").alias("size"))
        next_sub = dict.fromkeys(large, SUBS)
        cut = []
        for r in texts.where(F.col("size") * shards > total).orderBy("slot", "th").collect():  # fewer than ``shards``
            n = -(-16 * shards * r["size"] // total)
            sub = F.when(F.col("th") == r["th"], F.pmod(F.xxhash64("id", "nth"), F.lit(n)) + next_sub[r["slot"]]).otherwise(sub)
            next_sub[r["slot"]] += n
            cut.append(r["th"])
        records = numbered(records, cut)
    records = records.withColumn("sub", sub.cast("int"))
    return records, records.groupBy("slot", "sub").agg(F.sum("size").alias("size"), F.count("*").alias("rows")).collect()


def shard_by_slots(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS,
                   shards: int = SHARDS, map_path: "str | None" = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (position in the shard, from 0), grown_shard, virtual_slot, map_version."""
    spark = docs.sparkSession
    records, sums = slotted(docs, id_col, text_col, slots, shards)
    units = {(r["slot"], r["sub"]): r["size"] for r in sums}
    if map_path is None:
        map_path = scratch_path(spark, "slot-map")
        store_map(spark, map_path, 0, {(s, 0): s % shards for s in range(slots)})
    version, shard_of = latest_map(spark, map_path)
    current = {u: shard_of.get(u, shard_of.get((u[0], 0), u[0] % shards)) for u in {*shard_of, *units}}
    edited = _rebalanced(units, current, shards)
    if edited != shard_of:
        version += 1
        store_map(spark, map_path, version, edited)
    # Positions: bins of a slot are counted, bins are laid end to end inside their shard, rows are numbered in their bin.
    most = max(BIN_ROWS, sum(r["rows"] for r in sums) // slots)
    n_bins = {(r["slot"], r["sub"]): -(-r["rows"] // most) for r in sums}
    wide = [(s, u, n) for (s, u), n in sorted(n_bins.items()) if n > 1]
    wide = small_table(spark, wide, "slot int, sub int, bins int")
    records = (records.join(wide, ["slot", "sub"], "left")
               .withColumn("bin", F.pmod(F.xxhash64("id", "nth", F.lit("bin")), F.coalesce("bins", F.lit(1))).cast("int")))
    bins, after = [], [0] * shards
    for r in records.groupBy("slot", "sub", "bin").agg(F.count("*").alias("rows")).orderBy("slot", "sub", "bin").collect():
        shard = edited[r["slot"], r["sub"]]
        bins.append((r["slot"], r["sub"], r["bin"], shard, after[shard]))
        after[shard] += r["rows"]
    bins = small_table(spark, bins, _BINS)  # at most two rows per slot and those of split slots
    place = F.row_number().over(Window.partitionBy("slot", "sub", "bin").orderBy("id", "text_crc32", "size")) - 1
    return (records.withColumn("place", place).join(bins, ["slot", "sub", "bin"])
            .select(from_id_key("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("at") + F.col("place")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
                    F.col("slot").alias("virtual_slot"), F.lit(version).alias("map_version")))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard under the rebalanced slot map."""
    return shard_by_slots(table(spark, sf_dir, "documents"))

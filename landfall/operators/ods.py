"""Stage -> ODS row plan (JOIN-2, JOIN-3, ODS-1, ODS-2).

Hard deletes are a left join of the day's staging rows with the distinct keys
of the day's validated delete feed. The feed side is aggregated to distinct
keys first (partial aggregation, one row per key) so the join never multiplies
rows. In the load job that side is materialised and measured
(``delete_key_side``) and broadcast only under the size limit; otherwise the
join is a sort-merge join (staging keys are unique, so it has no hot key). Where
staging and its key table are bucketed alike by key, a feed above the limit is
joined bucket by bucket, without moving a row of either (``co_located``).
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.operators.sizing import ROW_OVERHEAD_BYTES, SizedSide, measure

HARD_DEL = "etl_is_hard_del"
CREATED = "etl_created_ts"
MODIFIED = "etl_modified_ts"
_HIT = "__lf_hit"


def load_timestamp(load_ts: Optional[str] = None) -> Column:
    """Audit time (wall clock, no time zone): the given ``yyyy-MM-dd HH:mm:ss`` or now, to the second."""
    if load_ts is not None:
        return F.lit(load_ts).cast("timestamp_ntz")
    return F.date_trunc("second", F.localtimestamp()).cast("timestamp_ntz")


def _pk_names(keys: Sequence[str]) -> list[str]:
    return [f"__lf_pk{i}" for i in range(len(keys))]


def delete_key_side(pk_feed: DataFrame, keys: Sequence[str], limit: Optional[int] = None) -> SizedSide:
    """Distinct delete-feed keys, materialised and measured for the join decision."""
    renamed = _pk_names(keys)
    hits = (pk_feed.select(*[F.col(k).alias(r) for k, r in zip(keys, renamed)]).distinct()
            .withColumn(_HIT, F.lit(1)))
    return measure(hits, renamed, limit)


def feed_bytes(pk_feed: DataFrame, keys: Sequence[str]) -> int:
    """Bytes of a broadcast of all the feed's rows, which bounds that of its distinct keys."""
    width = sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys), F.lit(ROW_OVERHEAD_BYTES))
    return int(pk_feed.agg(F.coalesce(F.sum(width), F.lit(0)).cast("bigint")).first()[0])


def mark_hard_deletes(stg: DataFrame, pk_feed: Optional[DataFrame], keys: Sequence[str],
                      side: Optional[SizedSide] = None, co_located: bool = False) -> DataFrame:
    """JOIN-2: ``etl_is_hard_del`` = 1 when the row's key is in the delete feed, else 0."""
    if not keys:
        raise ValueError("a delete feed needs key columns")
    renamed = _pk_names(keys)
    if side is None:
        hits = (pk_feed.select(*[F.col(k).alias(r) for k, r in zip(keys, renamed)]).distinct()
                .withColumn(_HIT, F.lit(1)))
        hits = hits.hint("merge") if co_located else hits
    else:
        hits = side.for_join()
    cond = [stg[k] == hits[r] for k, r in zip(keys, renamed)]
    joined = stg.join(hits, cond, "left")
    return joined.select(*[stg[c] for c in stg.columns],
                         F.coalesce(hits[_HIT], F.lit(0)).cast("int").alias(HARD_DEL))


def without_delete_feed(stg: DataFrame) -> DataFrame:
    """JOIN-3: no delete feed -> nothing is hard-deleted."""
    return stg.withColumn(HARD_DEL, F.lit(0).cast("int"))


def add_audit_columns(df: DataFrame, load_ts: Optional[str] = None) -> DataFrame:
    """ODS-1: created / modified timestamps (the same value on a fresh load)."""
    ts = load_timestamp(load_ts)
    return df.withColumns({CREATED: ts, MODIFIED: ts})


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """ODS-2: cast and order to the target columns; a bad value becomes null (``try_cast``)."""
    out = []
    for f in schema.fields:
        c = F.col(f.name)
        out.append((c if df.schema[f.name].dataType == f.dataType else c.try_cast(f.dataType)).alias(f.name))
    return df.select(*out)


def stage_to_ods(stg: DataFrame, schema: T.StructType, keys: Sequence[str] = (),
                 pk_feed: Optional[DataFrame] = None, load_ts: Optional[str] = None,
                 side: Optional[SizedSide] = None, co_located: bool = False) -> DataFrame:
    """PIPE-3 row plan: hard-delete mark, audit columns, typed ODS columns."""
    has_feed = pk_feed is not None or side is not None
    if side is not None and side.rows == 0:
        has_feed = False    # measured: the day's delete feed is empty, no join needed
    marked = mark_hard_deletes(stg, pk_feed, keys, side, co_located) if has_feed else without_delete_feed(stg)
    return conform(add_audit_columns(marked, load_ts), schema)

"""validate(): one lazy plan that tags every landing row with its violations.

Plan shape (checked with ``explain``):

    scan(landing, PartitionFilters load_dt) -> Filter(not header row)
      -> Project(all checks)            # one codegen stage, no Python
      -> left join (null-safe, on keys) <- HashAggregate(partial) keys count>1

Only the key columns feed the aggregate, with map-side partial counts, so a
key holding a third of all rows costs one hash-table entry per task. In the
load job the duplicate-key set is materialised and measured first
(``duplicate_side``): it is broadcast only when its exact size is under the
limit, otherwise the join back is a sort-merge join whose hot keys AQE splits.
Duplicate keys never reach the driver.
"""

from __future__ import annotations

from functools import reduce
from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions import checks
from landfall.operators.sizing import SizedSide, leaf_bytes, measure
from landfall.spec import ColumnRule, Profile

FLAG = "flag"
VIOLATIONS = "violations"
_DUP = "__lf_dup"
_HASH = "__lf_hash"


def data_columns(df: DataFrame, load_date_col: Optional[str] = "load_dt") -> list[str]:
    """Columns checked by the rules: every column except the load-date partition."""
    return [c for c in df.columns if c != load_date_col]


def drop_header_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """DQ-1: remove rows that repeat the header (every column equals its name)."""
    return df.where(~checks.is_header_row(columns))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG-1: key values seen more than once (nulls group together), with their count."""
    return (df.groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("dup_count"))
              .where(F.col("dup_count") > 1))


def repeated_keys(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """The keys of ``duplicate_keys(drop_header_rows(df))`` from a scan of the key columns alone.

    Rows that repeat the header all have one key, the key columns' names. They
    are counted by a second scan whose filter (every column equals its name) is
    pushed down, and taken off that key in the same aggregation.
    """
    one, none = F.lit(1), F.lit(None).cast("int")
    rows = df.select(*keys, one.alias("__lf_row"), none.alias("__lf_head"))
    headers = df.where(checks.is_header_row(columns)).select(*keys, none.alias("__lf_row"), one.alias("__lf_head"))
    return (rows.unionAll(headers).groupBy(*keys).agg((F.count("__lf_row") - F.count("__lf_head")).alias("__lf_n"))
            .where("__lf_n > 1").drop("__lf_n"))


def _key_names(keys: Sequence[str]) -> list[str]:
    return [f"__lf_k{i}" for i in range(len(keys))]


def hash_bits(size: int) -> int:
    """Width of a key hash for ``size`` bytes of landed rows, each of 8 bytes at least.

    Of different keys, one in 256 at most shares its hash, and some 2**17 in all:
    few enough to be broadcast, however many rows there are (up to 2**40).
    """
    rows = (size >> 3).bit_length()
    return min(64, max(16, rows + 8, 2 * rows - 17))


def _key_hash(df: DataFrame, keys: Sequence[str], bits: int) -> Column:
    whole = F.xxhash64(*[df[k] for k in keys])
    return whole if bits >= 64 else F.shiftrightunsigned(whole, 64 - bits)


def suspect_keys(df: DataFrame, keys: Sequence[str], limit: Optional[int] = None) -> "tuple[SizedSide, int]":
    """Hashes that more than one row's key has, from a scan of the key columns; and their width in bits.

    A repeated key always has such a hash; few others do. Only the hash and its
    partial count are shuffled, whatever the number and width of the key columns.
    """
    bits = hash_bits(leaf_bytes(df))
    hashes = df.select(_key_hash(df, keys, bits).alias(_HASH)).groupBy(_HASH).agg(F.count(F.lit(1)).alias("__lf_n"))
    return measure(hashes.where("__lf_n > 1").select(_HASH), [_HASH], limit), bits


def of_suspects(df: DataFrame, keys: Sequence[str], suspects: SizedSide, bits: int) -> DataFrame:
    """The rows of ``df`` whose key has one of the suspect hashes."""
    side = suspects.for_join()
    return df.join(side, _key_hash(df, keys, bits) == side[_HASH], "left_semi")


def duplicate_side(df: DataFrame, keys: Sequence[str], load_date_col: Optional[str] = "load_dt",
                   limit: Optional[int] = None, drop_headers: bool = True, one_scan: bool = False,
                   hash_first: Optional[bool] = None) -> SizedSide:
    """Materialise and measure the duplicate keys of ``df`` (header rows excluded).

    ``one_scan`` is for rows that are parsed whole anyway (text): header rows are
    then left out in the scan of the keys instead of counted by a second one.

    The result decides the join of ``mark_duplicates``: broadcast when its
    measured size is under ``limit``, a shuffle join otherwise.

    ``hash_first`` (by default for keys of several columns) shuffles 64-bit hashes
    first; the keys themselves are then grouped only for rows of repeated
    hashes, of which clean data has few.
    """
    cols = data_columns(df, load_date_col)
    renamed = _key_names(keys)
    if len(keys) > 1 if hash_first is None else hash_first:
        suspects, bits = suspect_keys(df, keys, limit)
        try:
            if suspects.rows == 0:
                none = df.select(*[F.col(k).alias(r) for k, r in zip(keys, renamed)], F.lit(True).alias(_DUP)).limit(0)
                return SizedSide(none, 0, 0, True, None)
            return duplicate_side(of_suspects(df, keys, suspects, bits), keys, load_date_col, limit, drop_headers, one_scan, False)
        finally:
            suspects.release()
    if drop_headers and not one_scan:
        dups = repeated_keys(df, cols, keys)
    else:
        dups = duplicate_keys(drop_header_rows(df, cols) if drop_headers else df, keys)
    dups = dups.select(*[F.col(k).alias(r) for k, r in zip(keys, renamed)],
                                             F.lit(True).alias(_DUP))
    return measure(dups, renamed, limit)


def mark_duplicates(df: DataFrame, keys: Sequence[str], out_col: str = _DUP,
                    side: Optional[SizedSide] = None, repeated: Optional[DataFrame] = None) -> DataFrame:
    """DQ-8 / JOIN-4: add boolean ``out_col`` = the row's key occurs more than once.

    Null-safe equality reproduces the reference, where null key parts compare
    equal to each other. Without a measured ``side`` the whole thing stays one
    lazy plan and AQE chooses the join at runtime.
    """
    renamed = _key_names(keys)
    if side is None:
        repeated = duplicate_keys(df, keys) if repeated is None else repeated
        dups = repeated.select(*[F.col(k).alias(r) for k, r in zip(keys, renamed)], F.lit(True).alias(_DUP))
    else:
        dups = side.for_join()
    cond = reduce(lambda a, b: a & b, [df[k].eqNullSafe(dups[r]) for k, r in zip(keys, renamed)])
    joined = df.join(dups, cond, "left")
    return joined.select(*[df[c] for c in df.columns], F.coalesce(dups[_DUP], F.lit(False)).alias(out_col))


def check_schema(columns: Sequence[str], rules: Sequence[ColumnRule], keys: Sequence[str]) -> None:
    """B19: fail up front, naming every landing column without a rule and vice versa."""
    ruled = {r.name for r in rules}
    extra = [c for c in columns if c not in ruled]
    missing = [r.name for r in rules if r.name not in set(columns)]
    bad_keys = [k for k in keys if k not in set(columns)]
    if extra or missing or bad_keys:
        raise ValueError(f"landing columns do not match metadata: without rule={extra}, "
                         f"rule without column={missing}, unknown keys={bad_keys}")


def validate(df: DataFrame, rules: Sequence[ColumnRule], keys: Sequence[str] = (),
             profile: "str | Profile" = "v2", load_date_col: Optional[str] = "load_dt",
             message_style: str = "native", drop_headers: bool = True,
             duplicates: Optional[SizedSide] = None, structured: bool = False) -> DataFrame:
    """PIPE-1: checks, uniqueness and flag for one landing frame (one load date).

    Returns the landing columns (timestamps normalised in v2) followed by
    ``flag`` (``''`` when clean). The load-date column, when present, is kept.
    ``duplicates`` is an optional measured duplicate-key side from
    ``duplicate_side`` (same frame and keys); without it the plan is fully lazy.
    ``structured`` adds ``violations``, an array of (column, check, message)
    from which ``flag`` is then rendered; row checks have a null column.
    """
    prof = Profile.of(profile)
    msgs = checks.messages(message_style)
    cols = data_columns(df, load_date_col)
    check_schema(cols, rules, keys)
    by_name = {r.name: r for r in rules}

    base = drop_header_rows(df, cols) if drop_headers else df
    if not keys:            # B3: no key -> no uniqueness check
        dup: Optional[Column] = None
    elif duplicates is not None and duplicates.rows == 0:
        dup = None          # measured: no key repeats, so no join is needed
    else:
        repeated = repeated_keys(df, cols, keys) if drop_headers and duplicates is None else None
        base = mark_duplicates(base, list(keys), side=duplicates, repeated=repeated)
        dup = F.col(_DUP)

    # Timestamp / date columns: the ISO candidate and its test are computed once
    # in an inner projection and referenced by both the flag and the output.
    iso_names = {c: f"__lf_iso{i}" for i, c in enumerate(cols) if by_name[c].check in ("timestamp", "date")}
    ok_names = {c: f"__lf_ok{i}" for i, c in enumerate(cols) if c in iso_names}
    if iso_names:
        base = base.withColumns({n: checks.iso_candidate(F.col(c), prof.timestamp_formats)
                                 for c, n in iso_names.items()})
        base = base.withColumns({ok_names[c]: checks.is_present(c) & checks.iso_is_real(F.col(n))
                                 for c, n in iso_names.items()})
    iso_of = {c: F.col(n) for c, n in iso_names.items()}
    ok_of = {c: F.col(n) for c, n in ok_names.items()}

    values = {c: checks.output_value(by_name[c], prof, iso_of.get(c), ok_of.get(c)) for c in cols}
    tagged: list = []
    for c in cols:
        tagged.extend((c, k, m) for k, m in checks.column_violations(by_name[c], prof, msgs, ok_of.get(c)))
        if prof.check_castable:
            tagged.append((c, "castable", checks.not_castable(by_name[c], values[c], msgs)))
    if dup is not None:
        tagged.append((None, "unique", F.when(dup, F.lit(msgs["unique"]))))
    if prof.flag_misaligned:
        tagged.append((None, "misaligned", F.when(checks.any_null(cols), F.lit(msgs["misaligned"]))))

    out = [values[c].alias(c) for c in cols]
    if load_date_col and load_date_col in df.columns:
        out.append(F.col(load_date_col))
    if structured:
        found = base.select(*out, checks.violation_array(tagged).alias(VIOLATIONS))
        return found.withColumn(FLAG, checks.flag_of(F.col(VIOLATIONS)))
    out.append(checks.render_flag([m for _, _, m in tagged]).alias(FLAG))
    return base.select(*out)


def violation_summary(validated: DataFrame) -> DataFrame:
    """Violations per column and check of a ``structured`` validation (the column is null for row checks)."""
    each = validated.select(F.explode(VIOLATIONS).alias("v"))
    return each.groupBy(F.col("v.column").alias("column_name"), F.col("v.check").alias("check_name")) \
               .agg(F.count(F.lit(1)).alias("violation_count"))


def violation_of(rule: ColumnRule, check: str, profile: "str | Profile" = "v2",
                 message_style: str = "native") -> Column:
    """The message Column of one check on one column (null when it passes)."""
    pairs = dict(checks.column_violations(rule, Profile.of(profile), checks.messages(message_style)))
    if check not in pairs:
        raise ValueError(f"column {rule.name} has no {check!r} rule")
    return pairs[check]

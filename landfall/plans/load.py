"""End-to-end load (PIPE-1..PIPE-6).

Per file and load date:

1. validate the landing rows (one lazy plan, ``operators.validate``);
2. write the clean rows and the rejects in one pass, each layer to a new folder
   of its own, and observe the four audit counts during that write;
3. point the staging and the reject partition of the date at the new folders,
   both or neither (``operators.publish``);
4. the same for the delete-key feed when the file has one;
5. staging -> ODS: hard-delete join, audit columns, typed cast, and the
   write strategy of the file.

Files run concurrently from a small thread pool, those with most landed bytes
first. A failed stage is tried once more; with a ledger (``plans.ledger``) a
later run resumes after the stages that were finished.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Callable, Mapping, Optional, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from landfall import spec as S
from landfall.operators import ods as O
from landfall.operators import publish, sinks
from landfall.operators.sizing import broadcast_limit as broadcast_limit_of
from landfall.operators.sizing import leaf_bytes
from landfall.operators.split import audit_exprs, is_clean, is_reject
from landfall.operators.validate import FLAG, check_schema, data_columns, duplicate_side, validate
from landfall.plans import metadata as M
from landfall.plans import schema as SC
from landfall.plans.ledger import Ledger, SplitCounts
from landfall.session import apply_runtime_conf, restore_conf, runtime_conf, set_scheduler_pool
from landfall.sources import landing as L


@dataclass
class LoadResult:
    """Outcome of one file: split counts of the main and delete feeds, what the
    ODS step did, and ``extra`` (elapsed seconds and tries per stage, landed bytes)."""

    file_name: str
    main: Optional[SplitCounts] = None
    delete_feed: Optional[SplitCounts] = None
    ods: str = "not run"
    extra: dict = field(default_factory=dict)
    error: Optional[Exception] = None


class LoadError(RuntimeError):
    """Some files failed; ``results`` has one result per file, those that were loaded and those with their error."""

    def __init__(self, results: "list[LoadResult]"):
        self.results = results
        failed = [r for r in results if r.error is not None]
        super().__init__("; ".join(f"{r.file_name}: {r.error}" for r in failed))


CLEAN, REJECT = "clean", "reject"


def validate_and_split(spark: SparkSession, landing: DataFrame, rules: Sequence[S.ColumnRule],
                       keys: Sequence[str], stg_table: str, rej_table: str, load_dt: str,
                       profile: "str | S.Profile" = "v2", load_date_col: str = "load_dt",
                       message_style: str = "native", broadcast_limit: Optional[int] = None,
                       cache_landing: bool = False) -> SplitCounts:
    """PIPE-1 / PIPE-2: validate one landing frame and publish its two outputs for ``load_dt``.

    The landing rows are scanned once in full: one write puts clean rows and
    rejects into a staged folder, a sub-folder each, and the two partitions are
    then changed together. Only the key columns are read before, for the
    duplicate keys. ``cache_landing`` keeps the day's rows for both reads (for
    sources that are dear to read twice). When the frame carries a
    ``header_check`` (CSV read by ``landing.read_landing_csv``), it is made
    before anything is published.
    """
    header_check = getattr(landing, "header_check", None)
    landing = L.for_load_date(landing, load_dt, load_date_col) if load_date_col in landing.columns else landing
    check_schema(data_columns(landing, load_date_col), rules, keys)   # before any job
    facts = publish.table_facts(spark, stg_table)
    fmt, buckets = facts["Provider"], publish.buckets_of(facts)
    folder = publish.version_folder(spark, stg_table, load_dt)
    dups = cached = None
    try:
        if cache_landing:
            cached = landing = landing.persist(StorageLevel.MEMORY_AND_DISK)
        if keys:
            dups = duplicate_side(landing, keys, load_date_col, broadcast_limit, one_scan=header_check is not None)
            if header_check is not None:
                header_check()
        validated = validate(landing, rules, keys, profile, load_date_col, message_style, duplicates=dups)
        cols = [r.name for r in rules]
        obs = Observation(f"audit_{uuid.uuid4().hex[:12]}")
        name = publish.layer_name([*cols, FLAG])
        layer = F.when(is_clean(), CLEAN).when(is_reject(cols, profile), REJECT).alias(name)
        observed = validated.observe(obs, *audit_exprs(cols, profile))
        # Clean rows have an empty flag, which is not stored with them.
        rows = observed.select(*cols, F.when(~is_clean(), F.col(FLAG)).alias(FLAG), layer)
        publish.stage_layers(rows, name, folder, fmt, buckets, CLEAN)
        if header_check is not None:
            header_check()
        m = obs.get
        clean = publish.layer_folder(spark, folder, name, CLEAN)
        reject = publish.compacted(spark, publish.layer_folder(spark, folder, name, REJECT), fmt)
        publish.publish(spark, [publish.Target(stg_table, clean, load_date_col, load_dt),
                                publish.Target(rej_table, reject, load_date_col, load_dt)])
        return SplitCounts(total=m["total"], clean=m["clean"], rejected=m["rejected"], blank=m["blank"])
    except BaseException:
        publish.remove(spark, folder)
        raise
    finally:
        if cached is not None:
            cached.unpersist()
        if dups is not None:
            dups.release()


def load_to_ods(spark: SparkSession, spec: S.FileSpec, load_dt: str, load_ts: Optional[str] = None,
                load_date_col: str = "load_dt", broadcast_limit: Optional[int] = None) -> str:
    """PIPE-3: staging (and staging key feed) of ``load_dt`` -> ODS."""
    t = spec.tables
    sinks.assert_not_self([t.stg, t.stg_pk], t.ods)
    stg = L.read_table_for_date(spark, t.stg, load_dt, load_date_col)
    schema = SC.layer_schema(spec, "ods", load_date_col)
    side = pk = None
    if t.has_delete_feed:
        pk = L.read_table_for_date(spark, t.stg_pk, load_dt, load_date_col)
        alike = publish.buckets_of(publish.table_facts(spark, t.stg))
        alike = alike is not None and alike == publish.buckets_of(publish.table_facts(spark, t.stg_pk)) \
            and set(alike.columns) == set(spec.keys)
        if not alike or O.feed_bytes(pk, spec.keys) <= broadcast_limit_of(spark, broadcast_limit):
            side = O.delete_key_side(pk, spec.keys, broadcast_limit)
    try:
        ods = O.stage_to_ods(stg, schema, spec.keys, pk if side is None else None, load_ts, side, co_located=side is None)
        return sinks.write_ods(spark, ods, spec, load_dt, load_date_col)
    finally:
        if side is not None:
            side.release()


def landing_reader(spark: SparkSession, landing_root: Optional[str], load_date_col: str = "load_dt",
                   fmt: Optional[str] = None, load_dt: Optional[str] = None) -> Callable[[S.FileSpec, bool], DataFrame]:
    """Default landing source: folders under ``landing_root``, else those of the landing tables.

    CSV files are always read with empty and missing fields told apart, and
    only the folder of ``load_dt`` is listed; it need not be in the catalog.

    The reader's ``by_position(spec, is_key_feed)`` reads CSV files whose first
    lines are not their column names (``read_landing_csv``).
    """
    def parses_csv(spec: S.FileSpec) -> bool:
        return spec.file_type.upper() == "CSV"

    def read(spec: S.FileSpec, pk: bool, header_by: str = "name") -> DataFrame:
        cols = list(spec.keys) if pk else spec.columns
        kind, path = L.table_storage(spark, spec.tables.ldg_pk if pk else spec.tables.ldg)
        if landing_root and (fmt is not None or parses_csv(spec)):   # files under the landing root
            kind, path = fmt, f"{landing_root}/{spec.source_system}/{spec.ddl_name}{'_pk' if pk else ''}"
        if parses_csv(spec):
            return L.read_landing_csv(spark, path, cols, load_date_col, load_dt=load_dt, header_by=header_by)
        return L.read_landing(spark, path, kind, cols, load_date_col, load_dt)
    read.by_position = lambda spec, pk: read(spec, pk, "position")
    return read


def load_file(spark: SparkSession, spec: S.FileSpec, load_dt: str,
              read: Callable[[S.FileSpec, bool], DataFrame], profile: "str | S.Profile" = "v2",
              load_ts: Optional[str] = None, load_date_col: str = "load_dt", message_style: str = "native",
              stages: Sequence[str] = ("validate", "ods"), cache_landing: bool = False,
              scheduler_pool: Optional[str] = None, ledger: "Optional[Ledger]" = None, attempts: int = 2,
              broadcast_limit: Optional[int] = None) -> LoadResult:
    """All stages of one file for one date.

    A stage that fails is tried again, ``attempts`` times in all. With a
    ``ledger``, stages that its run has finished are not done again (their counts
    are the recorded ones) and every stage is recorded when it ends.
    """
    res = LoadResult(spec.file_name)
    t = spec.tables
    res.extra["tries"] = {}

    def split(pk: bool) -> SplitCounts:
        rules = spec.key_rules() if pk else spec.rules
        stg, rej = (t.stg_pk, t.rej_pk) if pk else (t.stg, t.rej)

        def of(landing: DataFrame) -> SplitCounts:
            return validate_and_split(spark, landing, rules, spec.keys, stg, rej, load_dt, profile, load_date_col,
                                      message_style, broadcast_limit, cache_landing)
        try:
            return of(read(spec, pk))
        except L.HeaderMismatch:          # nothing is published yet
            if not hasattr(read, "by_position"):
                raise
            return of(read.by_position(spec, pk))

    def stage(name: str, run: Callable):
        """``run`` unless the ledger has it; tried again when it fails, and recorded."""
        done = ledger.finished(spec.file_name, name) if ledger else None
        if done is not None:
            res.extra["tries"][name] = 0
            return done.counts if name != "ods" else done.note
        set_scheduler_pool(spark, scheduler_pool)   # a pool is a setting of the thread
        for attempt in range(1, attempts + 1):
            res.extra["tries"][name] = attempt
            started = time.perf_counter()
            try:
                out = run()
            except Exception as e:
                if ledger:
                    ledger.record(spec.file_name, name, "failed", note=f"{type(e).__name__}: {e}"[:2000])
                if attempt == attempts or isinstance(e, (ValueError, FileNotFoundError)):   # the same again
                    raise
                continue
            seconds = round(time.perf_counter() - started, 3)
            if ledger:
                counts = out if isinstance(out, SplitCounts) else None
                ledger.record(spec.file_name, name, "done", counts, "" if counts else out, seconds)
            return out

    started = time.perf_counter()
    if "validate" in stages:
        if t.has_delete_feed and S.Profile.of(profile).validate_delete_feed:
            # independent jobs: submit both, the scheduler interleaves them
            with ThreadPoolExecutor(max_workers=2) as pool:
                f_main = pool.submit(stage, "validate", lambda: split(False))
                f_feed = pool.submit(stage, "validate_feed", lambda: split(True))
                res.main, res.delete_feed = f_main.result(), f_feed.result()
        else:
            res.main = stage("validate", lambda: split(False))
        res.extra["validate_sec"] = round(time.perf_counter() - started, 3)
    if "ods" in stages:
        before = time.perf_counter()
        res.ods = stage("ods", lambda: load_to_ods(spark, spec, load_dt, load_ts, load_date_col, broadcast_limit))
        res.extra["ods_sec"] = round(time.perf_counter() - before, 3)
    res.extra["cache_landing"] = bool(cache_landing)
    return res


def _tables_of(spec: S.FileSpec) -> list[str]:
    t = spec.tables
    return [x for x in (t.ldg, t.stg, t.rej, t.ods, t.ldg_pk, t.stg_pk, t.rej_pk) if x]


def landed_bytes(read: Callable[[S.FileSpec, bool], DataFrame], spec: S.FileSpec, load_dt: str,
                 load_date_col: str = "load_dt") -> int:
    """Bytes of the files behind a file's landing rows of one date, from the planner's listing; 0 if they cannot be read."""
    try:
        frame = read(spec, False)
        if load_date_col in frame.columns:
            frame = L.for_load_date(frame, load_dt, load_date_col)
        return leaf_bytes(frame)
    except Exception:       # an absent day or a failing source is reported by the load itself
        return 0


def default_load_date(today: Optional[_dt.date] = None) -> str:
    """FN-15 / B17: yesterday as ``yyyy-MM-dd`` (the caller normally passes the date)."""
    return ((today or _dt.date.today()) - _dt.timedelta(days=1)).isoformat()


def select_files(spark: SparkSession, metadata: Mapping[str, DataFrame], files: Optional[Sequence[str]] = None,
                 drop_create: Optional[Sequence[bool]] = None,
                 generate_ddl: Optional[Sequence[bool]] = None) -> list:
    """PIPE-6: auto mode (load list) when ``files`` is None, else the given names and flags."""
    frame = M.load_list(metadata["load_file_list"]) if files is None else \
        M.manual_list(spark, files, drop_create, generate_ddl)
    return [(r["file_name"], bool(r["drop_create"]), bool(r["generate_ddl"])) for r in frame.collect()]


def run_load(spark: SparkSession, *args, **kwargs) -> list[LoadResult]:
    """``load_files`` under the engine's SQL settings; the session's own are put back."""
    before = runtime_conf(spark)
    apply_runtime_conf(spark)
    try:
        return load_files(spark, *args, **kwargs)
    finally:
        restore_conf(spark, before)


def load_files(spark: SparkSession, metadata: Mapping[str, DataFrame], load_dt: Optional[str] = None,
             files: Optional[Sequence[str]] = None, create_only: bool = False,
             profile: "str | S.Profile" = "v2", databases: Optional[dict] = None,
             warehouse_root: Optional[str] = None, landing_root: Optional[str] = None,
             landing: Optional[Callable[[S.FileSpec, bool], DataFrame]] = None,
             load_ts: Optional[str] = None, ddl_path: Optional[str] = None,
             drop_create: Optional[Sequence[bool]] = None, generate_ddl: Optional[Sequence[bool]] = None,
             stages: Sequence[str] = ("validate", "ods"), load_date_col: str = "load_dt",
             message_style: str = "native", max_parallel: int = 4,
             cache_landing: bool = False, landing_format: Optional[str] = None, recreate: bool = False,
             ledger: Optional[str] = None, resume: bool = False, attempts: int = 2,
             broadcast_limit: Optional[int] = None, staging_buckets: Optional[int] = None) -> list[LoadResult]:
    """PIPE-4 / PIPE-5: create tables and load the selected files for ``load_dt``.

    Tables are created where they are missing. Those that exist are compared with
    the metadata: added fields become columns, a changed type or partitioning is
    refused (``schema.SchemaChange``), and nothing is ever dropped, whatever a
    file's drop flag says, unless ``recreate`` is given: then the tables of
    files with the flag set are dropped and made again, their rows with them.

    ``ledger`` is a folder that every stage is recorded in; ``resume`` leaves out
    what the date's last run there has finished. ``staging_buckets`` creates the
    staging tables of files with a delete feed bucketed by key: their rows are
    shuffled once, when they are staged, and the delete join then moves none.

    Profile ``v1`` with ``stages=('validate',)`` is the older validate-only job.
    Landing data comes from ``landing`` (a callable ``(spec, is_key_feed) ->
    DataFrame``), else from CSV folders under ``landing_root`` for CSV files and
    from ``landing_format`` files there (or the folders of the landing tables)
    for the others. A file named more than once is loaded once, with its last
    flags. A file that fails does not stop the others: ``LoadError`` is raised
    at the end with the results of all.
    """
    prof = S.Profile.of(profile)
    load_dt = load_dt or default_load_date()
    dbs = {"ldg": "ldg", "stg": "stg", "rej": "rej", "ods": "ods", **(databases or {})}
    flags = {n: (d, g) for n, d, g in select_files(spark, metadata, files, drop_create, generate_ddl)}
    names = list(flags)
    specs = M.file_specs(metadata, names, dbs)     # uniqueness key: primary key first, in both profiles

    SC.create_databases(spark, dbs, warehouse_root)
    # The DDL job runs only when something must be created or written out; a
    # daily run over existing tables needs catalog lookups only.
    missing = [s.file_name for s in specs if not all(spark.catalog.tableExists(t) for t in _tables_of(s))]
    dropped = [n for n in names if recreate and flags[n][0]]
    to_create = [n for n in names if n in dropped or n in missing]
    to_write = [n for n in names if flags[n][1]] if ddl_path else []
    if to_create or to_write:
        ddl = SC.ddl_frame(metadata, dbs, landing_root or "landing", load_date_col,
                           message_style=message_style, key_table_prefer=prof.key_table_prefer,
                           staging_buckets=staging_buckets) \
            .where(F.col("file_name").isin(names))
        scripts = {r["file_name"]: r["script"] for r in
                   SC.ddl_scripts(ddl.where(F.col("file_name").isin(to_create))).collect()} if to_create else {}
        landing_tables = {t for s in specs for t in (s.tables.ldg, s.tables.ldg_pk) if t}
        SC.create_tables(spark, [scripts[n] for n in to_create if n in dropped], recreate=True, landing=landing_tables)
        SC.create_tables(spark, [scripts[n] for n in to_create if n not in dropped], recreate=False)
        if to_write:
            SC.write_ddl_text(ddl.where(F.col("file_name").isin(to_write)), ddl_path, load_dt)
    refused = {}
    for s in specs:
        try:
            SC.extend_tables(spark, s, load_date_col)
        except SC.SchemaChange as e:
            refused[s.file_name] = LoadResult(s.file_name, ods="failed", error=e)
    if create_only:
        if refused:
            raise LoadError([refused.get(n, LoadResult(n, ods="tables only")) for n in names])
        return [LoadResult(n, ods="tables only") for n in names]

    read = landing or landing_reader(spark, landing_root, load_date_col, landing_format, load_dt)
    records = Ledger(spark, ledger, load_dt, resume) if ledger else None

    def one(spec: S.FileSpec) -> LoadResult:
        # One scheduler pool per file: under FAIR scheduling a large file does
        # not hold back the small ones (ignored under FIFO).
        pool = f"landfall_{spec.ddl_name}"
        set_scheduler_pool(spark, pool)
        began = time.perf_counter()
        try:
            res = load_file(spark, spec, load_dt, read, prof, load_ts, load_date_col, message_style, stages,
                            cache_landing, pool, records, attempts, broadcast_limit)
        except Exception as e:
            res = LoadResult(spec.file_name, ods="failed", error=e)
        finally:
            set_scheduler_pool(spark, None)
        res.extra.update(landed_bytes=landed.get(spec.file_name), began=began)
        return res

    # Most landed bytes first: the longest file does not begin last.
    queue = [s for s in specs if s.file_name not in refused]
    landed = {s.file_name: landed_bytes(read, s, load_dt, load_date_col) for s in queue} if len(queue) > 1 else {}
    queue.sort(key=lambda s: -landed.get(s.file_name, 0))
    if max_parallel <= 1 or len(queue) <= 1:
        loaded = [one(s) for s in queue]
    else:
        with ThreadPoolExecutor(max_workers=min(max_parallel, len(queue))) as pool:
            loaded = list(pool.map(one, queue))
    by_name = {r.file_name: r for r in loaded} | refused
    results = [by_name[s.file_name] for s in specs]
    failed = [r for r in results if r.error is not None]
    if failed:
        raise LoadError(results) from failed[0].error
    return results

"""Landing readers (SRC-3..SRC-6).

CSV landing files keep the distinction the checks depend on: an *empty* field
is ``''`` and a *missing* field (short row) is null. Spark's CSV parser turns
both into null, so the raw line of a malformed row is kept in a corrupt-record
column and the number of fields is counted from it; for well-formed rows every
null becomes ``''``. All of this is column expressions on one text scan.
"""

from __future__ import annotations

import re
import uuid
import zlib
from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

CORRUPT = "_corrupt_record"
# An escaped character, or a quoted run with its own escapes (closed or not).
_QUOTED = r'\\.|"(?:[^"\\]|\\.)*+"?'


def string_schema(columns: Sequence[str], load_date_col: Optional[str] = "load_dt",
                  corrupt: Optional[str] = None) -> T.StructType:
    fields = [T.StructField(c, T.StringType()) for c in columns]
    if corrupt:
        fields.append(T.StructField(corrupt, T.StringType()))
    if load_date_col:
        fields.append(T.StructField(load_date_col, T.StringType()))
    return T.StructType(fields)


def _reader(spark: SparkSession, path: str, load_date_col: Optional[str], load_dt: Optional[str]):
    """A reader and the folder it reads: the whole landing folder, or only that of one load date."""
    if load_dt is None or not load_date_col:
        return spark.read, path
    return spark.read.option("basePath", path), f"{path.rstrip('/')}/{load_date_col}={load_dt}"


def _load(reader, fmt: str, path: str) -> DataFrame:
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"no landing folder {path}") from e
        raise


class HeaderMismatch(ValueError):
    """Some CSV files do not begin with exactly one line of their column names."""


def _fields(rows: DataFrame, line: Column, parsed: Sequence[Column], corrupt: Column, columns: Sequence[str],
            sep: str, dates: Sequence[str]) -> DataFrame:
    """The data columns of lines: ``''`` for empty, null for missing; a line of blanks has one field, an empty line none."""
    # Fields of a malformed line: separators left when escaped characters and
    # quoted runs are taken out, in one pass over the line and once per line.
    bare = F.regexp_replace(corrupt, _QUOTED, "")
    counted = F.length(bare) - F.length(F.replace(bare, F.lit(sep))) + 1
    rows = rows.withColumns({"__lf_fields": F.when(corrupt.isNull(), F.lit(len(columns))).otherwise(counted),
                             "__lf_blank": is_blank_line(line)})
    out = []
    for i, (c, value) in enumerate(zip(columns, parsed)):
        told = F.when(F.col("__lf_fields") > i, F.coalesce(value, F.lit("")))
        whole = F.when(line != "", line) if i == 0 else F.lit(None).cast("string")
        out.append(F.when(F.col("__lf_blank"), whole).otherwise(told).alias(c))
    return rows.select(*out, *dates)


def is_blank_line(line: Column) -> Column:
    return line.rlike(r"\A[\x00-\x20]*\z")


# Scheme and leading slashes, which a scan's metadata and its file list write differently.
_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:/+"


def _path_sum(paths: Sequence[str]) -> int:
    return sum(zlib.crc32(re.sub(_SCHEME, "/", p).encode()) for p in paths)


def read_landing_csv(spark: SparkSession, path: str, columns: Sequence[str],
                     load_date_col: Optional[str] = "load_dt", header: bool = True,
                     sep: str = ",", load_dt: Optional[str] = None, header_by: str = "position") -> DataFrame:
    """SRC-3: comma CSV, first line of each file skipped, partition folders ``load_dt=...``.

    Returns the data columns as strings (``''`` for empty, null for missing)
    and the load-date partition column; no schema inference. With ``load_dt``
    only that date's folder is listed and read; it must exist.

    The files are scanned once as text and each line is parsed by itself, so no
    line is lost: an empty line has no field at all (every column null), a line
    of blanks has one. A text scan does not number lines. With ``header_by``
    "name" the header is told by what it says, a line in a file's first block
    whose fields are the column names (in any case, blanks around them aside),
    and the frame's ``header_check()``, called after an action on it, raises
    ``HeaderMismatch`` unless every file had exactly one such line. By "position"
    the first line that is not blank is skipped, whatever it says, at the price
    of a second scan for blank lines; the load job does that only after a mismatch.
    """
    if header and header_by == "position":
        return _read_by_position(spark, path, columns, load_date_col, sep, load_dt)
    reader, folder = _reader(spark, path, load_date_col, load_dt)
    dates = [load_date_col] if load_date_col else []
    text = _load(reader.schema(string_schema(["value"], load_date_col)), "text", folder)
    lines = text.select("value", *dates, F.col("_metadata.file_path").alias("__lf_file"),
                        (F.col("_metadata.file_block_start") == 0).alias("__lf_first"))
    names = [f"c{i}" for i in range(len(columns))]
    schema = ", ".join(f"{n} string" for n in [*names, CORRUPT])
    lines = lines.withColumn("__lf_row", F.from_csv("value", schema, {
        "sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    check = None
    if header:
        row = F.col("__lf_row")
        is_header = F.col("__lf_first") & row[CORRUPT].isNull()
        for n, c in zip(names, columns):
            is_header = is_header & (F.lower(F.trim(row[n])) == F.lit(c.strip().lower()))
        lines = lines.withColumn("__lf_header", F.coalesce(is_header, F.lit(False)))
        seen = Observation(f"headers_{uuid.uuid4().hex[:12]}")
        files = text.inputFiles()
        if files:
            lines = lines.observe(seen, F.count_if(F.col("__lf_header")).alias("n"), F.coalesce(
                F.sum(F.when(F.col("__lf_header"), F.crc32(F.regexp_replace("__lf_file", _SCHEME, "/")))), F.lit(0)).alias("paths"))
        lines = lines.where(~F.col("__lf_header"))

        def check() -> None:
            if files and (seen.get["n"], seen.get["paths"]) != (len(files), _path_sum(files)):
                raise HeaderMismatch(f"{seen.get['n']} lines of column names in {len(files)} files under {folder}")
    row = F.col("__lf_row")
    out = _fields(lines, F.col("value"), [row[n] for n in names], row[CORRUPT], columns, sep, dates)
    if check is not None:
        out.header_check = check
    return out


def _read_by_position(spark: SparkSession, path: str, columns: Sequence[str], load_date_col: Optional[str],
                      sep: str, load_dt: Optional[str]) -> DataFrame:
    """Spark's own CSV reader skips the first line of every file, and all blank ones, which are read as text beside it."""
    reader, folder = _reader(spark, path, load_date_col, load_dt)
    raw = _load(reader.schema(string_schema(columns, load_date_col, CORRUPT))
                .option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", CORRUPT), "csv", folder)
    dates = [load_date_col] if load_date_col else []
    rows = _fields(raw, F.lit("x"), [F.col(c) for c in columns], F.col(CORRUPT), columns, sep, dates)
    reader, _ = _reader(spark, path, load_date_col, load_dt)
    lines = _load(reader.schema(string_schema(["value"], load_date_col)), "text", folder).where(is_blank_line(F.col("value")))
    none = F.lit(None).cast("string")
    return rows.unionByName(_fields(lines, F.col("value"), [none] * len(columns), none, columns, sep, dates))


def read_landing(spark: SparkSession, source: str, fmt: Optional[str] = None,
                 columns: Optional[Sequence[str]] = None, load_date_col: Optional[str] = "load_dt",
                 load_dt: Optional[str] = None) -> DataFrame:
    """SRC-4: non-CSV landing data, either a catalog table or files in ``fmt``.

    For files, pass ``columns``: the all-string schema (with the load-date
    partition as a string) is then given to the reader, so nothing is inferred
    (no footer-reading job, and ``load_dt=2022-09-11`` stays a string). With
    ``load_dt`` only that date's folder is listed and read; it must exist.
    """
    if fmt is None:
        return spark.table(source)
    reader, folder = _reader(spark, source, load_date_col, load_dt)
    if columns is not None:
        reader = reader.schema(string_schema(columns, load_date_col))
    return _load(reader, fmt, folder)


def table_storage(spark: SparkSession, table: str) -> tuple[Optional[str], Optional[str]]:
    """Format and location of a table, from the catalog."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return told.get("Provider"), told.get("Location")


def for_load_date(df: DataFrame, load_dt: str, load_date_col: str = "load_dt") -> DataFrame:
    """SRC-5 / SRC-6: one load date; on a partitioned source this becomes a PartitionFilter."""
    return df.where(F.col(load_date_col) == F.lit(load_dt))


def read_table_for_date(spark: SparkSession, table: str, load_dt: str, load_date_col: str = "load_dt") -> DataFrame:
    return for_load_date(spark.table(table), load_dt, load_date_col)

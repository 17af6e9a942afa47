"""Table definitions for every layer (DDL-1..DDL-10, SNK-7, SNK-8).

Two views of the same definitions:
* ``ddl_frame`` builds the DDL text of all files in one Spark job (explode
  fields x layers, ordered ``collect_list`` per table, string assembly);
* ``layer_schema`` gives the ``StructType`` of one layer from a ``FileSpec``
  for casts and writes.

Tables are Spark DataSource tables: landing external, ``USING CSV`` (or another
format) at ``<landing_root>/<source system>/<table>``, staging / reject / ODS ``USING ORC``, partitioned by the load date
(ODS: by load date, by load key or not at all).
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall import spec as S
from landfall.plans import metadata as M

LAYERS = ("ldg", "ldg_pk", "stg", "stg_pk", "rej", "rej_pk", "ods")
AUDIT_COLUMNS = (("etl_is_hard_del", "int", "0,1"),
                 ("etl_created_ts", "timestamp", "row created at"),
                 ("etl_modified_ts", "timestamp", "row modified at"))


# --------------------------------------------------------------------------- StructType view

# The ODS "timestamp" is a wall-clock value with no time zone (as in the
# original warehouse), which is Spark's TIMESTAMP_NTZ: casts and reads never
# shift it with the session time zone.
SPARK_TYPE_NAME = {"timestamp": "timestamp_ntz"}


def spark_type_name(ods_type: str) -> str:
    return SPARK_TYPE_NAME.get(ods_type, ods_type)


def _spark_type(name: str) -> T.DataType:
    return T._parse_datatype_string(spark_type_name(name))


def ods_columns(spec: S.FileSpec, load_date_col: str = "load_dt") -> list[tuple[str, str]]:
    """DDL-8 column list ``(name, type)``; partition columns last."""
    by_key = spec.partition_strategy == S.PART_LOAD_KEY
    cols = [(r.name, S.ods_type(r.declared_type)) for r in spec.rules
            if not (by_key and r.name in spec.load_keys)]
    cols += [(n, t) for n, t, _ in AUDIT_COLUMNS]
    if spec.partition_strategy != S.PART_LOAD_DATE:
        cols.append((load_date_col, "string"))
    cols += [(p, "string") for p in ods_partition_columns(spec, load_date_col)]
    return cols


def ods_partition_columns(spec: S.FileSpec, load_date_col: str = "load_dt") -> list[str]:
    if spec.partition_strategy == S.PART_LOAD_KEY:
        return list(spec.load_keys)
    if spec.partition_strategy == S.PART_LOAD_DATE:
        return [load_date_col]
    return []


def layer_schema(spec: S.FileSpec, layer: str, load_date_col: str = "load_dt") -> T.StructType:
    """StructType of one layer's table (partition columns last)."""
    string = T.StringType()
    if layer == "ods":
        return T.StructType([T.StructField(n, _spark_type(t)) for n, t in ods_columns(spec, load_date_col)])
    names = list(spec.keys) if layer.endswith("_pk") else spec.columns
    fields = [T.StructField(n, string) for n in names]
    if layer.startswith("rej"):
        fields.append(T.StructField("flag", string))
    fields.append(T.StructField(load_date_col, string))
    return T.StructType(fields)


# --------------------------------------------------------------------------- DDL text in Spark

def _q(c: Column) -> Column:
    """SQL string literal body: escape backslashes and quotes."""
    return F.regexp_replace(F.regexp_replace(c, r"\\", r"\\\\"), "'", r"\\'")


def _coldef(name: Column, typ: Column, comment: Optional[Column] = None) -> Column:
    spark_typ = typ
    for ours, theirs in SPARK_TYPE_NAME.items():
        spark_typ = F.when(spark_typ == F.lit(ours), F.lit(theirs)).otherwise(spark_typ)
    parts = [F.lit("\t`"), name, F.lit("` "), F.upper(spark_typ)]
    if comment is not None:
        parts += [F.lit(" COMMENT '"), _q(F.coalesce(comment, F.lit(""))), F.lit("'")]
    return F.concat(*parts)


def ddl_frame(metadata: dict, databases: Optional[dict] = None, landing_root: str = "landing",
              load_date_col: str = "load_dt", landing_format: str = "parquet",
              message_style: str = "native", key_table_prefer: str = "primary",
              staging_buckets: Optional[int] = None) -> DataFrame:
    """DDL-2..DDL-9 for every active file: one row per (file, layer) with ``statement``.

    Key-feed layers are produced only for files with physical deletion (DDL-9);
    their columns are the primary key, else the business key
    (``key_table_prefer='business'`` reverses that, as the older job did).
    ``staging_buckets`` buckets their staging and staging key tables by key.
    """
    files = M.file_plan(metadata["interface"], metadata["interface_file"], databases)
    fields = M.field_list(metadata["interface_field"])
    keys = M.key_columns(metadata["interface_field"], key_table_prefer).select("file_id", "keys")
    f = fields.join(files.select("file_id", "partition_strategy", "load_keys"), "file_id") \
              .join(keys, "file_id", "left")
    is_key = F.array_contains(F.coalesce(F.col("keys"), F.array().cast("array<string>")), F.col("column_name"))
    drop_from_ods = (F.col("partition_strategy") == S.PART_LOAD_KEY) & \
        F.array_contains(F.col("load_keys"), F.col("column_name"))
    s = F.lit("string")
    flag_comment = S.MESSAGES[message_style]["flag_comment"]

    # (file_id, layer, pos, coldef): field columns ...
    per_field = f.select("file_id", "index", "column_name", "ods_type", "field_comment",
                         is_key.alias("is_key"), drop_from_ods.alias("drop_ods"))
    col_rows = per_field.select("file_id", F.explode(F.array(
        F.struct(F.lit("ldg").alias("layer"), F.col("index").alias("pos"),
                 _coldef(F.col("column_name"), s).alias("coldef")),
        F.struct(F.lit("stg").alias("layer"), F.col("index").alias("pos"),
                 _coldef(F.col("column_name"), s, F.col("field_comment")).alias("coldef")),
        F.struct(F.lit("rej").alias("layer"), F.col("index").alias("pos"),
                 _coldef(F.col("column_name"), s, F.col("field_comment")).alias("coldef")),
        F.struct(F.when(F.col("is_key"), F.lit("ldg_pk")).alias("layer"), F.col("index").alias("pos"),
                 _coldef(F.col("column_name"), s).alias("coldef")),
        F.struct(F.when(F.col("is_key"), F.lit("stg_pk")).alias("layer"), F.col("index").alias("pos"),
                 _coldef(F.col("column_name"), s).alias("coldef")),
        F.struct(F.when(F.col("is_key"), F.lit("rej_pk")).alias("layer"), F.col("index").alias("pos"),
                 _coldef(F.col("column_name"), s).alias("coldef")),
        F.struct(F.when(~F.col("drop_ods"), F.lit("ods")).alias("layer"), F.col("index").alias("pos"),
                 _coldef(F.col("column_name"), F.col("ods_type"), F.col("field_comment")).alias("coldef")),
    )).alias("c")).select("file_id", "c.*").where(F.col("layer").isNotNull())

    # ... and the trailing columns of each layer.
    big = 1 << 20
    dt = F.lit(load_date_col)
    tail = files.select("file_id", "partition_strategy", "load_keys", F.explode(F.array(
        *[F.struct(F.lit(layer).alias("layer"), F.lit(big + 1).alias("pos"),
                   _coldef(F.lit("flag"), s, F.lit(flag_comment) if layer == "rej" else None).alias("coldef"))
          for layer in ("rej", "rej_pk")],
        *[F.struct(F.lit("ods").alias("layer"), F.lit(big + i).alias("pos"),
                   _coldef(F.lit(n), F.lit(t), F.lit(c)).alias("coldef"))
          for i, (n, t, c) in enumerate(AUDIT_COLUMNS)],
        *[F.struct(F.lit(layer).alias("layer"), F.lit(big + 10).alias("pos"), _coldef(dt, s).alias("coldef"))
          for layer in ("ldg", "ldg_pk", "stg", "stg_pk", "rej", "rej_pk", "ods")],
    )).alias("c")).select("file_id", "partition_strategy", "load_keys", "c.*")
    # ODS keeps the load date as the partition (load-date strategy) or as an
    # ordinary column; by-key tables end with the load-key partition columns.
    tail = tail.select("file_id", "layer", "pos", "coldef", "load_keys", "partition_strategy")
    key_parts = files.where(F.col("partition_strategy") == S.PART_LOAD_KEY).select(
        "file_id", F.lit("ods").alias("layer"), F.posexplode("load_keys").alias("p", "k")) \
        .select("file_id", "layer", (F.lit(big + 20) + F.col("p")).alias("pos"),
                _coldef(F.col("k"), s).alias("coldef"))
    all_cols = col_rows.unionByName(tail.select("file_id", "layer", "pos", "coldef")).unionByName(key_parts)

    bodies = all_cols.groupBy("file_id", "layer").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "coldef"))), lambda x: x["coldef"]),
                     ",\n").alias("columns_ddl"))

    t = files.select("*", F.explode(F.array(*[
        F.struct(F.lit(layer).alias("layer"), F.col(f"{layer}_table").alias("table_name")) for layer in LAYERS
    ])).alias("l")).select("*", "l.*").drop("l").where(F.col("table_name") != "")

    csv = F.upper(F.col("file_type")) == "CSV"
    landing_using = F.when(csv, F.lit("USING CSV\nOPTIONS (header 'true')")) \
                     .otherwise(F.lit(f"USING {landing_format.upper()}"))
    location = F.concat(F.lit(f"\nLOCATION '{landing_root}/"), _q(F.col("source_system")), F.lit("/"),
                        F.col("ddl_name"), F.when(F.col("layer") == "ldg_pk", F.lit("_pk")).otherwise(F.lit("")),
                        F.lit("'"))
    is_ldg = F.col("layer").isin("ldg", "ldg_pk")
    using = F.when(is_ldg, landing_using).otherwise(F.lit("USING ORC"))
    quoted_keys = F.array_join(F.transform("load_keys", lambda k: F.concat(F.lit("`"), k, F.lit("`"))), ", ")
    is_ods = F.col("layer") == "ods"
    by_date = F.lit(f"\nPARTITIONED BY (`{load_date_col}`)")
    partition = (F.when(~is_ods, by_date)
                  .when(F.col("partition_strategy") == S.PART_LOAD_KEY,
                        F.concat(F.lit("\nPARTITIONED BY ("), quoted_keys, F.lit(")")))
                  .when(F.col("partition_strategy") == S.PART_LOAD_DATE, by_date)
                  .otherwise(F.lit("")))
    comment = F.concat(F.lit("\nCOMMENT '"), _q(F.coalesce(F.col("tab_comment_cn"), F.lit(""))), F.lit("'"))

    bucketed = F.lit("")
    if staging_buckets:
        quoted = F.array_join(F.transform("keys", lambda k: F.concat(F.lit("`"), k, F.lit("`"))), ", ")
        bucketed = F.when(F.col("layer").isin("stg", "stg_pk") & (F.col("stg_pk_table") != "") & (F.size("keys") > 0), F.concat(
            F.lit("\nCLUSTERED BY ("), quoted, F.lit(f") INTO {int(staging_buckets)} BUCKETS"))).otherwise(F.lit(""))
    joined = t.join(bodies, ["file_id", "layer"], "left").join(keys, "file_id", "left")
    statement = F.concat(
        F.lit("DROP TABLE IF EXISTS "), F.col("table_name"), F.lit(";\n"),
        F.lit("CREATE TABLE IF NOT EXISTS "), F.col("table_name"), F.lit(" (\n"), F.col("columns_ddl"), F.lit(")\n"),
        using, partition, bucketed, comment, F.when(is_ldg, location).otherwise(F.lit("")), F.lit(";"))
    order = F.array_position(F.array(*[F.lit(x) for x in ("ldg", "stg", "rej", "ods", "ldg_pk", "stg_pk", "rej_pk")]),
                             F.col("layer"))
    return joined.select("file_name", "file_id", "layer", order.alias("layer_order"), "table_name",
                         statement.alias("statement"))


def ddl_scripts(ddl: DataFrame) -> DataFrame:
    """DDL-9 / DDL-10 / AGG-4: one script per file (layers in the reference's order)."""
    return ddl.groupBy("file_name").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("layer_order", "statement"))),
                                 lambda x: x["statement"]), "\n").alias("script"))


def ddl_for(ddl: DataFrame, names) -> DataFrame:
    """DDL-10: the scripts of one or many files."""
    names = [names] if isinstance(names, str) else list(names)
    return ddl_scripts(ddl.where(F.col("file_name").isin(names)))


def write_ddl_text(ddl: DataFrame, path: str, load_dt: str) -> None:
    """SNK-7: scripts as text, one folder per load date and file."""
    (ddl_scripts(ddl).withColumn("load_dt", F.lit(load_dt))
        .select("script", "load_dt", "file_name")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")   # keep other dates' scripts
        .partitionBy("load_dt", "file_name").text(path))


def _holds_its_rows(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType == "MANAGED"


def create_tables(spark: SparkSession, statements: list[str], recreate: bool = True, landing: "set | None" = None) -> None:
    """SNK-8: run drop/create statements (``recreate=False`` skips the drops).

    Landing tables are external, so dropping one leaves the landed files. A
    table named in ``landing`` that is managed (made elsewhere) is kept as it is.
    """
    kept = {t.replace("`", "").lower() for t in landing or ()}
    for script in statements:
        for stmt in script.split(";\n"):
            stmt = stmt.strip().rstrip(";")
            if not stmt:
                continue
            if stmt.upper().startswith("DROP "):
                table = stmt.split()[-1].replace("`", "")
                if not recreate or (table.lower() in kept and _holds_its_rows(spark, table)):
                    continue
            spark.sql(stmt)


class SchemaChange(ValueError):
    """A table in the catalog differs from its metadata in a way that rows already in it do not allow."""


def layer_tables(spec: S.FileSpec) -> dict:
    """The tables of a file that hold loaded rows, by layer."""
    t = spec.tables
    return {layer: table for layer, table in (("stg", t.stg), ("rej", t.rej), ("ods", t.ods), ("stg_pk", t.stg_pk),
                                              ("rej_pk", t.rej_pk)) if table}


def table_change(spark: SparkSession, spec: S.FileSpec, layer: str, table: str,
                 load_date_col: str = "load_dt") -> list:
    """Fields of the metadata that ``table`` lacks; ``SchemaChange`` for what cannot be added.

    Fields that left the metadata stay in the table and are null from then on.
    """
    have = spark.table(table).schema
    types = {f.name.lower(): f.dataType for f in have}
    parts = [c.name.lower() for c in spark.catalog.listColumns(table) if c.isPartition]
    want = layer_schema(spec, layer, load_date_col)
    by = ods_partition_columns(spec, load_date_col) if layer == "ods" else [load_date_col]
    retyped = [f"{f.name}: {types[f.name.lower()].simpleString()} -> {f.dataType.simpleString()}" for f in want
               if f.name.lower() in types and types[f.name.lower()] != f.dataType]
    if retyped:
        raise SchemaChange(f"{table}: changed types ({', '.join(retyped)}); recreate it to change them")
    if parts != [c.lower() for c in by]:
        raise SchemaChange(f"{table}: partitioned by ({', '.join(parts)}), the metadata says ({', '.join(by)})")
    return [f for f in want if f.name.lower() not in types]


def extend_tables(spark: SparkSession, spec: S.FileSpec, load_date_col: str = "load_dt") -> dict:
    """SNK-8: bring a file's tables up to its metadata without losing a row; the fields added, by table.

    All layers are compared before any is changed, so a refused change leaves
    them as they were. Landing tables are not touched: their rows are read by the
    file's columns, not by the table's.
    """
    added = {table: table_change(spark, spec, layer, table, load_date_col) for layer, table in layer_tables(spec).items()}
    comments = {r.name: r.comment for r in spec.rules}
    for table, fields in added.items():
        if fields:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + (
                f" COMMENT '{_text(comments[f.name])}'" if comments.get(f.name) else "") for f in fields)
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return {table: [f.name for f in fields] for table, fields in added.items() if fields}


def _text(v: str) -> str:
    return v.replace("\\", "\\\\").replace("'", "\\'")


def create_databases(spark: SparkSession, databases: dict, root: Optional[str] = None) -> None:
    for db in sorted(set(databases.values())):
        loc = f" LOCATION '{root}/{db}.db'" if root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`{loc}")

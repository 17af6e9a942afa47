"""Metadata plans (MET-1..MET-14, SRC-7, PIPE-6) over the metadata DataFrames.

Every function is a DataFrame transform over *all* configured files at once;
``file_specs`` is the only place that collects, and it collects metadata only
(one row per file plus one row per field).
"""

from __future__ import annotations

from typing import Iterable, Optional, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall import spec as S

COMMENT_CHARS = S.COMMENT_CHARS


# --------------------------------------------------------------------------- expressions

def physical_column_name(alias: str = "field_alias", name: str = "name") -> Column:
    """MET-4: ``lower(coalesce(nullif(alias, ''), name))``."""
    return F.lower(F.coalesce(F.nullif(F.col(alias), F.lit("")), F.col(name)))


def file_name_expr() -> Column:
    """Configured file name: alias when set and non-empty, else the name."""
    return F.coalesce(F.nullif(F.col("file_alias"), F.lit("")), F.col("name"))


def physical_table_name() -> Column:
    """MET-5: ``lower(source_system) || '_' || lower(file name)``."""
    return F.concat(F.lower(F.col("source_system")), F.lit("_"), F.lower(file_name_expr()))


def clean_comment(en: str = "fields_comment_en", cn: str = "fields_comment_cn") -> Column:
    """MET-7: both languages joined by ``||`` (null-safe), special characters blanked."""
    return F.regexp_replace(F.concat_ws(S.COMMENT_JOIN, F.col(en), F.col(cn)), S.COMMENT_CHARS, " ")


def dq_check_kind(field_type: str = "field_type") -> Column:
    """MET-10 type part: ``int`` / ``timestamp`` / ``date`` / ``''`` from the lower-cased declared type."""
    t = F.lower(F.col(field_type))
    return (F.when(t.isin(*S.INT_CHECK_TYPES), F.lit("int"))
             .when(t.isin(*S.TIMESTAMP_CHECK_TYPES), F.lit("timestamp"))
             .when(t.isin(*S.DATE_CHECK_TYPES), F.lit("date"))
             .otherwise(F.lit("")))


def ods_type_expr(field_type: str = "field_type") -> Column:
    """DDL-1: declared type -> ODS type name."""
    mapping = F.create_map(*[x for k, v in S.ODS_TYPE_BY_DECLARED.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(mapping[F.lower(F.col(field_type))], F.lit(S.DEFAULT_ODS_TYPE))


def partition_strategy_expr() -> Column:
    """MET-13: load key when loaded by key, none for Full, load date for Delta (B12: per row)."""
    return (F.when(F.col("load_solution") == S.LOAD_SOLUTION_BY_KEY, F.lit(S.PART_LOAD_KEY))
             .when(F.col("full_delta") == S.FULL_DELTA_FULL, F.lit(S.PART_NONE))
             .when(F.col("full_delta") == S.FULL_DELTA_DELTA, F.lit(S.PART_LOAD_DATE)))


def load_keys_expr() -> Column:
    """MET-14: ``split(lower(load_key), ',')``; empty array when unset."""
    return F.when(F.col("load_key").isNull() | (F.col("load_key") == ""), F.array().cast("array<string>")) \
            .otherwise(F.split(F.lower(F.col("load_key")), ","))


# --------------------------------------------------------------------------- plans

def file_lookup(interface: DataFrame, interface_file: DataFrame) -> DataFrame:
    """MET-1 / JOIN-1: active files with their interface, one row per (file, interface).

    The reference's left join with a filter on the right side is an inner join.
    """
    f, i = interface_file.alias("f"), interface.alias("i")
    joined = f.join(i, F.col("i.id") == F.col("f.interface_id"), "inner") \
              .where((F.col("i.status") == 3) & (F.col("i.deleted") == F.lit(False)))
    return joined.select(
        file_name_expr().alias("file_name"),
        F.col("i.id").alias("interface_id"),
        F.col("i.source_system").alias("source_system"),
        F.col("f.id").alias("file_id"),
        F.col("f.file_type").alias("file_type"),
        F.col("f.tab_comment_cn").alias("tab_comment_cn"),
        F.col("f.load_solution").alias("load_solution"),
        F.col("f.full_delta").alias("full_delta"),
        F.col("f.if_physical_deletion").alias("if_physical_deletion"),
        F.col("f.load_key").alias("load_key"),
        physical_table_name().alias("ddl_name"))


def lookup_cardinality(files: DataFrame, names: Optional[DataFrame] = None) -> DataFrame:
    """MET-2: matches per requested file name -> ``not_found`` / ``ok`` / ``ambiguous``."""
    counts = files.groupBy("file_name").agg(F.count(F.lit(1)).alias("matches"))
    if names is not None:
        counts = names.select("file_name").distinct().join(counts, "file_name", "left") \
                      .select("file_name", F.coalesce("matches", F.lit(0)).cast("bigint").alias("matches"))
    status = (F.when(F.col("matches") == 0, F.lit("not_found"))
               .when(F.col("matches") == 1, F.lit("ok")).otherwise(F.lit("ambiguous")))
    return counts.withColumn("status", status)


def field_list(interface_field: DataFrame) -> DataFrame:
    """MET-3 / MET-4 / MET-7 / DDL-1: physical fields of every file, ordered by index."""
    return (interface_field.select(
                "file_id", "index", "name", "field_alias",
                physical_column_name().alias("column_name"),
                F.lower("field_type").alias("field_type"),
                ods_type_expr().alias("ods_type"),
                clean_comment().alias("field_comment"),
                "primary_key", "business_key", "if_enum_field", "if_not_null", "value_range")
            .orderBy("file_id", "index"))


def table_names(files: DataFrame, databases: Optional[dict] = None) -> DataFrame:
    """MET-6: table names per layer; the key-feed names are blank without physical deletion."""
    db = {"ldg": "ldg", "stg": "stg", "rej": "rej", "ods": "ods", **(databases or {})}
    x = F.col("ddl_name")
    has_pk = F.col("if_physical_deletion") == "Y"

    def name(layer: str, *parts) -> Column:
        return F.concat(F.lit(db[layer] + "."), *parts)

    def pk_only(c: Column) -> Column:
        return F.when(has_pk, c).otherwise(F.lit(""))

    return files.select(
        "*",
        name("ldg", x).alias("ldg_table"),
        pk_only(name("ldg", x, F.lit("_pk"))).alias("ldg_pk_table"),
        name("stg", x).alias("stg_table"),
        pk_only(name("stg", x, F.lit("_pk"))).alias("stg_pk_table"),
        name("rej", F.lit("ldg_"), x, F.lit("_rej")).alias("rej_table"),
        pk_only(name("rej", F.lit("ldg_"), x, F.lit("_pk"))).alias("rej_pk_table"),
        name("ods", x).alias("ods_table"))


def key_columns(interface_field: DataFrame, prefer: str = "primary") -> DataFrame:
    """MET-8 / MET-9 / AGG-3: key columns per file in index order.

    ``keys`` is the primary key when one is flagged, else the business key
    (``prefer='business'`` swaps the precedence, as the v1 key tables do).
    """
    def ordered(flag: str) -> Column:
        picked = F.collect_list(F.when(F.col(flag) == "Y", F.struct(F.col("index"), physical_column_name().alias("n"))))
        return F.transform(F.array_sort(picked), lambda s: s["n"])

    out = interface_field.groupBy("file_id").agg(ordered("primary_key").alias("primary_keys"),
                                                 ordered("business_key").alias("business_keys"))
    first, second = ("primary_keys", "business_keys") if prefer == "primary" else ("business_keys", "primary_keys")
    return out.select(
        "file_id", "primary_keys", "business_keys",
        F.when(F.size(first) > 0, F.col(first)).otherwise(F.col(second)).alias("keys"),
        F.array_join("primary_keys", ",").alias("pk_list"),
        F.array_join("business_keys", ",").alias("bk_list"))


def column_rules(interface_field: DataFrame) -> DataFrame:
    """MET-10 / MET-12: one rule row per (file, column) for all files in one frame.

    ``rule_error`` is set when an enum rule has no value range (B18); rule
    building refuses such files.
    """
    is_enum = F.col("if_enum_field") == "Y"
    return interface_field.select(
        "file_id", "index",
        physical_column_name().alias("column_name"),
        F.lower("field_type").alias("field_type"),
        dq_check_kind().alias("check"),
        is_enum.alias("check_enum"),
        F.when(is_enum, F.col("value_range")).alias("enum_range"),
        (F.col("if_not_null") == "Y").alias("not_null"),
        clean_comment().alias("field_comment"),
        F.when(is_enum & F.col("value_range").isNull(), F.lit("enum rule without value range")).alias("rule_error"))


def rules_by_file(interface: DataFrame, interface_file: DataFrame, interface_field: DataFrame) -> DataFrame:
    """MET-12: the rules of every active file in one frame, tagged with the file name."""
    files = file_lookup(interface, interface_file).select("file_id", F.lower("file_name").alias("file_name"))
    return files.join(column_rules(interface_field), "file_id").orderBy("file_name", "index")


def key_rules(interface_field: DataFrame, prefer: str = "primary") -> DataFrame:
    """MET-11: rules of the key columns only (for the delete-key feed)."""
    keys = key_columns(interface_field, prefer).select("file_id", F.explode("keys").alias("column_name"))
    return column_rules(interface_field).join(keys, ["file_id", "column_name"], "left_semi")


def file_plan(interface: DataFrame, interface_file: DataFrame, databases: Optional[dict] = None) -> DataFrame:
    """MET-1 + MET-6 + MET-13 + MET-14: everything known per active file."""
    files = file_lookup(interface, interface_file)
    return table_names(files, databases).withColumns({
        "partition_strategy": partition_strategy_expr(),
        "load_keys": load_keys_expr(),
        "has_delete_feed": F.col("if_physical_deletion") == "Y"})


def load_list(load_file_list: DataFrame) -> DataFrame:
    """SRC-7: files switched on for automatic runs with their two flags."""
    return load_file_list.where(F.col("on_line")).select(
        F.col("load_file_name").alias("file_name"),
        F.col("drop_create_table_flag").alias("drop_create"),
        F.col("generate_tableddl_flag").alias("generate_ddl"))


def manual_list(spark: SparkSession, names: Sequence[str], drop_create: Optional[Sequence[bool]] = None,
                generate_ddl: Optional[Sequence[bool]] = None) -> DataFrame:
    """PIPE-6 manual mode: names with per-file flags, both default true."""
    drop_create = list(drop_create) if drop_create is not None else [True] * len(names)
    generate_ddl = list(generate_ddl) if generate_ddl is not None else [True] * len(names)
    if not (len(drop_create) == len(generate_ddl) == len(names)):
        raise ValueError("one drop/generate flag per file name is required")
    schema = T.StructType([T.StructField("file_name", T.StringType(), False),
                           T.StructField("drop_create", T.BooleanType(), False),
                           T.StructField("generate_ddl", T.BooleanType(), False)])
    return spark.createDataFrame(list(zip(names, drop_create, generate_ddl)), schema)


def empty_rules(spark: SparkSession) -> DataFrame:
    """SRC-8: typed empty rule frame (the starting point when rules are built file by file)."""
    return spark.createDataFrame([], column_rules_schema())


def column_rules_schema() -> T.StructType:
    return T.StructType([
        T.StructField("file_id", T.LongType()), T.StructField("index", T.IntegerType()),
        T.StructField("column_name", T.StringType()), T.StructField("field_type", T.StringType()),
        T.StructField("check", T.StringType()), T.StructField("check_enum", T.BooleanType()),
        T.StructField("enum_range", T.StringType()), T.StructField("not_null", T.BooleanType()),
        T.StructField("field_comment", T.StringType()), T.StructField("rule_error", T.StringType())])


# --------------------------------------------------------------------------- the one collect

def file_specs(metadata: dict, names: Optional[Iterable[str]] = None, databases: Optional[dict] = None,
               prefer: str = "primary") -> list[S.FileSpec]:
    """Build the driver-side specs of the requested files (MET-2 enforced).

    ``metadata`` holds the ``interface``, ``interface_file`` and
    ``interface_field`` DataFrames. One job collects the per-file rows with
    their ordered rules nested, so the driver receives metadata only.
    """
    files = file_plan(metadata["interface"], metadata["interface_file"], databases)
    fields = metadata["interface_field"]
    if names is not None:
        wanted = list(names)
        files = files.where(F.col("file_name").isin(wanted))
    rules = (column_rules(fields)
             .groupBy("file_id")
             .agg(F.array_sort(F.collect_list(F.struct("index", "column_name", "field_type", "check",
                                                       "enum_range", "check_enum", "not_null",
                                                       "field_comment", "rule_error"))).alias("rules")))
    keys = key_columns(fields, prefer).select("file_id", "keys")
    rows = files.join(rules, "file_id", "left").join(keys, "file_id", "left").collect()

    by_name: dict[str, list] = {}
    for r in rows:
        by_name.setdefault(r["file_name"], []).append(r)
    if names is not None:
        missing = [n for n in wanted if n not in by_name]
        if missing:
            raise LookupError(f"no active metadata for file(s) {missing}")
    ambiguous = sorted(n for n, rs in by_name.items() if len(rs) > 1)
    if ambiguous:
        raise LookupError(f"file(s) {ambiguous} match more than one active interface")

    specs = []
    for name in (wanted if names is not None else sorted(by_name)):
        r = by_name[name][0]
        if r["partition_strategy"] is None:
            raise ValueError(f"{name}: neither loaded by key nor {S.FULL_DELTA_FULL} nor {S.FULL_DELTA_DELTA} "
                             f"(load_solution={r['load_solution']!r}, full_delta={r['full_delta']!r})")
        col_rules = []
        for x in (r["rules"] or []):
            if x["rule_error"]:
                raise ValueError(f"{name}.{x['column_name']}: {x['rule_error']}")
            col_rules.append(S.ColumnRule(name=x["column_name"], check=x["check"], not_null=bool(x["not_null"]),
                                          enum_range=x["enum_range"] if x["check_enum"] else None,
                                          declared_type=x["field_type"], comment=x["field_comment"] or "",
                                          index=x["index"]))
        tables = S.TableSet(ldg=r["ldg_table"], stg=r["stg_table"], rej=r["rej_table"], ods=r["ods_table"],
                            ldg_pk=r["ldg_pk_table"], stg_pk=r["stg_pk_table"], rej_pk=r["rej_pk_table"])
        specs.append(S.FileSpec(
            file_name=name, file_id=r["file_id"], ddl_name=r["ddl_name"], source_system=r["source_system"],
            file_type=r["file_type"] or "", table_comment=r["tab_comment_cn"] or "",
            load_solution=r["load_solution"], full_delta=r["full_delta"],
            physical_deletion=bool(r["has_delete_feed"]), load_keys=tuple(r["load_keys"] or ()),
            partition_strategy=r["partition_strategy"], keys=tuple(r["keys"] or ()),
            rules=tuple(col_rules), tables=tables))
    return specs

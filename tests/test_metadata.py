"""Metadata plans over the inline metadata fixture (MET-*, SRC-7/8, PIPE-6)."""

import pytest

from landfall import spec as S
from landfall.plans import metadata as M


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_file_lookup_filters_inactive(meta):
    files = M.file_lookup(meta["interface"], meta["interface_file"])
    names = sorted(r["file_name"] for r in files.collect())
    assert names == ["CUSTOMER", "EVENTS", "LINEITEM", "ORDERS", "TWICE", "TWICE"]


def test_cardinality(spark, meta):
    files = M.file_lookup(meta["interface"], meta["interface_file"])
    wanted = M.manual_list(spark, ["ORDERS", "TWICE", "ORPHAN"])
    got = {r["file_name"]: (r["matches"], r["status"]) for r in M.lookup_cardinality(files, wanted).collect()}
    assert got == {"ORDERS": (1, "ok"), "TWICE": (2, "ambiguous"), "ORPHAN": (0, "not_found")}


def test_names_and_comments(meta):
    plan = M.file_plan(meta["interface"], meta["interface_file"])
    got = {r["file_name"]: r for r in plan.collect()}
    o = got["ORDERS"]
    assert (o.ddl_name, o.ldg_table, o.ldg_pk_table, o.stg_pk_table, o.rej_table, o.rej_pk_table, o.ods_table) == (
        "crm_orders", "ldg.crm_orders", "ldg.crm_orders_pk", "stg.crm_orders_pk", "rej.ldg_crm_orders_rej",
        "rej.ldg_crm_orders_pk", "ods.crm_orders")
    assert got["CUSTOMER"].ddl_name == "crm_customer" and got["CUSTOMER"].ldg_pk_table == ""
    assert got["EVENTS"].ddl_name == "erp_events"            # blank alias falls back to the name
    assert [got[n].partition_strategy for n in ("ORDERS", "CUSTOMER", "EVENTS")] == ["load_date", "none", "load_key"]
    assert got["EVENTS"].load_keys == ["event_type"]
    fields = {(r["file_id"], r["name"]): r for r in M.field_list(meta["interface_field"]).collect()}
    assert fields[(10, "ORDER_ID")].column_name == "order_id"
    assert fields[(10, "CUST_ID")].column_name == "cust_id"   # '' alias
    assert fields[(11, "CUSTKEY")].column_name == "c_custkey"  # real alias
    assert fields[(10, "ORDER_ID")].field_type == "int8" and fields[(10, "ORDER_ID")].ods_type == "bigint"
    assert fields[(10, "STATUS")].field_comment == "status  code ||状态"
    assert fields[(10, "TOTAL_PRICE")].field_comment == "price  amount  "   # null second language
    assert fields[(16, "DAY")].ods_type == "date" and fields[(16, "FLAG_COL")].ods_type == "boolean"
    assert fields[(16, "SMALL")].ods_type == "smallint" and fields[(12, "USER_ID")].ods_type == "int"
    assert fields[(13, "L_TAX")].ods_type == "decimal(20,4)" and fields[(12, "PROPS")].ods_type == "string"


def test_keys(meta):
    k = {r["file_id"]: r for r in M.key_columns(meta["interface_field"]).collect()}
    assert k[13]["keys"] == ["l_orderkey", "l_linenumber"] and k[13]["pk_list"] == "l_orderkey,l_linenumber"
    assert k[11]["keys"] == ["c_custkey"] and k[11]["primary_keys"] == []
    kb = {r["file_id"]: r for r in M.key_columns(meta["interface_field"], prefer="business").collect()}
    assert kb[17]["keys"] == ["id"] and kb[13]["keys"] == ["l_orderkey", "l_linenumber"]


def test_rules(meta):
    r = {(x["file_id"], x["column_name"]): x for x in M.column_rules(meta["interface_field"]).collect()}
    assert r[(10, "order_id")]["check"] == "int"                 # 'INT8' lower-cased (B7)
    assert r[(10, "status")]["enum_range"] == "F,O,P" and r[(10, "status")]["not_null"]
    assert r[(10, "order_ts")]["check"] == "timestamp" and r[(16, "day")]["check"] == "date"
    assert r[(13, "l_extendedprice")]["check"] == ""
    kr = rows(M.key_rules(meta["interface_field"]), "file_id", "column_name")
    assert (10, "order_id") in kr and (10, "status") not in kr and (13, "l_linenumber") in kr


def test_enum_without_range_is_refused(spark, meta):
    bad = meta["interface_field"].union(spark.createDataFrame(
        [(10, "EXTRA", None, "varchar", None, 7, "N", "N", "e", "e", "Y", "N")], meta["interface_field"].schema))
    with pytest.raises(ValueError, match="enum rule without value range"):
        M.file_specs({**meta, "interface_field": bad}, ["ORDERS"])


def test_file_specs(meta):
    orders, events = M.file_specs(meta, ["ORDERS", "EVENTS"])
    assert orders.columns == ["order_id", "cust_id", "status", "total_price", "order_ts", "priority"]
    assert orders.keys == ("order_id",) and orders.physical_deletion and orders.tables.stg_pk == "stg.crm_orders_pk"
    assert [r.name for r in orders.key_rules()] == ["order_id"]
    assert events.partition_strategy == S.PART_LOAD_KEY and events.load_keys == ("event_type",)
    with pytest.raises(LookupError, match="more than one"):
        M.file_specs(meta, ["TWICE"])
    with pytest.raises(LookupError, match="no active metadata"):
        M.file_specs(meta, ["ORPHAN"])


def test_load_lists(spark, meta):
    assert rows(M.load_list(meta["load_file_list"]), "file_name", "drop_create", "generate_ddl") == [
        ("CUSTOMER", False, True), ("EVENTS", True, False), ("ORDERS", True, True)]
    assert rows(M.manual_list(spark, ["A", "B"], [False, True]), "file_name", "drop_create", "generate_ddl") == [
        ("A", False, True), ("B", True, True)]
    assert M.empty_rules(spark).count() == 0


def test_rules_by_file(meta):
    r = M.rules_by_file(meta["interface"], meta["interface_file"], meta["interface_field"])
    names = {x["file_name"] for x in r.collect()}
    assert names == {"orders", "customer", "events", "lineitem", "twice"}
    assert [x["column_name"] for x in r.where("file_name = 'orders'").collect()] == [
        "order_id", "cust_id", "status", "total_price", "order_ts", "priority"]


def test_metadata_from_files_and_views(spark, meta, tmp_path):
    from landfall.sources.metadata import read_metadata_files, register_views
    root = str(tmp_path / "meta")
    for name, df in meta.items():
        df.write.parquet(f"{root}/{name}")
    again = read_metadata_files(spark, root)
    assert [s.keys for s in M.file_specs(again, ["ORDERS", "LINEITEM"])] == [("order_id",), ("l_orderkey", "l_linenumber")]
    register_views(again, {"interface_file": "pg_file"})
    assert spark.sql("select count(*) from pg_file").first()[0] == 8
    assert spark.sql("select count(*) from interface_field").first()[0] == len(meta["interface_field"].collect())

"""Edge values of every row check (FIXTURES.md §3-5) and the flag rules."""

import pytest
from pyspark.sql import functions as F

from landfall import spec as S
from landfall.functions import checks
from landfall.operators.validate import validate, violation_of

TS_ACCEPT = ["2022-09-11 10:00:00", "09/11/2022 10:00:00", "2022-09-11", "2024-03-10 02:30:00"]
TS_REJECT = ["2022/09/11 10:00:00", "2022-02-30", "2022-9-1", "2022-09-11 10:00:00x", "2022-09-11T10:00:00",
             "2022-09-11 24:00:00", "02/29/2023 00:00:00", "13/01/2022 00:00:00", "12022-01-01", "0000-01-01",
             "2022-09-11 10:00:00\n"]


def one_col(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def evaluate(spark, values, expr):
    df = one_col(spark, values)
    return {r["v"]: r["out"] for r in df.select("v", expr.alias("out")).collect()}


def test_timestamp_v2(spark):
    got = evaluate(spark, TS_ACCEPT + TS_REJECT, checks.timestamp_ok("v", S.TIMESTAMP_FORMATS_V2))
    assert all(got[v] for v in TS_ACCEPT)
    assert not any(got[v] for v in TS_REJECT)


def test_timestamp_v1_middle_format(spark):
    got = evaluate(spark, ["2022/09/11 10:00:00", "09/11/2022 10:00:00"], checks.timestamp_ok("v", S.TIMESTAMP_FORMATS_V1))
    assert got == {"2022/09/11 10:00:00": True, "09/11/2022 10:00:00": False}


def test_timestamp_ok_is_timezone_free(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = evaluate(spark, ["2024-03-10 02:30:00"], checks.timestamp_ok("v", S.TIMESTAMP_FORMATS_V2))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got["2024-03-10 02:30:00"]


def test_integer(spark):
    got = evaluate(spark, ["12", "007", "-1", "+1", "1.0", " 12", "12\n", "１２"], checks.int_ok("v"))
    assert got == {"12": True, "007": True, "-1": False, "+1": False, "1.0": False, " 12": False,
                   "12\n": False, "１２": False}


def test_enum_exact_membership(spark):
    got = evaluate(spark, ["ddDocument", "document", "MiniSite", " MiniSite"],
                   checks.enum_ok("v", "Document,MiniSite".split(",")))
    assert got == {"ddDocument": False, "document": False, "MiniSite": True, " MiniSite": False}


def test_normalise(spark):
    rule = S.ColumnRule("v", check="timestamp")
    got = evaluate(spark, ["09/11/2022 10:00:00", "2022-09-11", "2022-09-11 10:00:00", "2022-02-30", None],
                   checks.output_value(rule, S.V2))
    assert got == {"09/11/2022 10:00:00": "2022-09-11 10:00:00", "2022-09-11": "2022-09-11 00:00:00",
                   "2022-09-11 10:00:00": "2022-09-11 10:00:00", "2022-02-30": "2022-02-30", None: None}
    date_rule = S.ColumnRule("v", check="date")
    got = evaluate(spark, ["09/11/2022 10:00:00", "2022-09-11"], checks.output_value(date_rule, S.V2))
    assert got == {"09/11/2022 10:00:00": "2022-09-11 10:00:00", "2022-09-11": "2022-09-11"}
    # v1 never rewrites
    got = evaluate(spark, ["2022-09-11"], checks.output_value(rule, S.V1))
    assert got == {"2022-09-11": "2022-09-11"}


def test_not_null_profiles(spark):
    rule = S.ColumnRule("v", not_null=True)
    v2 = evaluate(spark, ["", None, "a"], violation_of(rule, "not_null", "v2"))
    v1 = evaluate(spark, ["", None, "a"], violation_of(rule, "not_null", "v1"))
    msg = "v列未通过[非空检查]"
    assert v2 == {"": msg, None: None, "a": None}
    assert v1 == {"": msg, None: msg, "a": None}


def test_type_and_enum_skip_blank(spark):
    rule = S.ColumnRule("v", check="int", enum_range="1,2")
    got = evaluate(spark, ["", None, "3", "x"], checks.render_flag([m for _, m in checks.column_violations(
        rule, S.V2, checks.messages())]))
    assert got[""] == "" and got[None] == ""
    assert got["3"] == "v列未通过[枚举值检查] errValue->3,range->1,2"
    assert got["x"] == ("v列未通过[数据格式校验-数值格式] errValue->x||"
                        "v列未通过[枚举值检查] errValue->x,range->1,2")


RULES = [S.ColumnRule("id", check="int"), S.ColumnRule("st", not_null=True, enum_range="A,B"),
         S.ColumnRule("ts", check="timestamp")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, st string, ts string, load_dt string")


def test_validate_flag_order_and_header(spark):
    rows = [("1", "A", "2022-09-11", "d"),       # clean, ts padded
            ("id", "st", "ts", "d"),             # header: dropped
            ("id", "st", None, "d"),             # not a header (null differs)
            ("x", "", "09/11/2022 10:00:00", "d"),
            ("2", "A", "2022-09-11 10:00:00", "d"),
            ("2", "C", "bad", "d")]
    got = {(r["id"], r["st"]): (r["ts"], r["flag"]) for r in validate(frame(spark, rows), RULES, ["id"]).collect()}
    assert len(got) == 5
    assert got[("1", "A")] == ("2022-09-11 00:00:00", "")
    assert got[("id", "st")] == (None, "id列未通过[数据格式校验-数值格式] errValue->id||"
                                       "st列未通过[枚举值检查] errValue->st,range->A,B||错行数据")
    assert got[("x", "")] == ("2022-09-11 10:00:00", "id列未通过[数据格式校验-数值格式] errValue->x||st列未通过[非空检查]")
    assert got[("2", "A")][1] == "主键未通过[唯一性校验]"
    assert got[("2", "C")][1] == ("st列未通过[枚举值检查] errValue->C,range->A,B||"
                                  "ts列未通过[数据格式校验-时间格式] errValue->bad||主键未通过[唯一性校验]")


def test_uniqueness_null_keys_and_no_keys(spark):
    rows = [(None, None, None, "d"), (None, None, None, "d"), ("1", "A", "2022-09-11", "d")]
    flags = sorted(r["flag"] for r in validate(frame(spark, rows), RULES, ["id"]).collect())
    assert flags == ["", "主键未通过[唯一性校验]||错行数据", "主键未通过[唯一性校验]||错行数据"]
    flags = sorted(r["flag"] for r in validate(frame(spark, rows), RULES, []).collect())
    assert flags == ["", "错行数据", "错行数据"]


def test_composite_key_no_concat_collision(spark):
    rules = [S.ColumnRule("a"), S.ColumnRule("b")]
    df = spark.createDataFrame([("1", "11", "d"), ("11", "1", "d")], "a string, b string, load_dt string")
    assert [r["flag"] for r in validate(df, rules, ["a", "b"]).collect()] == ["", ""]


def test_v1_profile(spark):
    rows = [("1", None, "2022/09/11 10:00:00", "d"), ("2", "A", "2022-09-11", "d")]
    got = {r["id"]: (r["ts"], r["flag"]) for r in validate(frame(spark, rows), RULES, ["id"], profile="v1").collect()}
    assert got["1"] == ("2022/09/11 10:00:00", "st列未通过[非空检查]")
    assert got["2"] == ("2022-09-11", "")


def test_english_messages(spark):
    rows = [("x", "A", "2022-09-11", "d")]
    flag = validate(frame(spark, rows), RULES, ["id"], message_style="en").first()["flag"]
    assert flag == "id failed [format - integer] value->x"


def test_schema_mismatch_is_reported(spark):
    with pytest.raises(ValueError, match="without rule=\\['ts'\\]"):
        validate(frame(spark, [("1", "A", "x", "d")]), RULES[:2], ["id"])
    with pytest.raises(ValueError, match="unknown keys"):
        validate(frame(spark, [("1", "A", "x", "d")]), RULES, ["nope"])


def test_layout_regex():
    rx, iso, has_time = checks.layout_regex("MM/dd/yyyy HH:mm:ss")
    assert iso == "$3-$1-$2 $4:$5:$6" and has_time
    assert rx.startswith(r"\A") and rx.endswith(r"\z")


def test_layout_positions():
    assert checks.layout_positions("MM/dd/yyyy HH:mm:ss") == (
        {"MM": 1, "dd": 4, "yyyy": 7, "HH": 12, "mm": 15, "ss": 18}, True)
    assert checks.layout_positions("yyyy-MM-dd") == ({"yyyy": 1, "MM": 6, "dd": 9}, False)


def test_normalise_timestamp_expression(spark):
    got = evaluate(spark, ["09/11/2022 10:00:00", "2022-09-11", "bad", "02/30/2022 00:00:00"],
                   checks.normalise_timestamp("v", S.TIMESTAMP_FORMATS_V2))
    assert got == {"09/11/2022 10:00:00": "2022-09-11 10:00:00", "2022-09-11": "2022-09-11 00:00:00",
                   "bad": "bad", "02/30/2022 00:00:00": "02/30/2022 00:00:00"}

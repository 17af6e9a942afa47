"""Spark checks vs a small pure-Python model of the row rules, on generated inputs."""

import datetime as dt
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from landfall import spec as S
from landfall.functions import checks
from landfall.operators.validate import validate

MSG = S.MESSAGES["native"]


def py_ts_ok(v: str, formats) -> bool:
    """Strict layout: exact digits per field and a real calendar time."""
    for fmt in formats:
        pat = re.escape(fmt)
        for tok, width in (("yyyy", 4), ("MM", 2), ("dd", 2), ("HH", 2), ("mm", 2), ("ss", 2)):
            pat = pat.replace(tok, r"(?P<%s>\d{%d})" % (tok[0] + str(len(tok)) + tok[-1], width))
        m = re.fullmatch(pat, v, flags=re.ASCII)
        if not m:
            continue
        g = m.groupdict()
        try:
            dt.datetime(int(g["y4y"]), int(g["M2M"]), int(g["d2d"]), int(g.get("H2H") or 0),
                        int(g.get("m2m") or 0), int(g.get("s2s") or 0))
            return int(g["y4y"]) > 0
        except ValueError:
            continue
    return False


def py_int_ok(v: str) -> bool:
    return all(c in "0123456789" for c in v)


digits = st.text(alphabet="0123456789", min_size=1, max_size=4)
ts_like = st.one_of(
    st.builds(lambda y, mo, d, h, mi, s: f"{y}-{mo}-{d} {h}:{mi}:{s}", digits, digits, digits, digits, digits, digits),
    st.builds(lambda y, mo, d, h, mi, s: f"{mo}/{d}/{y} {h}:{mi}:{s}", digits, digits, digits, digits, digits, digits),
    st.builds(lambda y, mo, d: f"{y}-{mo}-{d}", digits, digits, digits),
    st.tuples(st.datetimes(min_value=dt.datetime(1900, 1, 1), max_value=dt.datetime(2100, 1, 1)),
              st.sampled_from(["%Y-%m-%d %H:%M:%S", "%m/%d/%Y %H:%M:%S", "%Y-%m-%d", "%Y/%m/%d %H:%M:%S"]))
      .map(lambda p: p[0].strftime(p[1])),
    st.sampled_from(["0000-01-01", "0000-01-01 00:00:00", "01/01/0000 00:00:00", "2024-02-29", "2023-02-29"]),
    st.text(alphabet="0123456789-/: T", max_size=20))


@settings(max_examples=3, deadline=None, derandomize=True)
@given(st.lists(ts_like, min_size=50, max_size=200))
def test_timestamp_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for formats in (S.TIMESTAMP_FORMATS_V2, S.TIMESTAMP_FORMATS_V1):
        got = {r["v"]: r["ok"] for r in df.select("v", checks.timestamp_ok("v", formats).alias("ok")).collect()}
        for v in values:
            assert got[v] == py_ts_ok(v, formats), (v, formats)


@settings(max_examples=3, deadline=None, derandomize=True)
@given(st.lists(st.text(alphabet="0123456789 +-.a１\n", max_size=6), min_size=20, max_size=100))
def test_integer_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = {r["v"]: r["ok"] for r in df.select("v", checks.int_ok("v").alias("ok")).collect()}
    assert all(got[v] == py_int_ok(v) for v in values)


# ----------------------------------------------------------------------------- whole rows

RULES = [S.ColumnRule("k", check="int"), S.ColumnRule("s", not_null=True, enum_range="A,B"),
         S.ColumnRule("t", check="timestamp")]


def py_flags(rows, profile="v2"):
    """The reference's per-row algorithm, written directly."""
    cols = ["k", "s", "t"]
    rules = {r.name: r for r in RULES}
    prof = S.Profile.of(profile)
    body = [r for r in rows if not all(r[i] == c for i, c in enumerate(cols))]
    counts = {}
    for r in body:
        counts[r[0]] = counts.get(r[0], 0) + 1
    out = []
    for r in body:
        msgs, misaligned, vals = [], False, list(r)
        for i, c in enumerate(cols):
            v, rule = r[i], rules[c]
            if v is None:
                misaligned = True
            if v is None or v == "":
                if rule.not_null and (prof.null_is_missing or v is not None):
                    msgs.append(MSG["not_null"].format(col=c))
                continue
            if rule.check == "int" and not py_int_ok(v):
                msgs.append(MSG["int"].format(col=c) + v)
            if rule.check == "timestamp":
                if not py_ts_ok(v, prof.timestamp_formats):
                    msgs.append(MSG["timestamp"].format(col=c) + v)
                elif prof.normalise_timestamps:
                    if "/" in v:
                        m, d, rest = v[:2], v[3:5], v[6:]
                        vals[i] = f"{rest[:4]}-{m}-{d}{rest[4:]}"
                    if len(v) == 10:
                        vals[i] = v + " 00:00:00"
            if rule.enum_range is not None and v not in rule.enum_range.split(","):
                msgs.append(MSG["enum"].format(col=c) + v + MSG["enum_range"].format(range=rule.enum_range))
        if counts[r[0]] > 1:
            msgs.append(MSG["unique"])
        if misaligned and prof.flag_misaligned:
            msgs.append(MSG["misaligned"])
        out.append((*vals, "||".join(msgs)))
    return sorted(out, key=repr)


cell = {
    "k": st.one_of(st.none(), st.just(""), st.sampled_from(["1", "2", "3", "x", "k"])),
    "s": st.one_of(st.none(), st.just(""), st.sampled_from(["A", "B", "C", "a", "s"])),
    "t": st.one_of(st.none(), st.just(""), ts_like, st.just("t")),
}
row = st.tuples(cell["k"], cell["s"], cell["t"])


@settings(max_examples=4, deadline=None, derandomize=True)
@given(st.lists(row, min_size=1, max_size=60), st.sampled_from(["v2", "v1"]))
def test_validate_matches_model(spark, rows, profile):
    df = spark.createDataFrame([(*r, "d") for r in rows], "k string, s string, t string, load_dt string")
    got = sorted((tuple(x[:3]) + (x[4],) for x in validate(df, RULES, ["k"], profile=profile).collect()), key=repr)
    assert got == py_flags(rows, profile)

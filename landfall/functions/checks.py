"""Row-level data-quality checks as Spark Column expressions (DQ-1..DQ-10).

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so the
whole check list of a table compiles into one projection inside whole-stage
codegen; nothing here runs Python per row.

Semantics (per column, value ``v``):
* blank (null or ``''``): only the not-null rule applies. Profile v2 fails only
  ``''`` (a null means a misaligned row, flagged once per row); v1 fails both.
* present: the type check (integer / timestamp / date) and then the enum check.
"""

from __future__ import annotations

import re
from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from landfall.spec import FLAG_SEPARATOR, MESSAGES, ColumnRule, Profile, ods_type

_TOKEN = re.compile(r"yyyy|MM|dd|HH|mm|ss")
_WIDTH = {"yyyy": 4, "MM": 2, "dd": 2, "HH": 2, "mm": 2, "ss": 2}


def messages(style: str = "native") -> dict:
    return MESSAGES[style]


def _c(col: "str | Column") -> Column:
    return F.col(col) if isinstance(col, str) else col


# --------------------------------------------------------------------------- layouts

def layout_regex(fmt: str) -> tuple[str, str, bool]:
    """Java regex matching exactly ``fmt``, the ISO replacement and whether it has a time part.

    Kept for callers that want a regex; the checks use ``layout_mask``.
    """
    parts, order, pos = [], [], 0
    for m in _TOKEN.finditer(fmt):
        parts.append(re.escape(fmt[pos:m.start()]))
        parts.append(r"(\d{%d})" % _WIDTH[m.group()])
        order.append(m.group())
        pos = m.end()
    parts.append(re.escape(fmt[pos:]))
    group = {tok: f"${i + 1}" for i, tok in enumerate(order)}
    has_time = "HH" in group
    iso = f"{group['yyyy']}-{group['MM']}-{group['dd']}"
    if has_time:
        iso += f" {group['HH']}:{group['mm']}:{group['ss']}"
    return r"\A" + "".join(parts) + r"\z", iso, has_time


_ISO_DATE, _ISO_TS = "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss"


def layout_positions(fmt: str) -> tuple[dict, bool]:
    """1-based position of each field of a fixed-width layout, and whether it has a time.

    ``'MM/dd/yyyy HH:mm:ss'`` -> ``({'MM': 1, 'dd': 4, 'yyyy': 7, 'HH': 12, ...}, True)``.
    """
    fields, width, pos = {}, 0, 0
    for m in _TOKEN.finditer(fmt):
        width += m.start() - pos
        fields[m.group()] = width + 1
        width += _WIDTH[m.group()]
        pos = m.end()
    if not {"yyyy", "MM", "dd"} <= set(fields):
        raise ValueError(f"layout {fmt!r} needs yyyy, MM and dd")
    return fields, "HH" in fields


# --------------------------------------------------------------------------- predicates

def is_header_row(columns: Sequence[str]) -> Column:
    """DQ-1: every data column equals its own name (a null never does)."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(c)) for c in columns])


def any_null(columns: Sequence[str]) -> Column:
    """DQ-2: a landing row with a missing (null) field is misaligned."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def all_null(columns: Sequence[str]) -> Column:
    """SPL-3: every data column is null (``coalesce`` short-circuits)."""
    return F.coalesce(*[F.col(c) for c in columns]).isNull()


def is_present(v: "str | Column") -> Column:
    v = _c(v)
    return v.isNotNull() & (v != F.lit(""))


def int_ok(v: "str | Column") -> Column:
    """DQ-4: only ASCII digits (no sign, blank, dot); ``''`` trivially passes."""
    return _c(v).rlike(r"\A[0-9]*\z")


def iso_candidate(v: "str | Column", formats: Iterable[str]) -> Column:
    """The value rewritten to ISO by the first layout it matches exactly, else null.

    One anchored ``rlike`` per layout until the first match (a mismatching layout
    fails at its first differing character); an ISO layout is used as is and any
    other layout is reassembled from fixed-position substrings, so no
    ``regexp_replace`` runs.
    """
    v = _c(v)
    out = F.lit(None).cast("string")
    for fmt in reversed(list(formats)):
        pos, has_time = layout_positions(fmt)
        rx, _, _ = layout_regex(fmt)
        if fmt in (_ISO_TS, _ISO_DATE):
            iso = v
        else:
            part = lambda tok: F.substring(v, pos[tok], _WIDTH[tok])
            bits = [part("yyyy"), F.lit("-"), part("MM"), F.lit("-"), part("dd")]
            if has_time:
                bits += [F.lit(" "), part("HH"), F.lit(":"), part("mm"), F.lit(":"), part("ss")]
            iso = F.concat(*bits)
        out = F.when(v.rlike(rx), iso).otherwise(out)
    return out


def iso_is_real(iso: Column) -> Column:
    """A real calendar date/time (no Feb 30, hour 24, month 13, year 0000); no time zone involved."""
    return iso.try_cast("timestamp_ntz").isNotNull() & ~iso.startswith("0000")


def timestamp_ok(v: "str | Column", formats: Iterable[str]) -> Column:
    """DQ-5/DQ-6: value has one of the layouts exactly and is a real calendar time."""
    return iso_is_real(iso_candidate(v, formats))


def normalised_from_iso(iso: Column, pad_time: bool) -> Column:
    """DQ-10 from the ISO candidate: a date-only value gets `` 00:00:00`` when ``pad_time``."""
    if not pad_time:
        return iso
    return F.when(F.length(iso) == 10, F.concat(iso, F.lit(" 00:00:00"))).otherwise(iso)


def normalise_timestamp(v: "str | Column", formats: Iterable[str], pad_time: bool = True) -> Column:
    """DQ-10: passing value rewritten to ``yyyy-MM-dd HH:mm:ss``; others unchanged."""
    v = _c(v)
    iso = iso_candidate(v, formats)
    return F.when(iso_is_real(iso), normalised_from_iso(iso, pad_time)).otherwise(v)


def enum_ok(v: "str | Column", members: Sequence[str]) -> Column:
    """DQ-7: exact, case-sensitive, untrimmed membership."""
    return _c(v).isin(list(members))


# --------------------------------------------------------------------------- violations

def column_violations(rule: ColumnRule, profile: Profile, msgs: dict,
                      ts_ok: "Column | None" = None) -> list[tuple[str, Column]]:
    """``(check, message)`` pairs of one column in the reference's order; a message is null when passing.

    ``ts_ok`` may carry a precomputed timestamp test (see ``validate``).
    """
    name = rule.name
    v = F.col(name)
    present = is_present(v)
    out: list[tuple[str, Column]] = []
    if rule.not_null:
        blank = (v.isNull() | (v == F.lit(""))) if profile.null_is_missing else (v == F.lit(""))
        out.append(("not_null", F.when(blank, F.lit(msgs["not_null"].format(col=name)))))
    if rule.check == "int":
        out.append(("int", F.when(present & ~int_ok(v), F.concat(F.lit(msgs["int"].format(col=name)), v))))
    elif rule.check in ("timestamp", "date"):
        ok = ts_ok if ts_ok is not None else timestamp_ok(v, profile.timestamp_formats)
        out.append((rule.check, F.when(present & ~ok, F.concat(F.lit(msgs["timestamp"].format(col=name)), v))))
    if rule.enum_range is not None:
        text = F.concat(F.lit(msgs["enum"].format(col=name)), v,
                        F.lit(msgs["enum_range"].format(range=rule.enum_range)))
        out.append(("enum", F.when(present & ~enum_ok(v, rule.enum_members), text)))
    return out


def output_value(rule: ColumnRule, profile: Profile, iso: "Column | None" = None,
                 ok: "Column | None" = None) -> Column:
    """Value written downstream: timestamps normalised (v2), everything else raw.

    Date columns are rewritten from the slash layout only (so the ODS cast keeps
    them) and are not padded with a time. ``iso`` may carry a precomputed
    ``iso_candidate`` and ``ok`` its test.
    """
    v = F.col(rule.name)
    if not profile.normalise_timestamps or rule.check not in ("timestamp", "date"):
        return v
    if iso is None:
        iso = iso_candidate(v, profile.timestamp_formats)
    if ok is None:
        ok = is_present(v) & iso_is_real(iso)
    return F.when(ok,
                  normalised_from_iso(iso, pad_time=rule.check == "timestamp")).otherwise(v)


def not_castable(rule: ColumnRule, value: Column, msgs: dict) -> Column:
    """The message of a present value (as written downstream) that its ODS type cannot take, else null."""
    target = ods_type(rule.declared_type)
    target = "timestamp_ntz" if target == "timestamp" else target
    lost = is_present(value) & value.try_cast(target).isNull() if target != "string" else F.lit(False)
    return F.when(lost, F.concat(F.lit(msgs["castable"].format(col=rule.name)), value))


def violation_array(tagged: "Sequence[tuple[str, str, Column]]") -> Column:
    """``(column, check, message)`` of every violation, in order, as an array of structs."""
    every = [F.struct(F.lit(c).alias("column"), F.lit(k).alias("check"), m.alias("message")) for c, k, m in tagged]
    if not every:
        return F.array().cast("array<struct<column:string,check:string,message:string>>")
    return F.filter(F.array(*every), lambda x: x["message"].isNotNull())


def flag_of(violations: Column) -> Column:
    """DQ-9 from the array of ``violation_array``."""
    return F.array_join(F.transform(violations, lambda x: x["message"]), FLAG_SEPARATOR)


def render_flag(violations: Sequence[Column]) -> Column:
    """DQ-9: messages joined by ``||``; ``concat_ws`` skips nulls so a clean row gets ``''``."""
    if not violations:
        return F.lit("")
    return F.concat_ws(FLAG_SEPARATOR, *violations)

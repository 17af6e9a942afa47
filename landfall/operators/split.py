"""Split a validated frame into clean, rejected and blank rows, and count them.

SPL-1..4. All four counts come from one aggregate (or from an ``Observation``
attached to the write, see ``plans.load``) instead of the four
separate count jobs of the reference.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions import checks
from landfall.operators.validate import FLAG
from landfall.spec import Profile


def is_clean() -> Column:
    return F.col(FLAG) == F.lit("")


def is_reject(columns: Sequence[str], profile: "str | Profile" = "v2") -> Column:
    """SPL-2 (v2): flagged and at least one data column not null; SPL-2b (v1): flagged."""
    flagged = F.col(FLAG) != F.lit("")
    if Profile.of(profile).reject_requires_value:
        return flagged & ~checks.all_null(columns)
    return flagged


def is_blank(columns: Sequence[str]) -> Column:
    """SPL-3: flagged rows whose data columns are all null (stored nowhere)."""
    return (F.col(FLAG) != F.lit("")) & checks.all_null(columns)


def clean_rows(validated: DataFrame, columns: Sequence[str]) -> DataFrame:
    """SPL-1: rows with an empty flag, data columns only."""
    return validated.where(is_clean()).select(*columns)


def reject_rows(validated: DataFrame, columns: Sequence[str], profile: "str | Profile" = "v2") -> DataFrame:
    """SPL-2: rejected rows with their flag."""
    return validated.where(is_reject(columns, profile)).select(*columns, FLAG)


def blank_rows(validated: DataFrame, columns: Sequence[str]) -> DataFrame:
    return validated.where(is_blank(columns)).select(*columns, FLAG)


def audit_exprs(columns: Sequence[str], profile: "str | Profile" = "v2") -> list[Column]:
    """SPL-4 / AGG-2: total, clean, rejected and blank counts as aggregate expressions."""
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(is_clean()).alias("clean"),
        F.count_if(is_reject(columns, profile)).alias("rejected"),
        F.count_if(is_blank(columns)).alias("blank"),
    ]


def load_audit(validated: DataFrame, columns: Sequence[str], profile: "str | Profile" = "v2") -> DataFrame:
    """One-row frame of the load counts, computed in a single pass."""
    return validated.agg(*audit_exprs(columns, profile))

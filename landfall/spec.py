"""Plain value objects handed from the metadata plans to the row plans.

Only metadata (one row per file, one row per field) is ever collected to the
driver; these classes hold that small result so the row-level plans can be
built as Column expressions.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Optional

# ---------------------------------------------------------------------------
# They must equal the reference's so results match.
# ---------------------------------------------------------------------------

# Declared field type (lower-cased) -> ODS column type.
ODS_TYPE_BY_DECLARED = {
    "bigint": "bigint", "int8": "bigint", "int8range": "bigint", "int4range": "bigint", "int2vector": "bigint",
    "_int2": "smallint", "int2": "smallint",
    "_int4": "int", "int4": "int",
    "time_stamp": "timestamp", "timestamp": "timestamp", "timestamptz": "timestamp",
    "datetime": "timestamp", "datetime2": "timestamp",
    "float4": "double", "float8": "double",
    "money": "decimal(20,4)", "numeric": "decimal(20,4)",
    "date": "date",
    "bool": "boolean",
}
DEFAULT_ODS_TYPE = "string"

# Declared field type (lower-cased) -> data-quality check.
INT_CHECK_TYPES = ("bigint", "int8", "int8range", "int4range", "int2vector", "_int2", "int2", "_int4", "int4")
TIMESTAMP_CHECK_TYPES = ("time_stamp", "timestamp", "timestamptz", "datetime", "datetime2")
DATE_CHECK_TYPES = ("date",)

# Accepted timestamp layouts, tried in this order.
TIMESTAMP_FORMATS_V2 = ("yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy HH:mm:ss", "yyyy-MM-dd")
TIMESTAMP_FORMATS_V1 = ("yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss", "yyyy-MM-dd")

# Load strategy names in interface_file.
LOAD_SOLUTION_BY_KEY = "full delete full load by key"
FULL_DELTA_FULL = "Full"
FULL_DELTA_DELTA = "Delta"

# Violation texts. "native" keeps the reference's exact wording.
MESSAGES = {
    "native": {
        "not_null": "{col}列未通过[非空检查]",
        "int": "{col}列未通过[数据格式校验-数值格式] errValue->",
        "timestamp": "{col}列未通过[数据格式校验-时间格式] errValue->",
        "enum": "{col}列未通过[枚举值检查] errValue->",
        "enum_range": ",range->{range}",
        "unique": "主键未通过[唯一性校验]",
        "misaligned": "错行数据",
        "castable": "{col}列未通过[类型转换检查] errValue->",
        "flag_comment": "标签",
    },
    "en": {
        "not_null": "{col} failed [not null]",
        "int": "{col} failed [format - integer] value->",
        "timestamp": "{col} failed [format - timestamp] value->",
        "enum": "{col} failed [allowed values] value->",
        "enum_range": ",range->{range}",
        "unique": "key failed [uniqueness]",
        "misaligned": "misaligned row",
        "castable": "{col} failed [cast to its type] value->",
        "flag_comment": "violations",
    },
}
FLAG_SEPARATOR = "||"

# Characters replaced by a blank in column comments; the two comment languages
# are joined with "||".
COMMENT_CHARS = r"[.,`'/{}$]"
COMMENT_JOIN = "||"

# Partition strategies (MET-13).
PART_LOAD_KEY = "load_key"
PART_LOAD_DATE = "load_date"
PART_NONE = "none"


def ods_type(declared: Optional[str]) -> str:
    return ODS_TYPE_BY_DECLARED.get((declared or "").lower(), DEFAULT_ODS_TYPE)


@dataclass(frozen=True)
class Profile:
    """Behaviour switches between the two generations of the reference."""

    name: str = "v2"
    null_is_missing: bool = False          # not-null also fails on null (v1)
    flag_misaligned: bool = True           # any null column -> misaligned flag (v2)
    normalise_timestamps: bool = True      # rewrite passing timestamps to ISO (v2)
    reject_requires_value: bool = True     # rejects need one non-null column (v2)
    timestamp_formats: tuple = TIMESTAMP_FORMATS_V2
    key_table_prefer: str = "primary"      # key precedence for the columns of the key-feed tables (DDL)
    validate_delete_feed: bool = True      # the delete-key feed is validated and staged (v2 only)
    check_castable: bool = False           # optional: values that the ODS cast would turn into null

    @staticmethod
    def of(name: "str | Profile") -> "Profile":
        if isinstance(name, Profile):
            return name
        if name == "v2":
            return V2
        if name == "v1":
            return V1
        raise ValueError(f"unknown profile {name!r}")


V2 = Profile()
V1 = Profile(name="v1", null_is_missing=True, flag_misaligned=False, normalise_timestamps=False,
             reject_requires_value=False, timestamp_formats=TIMESTAMP_FORMATS_V1, key_table_prefer="business",
             validate_delete_feed=False)


@dataclass(frozen=True)
class ColumnRule:
    """Data-quality rule for one landing column (MET-10)."""

    name: str
    check: str = ""                 # "", "int", "timestamp", "date"
    not_null: bool = False
    enum_range: Optional[str] = None  # comma-separated allowed values when the enum check is on
    declared_type: str = "varchar"
    comment: str = ""
    index: int = 0

    @property
    def enum_members(self) -> Optional[list]:
        if self.enum_range is None:
            return None
        return self.enum_range.split(",")


@dataclass(frozen=True)
class TableSet:
    """Physical table names of one file in every layer (MET-6)."""

    ldg: str
    stg: str
    rej: str
    ods: str
    ldg_pk: str = ""
    stg_pk: str = ""
    rej_pk: str = ""

    @property
    def has_delete_feed(self) -> bool:
        return bool(self.stg_pk)


@dataclass(frozen=True)
class FileSpec:
    """Everything the row plans need for one configured source file."""

    file_name: str
    file_id: int
    ddl_name: str
    source_system: str
    file_type: str
    table_comment: str
    load_solution: Optional[str]
    full_delta: Optional[str]
    physical_deletion: bool
    load_keys: tuple
    partition_strategy: Optional[str]
    keys: tuple
    rules: tuple = field(default_factory=tuple)   # tuple[ColumnRule], ordered by index
    tables: Optional[TableSet] = None

    @property
    def columns(self) -> list:
        return [r.name for r in self.rules]

    def rule_map(self) -> dict:
        return {r.name: r for r in self.rules}

    def key_rules(self) -> tuple:
        by_name = self.rule_map()
        return tuple(by_name[k] for k in self.keys if k in by_name)

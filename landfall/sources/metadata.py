"""Metadata sources (SRC-1, SRC-2): JDBC, files or ready DataFrames.

The caller supplies connection options; nothing is read from property files
or the environment.
"""

from __future__ import annotations

from typing import Mapping, Optional

from pyspark.sql import DataFrame, SparkSession

METADATA_TABLES = ("interface", "interface_file", "interface_field", "load_file_list")


def read_jdbc(spark: SparkSession, options: Mapping[str, str], table: str) -> DataFrame:
    """SRC-1: one metadata table over JDBC (``url``, ``user``, ``password``, driver options...)."""
    return spark.read.format("jdbc").options(**dict(options)).option("dbtable", table).load()


def read_metadata_jdbc(spark: SparkSession, options: Mapping[str, str], table_names: Mapping[str, str]) -> dict:
    """All metadata tables over JDBC; ``table_names`` maps our names to source tables."""
    return {ours: read_jdbc(spark, options, theirs) for ours, theirs in table_names.items()}


def read_metadata_files(spark: SparkSession, root: str, fmt: str = "parquet",
                        names=METADATA_TABLES) -> dict:
    """Metadata tables exported as files under ``root/<name>``."""
    return {n: spark.read.format(fmt).load(f"{root}/{n}") for n in names}


def register_views(frames: Mapping[str, DataFrame], view_names: Optional[Mapping[str, str]] = None) -> None:
    """SRC-2: expose metadata frames as temp views (for SQL users)."""
    for name, df in frames.items():
        df.createOrReplaceTempView((view_names or {}).get(name, name))

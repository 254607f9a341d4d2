"""The five tables as parquet with fixed schemas."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from noticelake.schemas import TABLES

# Sort columns inside files, for min/max pruning of the usual filters.
FILE_ORDER = {
    "sources": ("name",),
    "collection_runs": ("source_id", "started_at"),
    "notices": ("status", "registration_deadline"),
    "categories": ("name",),
    "notice_categories": ("category_id", "notice_id"),
}


def load_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All five tables; columns and filters reach the parquet scan."""
    return {
        name: spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{name}")
        for name, schema in TABLES.items()
    }


def save_tables(tables: dict[str, DataFrame], root: str) -> None:
    """Write a new snapshot; the folder must be unused, as it may be read meanwhile."""
    for name, table in tables.items():
        columns = TABLES[name].names
        (
            table.select(*columns)
            .sortWithinPartitions(*FILE_ORDER[name])
            .write.mode("errorifexists")
            .parquet(f"{root.rstrip('/')}/{name}")
        )


def inline(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """A small relation from literal rows."""
    return spark.createDataFrame(list(rows), schema)

"""Lookups, listings and latest-N reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticelake.functions import clean_trim
from noticelake.schemas import DEFAULT_RUN_LIST, MAX_RUN_LIST


def lookup_by_id(df: DataFrame, ids: DataFrame) -> DataFrame:
    """The row of each requested id; an unknown id keeps its row with nulls.

    ``found`` tells the two apart.
    """
    return ids.select("id").join(df.withColumn("found", F.lit(True)), "id", "left").fillna(
        False, ["found"]
    )


def lookup_by_name(df: DataFrame, names: DataFrame) -> DataFrame:
    """Rows whose name equals a requested name after trimming."""
    wanted = names.select(clean_trim(F.col("name")).alias("name")).distinct()
    return df.join(wanted, "name", "left_semi")


def name_order(column: Column | str = "name", collation: str | None = None) -> Column:
    """Sort key for names; a collation such as ``UNICODE`` orders accented names."""
    key = F.col(column) if isinstance(column, str) else column
    return (F.collate(key, collation) if collation else key).asc_nulls_last()


def list_all(df: DataFrame, collation: str | None = None) -> DataFrame:
    """All rows by name."""
    return df.orderBy(name_order("name", collation), F.col("id").asc())


def _checked_limit(limit: int) -> int:
    if limit <= 0:
        raise ValueError("limit must be greater than zero")
    if limit > MAX_RUN_LIST:
        raise ValueError(f"limit must not exceed {MAX_RUN_LIST}")
    return limit


def list_by_source(
    runs: DataFrame, source_id: int, limit: int = DEFAULT_RUN_LIST
) -> DataFrame:
    """The most recent runs of one source."""
    return (
        runs.where(F.col("source_id") == source_id)
        .orderBy(F.col("started_at").desc_nulls_first(), F.col("id").desc())
        .limit(_checked_limit(limit))
    )


def latest_runs(runs: DataFrame, n: int = DEFAULT_RUN_LIST) -> DataFrame:
    """The most recent ``n`` runs of every source.

    ``n`` is bounded, so Spark limits each group inside every input task before the
    shuffle (WindowGroupLimit) and a hot source arrives as at most ``n`` rows per task.
    """
    recent = Window.partitionBy("source_id").orderBy(
        F.col("started_at").desc_nulls_first(), F.col("id").desc()
    )
    return (
        runs.withColumn("recency", F.row_number().over(recent))
        .where(F.col("recency") <= _checked_limit(n))
    )

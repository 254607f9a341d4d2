"""The report queries over the five tables.

No join is hinted: Spark broadcasts a side whose size it has measured, and otherwise
sort-merges with skew splitting. Counts are taken before joins, so a source or category
with very many notices reaches the join as one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelake.functions import duration_seconds
from noticelake.operators.lookups import name_order


def notices_with_source(notices: DataFrame, sources: DataFrame) -> DataFrame:
    """Every notice with the name of its source, by deadline and title."""
    names = sources.select(F.col("id").alias("source_id"), F.col("name").alias("source_name"))
    return (
        notices.select("id", "title", "source_id", "status", "registration_deadline")
        .join(names, "source_id")
        .select("id", "title", "source_name", "status", "registration_deadline")
        .orderBy(
            F.col("registration_deadline").asc_nulls_last(),
            F.col("title").asc_nulls_last(),
            F.col("id"),
        )
    )


def notice_categories_list(
    notices: DataFrame, links: DataFrame, categories: DataFrame, collation: str | None = None
) -> DataFrame:
    """Each categorised notice with its category names in one ordered text."""
    names = categories.select(F.col("id").alias("category_id"), "name")
    key = f"name COLLATE {collation}" if collation else "name"
    listed = (
        links.join(names, "category_id")
        .groupBy("notice_id")
        .agg(F.expr(f"listagg(name, ', ') WITHIN GROUP (ORDER BY {key})").alias("categories"))
    )
    return (
        notices.select(F.col("id").alias("notice_id"), "title")
        .join(listed, "notice_id")
        .orderBy(name_order("title", collation), F.col("notice_id"))
        .select("title", "categories")
    )


def notices_per_source(
    sources: DataFrame, notices: DataFrame, collation: str | None = None
) -> DataFrame:
    """Total, open and closed notices of every source, also of those without any."""
    counts = notices.groupBy("source_id").agg(
        F.count("id").alias("total_notices"),
        F.count_if(F.col("status") == "open").alias("open_notices"),
        F.count_if(F.col("status") == "closed").alias("closed_notices"),
    )
    filled = ["total_notices", "open_notices", "closed_notices"]
    return (
        sources.select(F.col("id").alias("source_id"), "name")
        .join(counts, "source_id", "left")
        .fillna(0, filled)
        .orderBy(
            F.col("total_notices").desc(), name_order("name", collation), F.col("source_id")
        )
        .select("name", *filled)
    )


def popular_categories(
    categories: DataFrame,
    links: DataFrame,
    minimum: int = 2,
    collation: str | None = None,
) -> DataFrame:
    """Categories with at least ``minimum`` notices."""
    counts = links.groupBy("category_id").agg(F.count("notice_id").alias("total_notices"))
    return (
        categories.select(F.col("id").alias("category_id"), "name")
        .join(counts, "category_id", "left")
        .fillna(0, ["total_notices"])
        .where(F.col("total_notices") >= minimum)
        .orderBy(
            F.col("total_notices").desc(), name_order("name", collation), F.col("category_id")
        )
        .select("name", "total_notices")
    )


def sources_above_average(
    sources: DataFrame, notices: DataFrame, collation: str | None = None
) -> DataFrame:
    """Sources with more notices than the average over sources that have any."""
    counts = notices.groupBy("source_id").agg(F.count("*").alias("total_notices"))
    average = counts.select(F.avg("total_notices")).scalar()
    above = counts.where(F.col("total_notices") > average)
    return (
        sources.select(F.col("id").alias("source_id"), "name")
        .join(above, "source_id")
        .orderBy(name_order("name", collation), F.col("source_id"))
        .select("name", "total_notices")
    )


def run_report(runs: DataFrame, sources: DataFrame) -> DataFrame:
    """Every run with its source, counts and duration, latest first."""
    names = sources.select(F.col("id").alias("source_id"), "name")
    counts = ["records_found", "records_inserted", "records_updated", "records_rejected"]
    return (
        runs.join(names, "source_id")
        .orderBy(F.col("started_at").desc_nulls_first(), F.col("id").desc())
        .select(
            "name",
            "status",
            *counts,
            duration_seconds(F.col("started_at"), F.col("finished_at")).alias("duration_seconds"),
        )
    )


def open_notices(notices: DataFrame) -> DataFrame:
    """Open notices by deadline; filter and columns reach the scan."""
    return (
        notices.where(F.col("status") == "open")
        .select("id", "title", "registration_deadline")
        .orderBy(F.col("registration_deadline").asc_nulls_last(), F.col("id"))
    )


def reports(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All reports over a set of tables."""
    sources, notices = tables["sources"], tables["notices"]
    links, categories = tables["notice_categories"], tables["categories"]
    return {
        "notices_with_source": notices_with_source(notices, sources),
        "notice_categories": notice_categories_list(notices, links, categories),
        "notices_per_source": notices_per_source(sources, notices),
        "popular_categories": popular_categories(categories, links),
        "sources_above_average": sources_above_average(sources, notices),
        "collection_runs": run_report(tables["collection_runs"], sources),
        "open_notices": open_notices(notices),
    }

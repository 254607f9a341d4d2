"""Matching, sighting history and change accounting of notices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelake.operators.dedupe import long_keys

# Kind of match and its column; the first key that finds a notice decides.
MATCH_KEYS = {"external_id": "external_id", "url": "url", "content_hash": "content_hash"}


def match_notices(cur: DataFrame, new: DataFrame) -> DataFrame:
    """Add ``notice_id`` and ``match_kind`` to incoming notices of known sources.

    All three keys go through one join in long form: rows without an external id then
    never meet in a partition of nulls, and the result returns over the unique row number.
    """
    asked = long_keys(new, MATCH_KEYS, ["source_id", "row_number"])
    held = long_keys(cur, MATCH_KEYS, ["source_id", "id"]).withColumnRenamed("id", "notice_id")
    first = F.min(F.struct("rank", "kind", "notice_id"))
    matches = (
        asked.join(held, ["source_id", "rank", "kind", "key"])
        .groupBy("row_number")
        .agg(first.alias("m"))
        .select("row_number", "m.notice_id", F.col("m.kind").alias("match_kind"))
    )
    return new.join(matches, "row_number", "left").withColumn(
        "match_kind", F.coalesce("match_kind", F.lit("none"))
    )


def sighting_history(
    sightings: DataFrame, key: Sequence[str] = ("source_id", "url")
) -> DataFrame:
    """First and last sighting of each notice, and the run of the last one."""
    return sightings.groupBy(*key).agg(
        F.min("seen_at").alias("first_seen_at"),
        F.max("seen_at").alias("last_seen_at"),
        F.max_by(
            "collection_run_id", F.struct("seen_at", "collection_run_id")
        ).alias("last_collection_run_id"),
    )


def merge_history(
    state: DataFrame, sightings: DataFrame, key: Sequence[str] = ("source_id", "url")
) -> DataFrame:
    """The history after a batch of sightings, from the stored history before it.

    A history is a partial aggregate of itself, so batches may come in any order and be split
    anywhere; the sightings behind the state are not read again.
    """
    both = state.unionByName(sighting_history(sightings, key).select(*state.columns))
    last = F.struct("last_seen_at", "last_collection_run_id")
    return both.groupBy(*key).agg(
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
        F.max_by("last_collection_run_id", last).alias("last_collection_run_id"),
    )


def classify_changes(
    cur: DataFrame, new: DataFrame, key: Sequence[str] = ("source_id", "url")
) -> DataFrame:
    """Add ``change``: insert, update or unchanged, by the content hash."""
    held = cur.select(*key, F.col("content_hash").alias("_held"))
    return (
        new.join(held, [*key], "left")
        .withColumn(
            "change",
            F.when(F.col("_held").isNull(), F.lit("insert"))
            .when(F.col("_held") != F.col("content_hash"), F.lit("update"))
            .otherwise(F.lit("unchanged")),
        )
        .drop("_held")
    )


def run_counts(outcomes: DataFrame) -> DataFrame:
    """Records found, inserted, updated and rejected per run.

    ``outcomes`` has a row per received record: ``collection_run_id`` and ``change``, which
    is insert, update, unchanged or rejected.
    """

    def counted(kind: str, name: str):
        return F.count_if(F.col("change") == kind).cast("int").alias(name)

    return outcomes.groupBy("collection_run_id").agg(
        F.count("*").cast("int").alias("records_found"),
        counted("insert", "records_inserted"),
        counted("update", "records_updated"),
        counted("rejected", "records_rejected"),
    )

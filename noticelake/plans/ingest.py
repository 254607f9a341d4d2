"""Landed API pages to the raw landing set and closed runs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.operators.pages import RUN, explode_pages, parse_pages, run_verdicts
from noticelake.operators.runs import finish_runs
from noticelake.session import shared_dir
from noticelake.sources.landing import write_raw
from noticelake.sources.landingset import LandingSet

VERDICT = (
    "pages_fetched",
    "total_items",
    "records_found",
    "pages_landed",
    "failed_page",
    "code",
    "error_message",
)


@dataclass(frozen=True)
class Ingested:
    """Records of complete runs, the verdict of each run, and the runs table after it.

    ``rejects`` also has landed runs that are unknown (``not_found``) or no longer running
    (``bad_state``); nothing of those is written.
    """

    records: DataFrame
    verdicts: DataFrame
    runs: DataFrame
    rejects: DataFrame


def ingest(
    landed: DataFrame,
    runs: DataFrame,
    root: str | None = None,
    finished_at: Column | None = None,
    keep: bool = False,
) -> Ingested:
    """Check landed pages, write the records of complete runs, and close the runs.

    A failed check fails that run alone. With ``root`` the raw landing set is written
    before any run is marked as a success. With ``root`` or ``keep`` the verdicts are computed
    once and kept.
    """
    pages = parse_pages(landed)
    states = runs.where("status = 'running'").select(
        F.col("id").alias("collection_run_id"), F.lit(True).alias("_open")
    )
    verdicts = run_verdicts(pages).join(states, "collection_run_id", "left").select(
        *RUN, F.coalesce("_open", F.lit(False)).alias("is_open"), *VERDICT
    )
    if keep or root is not None:
        # Kept, because records and closing events must come from the same verdicts.
        shared_dir(landed.sparkSession)
        verdicts = verdicts.checkpoint()
    complete = verdicts.where("code IS NULL AND is_open").select(
        *RUN, "pages_fetched", F.col("records_found").alias("record_count")
    )
    records = explode_pages(pages, complete)
    if root is not None:
        write_raw(records, root, runs=complete)
    events = closing_events(verdicts, finished_at)
    table, rejects = finish_runs(runs, events)
    return Ingested(records, verdicts.drop("is_open"), table, rejects)


def ingest_into(
    store: LandingSet, landed: DataFrame, runs: DataFrame | None = None, finished_at: Column | None = None
) -> Ingested:
    """The same into a versioned landing set, which keeps the runs table too.

    Records and closed runs become visible in one commit: after a crash there are neither, and
    the same call does it again. ``runs`` is the runs table to begin with, where the set has none.
    """
    known = store.runs()
    runs = runs if known is None else known
    if runs is None:
        raise ValueError("the landing set has no runs table yet")
    done = ingest(landed, runs, finished_at=finished_at, keep=True)
    complete = done.verdicts.where("code IS NULL").join(
        runs.where("status = 'running'").select(F.col("id").alias("collection_run_id")), "collection_run_id", "left_semi"
    )
    counts = complete.select(*RUN, "pages_fetched", F.col("records_found").alias("record_count"))
    store.commit(store.stage(done.records, counts, finished_at), done.runs)
    return Ingested(store.read(counts), done.verdicts, store.runs(), done.rejects)


def closing_events(verdicts: DataFrame, finished_at: Column | None = None) -> DataFrame:
    """What ``finish_runs`` needs: success with the record count, or failure with a message."""
    failed = F.col("code").isNotNull()
    zero = F.lit(0).cast("int")
    return verdicts.select(
        F.col("collection_run_id").alias("row_number"),
        F.col("collection_run_id").alias("run_id"),
        F.when(failed, F.lit("failed")).otherwise(F.lit("success")).alias("status"),
        (F.current_timestamp() if finished_at is None else finished_at).alias("finished_at"),
        F.when(failed, zero).otherwise(F.col("records_found").try_cast("int")).alias("records_found"),
        zero.alias("records_inserted"),
        zero.alias("records_updated"),
        zero.alias("records_rejected"),
        "error_message",
    )

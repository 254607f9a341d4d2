"""Collection runs: start, finish and late registration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions import clean_trim, is_allowed
from noticelake.operators.maintenance import assign_ids, fit_table, prepared, with_parents
from noticelake.operators.rules import first_code

COUNTS = ("records_found", "records_inserted", "records_updated", "records_rejected")
FINAL_STATUSES = ("success", "partial", "failed")


def start_runs(
    runs: DataFrame, sources: DataFrame, requests: DataFrame, now: Column | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Open a run per request (``row_number``, ``source_id``, optional ``started_at``).

    Gives (table, started, rejects); requests for unknown sources are rejects.
    """
    known = sources.select(F.col("id").alias("source_id"))
    good = requests.join(known, "source_id", "left_semi")
    rejects = requests.join(known, "source_id", "left_anti").select(
        "row_number", F.lit("source_not_found").alias("code")
    )
    kept = [c for c in ("row_number", "source_id", "started_at") if c in requests.columns]
    started = fit_table(assign_ids(runs, good.select(*kept)), "collection_runs", now)
    return runs.unionByName(started), started, rejects


def finish_message(status: Column, message: Column) -> Column:
    """Trimmed message of a partial or failed run; success clears it."""
    return F.when(status != "success", clean_trim(message))


def finish_runs(
    runs: DataFrame, events: DataFrame, now: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Close running runs; gives (table, rejects). An event without a time ends its run now.

    ``events``: ``row_number``, ``run_id``, ``status``, ``finished_at``, the four counts
    and ``error_message``. Only the first acceptable event of a run counts, by time and
    then batch order; later ones find the run already closed (``bad_state``).
    """
    states = runs.select(
        F.col("id").alias("run_id"),
        F.col("status").alias("_state"),
        F.col("started_at").alias("_started"),
    )
    message = finish_message(F.col("status"), F.col("error_message"))
    negative = F.lit(False)
    for name in COUNTS:
        negative = negative | F.coalesce(F.col(name) < 0, F.lit(False))
    rules = [
        ("status_invalid", ~is_allowed(F.col("status"), FINAL_STATUSES)),
        (
            "blank_message",
            (F.col("status") != "success") & F.coalesce(F.col("error_message") == "", F.lit(True)),
        ),
        ("count_negative", negative),
        ("not_found", F.col("_state").isNull()),
        ("bad_state", F.col("_state") != "running"),
        ("finished_before_started", F.col("finished_at") < F.col("_started")),
    ]
    coded = (
        events.withColumn("error_message", message)
        .withColumn("finished_at", F.coalesce("finished_at", F.current_timestamp() if now is None else now))
        .join(states, "run_id", "left")
        .withColumn("code", first_code(rules))
    )
    closing = F.struct(
        "row_number",
        "finished_at",
        "status",
        *[F.coalesce(F.col(name), F.lit(0)).cast("int").alias(name) for name in COUNTS],
        "error_message",
    )
    winners = (
        coded.where("code IS NULL")
        .groupBy("run_id")
        .agg(F.min_by(closing, F.struct("finished_at", "row_number")).alias("_end"))
    )
    rejects = (
        coded.join(
            winners.select(F.col("_end.row_number").alias("row_number")),
            "row_number",
            "left_anti",
        )
        .select("row_number", "run_id", F.coalesce("code", F.lit("bad_state")).alias("code"))
    )
    changed = ("finished_at", "status", *COUNTS, "error_message")
    table = runs.join(winners.withColumnRenamed("run_id", "id"), "id", "left").select(
        *[
            F.when(F.col("_end").isNotNull(), F.col(f"_end.{c}")).otherwise(F.col(c)).alias(c)
            if c in changed
            else F.col(c)
            for c in runs.columns
        ]
    )
    return table, rejects


def insert_missing_runs(
    runs: DataFrame, new: DataFrame, sources: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Register finished runs unless the source already has one with that start time.

    ``new`` carries ``row_number``; equal (source, start) pairs inside the batch count once.
    Gives (table, rejects): rows that break a rule of the table, and with ``sources`` those
    of unknown ones (``source_not_found``). A row without a start time starts now.
    """
    key = ["source_id", "started_at"]
    shaped = prepared(
        new.withColumn("started_at", F.coalesce("started_at", F.current_timestamp())), "collection_runs"
    )
    coded = with_parents(shaped, {"source_id": (sources, "source_not_found")})
    good = coded.where("code IS NULL").drop("code")
    claims = good.groupBy(*key).agg(F.min("row_number").alias("row_number"))
    free = claims.join(runs.select(*key), key, "left_anti").select("row_number")
    fresh = good.join(free, "row_number", "left_semi")
    table = runs.unionByName(fit_table(assign_ids(runs, fresh), "collection_runs"))
    return table, coded.where("code IS NOT NULL").select("row_number", "code")

"""Raw landing set to CSV exports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.functions import utc_stamp
from noticelake.plans.transform import Transformed, transform
from noticelake.session import kept_as_table, shared_dir, shuffles_removed
from noticelake.sources.exports import export_rejected, export_valid
from noticelake.sources.landing import (
    RAW_FILE_PATTERN,
    latest_landed,
    latest_raw,
    list_raw,
    read_envelopes,
    read_landed,
    read_raw,
)

RUN = ("source_id", "collection_run_id")
LIST = ("file", "generation")


@dataclass(frozen=True)
class Exported:
    valid_path: str
    rejected_path: str
    metrics: DataFrame
    unusable: DataFrame | None


def transform_and_export(
    spark: SparkSession, root: str, out: str, latest_only: bool = True, pattern: str = RAW_FILE_PATTERN
) -> Exported:
    """Transform raw files below ``root`` and write both exports below ``out``.

    By default only the file modified last, otherwise all, each as its own batch.
    """
    # The newest file is found from names and times alone; then that one file is read.
    if latest_only:
        newest = latest_raw(list_raw(spark, root, pattern)).first()
        root = newest.path if newest and newest.path else root
    with shuffles_removed(spark):
        documents = read_raw(spark, root, pattern)
        batch = transform(documents.scanned, LIST, documents.lists.select(*LIST, "last"))
        return _write(spark, batch, out, documents.unusable, documents.lists.select(*LIST, "path"))


def transform_landed(
    spark: SparkSession, root: str, out: str, latest_only: bool = False
) -> Exported:
    """The same for a landing set written by ``write_raw``: every run is a batch.

    With ``latest_only`` the run saved last of each source, also where that one is empty.
    """
    landed = read_landed(spark, root)
    if latest_only:
        newest = latest_landed(read_envelopes(spark, root))
        landed = landed.join(newest, list(RUN), "left_semi")
    with shuffles_removed(spark):
        return _write(spark, transform(landed, within=RUN), out, None)


def _write(
    spark: SparkSession,
    batch: Transformed,
    out: str,
    unusable: DataFrame | None,
    names: DataFrame | None = None,
) -> Exported:
    """``names`` may have the ``path`` of each batch, which then stands for the columns that tell batches apart."""
    shared_dir(spark)
    # Three outputs come from the tagged rows, so they are computed once and kept.
    with kept_as_table(batch.tagged, "tagged") as tagged:
        kept = Transformed(tagged, batch.within)
        stamp = spark.range(1).select(utc_stamp(F.current_timestamp())).first()[0]
        valid_path = f"{out.rstrip('/')}/transformed_notices_{stamp}"
        rejected_path = f"{out.rstrip('/')}/rejected_notices_{stamp}"
        export_valid(kept.valid, valid_path)
        export_rejected(kept.rejected, rejected_path)
        metrics = kept.metrics
        if names is not None:
            counters = [c for c in metrics.columns if c not in batch.within]
            metrics = metrics.join(names, list(batch.within)).select("path", *counters)
        return Exported(valid_path, rejected_path, metrics.checkpoint(), unusable)

"""A landing set in versions: many runs to a file, and the runs table that goes with them.

Records lie in files of about ``rows_per_file`` lines, ordered by source and run, so their
number follows the size of what is landed and not the number of runs. The list of a version
says which files have a run; a run that is landed again is listed with its new files, and what
older files have of it is no longer read. One commit names the list and the runs table, so a
reader sees both as they were before an ingest or both as they are after it. A job that fails in
between leaves files that no version names, and can simply be repeated.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.schemas import COLLECTION_RUNS
from noticelake.sources import commits

LANDED = "saved_at timestamp, pages_fetched bigint, record_count bigint, row_number bigint, record variant"

ROWS_PER_FILE = 250_000

RUN = ["source_id", "collection_run_id"]
_LINES = f"source_id bigint, collection_run_id bigint, {LANDED}"
_LISTED = "source_id bigint, collection_run_id bigint, saved_at timestamp, pages_fetched bigint, record_count bigint, files array<string>"


class LandingSet:
    """A landing set below ``root``."""

    def __init__(self, spark: SparkSession, root: str, rows_per_file: int = ROWS_PER_FILE):
        self.spark, self.root, self.rows_per_file = spark, root.rstrip("/"), rows_per_file

    def _entry(self) -> dict:
        newest = commits.latest(self.spark, self.root)
        return newest[1] if newest else {}

    # --- Reading

    def runs(self) -> DataFrame | None:
        """The runs table of the newest version; None before the first ingest."""
        name = self._entry().get("runs")
        return self.spark.read.schema(COLLECTION_RUNS).parquet(f"{self.root}/{name}") if name else None

    def listed(self) -> DataFrame:
        """A row for each landed run: ``saved_at, pages_fetched, record_count`` and its ``files``."""
        name = self._entry().get("listed")
        if name is None:
            return self.spark.createDataFrame([], _LISTED)
        return self.spark.read.schema(_LISTED).parquet(f"{self.root}/{name}")

    def read(self, runs: DataFrame | None = None) -> DataFrame:
        """The records of all landed runs, or of those in ``runs``; only their files are read."""
        listed = self.listed() if runs is None else self.listed().join(runs.select(*RUN), RUN, "left_semi")
        held = listed.select(*RUN, F.explode("files").alias("_file"))
        files = [r[0] for r in held.select("_file").distinct().collect()]
        if not files:
            return self.spark.createDataFrame([], _LINES)
        lines = self.spark.read.schema(_LINES).json(files).withColumn("_file", F.col("_metadata.file_path"))
        # A file may still have what an older version listed.
        return lines.join(held, [*RUN, "_file"], "left_semi").drop("_file")

    def latest(self) -> DataFrame:
        """The run saved last of each source, also an empty one."""
        newest = F.max_by("collection_run_id", F.struct("saved_at", "collection_run_id"))
        return self.listed().groupBy("source_id").agg(newest.alias("collection_run_id"))

    # --- Writing

    def land(self, records: DataFrame, runs: DataFrame, saved_at: Column | None = None) -> int:
        """Add runs, or replace them; ``records`` as for ``write_raw``, ``runs`` with each run's counts."""
        return self.commit(self.stage(records, runs, saved_at))

    def stage(self, records: DataFrame, runs: DataFrame, saved_at: Column | None = None) -> str:
        """Write records and the list of the next version, which ``commit`` makes visible."""
        saved_at = F.current_timestamp() if saved_at is None else saved_at
        counts = runs.select(*RUN, "pages_fetched", "record_count")
        total = counts.agg(F.coalesce(F.sum("record_count"), F.lit(0))).first()[0]
        held = self.spark.createDataFrame([], "source_id bigint, collection_run_id bigint, files array<string>")
        if total:
            data = f"{self.root}/data/{uuid.uuid4().hex}"
            lines = records.withColumn("saved_at", saved_at).select(
                *RUN, "saved_at", "pages_fetched", "record_count", "row_number", "record"
            )
            n = math.ceil(total / self.rows_per_file)
            lines.repartitionByRange(n, *RUN, "row_number").sortWithinPartitions(*RUN, "row_number").write.json(data)
            written = self.spark.read.schema("source_id bigint, collection_run_id bigint").json(data)
            held = written.groupBy(*RUN).agg(F.collect_set(F.col("_metadata.file_path")).alias("files"))
        fresh = counts.join(held, RUN, "left").select(
            *RUN,
            saved_at.cast("timestamp").alias("saved_at"),
            F.col("pages_fetched").cast("bigint").alias("pages_fetched"),
            F.col("record_count").cast("bigint").alias("record_count"),
            F.coalesce("files", F.array().cast("array<string>")).alias("files"),
        )
        kept = self.listed().join(counts.select(*RUN), RUN, "left_anti")
        name = f"listed/{uuid.uuid4().hex}"
        kept.select(*fresh.columns).unionByName(fresh).write.parquet(f"{self.root}/{name}")
        return name

    def commit(self, staged: str, runs: DataFrame | None = None) -> int:
        """Make a staged list visible, with the runs table that belongs to it."""
        entry = {**self._entry(), "listed": staged}
        if runs is not None:
            entry["runs"] = f"runs/{uuid.uuid4().hex}"
            runs.select(*COLLECTION_RUNS.names).write.parquet(f"{self.root}/{entry['runs']}")
        return commits.commit(self.spark, self.root, entry)

"""A log of commits: which version of a dataset its readers see.

A dataset's files lie in folders that are written once and never changed. A commit is one line
in the log that names what belongs to a version, and it becomes visible all at once, when
Spark's commit protocol moves that one file in. A writer that fails before leaves folders that
no version names; so a reader sees the old version or the new one. One writer at a time.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

_ENTRY = "version long, entry string"


def history(spark: SparkSession, root: str) -> DataFrame | None:
    """``version, entry`` of all commits; None where there is no dataset yet."""
    try:
        return spark.read.schema(_ENTRY).json(_log(root))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def latest(spark: SparkSession, root: str) -> tuple[int, dict] | None:
    """The newest version and what it names."""
    log = history(spark, root)
    newest: Row | None = log and log.agg(F.max_by(F.struct("version", "entry"), "version").alias("e")).first().e
    return (newest.version, json.loads(newest.entry)) if newest else None


def commit(spark: SparkSession, root: str, entry: dict) -> int:
    """Make ``entry`` the newest version."""
    before = latest(spark, root)
    version = before[0] + 1 if before else 1
    line = spark.createDataFrame([(version, json.dumps(entry, sort_keys=True))], _ENTRY)
    line.coalesce(1).write.mode("append").json(_log(root))
    return version


def _log(root: str) -> str:
    return f"{root.rstrip('/')}/log"

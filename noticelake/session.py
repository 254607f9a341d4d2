"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM never compiles methods above 8000 bytes to machine code; stages that would need
    # one run operator by operator instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Folders are listed by so many tasks at most; by default each has a task of its own, up to 10,000.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # A repeated key in a JSON object keeps its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Possible only at session start. Recording the Python line of every column would cost
# more than building the column.
STATIC_SETTINGS = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.checkpoint.compress": "true",
    # Checkpoint files go away with the last DataFrame that needs them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    app_name: str = "noticelake",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create a session; cluster sizing is left to the submit command."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **STATIC_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else created.

    The settings that hold from session start, checkpoint clean-up among them, are left to
    whoever starts it.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names; one of our own only where unset.

    Our own would be below the warehouse. Where that is a local folder and the executors are
    other machines, they would not see each other's files, so this refuses.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    active = spark.sparkContext.getCheckpointDir()
    if active is None:
        target = configured or own_dir(_warehouse(spark), spark.sparkContext.master)
        spark.sparkContext.setCheckpointDir(target)
    return configured or active or spark.sparkContext.getCheckpointDir()


def own_dir(warehouse: str, master: str) -> str:
    """The folder below the warehouse, unless it is local to one of several machines."""
    local = warehouse.startswith("file:") or "://" not in warehouse
    if local and not master.startswith("local[") and master != "local":
        raise ValueError(
            "set spark.checkpoint.dir to a folder that all executors share; "
            f"the warehouse {warehouse} is local to each machine"
        )
    return f"{warehouse}/_checkpoints"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/noticelake/{name}-{uuid.uuid4().hex}"


@contextmanager
def kept_as_table(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` computed once and read back from parquet below the shared folder, where it is removed in the end.

    For wide rows that several outputs need: columns take about half the disk of a checkpoint.
    """
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, name))
    try:
        df.write.option("compression", "zstd").parquet(path.toString())
        yield spark.read.schema(df.schema).parquet(path.toString())
    finally:
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go as soon as the write, checkpoint or query that made them is done.

    By default they stay until the driver happens to collect its garbage. Only for code that
    runs no DataFrame twice, as a second run would have to make them again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _warehouse(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")

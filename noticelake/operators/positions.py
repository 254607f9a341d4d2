"""Global row positions and page assignment without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticelake.session import shared_dir

_LOCAL_BITS = (1 << 33) - 1


def number_rows(
    df: DataFrame, order: Sequence[str | Column], name: str = "position"
) -> DataFrame:
    """Add the 1-based position of each row in a total order.

    ``order`` must be unique per row, so that the range shuffle can split any run of
    equal leading values. The ranged rows are checkpointed: their partitions then stay
    the same for the counting and the numbering pass, also when executors are lost.
    """
    shared_dir(df.sparkSession)
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_local", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_BITS)))
        .checkpoint()
    )
    # One row per partition, so this window holds as many rows as there are partitions.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    return (
        ranged.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_local") + 1)
        .drop("_part", "_local", "_before")
    )


def assign_pages(df: DataFrame, order: Sequence[str | Column], page_size: int) -> DataFrame:
    """Add ``page``, ``page_size``, ``total_pages`` and ``total_items`` to every row."""
    if page_size <= 0:
        raise ValueError("page_size must be positive")
    numbered = number_rows(df, order, "_position")
    total = numbered.select(F.count("*")).scalar()
    return (
        numbered.withColumn("page", F.expr(f"(_position - 1) div {page_size} + 1"))
        .withColumn("page_size", F.lit(page_size))
        .withColumn("total_items", total)
        .withColumn(
            "total_pages",
            F.greatest(F.lit(1), F.ceil(F.col("total_items") / page_size)).cast("long"),
        )
        .drop("_position")
    )


def page_slice(paged: DataFrame, page: int) -> DataFrame:
    """The rows of one page."""
    if page <= 0:
        raise ValueError("page must be positive")
    return paged.where(F.col("page") == page)

"""Keep-first duplicate flags that stay balanced when one key dominates.

A ranking window would put all rows of a hot key into one task. Here the first row of
each key comes from a partial aggregate; the rows of repeated keys, narrow, are joined to it,
which Spark can split. The answer travels back as bitmaps, one bit for each row number: the wide
rows meet one small row for every 32,768 of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def long_keys(df: DataFrame, keys: dict[str, str], keep: Sequence[str]) -> DataFrame:
    """One row per set key of each row: the kept columns, ``rank``, ``kind`` and ``key``.

    ``keys`` maps kinds to columns and ranks them by their order. Null keys give no row, so
    they never gather in one partition.
    """
    entries = [
        F.when(
            F.col(column).isNotNull(),
            F.struct(
                F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), F.col(column).alias("key")
            ),
        )
        for rank, (kind, column) in enumerate(keys.items())
    ]
    exploded = df.select(*keep, F.explode(F.array_compact(F.array(*entries))).alias("_entry"))
    return exploded.select(*keep, "_entry.*")


def join_batches(
    left: DataFrame, right: DataFrame, within: Sequence[str], keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on equal keys inside the same batch, where null names a batch too.

    The columns joined on are kept once, as the left side has them.
    """
    names = {name: f"_right_{name}" for name in (*within, *keys)}
    condition = F.lit(True)
    for name in within:
        condition = condition & F.col(name).eqNullSafe(F.col(names[name]))
    for name in keys:
        condition = condition & (F.col(name) == F.col(names[name]))
    return left.join(right.withColumnsRenamed(names), condition, how).drop(*names.values())


def repeated_rows(
    df: DataFrame, keys: dict[str, str], row_id: str, within: Sequence[str] = ()
) -> DataFrame:
    """For each row that repeats an earlier one on some key: its id and a boolean per flag.

    First rows, most of any real batch, are not listed, so the answer is small.
    """
    entries = long_keys(df, keys, [*within, row_id])
    firsts = (
        entries.groupBy(*within, "kind", "key")
        .agg(F.min(row_id).alias("_first"), F.max(row_id).alias("_last"))
        .where("_first < _last")
    )
    return (
        join_batches(entries, firsts, within, ("kind", "key"))
        .where(F.col(row_id) > F.col("_first"))
        .groupBy(*within, row_id)
        .agg(*[F.max(F.col("kind") == flag).alias(_mark(flag)) for flag in keys])
    )


def flag_repeats(
    df: DataFrame,
    keys: dict[str, str],
    row_id: str = "row_number",
    within: Sequence[str] = (),
    keys_from: DataFrame | None = None,
    batches: DataFrame | None = None,
) -> DataFrame:
    """Add a boolean per flag name: the key is set and an earlier row has it too.

    ``keys`` maps flag names to key columns, ``row_id`` is a whole number that is unique in a
    batch. ``keys_from`` may supply the key columns from a narrower read of the same rows; it
    is read twice. ``batches`` may name the batches whose rows are wanted, by the columns of
    ``within`` and ``last``, their greatest row id, where ids begin at 1; others' rows are dropped.
    """
    repeats = repeated_rows(df if keys_from is None else keys_from, keys, row_id, within)
    bucket, place = F.bitmap_bucket_number(row_id).alias("_bucket"), F.bitmap_bit_position(row_id)
    marks = repeats.groupBy(*within, bucket).agg(
        # Cut after the last bit, so that a batch of few rows has few bytes.
        *[_used(F.bitmap_construct_agg(p), F.max(p)).alias(_mark(f)) for f, p in _marked(keys, place).items()]
    )
    if batches is not None:
        # A small row for each stretch of a wanted batch, so that choosing rows and marking them is one join.
        buckets = F.sequence(F.bitmap_bucket_number(F.lit(1)), F.bitmap_bucket_number("last"))
        wanted = batches.where("last > 0").select(*within, F.explode(buckets).alias("_bucket"))
        marks = join_batches(wanted, marks, within, ("_bucket",), "left")
    how = "left" if batches is None else "inner"
    flagged = join_batches(df.select("*", bucket), marks, within, ("_bucket",), how)
    bits = {flag: F.coalesce(_bit(F.col(_mark(flag)), place), F.lit(False)) for flag in keys}
    return flagged.select(*df.columns, *[bit.alias(flag) for flag, bit in bits.items()])


def _marked(keys: dict[str, str], place: Column) -> dict[str, Column]:
    return {flag: F.when(F.col(_mark(flag)), place) for flag in keys}


def _used(bitmap: Column, last: Column) -> Column:
    return F.substring(bitmap, F.lit(1), F.coalesce(F.floor(last / 8), F.lit(-1)).cast("int") + 1)


def _bit(bitmap: Column, place: Column) -> Column:
    """Whether the bit of a place is set."""
    octet = F.conv(F.hex(F.substring(bitmap, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    mask = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (place % 8).cast("int") + 1)
    return octet.bitwiseAND(mask) != 0


def flag_dup_external_id(
    df: DataFrame, row_id: str = "row_number", within: Sequence[str] = ()
) -> DataFrame:
    return flag_repeats(df, {"dup_external_id": "external_key"}, row_id, within)


def flag_dup_url(
    df: DataFrame, row_id: str = "row_number", within: Sequence[str] = ()
) -> DataFrame:
    return flag_repeats(df, {"dup_url": "url"}, row_id, within)


BATCH_KEYS = {"dup_external_id": "external_key", "dup_url": "url"}


def flag_duplicates(
    df: DataFrame,
    row_id: str = "row_number",
    within: Sequence[str] = (),
    keys_from: DataFrame | None = None,
    batches: DataFrame | None = None,
) -> DataFrame:
    """Both flags and their union, which counts a row once."""
    flagged = flag_repeats(df, BATCH_KEYS, row_id, within, keys_from, batches)
    return flagged.withColumn("is_duplicate", F.col("dup_external_id") | F.col("dup_url"))


def _mark(flag: str) -> str:
    return f"_repeats_{flag}"

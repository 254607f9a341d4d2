"""What the operators share: reading a table, words, row keys, checkpoints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.session import shared_dir

# The white space that ends a word: space, tab, line feed, vertical tab, form feed, return.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """The maximal runs of other characters, in order; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def text_key(text: Column) -> Column:
    """Tells rows of one doc_id apart; with the id it names a row up to exact repeats."""
    return F.xxhash64(text)


def settled(df: DataFrame) -> DataFrame:
    """Computed once and kept in the cluster's shared checkpoint folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def packed(df: DataFrame) -> Column:
    """All columns as one, so that no name clashes with those an operator adds."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def text_slices(batches: Iterator[pa.RecordBatch], most: int, text_col: str = "text") -> Iterator[pa.RecordBatch]:
    """Rows of about ``most`` bytes of text at a time; a longer text comes alone."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(text_col)).fill_null(0).to_numpy(zero_copy_only=False)
        chunk = (np.cumsum(sizes, dtype=np.int64) - sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            yield batch.slice(low, high - low)

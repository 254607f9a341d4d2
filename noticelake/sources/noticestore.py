"""Notices in files that an upsert rewrites only where it must.

Files are ordered by source and url, and never changed. For each the store keeps which sources
are in it and a Bloom filter of its keys (url, content hash and external id within the source).
An upsert reads the files that may hold a key of the batch, judges the batch against them, and
rewrites those where a notice changes; new notices go into new files. The other files belong
to the next version as they are, with their filters. A filter never misses a key, so the answer
is that of an upsert into the whole table; a false hit costs reading a file and nothing else.

The keys of a batch meet only files that have their source: a source with F files and a batch
with K keys of it costs F * K bit look-ups, made a file at a time.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.operators.dedupe import long_keys
from noticelake.operators.maintenance import NOTICE_KEYS, judge_notices, merge_notices
from noticelake.schemas import NOTICES
from noticelake.session import shared_dir
from noticelake.sources import commits

ROWS_PER_FILE = 250_000
FILTER_BITS = 16
# Keys of one source of a batch go to a file's task in lists of this fraction.
_LISTS = 64
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


@dataclass(frozen=True)
class Upserted:
    """``rejects``: ``row_number, code``; how many files there were, were read, replaced and written."""

    version: int
    rejects: DataFrame
    files: int
    read: int
    replaced: int
    written: int


def _places(hashes: np.ndarray, power: int) -> Iterator[np.ndarray]:
    for odd in _ODD:
        yield ((hashes.astype(np.uint64) * np.uint64(odd)) >> np.uint64(64 - power)).astype(np.int64)


def key_filter(hashes: np.ndarray) -> bytes:
    """A Bloom filter of 64-bit hashes; its size follows their number."""
    power = max(3, math.ceil(math.log2(FILTER_BITS * max(len(hashes), 1))))
    bits = np.zeros(1 << power, bool)
    for at in _places(hashes, power):
        bits[at] = True
    return np.packbits(bits, bitorder="little").tobytes()


def may_hold(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """For each hash whether the filter has it, or seems to."""
    flat = np.frombuffer(bits, np.uint8)
    found = np.ones(len(hashes), bool)
    for at in _places(hashes, len(flat).bit_length() + 2):
        found &= (flat[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    return found


def _key_hashes(notices: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and ``hash`` of every set key."""
    return long_keys(notices, NOTICE_KEYS, keep).select(*keep, F.xxhash64("source_id", "kind", "key").alias("hash"))


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One file: its sources and its filter."""
    table = pa.Table.from_batches(batches)
    hashes = table.column("hashes").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    columns = {
        "file": table.column("file").slice(0, 1).combine_chunks(),
        "rows": pa.array([table.num_rows], pa.int64()),
        "top_id": pa.array([pc.max(table.column("id")).as_py()], pa.int64()),
        "sources": pa.array([table.column("source_id").unique().to_pylist()], pa.list_(pa.int64())),
        "bits": pa.array([key_filter(hashes)], pa.binary()),
    }
    yield pa.RecordBatch.from_pydict(columns)


_FILE = "file string, rows long, top_id long, sources array<long>, bits binary"
_LISTED = "file string, rows long, top_id long, folder string"


class NoticeStore:
    """A versioned table of notices below ``root``."""

    def __init__(self, spark: SparkSession, root: str, rows_per_file: int = ROWS_PER_FILE):
        self.spark, self.root, self.rows_per_file = spark, root.rstrip("/"), rows_per_file

    # --- Reading

    def files(self) -> DataFrame:
        """``file, rows, top_id, folder`` of the newest version; the folder has the filters."""
        newest = commits.latest(self.spark, self.root)
        if newest is None:
            return self.spark.createDataFrame([], _LISTED)
        return self.spark.read.schema(_LISTED).parquet(f"{self.root}/{newest[1]['files']}")

    def read(self) -> DataFrame:
        return self._read([r.file for r in self.files().select("file").collect()])

    def _read(self, files: list[str]) -> DataFrame:
        # Names of files, as any scan lists them on the driver.
        if not files:
            return self.spark.createDataFrame([], NOTICES)
        return self.spark.read.schema(NOTICES).parquet(*files)

    def _filters(self, listed: DataFrame) -> DataFrame:
        """``file, sources, bits`` of the files listed."""
        folders = [f"{self.root}/{r.folder}" for r in listed.select("folder").distinct().collect()]
        if not folders:
            return self.spark.createDataFrame([], "file string, sources array<long>, bits binary")
        return self.spark.read.schema(_FILE).parquet(*folders).join(listed.select("file"), "file", "left_semi")

    def files_that_may_hold(self, batch: DataFrame) -> list[str]:
        """The files that may have a key of the batch."""
        filters = self._filters(self.files())
        keys = _key_hashes(batch, ["source_id"]).distinct()
        lists = keys.groupBy("source_id", F.pmod("hash", F.lit(_LISTS)).alias("list")).agg(F.collect_list("hash").alias("hashes"))
        # Which files have a source is told without their filters.
        sourced = filters.select("file", F.explode("sources").alias("source_id"))
        asked = sourced.join(lists, "source_id").groupBy("file").agg(F.flatten(F.collect_list("hashes")).alias("hashes"))

        def tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = zip(b.column("file").to_pylist(), b.column("bits").to_pylist(), b.column("hashes"))
                hit = [f for f, bits, hashes in rows if may_hold(bits, hashes.values.to_numpy()).any()]
                yield pa.RecordBatch.from_pydict({"file": pa.array(hit, pa.string())})

        pairs = filters.select("file", "bits").join(asked, "file")
        return sorted(r.file for r in pairs.mapInArrow(tested, "file string").collect())

    # --- Writing

    def create(self, notices: DataFrame) -> int:
        """The first version."""
        if commits.latest(self.spark, self.root):
            raise ValueError(f"{self.root} has notices already")
        return self._commit(self.files(), self._write(notices, notices.count()))

    def _write(self, notices: DataFrame, rows: int) -> DataFrame:
        """Write rows as new files in a folder of their own; ``file, rows, top_id, folder`` of them."""
        if not rows:
            return self.spark.createDataFrame([], _LISTED)
        name = uuid.uuid4().hex
        ordered = notices.select(*NOTICES.names).repartitionByRange(math.ceil(rows / self.rows_per_file), "source_id", "url", "id")
        ordered.sortWithinPartitions("source_id", "url").write.parquet(f"{self.root}/data/{name}")
        written = self.spark.read.schema(NOTICES).parquet(f"{self.root}/data/{name}")
        hashes = [F.when(F.col(c).isNotNull(), F.xxhash64("source_id", F.lit(kind), c)) for kind, c in NOTICE_KEYS.items()]
        narrow = written.select(
            F.col("_metadata.file_path").alias("file"), "id", "source_id", F.array_compact(F.array(*hashes)).alias("hashes")
        )
        described = narrow.groupBy("file").applyInArrow(_describe, _FILE)
        described.write.parquet(f"{self.root}/filters/{name}")
        listed = self.spark.read.schema(_FILE).parquet(f"{self.root}/filters/{name}")
        return listed.select("file", "rows", "top_id", F.lit(f"filters/{name}").alias("folder"))

    def _commit(self, kept: DataFrame, written: DataFrame) -> int:
        name = f"files/{uuid.uuid4().hex}"
        kept.unionByName(written).coalesce(1).write.parquet(f"{self.root}/{name}")
        return commits.commit(self.spark, self.root, {"files": name})

    def upsert(
        self,
        batch: DataFrame,
        parents: dict[str, tuple[DataFrame | None, str]] | None = None,
        placed: DataFrame | None = None,
    ) -> Upserted:
        """As ``upsert_notices`` into the whole table, reading and rewriting as few files as it can."""
        shared_dir(self.spark)
        files = self.files()
        n_files, top_id = files.agg(F.count("*"), F.coalesce(F.max("top_id"), F.lit(0))).first()
        near = self.files_that_may_hold(batch if placed is None else batch.join(placed, "row_number"))
        judged = judge_notices(self._read(near), batch, parents, top_id, placed)
        changed_ids = judged.accepted.where("NOT is_new").select("id")
        changed: list[str] = []
        if near:
            ids = self._read(near).select("id", F.col("_metadata.file_path").alias("file"))
            changed = [r.file for r in ids.join(changed_ids, "id", "left_semi").select("file").distinct().collect()]
        kept = files.where(~_any_of("file", changed))
        rows = judged.accepted.where("is_new").count() + (files.where(_any_of("file", changed)).agg(F.sum("rows")).first()[0] or 0)
        written = self._write(merge_notices(self._read(changed), judged), rows)
        version = self._commit(kept, written)
        return Upserted(version, judged.rejects, n_files, len(near), len(changed), written.count())


def _any_of(column: str, values: list[str]) -> Column:
    return F.col(column).isin(values) if values else F.lit(False)

"""Exact top-k by inner product with MaxScore over sharded postings.

Vectors of whole numbers are packed into shards. A shard keeps a posting list per component,
the positions and values that aren't zero, in sub-blocks, and for each list the least and
the greatest value. The components of a query that aren't zero are its terms. The most that a
term can add to a score is known from its list. Terms are put in order of that bound; those at
the end whose bounds together stay below the current k-th best score are non-essential: alone
they can't bring a vector in. Essential postings are traversed, and the non-essential terms of
what is still competitive are probed one by one, the strongest first, while any candidate can
still reach the k-th best score. Shards run apart, and their best are merged.

Queries meet shards in blocks, by a join on the shard's number, so each task holds one block
of queries and one shard, both of bounded size.

Ties go to the smaller id. A query's own row, and rows of the same id, are no candidates for
it. Vectors that are null or hold a null or a non-finite component take no part; shorter ones
count as filled with zeros. Exact repeats of a row are ranked each; a repeated query row is
answered each time. A null id takes no part. With fewer than k candidates all are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticelake.llm.common import settled

SHARD_ROWS = 8192
QUERY_ROWS = 512
_SUB_BLOCK = 2048

_PACKED = "shard string, ids binary, vectors binary, width int"


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, factor: float) -> DataFrame:
    """``id, v``: floor(factor * x) of each component as a double."""
    v = F.col(vector_col)
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    taken = vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & ~F.exists(v, bad))
    return taken.select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(v, lambda x: F.floor(x.cast("double") * factor).cast("long")).alias("v"),
    )


def _pack(rows_per_shard: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made, ids, vectors = TaskContext.get().partitionId(), 0, [], []

        def shard() -> pa.RecordBatch:
            width = max((len(v) for v in vectors), default=0)
            dense = np.zeros((len(vectors), width), np.int64)
            for row, v in zip(dense, vectors):
                row[: len(v)] = v
            parts = [[f"{part}:{made}"], [np.array(ids, np.int64).tobytes()], [dense.tobytes()]]
            return pa.record_batch([*map(pa.array, parts), pa.array([width], pa.int32())], ["shard", "ids", "vectors", "width"])

        for batch in batches:
            for i, v in zip(batch.column("id").to_pylist(), batch.column("v")):
                ids.append(i)
                vectors.append(np.asarray(v.values))
                if len(ids) == rows_per_shard:
                    yield shard()
                    made, ids, vectors = made + 1, [], []
        if ids:
            yield shard()

    return pack


class Shard:
    """Posting lists of a block of vectors, by component and sub-block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        # In order of ids, so that among equal scores the first found is the smaller.
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.least = np.minimum(vectors.min(axis=0, initial=0), 0)
        self.most = np.maximum(vectors.max(axis=0, initial=0), 0)
        self.blocks = [(a, min(a + _SUB_BLOCK, len(ids))) for a in range(0, len(ids), _SUB_BLOCK)]
        self.postings = [self._lists(np.ascontiguousarray(self.vectors[a:b].T)) for a, b in self.blocks]

    @staticmethod
    def _lists(columns: np.ndarray) -> list[tuple[np.ndarray | None, np.ndarray]]:
        """Positions and values that aren't zero; no positions where most aren't zero."""
        full = np.count_nonzero(columns, axis=1) * 2 > columns.shape[1]
        return [(None, c) if f else ((at := np.flatnonzero(c)), c[at]) for c, f in zip(columns, full)]

    def best(self, own_id: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k highest (score, id), ties to the smaller id."""
        n = min(len(query), self.vectors.shape[1])
        query = query[:n]
        terms = np.flatnonzero(query)
        bounds = np.maximum(query * self.least[:n], query * self.most[:n])
        terms = terms[np.argsort(-bounds[terms], kind="stable")]
        rest = np.append(np.cumsum(bounds[terms][::-1])[::-1], 0)  # what terms from here on can add
        scores, ids = np.empty(0, np.int64), np.empty(0, np.int64)
        for (a, b), lists in zip(self.blocks, self.postings):
            # Scores below this one can't enter any more; an equal one can by a smaller id.
            floor = scores[k - 1] if len(scores) >= k else None
            essential = len(terms) if floor is None else int(np.searchsorted(-rest, -floor, "right"))
            essential = min(essential, len(terms))
            total = np.zeros(b - a, np.int64)
            for t in terms[:essential]:
                at, values = lists[t]
                if at is None:
                    total += query[t] * values
                else:
                    total[at] += query[t] * values
            left = np.flatnonzero(self.ids[a:b] != own_id)
            if floor is not None:
                left = left[total[left] + rest[essential] >= floor]
            total = total[left]
            for j in range(essential, len(terms)):
                if not left.size:
                    break
                t = terms[j]
                total = total + query[t] * self.vectors[a + left, t]
                near = total + rest[j + 1] >= floor
                left, total = left[near], total[near]
            scores, ids = np.append(scores, total), np.append(ids, self.ids[a + left])
            order = np.lexsort((ids, -scores))[:k]
            scores, ids = scores[order], ids[order]
        return list(zip(scores.tolist(), ids.tolist()))


_FOUND = "query_row string, query_id long, id long, score long"


def _search(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = None, None
        for batch in batches:
            for r in batch.to_pylist():
                if r["shard"] != number:
                    ids = np.frombuffer(r["ids"], np.int64)
                    shard, number = Shard(ids, np.frombuffer(r["vectors"], np.int64).reshape(len(ids), -1)), r["shard"]
                query_ids = np.frombuffer(r["query_ids"], np.int64)
                queries = np.frombuffer(r["queries"], np.int64).reshape(len(query_ids), -1)
                names, owners, ids, scores = [], [], [], []
                for i, (own, q) in enumerate(zip(query_ids.tolist(), queries)):
                    for score, other in shard.best(own, q, k):
                        names.append(f"{r['block']}:{i}")
                        owners.append(own)
                        ids.append(other)
                        scores.append(score)
                yield pa.record_batch(
                    [pa.array(names, pa.string()), *[pa.array(x, pa.int64()) for x in (owners, ids, scores)]],
                    ["query_row", "query_id", "id", "score"],
                )

    return search


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    factor: float = 64.0,
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id, rank, id, score``; ``is_query`` is a condition on ``id``."""
    # Rows are dealt by hash, so that a lost task packs the same shards again.
    numbers = whole_numbers(vectors, id_col, vector_col, factor).repartition(F.xxhash64("id", "v"))
    shards = settled(numbers.mapInArrow(_pack(shard_rows), _PACKED))
    blocks = settled(numbers.where(is_query).mapInArrow(_pack(query_rows), _PACKED))
    names = [r.shard for r in shards.select("shard").collect()]  # one short name per shard
    asked = blocks.select(
        F.col("shard").alias("block"),
        F.col("ids").alias("query_ids"),
        F.col("vectors").alias("queries"),
        F.explode(F.array(*[F.lit(n) for n in names]).cast("array<string>")).alias("shard"),
    )
    met = asked.join(shards.select("shard", "ids", "vectors"), "shard")
    found = met.mapInArrow(_search(k), _FOUND)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "id", "score")
    )

"""Near-duplicate groups by SimHash and pigeonhole blocks.

Every text gets a 64-bit fingerprint. Fingerprints are cut into blocks, more of them than may
differ, so two close ones always agree on some set of whole blocks. They meet under the key
of each such set and are verified by Hamming distance. What leaves a meeting is a spanning
forest of the links found there, never all pairs, and the components of all forests are the
groups. Exact copies share a fingerprint and meet as one.

A null text counts as empty. Texts without a word have fingerprint zero and are linked like
any other. Repeated rows get the same answer each. A null id is never the smallest; a group
of null ids alone has a null component. No input column but the id and the text is read.
"""

from __future__ import annotations

from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticelake.llm.common import packed, settled, text_key

SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42
# Shingles whose bits are counted at once, so that a very long text needs little memory.
_STRETCH = 1 << 15
# Fingerprints that meet in one task at most about twice this number.
MEETING = 1 << 14
# Keys tell at least so many fingerprints apart, so that small inputs are treated alike.
LEAST_APART = 1 << 20


def fingerprint(raw: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The signed 64-bit SimHash of a UTF-8 text."""
    # On bytes, lower() changes A-Z alone and split() cuts at the six ASCII spaces alone.
    found = raw.lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= shingle_words:
        hashes = [xxhash.xxh64_intdigest(joined, HASH_SEED)]
        return int(np.array(hashes, np.uint64).view(np.int64)[0])
    ends = list(accumulate(len(w) + 1 for w in found))
    starts = [0, *ends]
    digest, total = xxhash.xxh64_intdigest, len(found) - shingle_words + 1
    ones = np.zeros(64, np.int64)
    for low in range(0, total, _STRETCH):
        high = min(total, low + _STRETCH)
        cuts = zip(starts[low:high], ends[low + shingle_words - 1 : high + shingle_words - 1])
        hashes = np.fromiter((digest(joined[a : b - 1], HASH_SEED) for a, b in cuts), ">u8", high - low)
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total).view(">i8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """``id, text_key, fp`` for every row."""

    @F.arrow_udf("long")
    def fp(texts: pa.Array) -> pa.Array:
        raw = texts.cast(pa.binary())
        return pa.array([fingerprint(t.as_py() or b"", shingle_words) for t in raw], pa.int64())

    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text_key(text).alias("text_key"), fp(text).alias("fp"))


def block_sets(n: int, max_bits: int) -> list[int]:
    """Masks, one of which any two fingerprints within ``max_bits`` agree on.

    64 bits are cut into B blocks; of close pairs at least B - max_bits blocks are equal. B is
    the least for which a set of so many blocks tells more than ``n`` fingerprints apart.
    """
    for blocks in range(max_bits + 1, 65):
        if 2 ** (64 * (blocks - max_bits) // blocks) >= n or comb(blocks + 1, max_bits) > 500:
            break
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(parts, blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def forest(members: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that join exactly those members which chains of close pairs join."""
    rest, links = np.unique(members.view(np.uint64)), []
    while rest.size > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and rest.size:
            at = queue.pop()
            near = np.bitwise_count(rest ^ at) <= max_bits
            if near.any():
                found, rest = rest[near], rest[~near]
                links += [(int(at.view(np.int64)), int(x)) for x in found.view(np.int64)]
                queue += list(found)
    return links


def close_links(distinct: DataFrame, max_bits: int = MAX_BITS, meeting: int = MEETING) -> DataFrame:
    """``a, b``: links between distinct fingerprints whose components are those of all close pairs."""
    masks = block_sets(max(distinct.count(), LEAST_APART), max_bits)
    fp = F.col("fp")
    keys = F.array(*[F.struct(F.lit(i).alias("set"), fp.bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(masks)])
    keyed = distinct.select("fp", F.explode(keys).alias("_k")).select("fp", "_k.*")
    # A key that one fingerprint has alone leads nowhere.
    shared = keyed.groupBy("set", "bits").agg(F.count("*").alias("n")).where("n > 1")
    # A key that very many have is met in pieces: each two of its pieces meet in one cell.
    other = F.sequence(F.lit(0), F.col("pieces") - 1)
    cells = F.transform(other, lambda o: F.struct(F.least("own", o).alias("low"), F.greatest("own", o).alias("high")))
    met = (
        keyed.join(shared, ["set", "bits"])
        .withColumn("pieces", F.ceil(F.col("n") / meeting).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int"))
        .select("set", "bits", "fp", F.explode(cells).alias("cell"))
        .groupBy("set", "bits", "cell")
        .agg(F.collect_list("fp").alias("fps"))
    )

    @F.arrow_udf("array<struct<a: bigint, b: bigint>>")
    def links(groups: pa.Array) -> pa.Array:
        found = [forest(np.array(g.values, np.int64), max_bits) for g in groups]
        return pa.array(
            [[{"a": a, "b": b} for a, b in f] for f in found],
            pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])),
        )

    return met.select(F.explode(links("fps")).alias("_l")).select("_l.*").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root``: for every linked node the smallest node that chains of links reach.

    Alternates two steps until nothing changes: every node's larger neighbours, then its
    smaller ones, are handed to the smallest neighbour. Only minima meet in one place.
    """
    edges = settled(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    )
    state = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settled(least.select("u", F.col("m").alias("v")).union(small).distinct())
        mix = F.xxhash64("u", "v")
        now = edges.agg(
            F.count("*"), F.sum(F.shiftright(mix, 32)), F.sum(mix.bitwiseAND(F.lit(0xFFFFFFFF)))
        ).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def _rooted(printed: DataFrame, max_bits: int, meeting: int) -> DataFrame:
    """``fp, first, root`` for every fingerprint; ``first`` names a row with its smallest id."""
    # Of rows that repeat an id, one with the smallest text key; of exact repeats, any.
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")).alias("first")
    per_fp = settled(printed.groupBy("fp").agg(first))
    roots = components(close_links(per_fp.select("fp"), max_bits, meeting))
    return per_fp.join(roots, per_fp["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    meeting: int = MEETING,
) -> DataFrame:
    """``id, text_key, fp, root, component`` for every row.

    ``root`` is the smallest fingerprint in reach, ``component`` the smallest id.
    """
    printed = settled(fingerprints(docs, id_col, text_col, shingle_words))
    rooted = _rooted(printed, max_bits, meeting)
    groups = rooted.groupBy("root").agg(F.min("first").alias("least"))
    components_of = rooted.join(groups, "root").select("fp", "root", F.col("least.id").alias("component"))
    return printed.join(components_of, "fp")


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    meeting: int = MEETING,
) -> DataFrame:
    """The documents, one of each group: a row with the smallest id."""
    printed = settled(fingerprints(docs, id_col, text_col, shingle_words))
    chosen = (
        _rooted(printed, max_bits, meeting)
        .groupBy("root")
        .agg(F.min("first").alias("first"))
        .select(F.col("first.id").alias("_id"), F.col("first.text_key").alias("_key"))
    )
    row = packed(docs).alias("_row")
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(row, F.col(id_col).alias("_own_id"), text_key(text).alias("_own_key"))
    kept = keyed.join(
        chosen, F.col("_own_id").eqNullSafe(F.col("_id")) & (F.col("_own_key") == F.col("_key"))
    )
    return one_per_key(kept, ["_own_id", "_own_key"]).select("_row.*")


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row of each key; rows of a key are exact repeats but for columns of no interest."""
    order = Window.partitionBy(*keys).orderBy(F.lit(0))
    return df.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")

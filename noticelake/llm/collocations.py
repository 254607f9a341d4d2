"""Phrases whose words stand together more often than their parts explain.

A phrase is a run of words within a piece of text, frequent if it is found ``threshold`` times
in its language. Which are frequent is found in two passes. The first keeps Misra-Gries
summaries: every n-gram belongs to a hash partition, and the summary of a partition has more
counters than the partition's mass divided by the threshold. So what it has subtracted from a
count stays below the threshold, and no frequent n-gram is lost. Tasks hand on what they have
counted of a partition in blocks, and blocks and summaries merge by the same rule. The second
pass counts what survived exactly, by its words; what is not frequent after all goes.

Parts of a frequent phrase are frequent. So single words and pairs come first, and of longer
n-grams only those whose pairs all survived are summarised. Survivors are known to the tasks
by a Bloom filter of bounded size, made in slices, one for each hash partition; it never misses
a survivor, and what it lets through by mistake costs time and is counted like the rest.

A hot word or phrase is one entry of each block, so no task gathers it. A null text counts as
empty and a null language as ``und``; repeated rows count as often as they stand there. An
empty table has no phrases.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noticelake.llm.common import settled, text_slices

MAX_WORDS = 5
THRESHOLD = 100
# Text read at a time, n-grams counted before they are handed on, distinct words and phrases
# that a task holds.
SLICE_BYTES = 4 << 20
BLOCK_NGRAMS = 4 << 20
HELD = 500_000
# Text of a hash partition, and the least and most partitions.
PARTITION_BYTES = 1 << 20
PARTITIONS = (64, 1 << 16)
# Bits of the filter for each survivor, and the least and most in all, as powers of two.
FILTER_BITS, FILTER_POWERS = 16, (20, 28)

# Pieces end at these; words are separated by spaces and tabs.
BREAKS = b".,;:!?\n\x0b\x0c\r"
_TRANSLATED = bytes.maketrans(BREAKS + b"\t", b"\n" * len(BREAKS) + b" ")
_EMPTY, _BREAK = 0, 1
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Vocabulary(dict):
    """Word to code, and the words and their hashes by code."""

    def __init__(self):
        super().__init__({b"": _EMPTY, b"\n": _BREAK})
        self.words: list[bytes] = [b"", b"\n"]
        self._hashes = np.zeros(1024, np.uint64)

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self.words)
        self.words.append(word)
        if code >= len(self._hashes):
            self._hashes = np.concatenate([self._hashes, np.zeros_like(self._hashes)])
        self._hashes[code] = xxhash.xxh64_intdigest(word)
        return code

    def codes(self, text: bytes) -> np.ndarray:
        """Of a lower-cased, translated text: words in order, with breaks between pieces."""
        tokens = text.replace(b"\n", b" \n ").split(b" ")
        found = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        return found[found != _EMPTY]

    def hashes(self, codes: np.ndarray) -> np.ndarray:
        return self._hashes[codes]


def _stretches(text: bytes, most: int = SLICE_BYTES) -> Iterator[bytes]:
    """A long text cut at breaks."""
    low = 0
    while len(text) - low > most:
        at = text.rfind(b"\n", low, low + most)
        at = at if at >= low else text.find(b"\n", low + most)
        if at < 0:
            break
        yield text[low : at + 1]
        low = at + 1
    yield text[low:]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """Language and text, many texts of a language as one; A-Z lower-cased."""
    for batch in text_slices(batches, SLICE_BYTES):
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            by_lang.setdefault(lang, []).append((text or "").encode())
        for lang, texts in by_lang.items():
            for stretch in _stretches(b"\n".join(texts).lower().translate(_TRANSLATED)):
                yield lang, stretch


def split(hashes: np.ndarray, partitions: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash partition, and the 32 bits that name an n-gram in it.

    Two n-grams of one name only make each other survive.
    """
    power = partitions.bit_length() - 1
    part = (hashes >> np.uint64(63 - power)) >> np.uint64(1)
    return part.astype(np.int64), (hashes >> np.uint64(32 - power)).astype(np.uint32)


def _places(keys: np.ndarray, power: int) -> Iterator[np.ndarray]:
    """The bits of an n-gram in a slice of the filter."""
    for odd in (_ODD, np.uint64(0xC2B2AE3D27D4EB4F)):
        yield ((keys.astype(np.uint64) * odd) >> np.uint64(64 - power)).astype(np.int64)


@dataclass(frozen=True)
class Filter:
    """A Bloom filter of survivors, in as many slices as there are hash partitions."""

    bits: np.ndarray
    partitions: int
    slice_power: int

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        part, keys = split(hashes, self.partitions)
        found = np.ones(len(hashes), bool)
        for at in _places(keys, self.slice_power):
            at += part << self.slice_power
            found &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return found


def ngram_hashes(codes: np.ndarray, vocabulary: Vocabulary, lang: str, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each number of words the hash at every place, and where a piece has that many words."""
    words = vocabulary.hashes(codes)
    inside = codes != _BREAK
    hashes, whole = _mixed(words ^ np.uint64(xxhash.xxh64_intdigest(lang.encode()))), inside
    yield hashes, whole
    for n in range(2, most + 1):
        hashes = _mixed(hashes[:-1] * _ODD + words[n - 1 :])
        whole = whole[:-1] & inside[n - 1 :]
        yield hashes, whole


class Summary:
    """Misra-Gries counters: a count is too small by ``cut`` at most, absent ones included."""

    def __init__(self, capacity: int):
        self.capacity, self.cut = capacity, 0
        self.keys, self.counts = np.empty(0, np.uint32), np.empty(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray, cut: int = 0) -> None:
        """Takes in counts, or another summary; with more keys than counters the rest is subtracted."""
        both = np.concatenate([self.keys, keys])
        order = np.argsort(both, kind="stable")
        both, sums = both[order], np.concatenate([self.counts, counts])[order]
        starts = np.flatnonzero(np.r_[True, both[1:] != both[:-1]]) if len(both) else np.empty(0, np.int64)
        self.keys, self.counts, self.cut = both[starts], np.add.reduceat(sums, starts) if len(starts) else sums, self.cut + cut
        if len(self.keys) > self.capacity:
            place = len(self.counts) - self.capacity - 1
            least = int(np.partition(self.counts, place)[place])
            left = self.counts > least
            self.keys, self.counts, self.cut = self.keys[left], self.counts[left] - least, self.cut + least

    def survivors(self, threshold: int) -> np.ndarray:
        return self.keys[self.counts + self.cut >= threshold]


def _block_maker(partitions: int, words: range, pairs: Broadcast | None):
    """Counts of n-grams: ``part, mass, keys, counts``, a row for each hash partition."""

    def blocks(hashes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        found, counts = np.unique(np.concatenate(hashes), return_counts=True)
        part, keys = split(found, partitions)
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        ends = np.r_[starts[1:], len(part)]
        columns = {
            "part": pa.array(part[starts], pa.int32()),
            "mass": pa.array(np.add.reduceat(counts, starts), pa.int64()),
            "keys": pa.array([keys[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
            "counts": pa.array([counts[a:b].astype(np.uint32).tobytes() for a, b in zip(starts, ends)], pa.binary()),
        }
        yield pa.RecordBatch.from_pydict(columns)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, held = Vocabulary(), []
        for lang, text in _texts(batches):
            if len(vocabulary) > HELD:
                vocabulary = Vocabulary()
            codes = vocabulary.codes(text)
            paired = joined = None
            for n, (hashes, whole) in enumerate(ngram_hashes(codes, vocabulary, lang, words[-1]), 1):
                if n == 2 and pairs is not None:
                    paired = joined = _surviving(hashes, whole, pairs.value)
                elif n > 2 and pairs is not None:
                    whole = joined = joined[:-1] & paired[n - 2 :]
                if n in words and whole.any():
                    held.append(hashes[whole])
            if sum(map(len, held)) >= BLOCK_NGRAMS:
                yield from blocks(held)
                held = []
        if held:
            yield from blocks(held)

    return make


def _surviving(hashes: np.ndarray, places: np.ndarray, known: Filter) -> np.ndarray:
    """Those places whose n-gram the filter lets through."""
    found = places.copy()
    found[places] = known.holds(hashes[places])
    return found


def _summed(threshold: int):
    """``part, n, keys``: the survivors of one hash partition, from its blocks as they come."""

    def survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary, part, keys, counts = None, None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                # More counters than mass / threshold.
                part, summary = row["part"], summary or Summary(row["in_all"] // threshold + 1)
                keys.append(np.frombuffer(row["keys"], np.uint32))
                counts.append(np.frombuffer(row["counts"], np.uint32).astype(np.int64))
                if sum(map(len, keys)) > max(summary.capacity, 1 << 16):
                    summary.merge(np.concatenate(keys), np.concatenate(counts))
                    keys, counts = [], []
        if keys:
            summary.merge(np.concatenate(keys), np.concatenate(counts))
        found = summary.survivors(threshold)
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "n": pa.array([len(found)], pa.int64()), "keys": pa.array([found.tobytes()], pa.binary())}
        )

    return survivors


def _slice_maker(power: int):
    """``part, bits``: the slice of the filter that a partition has."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for raw in batch.column("keys").to_pylist():
                bits = np.zeros(1 << power, bool)
                for at in _places(np.frombuffer(raw, np.uint32), power):
                    bits[at] = True
                made.append(np.packbits(bits, bitorder="little").tobytes())
            yield pa.RecordBatch.from_pydict({"part": batch.column("part"), "bits": pa.array(made, pa.binary())})

    return make


def survivors(texts: DataFrame, words: range, threshold: int, partitions: int, pairs: Broadcast | None = None) -> Broadcast:
    """A filter that holds every n-gram of so many words which is found ``threshold`` times."""
    made = texts.mapInArrow(_block_maker(partitions, words, pairs), "part int, mass long, keys binary, counts binary")
    blocks = settled(made)
    mass = blocks.groupBy("part").agg(F.sum("mass").alias("in_all"))
    grouped = blocks.join(mass, "part").groupBy("part")
    found = settled(grouped.applyInArrow(_summed(threshold), "part int, n long, keys binary"))
    n = found.agg(F.sum("n")).first()[0] or 0
    low, high = FILTER_POWERS
    power = min(max(math.ceil(math.log2(FILTER_BITS * n + 1)), low), high) - (partitions.bit_length() - 1)
    bits = np.zeros(partitions << (power - 3), np.uint8)
    # As many bytes as the filter has, whatever the input is.
    for r in found.mapInArrow(_slice_maker(power), "part int, bits binary").toLocalIterator():
        bits[r.part << (power - 3) : (r.part + 1) << (power - 3)] = np.frombuffer(r.bits, np.uint8)
    return texts.sparkSession.sparkContext.broadcast(Filter(bits, partitions, power))


class _Counts:
    """Exact counts of phrases by their words, handed on as a row for each hash partition."""

    def __init__(self):
        self.phrases: Counter[tuple[int, str, int, bytes]] = Counter()

    def add(self, parts: np.ndarray, lang: str, size: int, words: list[list[bytes]], counts: np.ndarray) -> None:
        for part, phrase, n in zip(parts.tolist(), map(b" ".join, words), counts.tolist()):
            self.phrases[part, lang, size, phrase] += n

    def rows(self) -> Iterator[pa.RecordBatch]:
        by_part: dict[int, list[tuple]] = {}
        for (part, *phrase), n in self.phrases.items():
            by_part.setdefault(part, []).append((*phrase, n))
        self.phrases = Counter()
        for part, held in by_part.items():
            lang, size, phrase, n = zip(*held)
            columns = {
                "part": pa.array([part], pa.int32()),
                "lang": pa.array([lang], pa.list_(pa.string())),
                "size": pa.array([size], pa.list_(pa.int32())),
                "phrase": pa.array([[x.decode() for x in phrase]], pa.list_(pa.string())),
                "n": pa.array([n], pa.list_(pa.int64())),
            }
            yield pa.RecordBatch.from_pydict(columns)


_COUNTS = "part int, lang array<string>, size array<int>, phrase array<string>, n array<long>"
_PHRASE = ["lang", "size", "phrase"]


def _added_up(threshold: int):
    """The frequent phrases of one hash partition, and the sums of size 0."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def summed(tables: list[pa.Table]) -> pa.Table:
            found = pa.concat_tables(tables).group_by(_PHRASE).aggregate([("n", "sum")])
            return found.select([*_PHRASE, "n_sum"]).rename_columns([*_PHRASE, "n"])

        held: list[pa.Table] = []
        for batch in batches:
            held.append(pa.table({c: batch.column(c).flatten() for c in [*_PHRASE, "n"]}))
            if sum(t.num_rows for t in held[1:]) > max(HELD, held[0].num_rows):
                held = [summed(held)]
        whole = summed(held)
        kept = pc.or_(pc.greater_equal(whole.column("n"), threshold), pc.equal(whole.column("size"), 0))
        yield from whole.filter(kept).combine_chunks().to_batches(50_000)

    return add


def _counter(most: int, first: Broadcast, later: Broadcast):
    """Counts of what survived, and of all words as a phrase of size 0.

    An n-gram is told from others by the number its first words have among those of its size,
    and by its last word, so no hash decides.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, counts = Vocabulary(), _Counts()
        for lang, text in _texts(batches):
            if len(vocabulary) > HELD:
                vocabulary = Vocabulary()
            codes = vocabulary.codes(text)
            counts.phrases[0, lang, 0, b""] += int((codes != _BREAK).sum())
            numbers, places = codes, np.ones(len(codes), bool)
            for n, (hashes, whole) in enumerate(ngram_hashes(codes, vocabulary, lang, most), 1):
                # The first words of a survivor survive too.
                places = _surviving(hashes, whole & places[: len(whole)], (first if n <= 2 else later).value)
                at = np.flatnonzero(places)
                pairs = numbers[at] * len(vocabulary.words) + codes[at + n - 1] if n > 1 else numbers[at]
                _, seen, named, found = np.unique(pairs, return_index=True, return_inverse=True, return_counts=True)
                starts = at[seen]
                parts, _ = split(hashes[starts], later.value.partitions)
                counts.add(parts, lang, n, [[vocabulary.words[c] for c in codes[i : i + n]] for i in starts.tolist()], found)
                numbers = np.zeros(len(places), np.int64)
                numbers[at] = named
            if len(counts.phrases) > HELD:
                yield from counts.rows()
        yield from counts.rows()

    return count


def _partitions(texts: DataFrame) -> int:
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    low, high = PARTITIONS
    return min(max(1 << math.ceil(math.log2(size / PARTITION_BYTES + 1)), low), high)


def frequent(docs: DataFrame, threshold: int = THRESHOLD, most: int = MAX_WORDS, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, size, phrase, n`` of the n-grams found ``threshold`` times; size 0 counts all words.

    The rows are kept, as what follows reads them several times.
    """
    if most < 2 or threshold < 1:
        raise ValueError("phrases have two words and are found once at least")
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").alias("text"))
    partitions = _partitions(texts)
    pairs = survivors(texts, range(1, 3), threshold, partitions)
    longer = survivors(texts, range(3, most + 1), threshold, partitions, pairs) if most > 2 else pairs
    counted = texts.mapInArrow(_counter(most, pairs, longer), _COUNTS)
    return settled(counted.groupBy("part").applyInArrow(_added_up(threshold), "lang string, size int, phrase string, n long"))


def scored(grams: DataFrame) -> DataFrame:
    """``lang, phrase, size, a, l, r, n, score`` of phrases: the cut of the lowest score counts."""
    words = F.split("phrase", " ")
    cuts = (
        grams.where("size > 1")
        .withColumnRenamed("n", "a")
        .select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
        .withColumn("left", F.array_join(F.slice(words, F.lit(1), F.col("k")), " "))
        .withColumn("right", F.array_join(F.slice(words, F.col("k") + 1, F.col("size")), " "))
    )

    def parts(name: str, n: str) -> DataFrame:
        return grams.where("size > 0").select("lang", F.col("phrase").alias(name), F.col("n").alias(n))

    totals = grams.where("size = 0").select("lang", "n")
    both = cuts.join(parts("left", "l"), ["lang", "left"]).join(parts("right", "r"), ["lang", "right"]).join(totals, "lang")
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "n")}
    score = F.expr("cast(over div under as bigint)")
    ranked = both.withColumn("over", exact["a"] * F.lit(1000).cast("decimal(4,0)") * exact["n"]).withColumn("under", exact["l"] * exact["r"])
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("least")
    return (
        ranked.groupBy("lang", "phrase", "size", "a", "n")
        .agg(least)
        .select("lang", "phrase", "size", "a", "least.l", "least.r", "n", "least.score")
    )


def standing_alone(phrases: DataFrame) -> DataFrame:
    """Phrases that no longer one holds as often.

    A phrase that stands as often in a much longer one does so in one of a word more, which is
    no less frequent; so those are enough.
    """
    words = F.split("phrase", " ")
    inner = F.array(F.slice(words, F.lit(1), F.col("size") - 1), F.slice(words, F.lit(2), F.col("size") - 1))
    holders = phrases.where("size > 2").select("lang", F.explode(inner).alias("words"), "a")
    most = holders.select("lang", F.array_join("words", " ").alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("inside"))
    return phrases.join(most, ["lang", "phrase"], "left").where("inside is null or inside < a").drop("inside")


def collocations(docs: DataFrame, top: int | None = None, **settings) -> DataFrame:
    """``lang, rank, phrase, size, a, l, r, n, score``, the first ``top`` of each language."""
    found = standing_alone(scored(frequent(docs, **settings)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return (ranked if top is None else ranked.where(F.col("rank") <= top)).withColumn("rank", F.col("rank").cast("long"))

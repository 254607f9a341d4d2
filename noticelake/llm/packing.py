"""Documents packed into sequences of a fixed number of tokens, by exact complements.

Spark makes the token ids and counts how many pieces have each length. That histogram has one
number per length, ``size`` at most, however many pieces there are, so the plan is made from it
on the driver: a pattern says which lengths share a sequence, and how many sequences are filled
that way. For a gap the index of single, pair and triple sums of lengths names a combination
that fills it exactly, as far as the counts allow, and lengths left over are packed best-fit.
An exact pattern uses up a length but for fewer pieces than it takes of it, and best fit starts
three patterns for a length at most, so there are less than ``size * (4 + ln(size))``.

A piece finds its place by its rank among the pieces of its length: pieces are numbered within
their partition as they are made and kept, and each partition's counts give the rest. So no
length is gathered anywhere, also where a third of all pieces are equally long.

A null text counts as empty and an empty text is its end token alone. A text longer than a
sequence is cut into pieces of ``size`` tokens, of which the first may be shorter. Repeated
rows and null ids are packed each by itself. An empty table gives no rows.
"""

from __future__ import annotations

import math
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticelake.llm.bpe import _cutter
from noticelake.llm.common import settled, text_slices

SIZE = 1024
END_ID = 2
# Distinct words that a worker remembers before it starts anew, and text it cuts at a time.
STRETCH_WORDS = 1_000_000
SLICE_BYTES = 4 << 20


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Codes(dict):
    """Word to code; a word that is not known yet gets the next code and is noted as fresh."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        code = self[word] = len(self)
        self.fresh.append(word)
        return code


class Encoder:
    """Ids of texts; the tokenizer is asked once for each word it has not seen.

    The tokenizer merges within words alone, so the ids of a text are those of its words. Only
    Latin-1 texts are cut here, where all versions of Unicode agree on letters and digits; any
    other text goes to the tokenizer whole.
    """

    def __init__(self, vocabulary: str, stretch: int = STRETCH_WORDS):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task on a core
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.encode_special_tokens = True
        self.cut, self.stretch = _cutter(None), stretch
        self._forget()

    def _forget(self) -> None:
        self.codes = _Codes()
        self.ids, self.sizes, self.starts = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self) -> None:
        found = self._encode(self.codes.fresh)
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), np.uint32)])
        self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, found), np.int64, len(found))])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.codes.fresh = []

    def _coded(self, text: str) -> np.ndarray | None:
        """Codes of the words of a Latin-1 text."""
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return None
        words = self.cut(text)
        return np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.codes) > self.stretch:
            self._forget()
        coded = [self._coded(t) for t in texts]
        if self.codes.fresh:
            self._learn()
        whole = iter(self._encode([t for t, codes in zip(texts, coded) if codes is None]))
        return [np.array(next(whole), np.uint32) if codes is None else self._joined(codes) for codes in coded]

    def _joined(self, codes: np.ndarray) -> np.ndarray:
        n = self.sizes[codes]
        before = np.cumsum(n) - n
        return self.ids[np.repeat(self.starts[codes] - before, n) + np.arange(n.sum())]


@lru_cache(maxsize=1)
def _encoder(vocabulary: str) -> Encoder:
    """One for all tasks of a worker process, so that it learns frequent words once."""
    return Encoder(vocabulary)


def _cut_pieces(tokens: int, size: int) -> Iterator[tuple[int, int]]:
    """Start and length of each piece; only the first may be shorter than ``size``."""
    start, length = 0, tokens % size or min(tokens, size)
    while start < tokens:
        yield start, length
        start, length = start + length, size


def _piece_maker(sent, id_type: pa.DataType, size: int, end_id: int, keep_ids: bool):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(sent.value)
        seen = np.zeros(size + 1, np.int64)
        for batch in text_slices(batches, SLICE_BYTES):
            keys, texts = batch.column("id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            rows: list[tuple] = []
            for key, ids in zip(keys, encoder.encode(texts)):
                raw = np.append(ids, np.uint32(end_id)).astype("<u4")
                for i, (start, length) in enumerate(_cut_pieces(len(raw), size)):
                    piece = raw[start : start + length].tobytes()
                    rows.append((key, i, start, length, zlib.crc32(piece), seen[length], piece if keep_ids else None))
                    seen[length] += 1
            if rows:
                key, piece, start, length, crc, nth, ids = zip(*rows)
                columns = {
                    "id": pa.array(key, id_type),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                    "nth": pa.array(nth, pa.int64()),
                }
                if keep_ids:
                    columns["ids"] = pa.array(ids, pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return make


def pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    size: int = SIZE,
    end_id: int = END_ID,
    keep_ids: bool = True,
) -> DataFrame:
    """``id, piece, start, length, ids_crc32[, ids]`` and ``part, nth``, which name a row among
    those of its length; computed once and kept, as the numbering must not change.

    ``ids`` are little-endian unsigned 32-bit numbers. The vocabulary file is read on the driver.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    with open(vocabulary or vocabulary_path(), encoding="utf-8") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    id_type = texts.schema["id"].dataType
    fields = [T.StructField("id", id_type)]
    fields += T.StructType.fromDDL("piece int, start long, length long, ids_crc32 long, nth long").fields
    fields += [T.StructField("ids", T.BinaryType())] * keep_ids
    made = texts.mapInArrow(_piece_maker(sent, to_arrow_type(id_type), size, end_id, keep_ids), T.StructType(fields))
    return settled(made.withColumn("part", F.spark_partition_id()))


@dataclass(frozen=True)
class Pattern:
    """``copies`` sequences that each hold ``times`` pieces of each length."""

    times: dict[int, int]
    copies: int


class Planner:
    """Turns counts of lengths into patterns."""

    def __init__(self, counts: dict[int, int], size: int = SIZE):
        self.size = size
        self.left = np.zeros(size + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n

    def _one(self, gap: int, free: np.ndarray) -> tuple[int, ...]:
        return (gap,) if free[gap] > 0 else ()

    def _two(self, gap: int, free: np.ndarray, longest: int) -> tuple[int, ...]:
        """The pair of the longest piece; equal ones need two in stock."""
        a = np.arange(min(longest, gap - 1), (gap - 1) // 2, -1)
        fits = (free[a] > 0) & (free[gap - a] > (2 * a == gap))
        return (int(a[at]), int(gap - a[at])) if len(a) and fits[at := int(fits.argmax())] else ()

    def _three(self, gap: int, free: np.ndarray) -> tuple[int, ...]:
        lengths = np.flatnonzero(free[: max(gap - 1, 0)])
        for a in lengths[lengths * 3 >= gap][::-1].tolist():
            free[a] -= 1
            rest = self._two(gap - a, free, a)
            free[a] += 1
            if rest:
                return (a, *rest)
        return ()

    def _exact(self, gap: int, free: np.ndarray, fewest: int = 1, most: int = 3) -> tuple[int, ...]:
        """Lengths, ``fewest`` to ``most`` of them, whose sum is the gap."""
        found = ()
        for n in range(fewest, most + 1):
            found = found or (self._one(gap, free), self._two(gap, free, gap), self._three(gap, free))[n - 1]
        return found

    def _fill(self, first: int) -> dict[int, int]:
        """Lengths that fill a sequence together with a first one, or none.

        Where no combination fills what is left, the longest that fits goes in before the next try.
        """
        free = self.left.copy()
        chosen, gap, last = [], self.size, (first,)
        while last:
            for length in last:
                chosen.append(length)
                free[length] -= 1
                gap -= length
            last = self._exact(gap, free) if gap else ()
            if not last:
                last = tuple(np.flatnonzero(free[: gap + 1])[-1:].tolist())
        return {} if gap else {x: chosen.count(x) for x in dict.fromkeys(chosen)}

    def _take(self, times: dict[int, int]) -> Pattern:
        copies = min(int(self.left[x]) // k for x, k in times.items())
        for x, k in times.items():
            self.left[x] -= k * copies
        return Pattern(times, copies)

    def _complements(self, pieces: int) -> Iterator[Pattern]:
        """Sequences filled by a piece and a combination of so many others, the longest pieces first."""
        for first in range(self.size - 1, 0, -1):
            while self.left[first]:
                free = self.left.copy()
                free[first] -= 1
                chosen = (first, *self._exact(self.size - first, free, pieces, pieces))
                if len(chosen) == 1:
                    break
                yield self._take({x: chosen.count(x) for x in dict.fromkeys(chosen)})

    def _filled(self) -> Iterator[Pattern]:
        """Sequences that combinations fill once the longest pieces have gone in."""
        for first in range(self.size, 0, -1):
            while self.left[first] and (times := self._fill(first)):
                yield self._take(times)

    def _best_fit(self) -> list[Pattern]:
        """The rest, longest first, each piece to the fullest sequence that has room for it.

        That one takes as many of the length as it can, so equally full ones go together.
        """
        rooms: dict[int, list[Pattern]] = {}
        for length in np.flatnonzero(self.left)[::-1].tolist():
            n, room = int(self.left[length]), length
            rooms[self.size] = [Pattern({}, n)]
            while n:
                while not rooms.get(room):
                    room += 1
                old = rooms[room].pop()
                each = min(room // length, n)
                copies = min(old.copies, n // each)
                n -= copies * each
                rooms.setdefault(room - each * length, []).append(Pattern({**old.times, length: each}, copies))
                if copies < old.copies:
                    rooms[room].append(Pattern(old.times, old.copies - copies))
        self.left[:] = 0
        return [p for found in rooms.values() for p in found if p.times]

    def patterns(self, most: int) -> list[Pattern]:
        """Exact complements of up to ``most`` pieces, 4 for any number, and the rest best-fit."""
        found: list[Pattern] = []
        for pieces in range(1, min(most, 3) + 1):
            found += self._complements(pieces) if most < 4 else ()
        found += self._filled() if most == 4 else ()
        return [*found, *self._best_fit()]


def plan(counts: dict[int, int], size: int = SIZE) -> list[Pattern]:
    """The best of five plans. Where short pieces are few, complements of many pieces use them up
    too early; where they abound, such complements leave the least room empty."""
    plans = [Planner(counts, size).patterns(most) for most in (4, 3, 2, 1, 0)]
    return min(plans, key=lambda found: sum(p.copies for p in found))


class Slots:
    """Where the pieces of a length go, by their rank; as arrays sorted by length and rank."""

    def __init__(self, patterns: list[Pattern]):
        used: dict[int, int] = {}
        rows, sequence = [], 0
        for p in patterns:
            offset = 0
            for length, k in p.times.items():
                rows.append((length, used.get(length, 0), k, sequence, offset))
                used[length] = used.get(length, 0) + k * p.copies
                offset += k * length
            sequence += p.copies
        self.sequences = sequence
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.length, self.rank, self.times, self.sequence, self.offset = table.T
        lengths = np.arange(self.length.max(initial=0) + 2)
        self.first = np.searchsorted(self.length, lengths)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces, by length and rank."""
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for x in np.unique(length):
            low, high = self.first[x], self.first[x + 1]
            mine = np.flatnonzero(length == x)
            at = low + np.searchsorted(self.rank[low:high], rank[mine], side="right") - 1
            copy, nth = np.divmod(rank[mine] - self.rank[at], self.times[at])
            sequence[mine] = self.sequence[at] + copy
            offset[mine] = self.offset[at] + nth * x
        return sequence, offset


def place(made: DataFrame, size: int = SIZE) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset`` in place of ``part`` and ``nth``."""
    counts = made.groupBy("part", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    histogram = {r.length: r.n for r in made.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = Slots(plan(histogram, size))
    ranked = made.join(before, ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    rows = ranked.select(*[c for c in made.columns if c not in ("part", "nth")], "rank")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = slots.place(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            kept = batch.drop_columns(["rank"])
            yield kept.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    schema = T.StructType([*rows.drop("rank").schema.fields, *T.StructType.fromDDL("sequence_id long, offset long").fields])
    return rows.mapInArrow(put, schema)


def pack(docs: DataFrame, size: int = SIZE, **settings) -> DataFrame:
    """``id, piece, start, length, ids_crc32[, ids], sequence_id, offset`` of every piece."""
    return place(pieces(docs, size=size, **settings), size)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, n_tokens, ids, starts`` of pieces packed with their ids.

    ``ids`` is binary as in the pieces, and ``starts`` tells where each piece begins.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts")).select(
        "sequence_id",
        "n_tokens",
        F.aggregate("parts.ids", F.lit(b""), lambda all_, x: F.concat(all_, x)).alias("ids"),
        F.col("parts.offset").alias("starts"),
    )


def fewest(counts: dict[int, int], size: int = SIZE) -> int:
    """No packing can have fewer sequences than this."""
    total = sum(x * n for x, n in counts.items())
    return max(math.ceil(total / size), sum(n for x, n in counts.items() if 2 * x > size))

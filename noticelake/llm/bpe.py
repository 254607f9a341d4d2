"""Byte-level BPE, encoding and decoding, by the ranks of a public vocabulary.

A text is cut into words by the tokenizer's pattern, and words, not texts, are encoded:
Spark's higher-order functions fold merges over the byte arrays of distinct words, at each step
joining the leftmost pair of the least rank, found in a literal map. Parts stand for their ranks
there, which are their ids, and the map leads from pairs of ranks to the rank of the joined piece.
Each part keeps the rank of its pair with the next one, so a step looks up only two pairs.
One pair for each piece is enough: while two parts spell a piece, no merge has crossed its ends,
so inside it the same merges came in the same order as when the piece is merged by itself, and
its two last parts are always the same.

The ``head_words`` most frequent words of all documents are encoded once and sent to all
tasks; words are at most ``FOLD_BYTES`` long there, so the size of what is sent is bounded.
Any other word is encoded once in each stretch of a partition that has it. Before and after
that fold a small Arrow step takes words out of the texts and puts their ids back in, within
one task and without a shuffle: it hands on each word ahead of the texts that hold it, and a
narrow stage keeps the order of rows. The head changes the time that encoding takes and never
its result. Decoding joins the binary pieces of the ids.

The bytes of a word enter the fold as the characters U+0000 to U+00FF. The fold's work grows with
the square of a word's length, so a word of more than ``FOLD_BYTES`` bytes is merged by the
same rule with a heap, in the Arrow step.

A null text counts as empty; an empty text has no ids. Repeated rows are encoded alike. The
pattern's letter and number classes are those of the Unicode version of the ``regex`` module.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import random
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticelake.llm.common import settled

FOLD_BYTES = 64
_SLICE_ROWS = 500
# Distinct words that a task remembers before it starts anew.
STRETCH_WORDS = 500_000
HEAD_WORDS = 1 << 19
# Ranks stand above this bit, parts below it.
_RANK_BIT = 31


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    """Piece to rank; read on the driver, a vocabulary has some ten thousand pieces."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(piece): int(rank) for piece, rank in pairs}


def _spelled_out(pattern: str, classes: dict[str, str]) -> str:
    """The pattern with each class written as its members, with brackets where it stands alone."""
    parts = re.split(r"(\[\^?[^\]]*\])", pattern)
    for name, members in classes.items():
        parts = [x.replace(name, members if x.startswith("[") else f"[{members}]") for x in parts]
    return "".join(x.replace(r"\S", f"[^{classes[chr(92) + 's']}]") for x in parts)


def _cutter(pattern: str | None) -> Callable[[str], list[str]]:
    r"""All matches of the tokenizer's pattern, or of another.

    ``\s`` means the Unicode property White_Space. Texts in Latin-1 are cut by the same
    pattern with its classes spelled out for Latin-1, which is faster.
    """
    import regex

    if pattern is None:
        from public_tokenizers import PATTERN as pattern
    latin = [chr(i) for i in range(256)]

    def members(name: str) -> str:
        return "".join(f"\\x{ord(c):02x}" for c in latin if regex.match(name, c))

    classes = {r"\p{L}": members(r"\p{L}"), r"\p{N}": members(r"\p{N}"), r"\s": members(r"\p{White_Space}")}
    in_latin = re.compile(_spelled_out(pattern, classes)).findall
    in_any = regex.compile(_spelled_out(pattern, {r"\s": r"\p{White_Space}"})).findall

    def cut(text: str) -> list[str]:
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return in_any(text)
        return in_latin(text)

    return cut


def last_parts(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The two parts that are joined last when a piece is merged, or more where merging ends early."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 2:
        known = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not known:
            break
        _, i = min(known)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


class RankMap(NamedTuple):
    """The literal map: ranks of bytes, of pairs of ranks, and of pieces that no merges lead to.

    A pair stands in ``pairs`` at its right rank, counted from where ``rows`` says that its left
    rank begins. Rows lie in gaps of each other, so what stands there names its left rank below
    the joined one. ``no_rank`` is above all ranks.
    """

    no_rank: int
    of_bytes: Column
    rows: Column
    pairs: Column
    whole: Column | None


def _laid_out(rows: dict[int, dict[int, int]], no_rank: int) -> tuple[list[int | None], list[int | None]]:
    """Where the row of each left rank begins, and what stands at each place.

    The longest rows come first, each at the first random place where it meets no other.
    """
    begins: list[int | None] = [None] * no_rank
    held: dict[int, int] = {}
    # About three of four places stay empty, as a row reaches far, so it is placed after a few trials.
    places, last = random.Random(0), 2 * sum(map(len, rows.values()))
    for left, row in sorted(rows.items(), key=lambda x: -len(x[1])):
        begin = places.randint(0, last)
        while any(begin + right in held for right in row):
            last += 1
            begin = places.randint(0, last)
        begins[left] = begin
        held.update((begin + right, joined << _RANK_BIT | left) for right, joined in row.items())
    return begins, [held.get(i) for i in range(max(held, default=-1) + 1)]


def rank_map(ranks: dict[bytes, int]) -> RankMap:
    no_rank = max(ranks.values(), default=0) + 1
    rows: dict[int, dict[int, int]] = {}
    whole = {}
    for piece, rank in ranks.items():
        parts = last_parts(piece, ranks)
        if len(parts) == 2 and all(x in ranks for x in parts):
            rows.setdefault(ranks[parts[0]], {})[ranks[parts[1]]] = rank
        elif len(piece) > 1:
            whole[piece.decode("latin-1")] = rank
    of_bytes = [ranks.get(bytes([i])) for i in range(256)]
    begins, pairs = _laid_out(rows, no_rank)

    def literal(value: object, kind: str) -> Column:
        return F.from_json(F.lit(json.dumps(value, ensure_ascii=False)), kind)

    return RankMap(
        no_rank,
        literal(of_bytes, "array<bigint>"),
        literal(begins, "array<int>"),
        literal(pairs, "array<bigint>"),
        literal(whole, "map<string,int>") if whole else None,
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """As ``common.let``; ``element_at`` derives the type of the body once, ``get`` in every evaluation."""
    return F.element_at(F.transform(F.array(value), body), F.lit(1))


def fold_merges(word: Column, ranks: RankMap) -> Column:
    """The ids of a word: ``array<int>``. Each literal is named once, which keeps plans small.

    The largest is named first, as each expression around it prints it again.
    """
    chars = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")
    folded = _let(ranks.pairs, lambda p: _let(ranks.rows, lambda r: _folded(chars, F.octet_length(word), ranks, r, p)))
    merged = folded.cast("array<int>")
    if ranks.whole is None:
        return merged
    whole = F.try_element_at(ranks.whole, chars)
    return F.when(whole.isNotNull(), F.array(whole)).otherwise(merged)


def _folded(chars: Column, size: Column, ranks: RankMap, rows: Column, pairs: Column) -> Column:
    """Each part is kept below the rank of its pair with the next one, in one number.

    The least number is then the next pair to join, the leftmost of its rank, as equal ranks mean
    equal parts. A merge changes two pairs, so it looks up two ranks, however long the word is.
    """
    # Stands above all ranks, for a pair that isn't joined.
    no_rank = F.lit(ranks.no_rank << _RANK_BIT)

    def part(ranked: Column) -> Column:
        return ranked.bitwiseAND(F.lit((1 << _RANK_BIT) - 1))

    def with_rank(left: Column, right: Column) -> Column:
        found = F.get(pairs, F.get(rows, left.cast("int")) + right.cast("int"))
        # The last part has no next one: its pair is null.
        return _let(found, lambda pair: F.when(part(pair) == left, pair).otherwise(no_rank.bitwiseOR(left)))

    def step(parts: Column, _: Column) -> Column:
        def joined_at(i: Column) -> Column:
            # The pair begins at position i, from 1, and a part stands before it.
            least = F.get(parts, i - 1)
            new = F.shiftright(least, _RANK_BIT)
            changed = F.array(with_rank(part(F.get(parts, i - 2)), new), with_rank(new, part(F.get(parts, i + 1))))
            # Arrays of an array are put together faster than by concat, which makes a lazy list.
            made = F.flatten(F.array(F.slice(parts, F.lit(1), i - 2), changed, F.slice(parts, i + 2, size)))
            return F.when(least < no_rank, made).otherwise(parts)

        return _let(F.array_position(parts, F.array_min(parts)).cast("int"), joined_at)

    def parts(of_bytes: Column) -> Column:
        return F.transform(F.split(chars, ""), lambda char: F.get(of_bytes, F.ascii(char)))

    def ranked(parts: Column) -> Column:
        return F.transform(parts, lambda left, i: with_rank(left, F.get(parts, i + 1)))

    # A part that joins nothing stands first, so that each pair has one before it.
    none = F.array(no_rank.bitwiseOR(F.lit(ranks.no_rank)))
    first = F.concat(none, _let(_let(ranks.of_bytes, parts), ranked))
    merged = F.aggregate(F.array_repeat(F.lit(0), size - 1), first, step)
    return F.transform(F.slice(merged, F.lit(2), size), part)


def heap_merges(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same ids in time n log n, for long words."""
    if word in ranks:
        return [ranks[word]]
    end = len(word)
    piece = [word[i : i + 1] for i in range(end)]
    before, after = list(range(-1, end - 1)), list(range(1, end + 1))
    heap: list[tuple[int, int, bytes, bytes]] = []

    def offer(i: int) -> None:
        j = after[i] if i >= 0 else end
        if j < end and (rank := ranks.get(piece[i] + piece[j])) is not None:
            heapq.heappush(heap, (rank, i, piece[i], piece[j]))

    for i in range(end - 1):
        offer(i)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        # A pair is stale once one of its pieces has changed or is gone.
        if piece[i] != left or j >= end or piece[j] != right:
            continue
        piece[i], piece[j] = left + right, b""
        after[i] = after[j]
        if after[i] < end:
            before[after[i]] = i
        offer(i)
        offer(before[i])
    return [ranks[p] for p in piece if p]


def count_words(texts: DataFrame, pattern: str | None = None, stretch: int = STRETCH_WORDS) -> DataFrame:
    """``word, n`` over all rows of one text column, counted within tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, counts = _cutter(pattern), Counter()

        def counted() -> Iterator[pa.RecordBatch]:
            table = pa.table({"word": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())})
            yield from table.to_batches(50_000)

        for batch in batches:
            for text in batch.column(0):
                counts.update(cut(text.as_py() or ""))
            if len(counts) > stretch:
                yield from counted()
                counts.clear()
        yield from counted()

    return texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# Makes columns, by name, of a batch's ids and of its key columns.
Finish = Callable[[pa.ListArray, list[pa.Array]], dict[str, pa.Array]]


class Head:
    """Frequent words and their ids, as two arrays that are quick to send."""

    def __init__(self, found: pa.Table):
        lists = found.column("ids").combine_chunks().cast(pa.list_(pa.int32()))
        self.words = found.column("word").combine_chunks()
        self.flat = lists.flatten().to_numpy()
        self.sizes = np.asarray(lists.value_lengths())


def frequent(texts: DataFrame, ranks: RankMap, head_words: int, pattern: str | None = None) -> Head:
    """At most ``head_words`` words come to the driver, each of at most ``FOLD_BYTES`` bytes."""
    counted = count_words(texts, pattern).where(F.octet_length("word") <= FOLD_BYTES)
    # Words of a count that head_words can't hold whole are left out, which needs no sorting.
    counted = settled(counted.where("n > 1"))
    per_count = counted.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).limit(head_words).collect()
    least, held = None, 0
    for r in per_count:
        held += r.words
        if held > head_words:
            break
        least = r.n
    # Spark prints a plan anew at each adaptive step, here with the literal map in it, and keeps the
    # text on the driver. So words are dealt out before, and the plan with the map has no such step.
    chosen = settled(counted.where(F.col("n") >= F.lit(least)).select("word").repartition("word"))
    return Head(chosen.select("word", fold_merges(F.col("word"), ranks).alias("ids")).toArrow())


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of few rows, as a row of a text grows much when it is taken apart."""
    for batch in batches:
        for low in range(0, batch.num_rows, _SLICE_ROWS):
            yield batch.slice(low, _SLICE_ROWS)


def _stretches(batches: Iterator[pa.RecordBatch], first: int) -> Iterator[pa.RecordBatch]:
    """The same rows, cut where a new stretch begins, which gives its first word the code ``first``."""
    for batch in batches:
        starts = np.flatnonzero(batch.column("code").fill_null(-1).to_numpy(zero_copy_only=False) == first)
        cuts = sorted({0, *starts.tolist(), batch.num_rows})
        for low, high in zip(cuts, cuts[1:]):
            yield batch.slice(low, high - low)


class _Codes(dict):
    """Word to code: those of the head first, and any other word gets the next code when it is met."""

    def __init__(self, head: list[str]):
        super().__init__(zip(head, range(len(head))))
        self.own: list[str] = []

    def __missing__(self, word: str) -> int:
        code = self[word] = len(self)
        self.own.append(word)
        return code

    def forget(self) -> None:
        for word in self.own:
            del self[word]
        self.own = []


def _take_out(keys: list[str], head: Broadcast, stretch: int, pattern: str | None):
    """Rows of new words, then rows of texts as codes of words.

    The head has the first codes; the code after it begins a new stretch.
    """

    def take_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, codes = _cutter(pattern), _Codes(head.value.words.to_pylist())
        code_of = codes.__getitem__
        for batch in _slices(batches):
            if len(codes.own) > stretch:
                codes.forget()
            known, coded = len(codes), []
            for text in batch.column("text"):
                found = cut(text.as_py() or "")
                coded.append(np.fromiter(map(code_of, found), np.int32, len(found)).tobytes())
            fresh = codes.own[len(codes.own) - (len(codes) - known) :]
            for low in range(0, len(fresh), 20_000):
                some = fresh[low : low + 20_000]
                n = len(some)
                numbers = pa.array(range(known + low, known + low + n), pa.int32())
                absent = [pa.nulls(n, batch.column(k).type) for k in keys]
                yield pa.record_batch(
                    [*absent, pa.array(some, pa.string()), numbers, pa.nulls(n, pa.binary())],
                    [*keys, "word", "code", "text_codes"],
                )
            n = batch.num_rows
            yield pa.record_batch(
                [*[batch.column(k) for k in keys], pa.nulls(n, pa.string()), pa.nulls(n, pa.int32()), pa.array(coded, pa.binary())],
                [*keys, "word", "code", "text_codes"],
            )

    return take_out


def _put_in(keys: list[str], ranks: dict[bytes, int], head: Broadcast, finish: Finish | None):
    """Texts with the ids of their words, or what ``finish`` makes of them."""

    def put_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = len(head.value.sizes)
        flat, sizes, starts = [head.value.flat], [head.value.sizes], None
        for batch in _slices(_stretches(batches, first)):
            is_word = batch.column("code").is_valid()
            new = batch.filter(is_word)
            if new.num_rows:
                if new.column("code")[0].as_py() == first:
                    flat, sizes = [head.value.flat], [head.value.sizes]
                found = new.column("ids")
                if found.null_count:
                    long = [
                        heap_merges(w.encode(), ranks) if i is None else i
                        for w, i in zip(new.column("word").to_pylist(), found.to_pylist())
                    ]
                    found = pa.array(long, pa.list_(pa.int32()))
                flat.append(found.flatten().to_numpy())
                sizes.append(np.asarray(found.value_lengths()))
                starts = None
            texts = batch.filter(pc.invert(is_word))
            if not texts.num_rows:
                continue
            if starts is None:
                ids, lengths = np.concatenate(flat), np.concatenate(sizes)
                flat, sizes = [ids], [lengths]
                starts = np.cumsum(lengths, dtype=np.int64) - lengths
            out, ends = [np.empty(0, np.int32)], [0]
            for raw in texts.column("text_codes"):
                codes = np.frombuffer(raw.as_py(), np.int32)
                n = lengths[codes]
                before = np.cumsum(n, dtype=np.int64) - n
                out.append(ids[np.repeat(starts[codes] - before, n) + np.arange(n.sum())])
                ends.append(ends[-1] + len(out[-1]))
            packed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(out), pa.int32()))
            own = [texts.column(k) for k in keys]
            made = {"ids": packed} if finish is None else finish(packed, own)
            yield pa.record_batch([*own, *made.values()], [*keys, *made])

    return put_in


def encode(
    docs: DataFrame,
    key_cols: Sequence[str] = ("doc_id",),
    text_col: str = "text",
    path: str | None = None,
    pattern: str | None = None,
    stretch: int = STRETCH_WORDS,
    head_words: int = HEAD_WORDS,
    finish: Finish | None = None,
    finish_schema: str = "ids array<int>",
) -> DataFrame:
    """``key_cols`` and ``ids`` for every row.

    With ``finish`` come the columns it makes instead, described by ``finish_schema``; it
    runs where the ids are, so that they need not travel to be measured or decoded.
    """
    ranks = read_ranks(path or vocabulary_path())
    keys = [f"key_{i}" for i in range(len(key_cols))]
    named = [F.col(f"`{c}`").alias(k) for c, k in zip(key_cols, keys)]
    texts = docs.select(*named, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    literal = rank_map(ranks)
    head = frequent(texts.select("text"), literal, head_words, pattern)
    sent = docs.sparkSession.sparkContext.broadcast(head)
    key_fields = [T.StructField(k, texts.schema[k].dataType) for k in keys]
    between = T.StructType(
        [
            *key_fields,
            T.StructField("word", T.StringType()),
            T.StructField("code", T.IntegerType()),
            T.StructField("text_codes", T.BinaryType()),
        ]
    )
    made = T.StructType.fromDDL(finish_schema)
    after = T.StructType([*key_fields, *made.fields])
    taken = texts.mapInArrow(_take_out(keys, sent, stretch, pattern), between)
    short = F.col("word").isNotNull() & (F.octet_length("word") <= FOLD_BYTES)
    folded = taken.withColumn("ids", F.when(short, fold_merges(F.col("word"), literal)))
    done = folded.mapInArrow(_put_in(keys, ranks, sent, finish), after)
    return done.select(*[F.col(k).alias(c) for c, k in zip(key_cols, keys)], *made.names)


def _joined(lists: pa.ListArray, parts: pa.Array, between: int = 0) -> Iterator[memoryview]:
    """For each list of ids their parts, joined, less the last ``between`` bytes of the last one."""
    taken = parts.take(lists.flatten())
    offsets = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset :]
    joined = memoryview(taken.buffers()[2] or b"")
    ends = np.cumsum([0, *lists.value_lengths().to_pylist()])
    for low, high in zip(offsets[ends[:-1]].tolist(), offsets[ends[1:]].tolist()):
        yield joined[low : max(low, high - between)]


def pieces_by_rank(ranks: dict[bytes, int]) -> pa.Array:
    pieces = [b""] * (max(ranks.values(), default=0) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    return pa.array(pieces, pa.large_binary())


def decoded(ids: pa.ListArray, pieces: pa.Array) -> Iterator[memoryview]:
    """The bytes of each list of ids: its binary pieces, joined."""
    return _joined(ids, pieces)


def decode(ids: Column, path: str | None = None) -> Column:
    """The bytes of an array of ids."""
    ranks = read_ranks(path or vocabulary_path())

    @F.arrow_udf("binary")
    def joined(lists: pa.Array) -> pa.Array:
        return pa.array(map(bytes, decoded(lists, pieces_by_rank(ranks))), pa.binary())

    return joined(ids)


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(path: str | None = None) -> Finish:
    """Token counts, and SHA-256 of the decimal ids with spaces between and of the decoded bytes."""
    ranks = read_ranks(path or vocabulary_path())
    made: dict[str, pa.Array] = {}

    def sha(parts: Iterator[memoryview]) -> pa.Array:
        return pa.array([hashlib.sha256(x).hexdigest() for x in parts], pa.string())

    def finish(ids: pa.ListArray, _: list[pa.Array]) -> dict[str, pa.Array]:
        if not made:
            made["pieces"] = pieces_by_rank(ranks)
            made["decimal"] = pa.array([b"%d " % i for i in range(len(made["pieces"]))], pa.large_binary())
        return {
            "n_tokens": ids.value_lengths().cast(pa.int64()),
            "ids_sha256": sha(_joined(ids, made["decimal"], between=1)),
            "decoded_sha256": sha(decoded(ids, made["pieces"])),
        }

    return finish


ROUND_TRIP = "n_tokens int, token_ids array<int>, same_text boolean"


def round_trip(path: str | None = None) -> Finish:
    """The ids, and whether they decode to the text whose SHA-256 is the last key."""
    ranks = read_ranks(path or vocabulary_path())
    made: list[pa.Array] = []

    def finish(ids: pa.ListArray, keys: list[pa.Array]) -> dict[str, pa.Array]:
        if not made:
            made.append(pieces_by_rank(ranks))
        pairs = zip(decoded(ids, made[0]), keys[-1].to_pylist())
        same = [hashlib.sha256(x).hexdigest() == sha for x, sha in pairs]
        return {"n_tokens": ids.value_lengths(), "token_ids": ids, "same_text": pa.array(same, pa.bool_())}

    return finish


def round_trips(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, token_ids, same_text`` for every row.

    Half as many words as elsewhere are sent to all tasks, as a stage of a pipeline meets
    executors whose memory earlier stages have used.
    """
    texts = docs.select(id_col, text_col, F.sha2(F.coalesce(text_col, F.lit("")), 256).alias("_sha"))
    return encode(texts, (id_col, "_sha"), text_col, head_words=HEAD_WORDS // 2, finish=round_trip(), finish_schema=ROUND_TRIP).drop("_sha")

"""Line dedup by pairwise alignment with patience diff.

A run of adjacent lines is cut where it reaches ``block_words`` words, once from each line
forward and once backward. Every line of a block that two documents share is in such a run
that both have. Each run, however many documents hold it, points from every later document to
its place in the first that holds it, so there are at most two places for each line. Rare
single lines would name no pair where each line of a passage was seen alone before; runs do.

The places of a pair tell the stretches of both documents that are worth aligning, and as
equal runs have equal lines, the later document's line hashes are enough for both sides: what
is gathered grows with the later document alone, whatever its number of partners. Patience
diff aligns the stretches in their order: equal heads and tails match, lines unique in both
anchor the rest in their longest common order, anchors grow outwards while lines are equal,
and the gaps between are aligned the same way; in a gap without such lines the first place of
a line anchors to the first, the second to the second. Matched lines that are adjacent in both
documents form a block; blocks of at least ``block_words`` words are deleted from the later
document. One alignment keeps one order, so stretches of which it left lines, being moved or
repeated, are aligned once more, each with its own stretch of the earlier document. Runs are
equal where 64-bit hashes are. As the first holder of a run never loses it to a pair, every
line lives on somewhere.

In scripts that put no spaces between words, so many characters count as a word as
``SPACELESS`` says. Lines end at ``\\n`` and are compared without the spaces around them.
"Later" is the larger id; rows that share an id are not compared, rows with a null id or text
stay as they are, and so do empty texts. Exact repeats of a row get the same answer. A
document that loses its last word goes. Columns other than the id, the text and ``n_chars``
pass through untouched.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.llm.common import SPACES, let, packed, settled, text_key, words

BLOCK_WORDS = 20
# Letters of scripts without spaces, and how many of them count as a word.
SPACELESS = (
    (r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}]", 2),
    (r"[\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}]", 4),
)
# One range that holds them all, as asking each letter for its script takes long.
_BEYOND = r"[\x{E00}-\x{10FFFF}]"
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)


def longest_rise(values: list[int]) -> list[int]:
    """Positions of a longest increasing subsequence."""
    tails, ends, before = [], [], []
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        tails[k : k + 1], ends[k : k + 1] = [v], [i]
        before.append(ends[k - 1] if k else -1)
    chain, i = [], ends[-1] if ends else -1
    while i >= 0:
        chain.append(i)
        i = before[i]
    return chain[::-1]


def numbered(values: list[int]) -> list[tuple[int, int]]:
    """Each value with how often it came before."""
    seen: Counter = Counter()
    return [(x, seen.update((x,)) or seen[x]) for x in values]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matched positions of two sequences, in no particular order."""
    matched, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        # The gap between two anchors: the blocks on both its sides grow into it.
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            matched.append((a1, b1))
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            matched.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at_b = {x: i for i, x in enumerate(b[b0:b1], b0) if in_b[x] == 1 and in_a.get(x) == 1}
        anchors = [(i, at_b[x]) for i, x in enumerate(a[a0:a1], a0) if x in at_b]
        if not anchors:
            nth_b = {x: i for i, x in enumerate(numbered(b[b0:b1]), b0)}
            anchors = [(i, nth_b[x]) for i, x in enumerate(numbered(a[a0:a1]), a0) if x in nth_b]
        anchors = [anchors[k] for k in longest_rise([j for _, j in anchors])]
        if anchors:
            matched += anchors
            low = [(a0, b0), *[(i + 1, j + 1) for i, j in anchors]]
            high = [*anchors, (a1, b1)]
            todo += [(i0, i1, j0, j1) for (i0, j0), (i1, j1) in zip(low, high) if i0 < i1 and j0 < j1]
    return matched


def stretches(places: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """``start, end, offset`` of the longest stretches of places ``start, end, start in the other``.

    A stretch holds overlapping or adjacent places with the same offset between the documents.
    """
    found: list[tuple[int, int, int]] = []
    for offset, s, e in sorted((t - s, s, e) for s, e, t in places):
        if found and found[-1][2] == offset and s <= found[-1][1]:
            found[-1] = (found[-1][0], max(e, found[-1][1]), offset)
        else:
            found.append((s, e, offset))
    return found


def aligned_blocks(
    a: list[int], upto: list[int], found: list[tuple[int, int, int]], block_words: int
) -> list[tuple[int, int]]:
    """``start, end`` in ``a`` of the aligned blocks of enough words within some stretches.

    ``upto`` has the number of words before each line of ``a``.
    """
    in_a = sorted({i for s, e, _ in found for i in range(s, e)})
    in_b = sorted({i + offset: a[i] for s, e, offset in found for i in range(s, e)}.items())
    matched = sorted(patience([a[i] for i in in_a], [x for _, x in in_b]))
    blocks, start, last = [], 0, (-9, -9)
    for i, j in [*((in_a[i], in_b[j][0]) for i, j in matched), (-9, -9)]:
        if (i - 1, j - 1) != last:
            if last[0] >= 0 and upto[last[0] + 1] - upto[start] >= block_words:
                blocks.append((start, last[0] + 1))
            start = i
        last = (i, j)
    return blocks


def common_blocks(a: list[int], upto: list[int], places: list[tuple[int, int, int]], block_words: int) -> set[int]:
    """Positions in ``a`` of the lines in blocks that one earlier document has."""
    found = stretches(places)
    deleted = {i for s, e in aligned_blocks(a, upto, found, block_words) for i in range(s, e)}
    for one in found:
        if not all(i in deleted for i in range(*one[:2])):
            deleted.update(i for s, e in aligned_blocks(a, upto, [one], block_words) for i in range(s, e))
    return deleted


def runs(h: np.ndarray, w: np.ndarray, block_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, end, hash`` of the runs of lines cut where they reach so many words."""
    n, upto = len(h), np.concatenate([[0], np.cumsum(w, dtype=np.int64)])
    # Forward from each line: the least end; backward: the largest start.
    ends = np.searchsorted(upto, upto[:-1] + block_words, "left")
    starts = np.searchsorted(upto, upto[1:] - block_words, "right") - 1
    first = np.concatenate([np.arange(n)[ends <= n], starts[starts >= 0]])
    end = np.concatenate([ends[ends <= n], np.arange(1, n + 1)[starts >= 0]])
    # A polynomial in the line hashes, modulo 2 ** 64: differences of sums, shifted to begin at one power.
    powers, back = (np.cumprod(np.full(n + 1, x, np.uint64)) for x in (_BASE, _UNBASE))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h.astype(np.int64).view(np.uint64) * powers[:n], dtype=np.uint64)])
    digest = (sums[end] - sums[first]) * back[first] + (end - first).astype(np.uint64)
    return first, end, digest.view(np.int64)


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, key, h, w``: of every text the hash and the word count of each line."""
    rows = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    trimmed = F.transform(_lines(F.col(text_col)), lambda line: F.btrim(line, F.lit(" \t\x0b\x0c\r")))
    return rows.select(
        F.col(id_col).alias("id"),
        text_key(F.col(text_col)).alias("key"),
        F.transform(trimmed, lambda line: F.xxhash64(line)).alias("h"),
        line_words(F.col(text_col), trimmed).alias("w"),
    )


def line_words(text: Column, trimmed: Column) -> Column:
    """The number of words of each line; in scripts without spaces by the number of letters."""

    def spaced(line: Column) -> Column:
        return F.when(line == "", 0).otherwise(F.size(F.split(line, SPACES)))

    def counted(line: Column) -> Column:
        rest, extra = line, F.lit(0)
        for letters, a_word in SPACELESS:
            extra = extra + F.ceil((F.length(rest) - F.length(F.regexp_replace(rest, letters, ""))) / a_word)
            rest = F.regexp_replace(rest, letters, " ")
        return (spaced(F.btrim(rest, F.lit(" \t\x0b\x0c\r"))) + extra).cast("int")

    any_letter = "|".join(letters for letters, _ in SPACELESS)
    some = (F.octet_length(text) > F.length(text)) & text.rlike(_BEYOND) & text.rlike(any_letter)
    return F.when(some, F.transform(trimmed, counted)).otherwise(F.transform(trimmed, spaced))


def aligned_deletions(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``id, key, gone, partners``: 0-based lines to delete, ids of the earlier documents."""

    @F.arrow_udf("array<struct<run: bigint, s: int, e: int>>")
    def run_places(h: pa.Array, w: pa.Array) -> pa.Array:
        found = [runs(np.array(x.values), np.array(y.values), block_words) for x, y in zip(h, w)]
        ends = np.cumsum([0, *(len(f[0]) for f in found)], dtype=np.int32)
        s, e, run = (np.concatenate([f[k] for f in found] or [np.empty(0, np.int64)]) for k in range(3))
        fields = [pa.array(run, pa.int64()), pa.array(s.astype(np.int32)), pa.array(e.astype(np.int32))]
        return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(fields, ["run", "s", "e"]))

    lines = settled(line_table(docs, id_col, text_col))
    held = settled(lines.select("id", "key", F.explode(run_places("h", "w")).alias("_p")).select("id", "key", "_p.*"))
    firsts = (
        held.groupBy("run")
        .agg(F.min(F.struct("id", "key", "s")).alias("first"), F.min("id").alias("low"), F.max("id").alias("high"))
        .where("low < high")
        .select("run", "first")
    )
    # Kept apart from the counting shuffle, so that the join can split a run that very many hold.
    firsts = settled(firsts)
    # At most two places for each line of a document, so they gather to about its own size.
    places = (
        held.join(firsts, "run")
        .where("id > first.id")
        .groupBy("id", "key")
        .agg(F.collect_set(F.struct(F.struct("first.id", "first.key").alias("of"), "s", "e", F.col("first.s").alias("t"))).alias("places"))
        .select("id", "key", F.array_sort("places").alias("places"))
    )

    @F.arrow_udf("struct<gone: array<int>, by: array<int>>")
    def aligned(h: pa.Array, w: pa.Array, other: pa.Array, s: pa.Array, e: pa.Array, t: pa.Array) -> pa.Array:
        def one(a: list, a_words: list, *columns: list) -> dict:
            upto, at, gone, by = [0, *accumulate(a_words)], list(zip(*columns)), set(), []
            starts = [k for k, place in enumerate(at) if place[0]]
            for k, end in zip(starts, [*starts[1:], len(at)]):
                found = common_blocks(a, upto, [place[1:] for place in at[k:end]], block_words)
                gone |= found
                by += [k] * bool(found)
            return {"gone": sorted(gone), "by": by}

        rows = [one(*(x.values.to_pylist() for x in row)) for row in zip(h, w, other, s, e, t)]
        return pa.array(rows, pa.struct([("gone", pa.list_(pa.int32())), ("by", pa.list_(pa.int32()))]))

    # Places are in the order of their holders; the first place of each is marked.
    other = F.transform("places", lambda p, i: F.coalesce(p["of"] != F.get("places", i - 1)["of"], F.lit(True)))
    at = [F.col(f"places.{c}") for c in "set"]
    found = lines.join(places, ["id", "key"]).withColumn("_a", aligned("h", "w", other, *at))
    return (
        found.where("size(_a.gone) > 0")
        .select(
            "id",
            "key",
            F.col("_a.gone").alias("gone"),
            F.array_sort(F.array_distinct(F.transform("_a.by", lambda i: F.get("places", i)["of"]["id"]))).alias("partners"),
        )
        .dropDuplicates(["id", "key"])
    )


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how
) -> DataFrame:
    """``row, text, n_lines, gone, partners, dropped`` for every row of ``docs``.

    ``row`` holds the input columns, ``text`` what is left of the text.
    """
    deletions = aligned_deletions(docs, id_col, text_col, **how).select(
        F.col("id").alias("_id"), F.col("key").alias("_key"), "gone", "partners"
    )
    keyed = docs.select(
        packed(docs).alias("row"),
        F.col(id_col).alias("_own_id"),
        text_key(F.col(text_col)).alias("_own_key"),
        F.col(text_col).alias("_text"),
    )
    joined = keyed.join(
        deletions, (F.col("_own_id") == F.col("_id")) & (F.col("_own_key") == F.col("_key")), "left"
    )

    def remaining(lines: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.size(lines) - 1)
        return F.transform(F.array_except(numbers, F.col("gone")), lambda i: F.get(lines, i))

    left = let(_lines(F.col("_text")), remaining)
    text = F.when(F.col("gone").isNull(), F.col("_text")).otherwise(F.array_join(left, "\n"))
    return (
        joined.select("row", "_text", "gone", "partners", text.alias("text"))
        .withColumn("n_lines", F.when(F.col("_text").isNull(), 0).otherwise(F.size(_lines(F.col("_text")))))
        .withColumn("dropped", F.col("gone").isNotNull() & (F.size(words(F.col("text"))) == 0))
        .drop("_text")
    )


def without_shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents with shared blocks deleted; those left without a word are gone."""
    done = dedup_lines(docs, id_col, text_col, **how).where("NOT dropped")

    def value(c: str) -> Column:
        if c == text_col:
            return F.col("text").alias(c)
        own = F.col("row").getField(c)
        if c == "n_chars":
            kind = docs.schema[c].dataType
            return F.when(F.col("gone").isNull(), own).otherwise(F.length("text").cast(kind)).alias(c)
        return own.alias(c)

    return done.select(*[value(c) for c in docs.columns])

"""Packing against the tokenizer itself and against plain best-fit decreasing."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from noticelake.llm import packing
from noticelake.llm.queries import QUERIES
from tests.compare import duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(packing.vocabulary_path())
    found.encode_special_tokens = True
    return found


def best_fit_decreasing(lengths, size):
    rooms: list[int] = []
    for x in sorted(lengths, reverse=True):
        fitting = [(room, i) for i, room in enumerate(rooms) if room >= x]
        if fitting:
            rooms[min(fitting)[1]] -= x
        else:
            rooms.append(size - x)
    return len(rooms)


def checked(rows, texts, tokenizer, size=packing.SIZE):
    """Every piece is there once and holds its ids; sequences have no gap. Returns their number."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert by_doc.keys() == texts.keys()
    for i, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        got = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in got] == list(range(len(got)))
        assert [r.start for r in got] == [sum(x.length for x in got[:k]) for k in range(len(got))]
        assert sum(r.length for r in got) == len(ids) and all(r.length == size for r in got[1:])
        for r in got:
            raw = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(raw)
    for placed in by_sequence.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= size
    return len(by_sequence)


def test_query(spark, tokenizer):
    texts = dict(duck(SF_DIR).execute("SELECT doc_id, text FROM documents").fetchall())
    rows = QUERIES["op13_best_fit"](spark, SF_DIR).collect()
    assert checked(rows, texts, tokenizer) <= best_fit_decreasing([r.length for r in rows], packing.SIZE)


EDGES = [
    None,
    "",
    " \t\r\n ",
    "one",
    "<|endoftext|> don't DON'T \x1c\x1d\x85 \xa0 x",
    "a b 　c naïve 東京 🙂🙂 ١٢ it’s",
    "x" * 50_000,
    "word " * 1023,
    "word " * 1024,
    "\n\n  tab\t\tend  ",
]


def test_edges(spark, tokenizer):
    rows = [(i, t) for i, t in enumerate(EDGES)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("id", "piece", "start", "length", "part", "nth", "rank", "offset", "ids"):
        docs = docs.withColumn(name, F.lit("clash"))
    packed = packing.pack(docs)
    checked(packed.withColumnRenamed("id", "doc_id").collect(), dict(rows), tokenizer)
    whole = packing.sequences(packed)
    read = {}
    for s in whole.collect():
        ids = np.frombuffer(s.ids, "<u4").tolist()
        assert len(ids) == s.n_tokens <= packing.SIZE and s.starts[0] == 0
        read[s.sequence_id] = ids
    for p in packed.collect():
        assert read[p.sequence_id][p.offset : p.offset + p.length] == np.frombuffer(p.ids, "<u4").tolist()
    assert packing.pack(docs.where("false")).count() == 0
    twice = spark.createDataFrame([(None, "same words"), (None, "same words"), (7, "same words"), (7, None)], "doc_id long, text string")
    assert packing.pack(twice).count() == 4


def test_hot_length_over_many_partitions(spark, tokenizer):
    texts = {i: "same words" if i % 3 else "other word here " * (i % 40) for i in range(3000)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(16)
    rows = packing.pack(docs, size=64, keep_ids=False).withColumnRenamed("id", "doc_id").collect()
    n = checked(rows, texts, tokenizer, 64)
    assert n <= best_fit_decreasing([r.length for r in rows], 64)


def test_plans_use_every_piece_and_fill_exactly():
    r = random.Random(3)
    for _ in range(40):
        size = r.choice([10, 50, 128])
        counts = Counter(r.choices(range(1, size + 1), k=r.randint(1, 400)))
        found = packing.plan(counts, size)
        used = Counter()
        for p in found:
            assert 0 < p.copies and sum(x * k for x, k in p.times.items()) <= size
            used.update({x: k * p.copies for x, k in p.times.items()})
        assert used == counts
        n = sum(p.copies for p in found)
        lengths = [x for x, k in counts.items() for _ in range(k)]
        assert packing.fewest(counts, size) <= n <= best_fit_decreasing(lengths, size)


@pytest.mark.parametrize(
    ("counts", "sequences"),
    [
        ({60: 5, 40: 5}, 5),  # one complement
        ({50: 4, 30: 4, 20: 4}, 4),  # a pair
        ({50: 2, 30: 2, 15: 2, 5: 2}, 2),  # a triple
        ({50: 3}, 2),  # two of one length, and what is left
        ({100: 7}, 7),
        ({25: 10**12}, 25 * 10**10),  # any number of equal pieces is one pattern
        ({}, 0),
    ],
)
def test_complements(counts, sequences):
    assert sum(p.copies for p in packing.plan(counts, 100)) == sequences


def test_exact_combinations_respect_counts():
    free = np.zeros(101, np.int64)
    free[[20, 40]] = 1, 1
    planner = packing.Planner({}, 100)
    assert planner._exact(40, free) == (40,)
    assert planner._exact(60, free) == (40, 20)
    assert planner._exact(80, free) == () and planner._exact(100, free) == ()
    free[20] = 3
    assert planner._exact(80, free) == (40, 20, 20)

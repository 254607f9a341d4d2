"""Phrases against plain counting, and what the summaries and filters promise."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from noticelake.llm import collocations as co


def brute(rows, threshold, most=5):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            counts.update((lang, tuple(words[i : i + k])) for k in range(1, most + 1) for i in range(len(words) - k + 1))
    found = {}
    for (lang, w), a in counts.items():
        if len(w) > 1 and a >= threshold:
            cuts = [(1000 * a * totals[lang] // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            found[lang, w] = (a, counts[lang, w[:k]], counts[lang, w[k:]], totals[lang], score)
    held = set()
    for lang, w in found:
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if j - i < len(w) and (lang, w[i:j]) in found and found[lang, w][0] >= found[lang, w[i:j]][0]:
                    held.add((lang, w[i:j]))
    ranked = []
    for name in {lang for lang, _ in found}:
        rows = [(-v[4], -v[0], " ".join(w).encode(), v) for (lang, w), v in found.items() if lang == name and (lang, w) not in held]
        ranked += [(name, i, p.decode(), *v) for i, (_, _, p, v) in enumerate(sorted(rows), 1)]
    return Counter(ranked)


def result(df, threshold, **settings):
    return Counter(tuple(r) for r in co.collocations(df, threshold=threshold, **settings).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def rows_of(seed, n=200):
    r = random.Random(seed)
    vocabulary = ["the", "The", "of", "new", "york", "été", "東京", "🙂", "a\x00b", "x", "y", "z"]
    made = []
    for _ in range(n):
        words = r.choices(vocabulary, k=r.randint(0, 40))
        joined = "".join(w + r.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\x0b"]) for w in words)
        made.append((r.choice(["en", "fr", "", None, "und"]), joined + r.choice(["", " in New York City today", "to be or not to be"])))
    return made + [("en", None), (None, None), ("en", ""), ("de", " \t . ,,"), made[0], made[0]]


@pytest.mark.parametrize(("threshold", "most"), [(2, 5), (7, 5), (3, 2), (1, 3)])
def test_equals_plain_counting(spark, threshold, most):
    rows = rows_of(threshold)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    for name in ("size", "phrase", "n", "part", "keys", "rank", "score", "a"):
        df = df.withColumn(name, F.lit("clash"))
    assert result(df, threshold, most=most) == brute(rows, threshold, most)


def test_long_texts_and_hot_phrases(spark):
    rows = [("en", "one two three " * 3000), ("en", "four, five six. " * 2000)] + [("en", "same old words again")] * 500
    df = spark.createDataFrame(rows, "lang string, text string")
    assert result(df, 100) == brute(rows, 100)
    assert co.collocations(df.where("false")).count() == 0
    assert [r["rank"] for r in co.collocations(df, top=2, threshold=100).collect()] == [1, 2]


def test_stretches_end_at_breaks():
    text = b"aa bb\ncc dd\n" * 50 + b"e" * 300 + b"\nf"
    parts = list(co._stretches(text, 100))
    assert b"".join(parts) == text and all(p.endswith(b"\n") for p in parts[:-1])
    assert list(co._stretches(b"", 10)) == [b""] and list(co._stretches(b"x" * 99, 10)) == [b"x" * 99]


@pytest.mark.parametrize("seed", range(5))
def test_summaries_lose_nothing_frequent(seed):
    """In blocks and merged from parts; the capacity holds, and so does the bound of what was cut."""
    rng, threshold = np.random.default_rng(seed), 50
    stream = np.minimum(rng.zipf(1.15, 60_000), 10**6).astype(np.uint32)
    keys, true = np.unique(stream, return_counts=True)
    capacity = len(stream) // threshold + 1
    halves = []
    for half in np.array_split(stream, 2):
        summary = co.Summary(capacity)
        for block in np.array_split(half, 40):
            summary.merge(*np.unique(block, return_counts=True))
            assert len(summary.keys) <= capacity
        halves.append(summary)
    whole = halves[0]
    whole.merge(halves[1].keys, halves[1].counts, halves[1].cut)
    assert len(keys) > capacity and 0 < whole.cut < threshold
    exact = dict(zip(keys.tolist(), true.tolist()))
    for k, n in zip(whole.keys.tolist(), whole.counts.tolist()):
        assert n <= exact[k] <= n + whole.cut
    assert set(keys[true >= threshold].tolist()) <= set(whole.survivors(threshold).tolist())


def test_filter_never_misses(spark):
    rows = rows_of(3, 400)
    texts = spark.createDataFrame([(lang or "und", t) for lang, t in rows], "lang string, text string")
    known = co.survivors(texts, range(1, 3), 3, 64).value
    vocabulary, counts, hashes = co.Vocabulary(), Counter(), {}
    for lang, text in rows:
        codes = vocabulary.codes((text or "").encode().lower().translate(co._TRANSLATED))
        for n, (h, whole) in enumerate(co.ngram_hashes(codes, vocabulary, lang or "und", 2), 1):
            counts.update(h[whole].tolist())
    frequent = np.array([h for h, n in counts.items() if n >= 3], np.uint64)
    assert known.holds(frequent).all()
    rare = np.random.default_rng(1).integers(0, 2**63, 10_000).astype(np.uint64) * np.uint64(2)
    assert known.holds(rare).mean() < 0.01
    assert len(known.bits) == 1 << (co.FILTER_POWERS[0] - 3)


def test_scores_beyond_64_bits(spark):
    big = 4 * 10**15
    rows = [("en", 0, "", big), ("en", 2, "a b", big - 5), ("en", 1, "a", big - 1), ("en", 1, "b", big - 2)]
    df = spark.createDataFrame(rows, "lang string, size int, phrase string, n long")
    assert co.scored(df).first().score == 1000 * (big - 5) * big // ((big - 1) * (big - 2))

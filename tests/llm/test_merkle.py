"""Manifests and proofs against a tree written out level by level."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from noticelake.llm import merkle
from noticelake.llm.queries import QUERIES
from tests.compare import duck
from tests.llm.brute import sha

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def leaf_of(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def grow(nodes, arity):
    """All levels, the lowest first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + arity])) for i in range(0, len(last), arity)])
    return levels


def climb(levels, at, arity):
    """The run and the place in it, on each level below the top."""
    for level in levels[:-1]:
        start = at - at % arity
        yield level[start : start + arity], at - start
        at //= arity


def brute(rows, tamper, arity=merkle.ARITY):
    """(doc_id, leaf, subroot, root, proof, folded) of (doc_id, source, lang, n_chars, text)."""
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[1]].append((row[0] is not None, row[0], leaf_of(*row), row))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by_source[s].sort(key=lambda x: (x[0], x[1] or 0, x[2]))
        trees[s] = grow([x[2] for x in by_source[s]], arity)
    top = grow([trees[s][-1][0] for s in names], arity)
    found = Counter()
    for k, s in enumerate(names):
        for i, (_, key, leaf, row) in enumerate(by_source[s]):
            steps = [*climb(trees[s], i, arity), *climb(top, k, arity)]
            proof = "".join("".join(run[:p] + run[p + 1 :]) for run, p in steps)
            folded = leaf_of(*row[:-1], tamper(row[-1])) if key is not None and zlib.crc32(str(key).encode()) % 5 == 0 else leaf
            for run, p in steps:
                folded = sha("".join([*run[:p], folded, *run[p + 1 :]]))
            found[key, leaf, trees[s][-1][0], top[-1][0], sha(proof), folded] += 1
    return found


def lower(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def test_query(spark):
    rows = duck(SF_DIR).execute("SELECT doc_id, source, lang, n_chars, text FROM documents").fetchall()
    got = QUERIES["op12_merkle"](spark, SF_DIR).collect()
    fields = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root")
    assert Counter(tuple(r[f] for f in fields) for r in got) == brute(rows, lower)
    assert all(r.verified == (r.folded_root == r.root) for r in got)
    changed = {i for i, *_, t in rows if zlib.crc32(str(i).encode()) % 5 == 0 and t != lower(t)}
    assert {r.doc_id for r in got if not r.verified} == changed


def proven(spark, rows, arity, stride):
    docs = spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3]) for r in rows], DOCS)
    columns = [F.col(c) for c in merkle.FIELDS]
    for name in ("leaf", "digest", "path", "members", "tree", "at", "key", "row", "number", "nodes"):
        docs = docs.withColumn(name, F.lit("clash"))
    made = merkle.manifest(docs, merkle.leaf_digest(columns), arity=arity, stride=stride)
    root = [r.root for r in made.root().collect()]
    got = made.proofs().select(
        "row.doc_id", "leaf", "subroot", merkle.path_digest(F.col("path")).alias("p"), merkle.folded(F.col("leaf"), F.col("path")).alias("f")
    )
    return root, Counter(tuple(r) for r in got.collect())


@pytest.mark.parametrize(("arity", "stride"), [(2, 1), (2, 3), (3, 2), (16, 2)])
def test_sizes_nulls_and_repeats(spark, arity, stride):
    sizes = {None: 5, "": 1, "a": 2, "b": 9, "é": 16, "z": 17, "hot": 65}
    rows = [(k, s, "en", k, f"Text {s} {k}") for s, n in sizes.items() for k in range(n)]
    rows += [rows[3], rows[3], (None, "hot", None, None, None), (3, "hot", None, 1, ""), (4, "hot", "en", 2, "x" * 70_000)]
    root, got = proven(spark, rows, arity, stride)
    want = brute(rows, lambda t: t, arity)
    assert got == Counter({(i, leaf, sub, p, f): n for (i, leaf, sub, _, p, f), n in want.items()})
    assert root == [next(iter(want))[3]] and {f for *_, f in got} == set(root)


def test_small_tables(spark):
    one = [(7, "s", "en", 1, "only")]
    root, got = proven(spark, one, 16, 2)
    assert root == [leaf_of(*one[0])] and got == Counter({(7, root[0], root[0], sha(""), root[0]): 1})
    assert proven(spark, [], 16, 2) == ([], Counter())


def test_only_every_second_level_is_stored(spark):
    leaves = spark.range(300).select(F.lit(0).alias("tree"), F.lit(300).cast("long").alias("nodes"), F.col("id").alias("at"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    tree = merkle.build(leaves, arity=4, stride=2)
    assert [level.count() for level in tree.stored] == [300, 19, 2, 1]
    assert tree.tops().first().digest == grow([sha(str(i)) for i in range(300)], 4)[-1][0]

"""Queries with SQL give the same rows on Spark and on DuckDB; the rest match brute force."""

from __future__ import annotations

import base64
from collections import Counter

import pytest

from noticelake.llm.queries import ORACLES, QUERIES
from tests.compare import difference, duck
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_bpe_is_what_tiktoken_gives(spark, texts):
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in QUERIES["op6_bpe"](spark, SF_DIR).collect():
        ids = own.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), brute.sha(" ".join(map(str, ids))))
        assert r.decoded_sha256 == brute.sha(texts[r.doc_id])


def test_simhash_components(spark, texts):
    rows = {r.doc_id: r for r in QUERIES["op10_simhash"](spark, SF_DIR).collect()}
    ids = sorted(texts)
    fps = [brute.simhash(texts[i], 4) for i in ids]
    assert [rows[i].fingerprint for i in ids] == [f"{f:016x}" for f in fps]
    assert [rows[i].component_id for i in ids] == [ids[g] for g in brute.linked_groups(fps, 4)]


def test_secret_base_spans(spark, texts):
    names = ("assign", "access", "hex")
    rows = {r.doc_id: r for r in QUERIES["op4_secrets"](spark, SF_DIR).collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        spans = brute.base_spans(text)
        written = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans)
        counts = Counter(k for _, k, _ in spans)
        r = rows[i]
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == (*(counts[k] for k in range(3)), brute.sha(written))
        assert ",".join(s for s in r.spans.split(",") if not s.startswith("random")) == written


def test_quality_on_held_out_labels(spark, con):
    labels = dict(con.execute("SELECT doc_id, quality FROM '/root/testdata/sf0.1/labels.parquet'").fetchall())
    rows = QUERIES["op5_quality_classifier"](spark, "/root/testdata/sf0.1").where("held_out").collect()
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.doc_id in labels]
    assert len(judged) > 1000
    assert sum(p == q for p, q in judged) / len(judged) > 0.93
    good = [p for p, q in judged if q == 1]
    assert sum(good) / len(good) > 0.98

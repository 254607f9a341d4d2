"""An upsert into the store gives the whole table's answer and leaves most files alone."""

import json
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from noticelake.operators.maintenance import upsert_notices
from noticelake.sources import commits, noticestore
from workload import queries as q
from workload import tables as t

SF_DIR = "/root/testdata/sf0.001"
ROWS_PER_FILE = 60


def rows(df):
    stable = [c for c in df.columns if c not in ("first_seen_at", "last_seen_at")]
    return Counter(tuple(r) for r in df.select(*stable, F.unix_micros("last_seen_at")).collect())


@pytest.fixture(scope="module")
def notices(spark):
    return t.notices(spark, SF_DIR).checkpoint()


@pytest.fixture
def store(spark, notices, tmp_path):
    made = noticestore.NoticeStore(spark, str(tmp_path / "store"), ROWS_PER_FILE)
    made.create(notices)
    return made


def test_filters_never_miss():
    rng = np.random.default_rng(2)
    held, other = rng.integers(-(2**62), 2**62, 5000), rng.integers(-(2**62), 2**62, 20_000)
    bits = noticestore.key_filter(held)
    assert noticestore.may_hold(bits, held).all() and noticestore.may_hold(bits, other).mean() < 0.02
    assert not noticestore.may_hold(noticestore.key_filter(held[:0]), held).any()


def test_created_and_read(store, notices):
    assert rows(store.read()) == rows(notices)
    files = store.files().collect()
    assert len(files) > 15 and sum(r.rows for r in files) == notices.count()
    with pytest.raises(ValueError, match="already"):
        store.create(notices)


def test_whole_batch_gives_the_same_answer(spark, store, notices):
    batch = q.incoming_notices(spark, SF_DIR)
    wanted, refused = upsert_notices(notices, batch)
    done = store.upsert(batch)
    assert rows(store.read()) == rows(wanted)
    assert Counter(map(tuple, done.rejects.collect())) == Counter(map(tuple, refused.collect()))


def test_batch_of_one_source_rewrites_few_files(spark, store, notices):
    before = {r.file for r in store.files().collect()}
    source = notices.groupBy("source_id").count().orderBy(F.desc("count"), "source_id").first().source_id
    batch = q.incoming_notices(spark, SF_DIR).where(F.col("source_id") == source)
    # The url of an existing notice, and one that is new, in every batch.
    known = notices.where(F.col("source_id") == source).select("url").first().url
    batch = batch.withColumn("url", F.when(F.col("row_number") % 2 == 0, F.col("url")).otherwise(F.lit(known)))
    wanted, refused = upsert_notices(notices, batch)
    done = store.upsert(batch)
    assert done.read <= 3 and 1 <= done.replaced <= done.read and done.files == len(before) > 15
    assert rows(store.read()) == rows(wanted)
    assert Counter(map(tuple, done.rejects.collect())) == Counter(map(tuple, refused.collect()))
    after = {r.file for r in store.files().collect()}
    assert len(before & after) == len(before) - done.replaced


def test_new_sources_read_nothing(spark, store, notices):
    batch = q.incoming_notices(spark, SF_DIR).withColumn("source_id", F.col("source_id") + 10**9)
    wanted, _ = upsert_notices(notices, batch)
    done = store.upsert(batch)
    assert (done.read, done.replaced) == (0, 0) and rows(store.read()) == rows(wanted)


def test_nothing_to_do(spark, store, notices):
    before = rows(store.read())
    done = store.upsert(q.incoming_notices(spark, SF_DIR).where("false"))
    assert (done.read, done.written) == (0, 0) and rows(store.read()) == before
    bad = q.incoming_notices(spark, SF_DIR).withColumn("title", F.lit(None).cast("string"))
    assert store.upsert(bad).replaced == 0 and rows(store.read()) == before


def test_empty_store(spark, notices, tmp_path):
    store = noticestore.NoticeStore(spark, str(tmp_path / "none"), ROWS_PER_FILE)
    assert store.read().count() == 0
    batch = q.incoming_notices(spark, SF_DIR)
    store.upsert(batch)
    assert rows(store.read()) == rows(upsert_notices(notices.where("false"), batch)[0])


def test_a_writer_that_fails_changes_nothing(spark, store, notices, monkeypatch):
    batch, before = q.incoming_notices(spark, SF_DIR), rows(store.read())

    def lost(*_):
        raise RuntimeError("lost before the commit")

    with monkeypatch.context() as patched:
        patched.setattr(commits, "commit", lost)
        with pytest.raises(RuntimeError):
            store.upsert(batch)
    assert rows(store.read()) == before
    store.upsert(batch)
    assert rows(store.read()) == rows(upsert_notices(notices, batch)[0])


def test_log(spark, tmp_path):
    root = str(tmp_path / "log")
    assert commits.latest(spark, root) is None
    assert [commits.commit(spark, root, {"n": n}) for n in (5, 6)] == [1, 2]
    assert commits.latest(spark, root) == (2, {"n": 6})
    assert sorted(json.loads(r.entry)["n"] for r in commits.history(spark, root).collect()) == [5, 6]

"""Versions of a landing set: files by size, runs landed again, and one commit for records and runs."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from noticelake.operators.maintenance import fit_table
from noticelake.plans.ingest import ingest_into
from noticelake.sources import commits
from noticelake.sources.landingset import LandingSet

RECORD = "source_id long, collection_run_id long, pages_fetched long, record_count long, row_number long"


def records(spark, sizes, mark="a"):
    rows = [(s, r, 1, n, i + 1) for (s, r), n in sizes.items() for i in range(n)]
    made = spark.createDataFrame(rows, RECORD)
    text = F.format_string('{"id": "%d-%d-%d", "mark": "' + mark + '"}', "source_id", "collection_run_id", "row_number")
    return made.withColumn("record", F.parse_json(text))


def counts(spark, sizes):
    return spark.createDataFrame([(s, r, 1, n) for (s, r), n in sizes.items()], RECORD.rsplit(",", 1)[0])


def held(df):
    marks = df.select("source_id", "collection_run_id", "row_number", F.expr("variant_get(record, '$.mark', 'string')"))
    return sorted(tuple(r) for r in marks.collect())


def wanted(*parts):
    return sorted((s, r, i + 1, mark) for sizes, mark in parts for (s, r), n in sizes.items() for i in range(n))


def test_many_small_runs_share_files(spark, tmp_path):
    store = LandingSet(spark, str(tmp_path), rows_per_file=1000)
    sizes = {(s, 100 * s + r): 2 for s in range(10) for r in range(100)} | {(77, 1): 2500, (78, 1): 0}
    store.land(records(spark, sizes), counts(spark, sizes))
    files = list(tmp_path.glob("data/*/part-*"))
    assert len(files) == 5  # 4,500 records of 1,002 runs, a thousand to a file
    assert store.listed().count() == 1002 and held(store.read()) == wanted((sizes, "a"))
    long_run = store.listed().where("source_id = 77").first()
    assert 3 <= len(long_run.files) <= 4
    one = spark.createDataFrame([(3, 305)], "source_id long, collection_run_id long")
    assert held(store.read(one)) == wanted(({(3, 305): 2}, "a"))


def test_landing_again_replaces(spark, tmp_path):
    store = LandingSet(spark, str(tmp_path), rows_per_file=10)
    first = {(1, 1): 12, (1, 2): 3, (2, 3): 4}
    store.land(records(spark, first), counts(spark, first), F.lit(datetime(2026, 1, 1)))
    before = store.read()
    again = {(1, 1): 5, (2, 3): 0, (2, 4): 1}
    store.land(records(spark, again, "b"), counts(spark, again), F.lit(datetime(2026, 1, 2)))
    assert held(store.read()) == wanted(({(1, 2): 3}, "a"), (again, "b"))
    # A reader that began before still has its version.
    assert held(before) == wanted((first, "a"))
    assert {tuple(r) for r in store.latest().collect()} == {(1, 1), (2, 4)}
    nothing = {(9, 9): 0}
    store.land(records(spark, nothing), counts(spark, nothing))
    assert held(store.read()) == wanted(({(1, 2): 3}, "a"), (again, "b")) and store.listed().count() == 5


def page(n):
    inner = {"page": 1, "page_size": 50, "total_pages": 1, "total_items": n}
    return json.dumps({"items": [{"external_id": str(i)} for i in range(n)], "pagination": inner})


def test_records_and_runs_are_committed_together(spark, tmp_path, monkeypatch):
    rows = [(7, 1, 1, page(3)), (7, 2, 1, "[]"), (8, 3, 1, page(0)), (8, 99, 1, page(2))]
    landed = spark.createDataFrame(rows, "source_id long, collection_run_id long, requested_page long, body string")
    now = datetime(2026, 1, 1)
    runs = fit_table(
        spark.createDataFrame([(i, 7, now, "running") for i in (1, 2, 3, 4)], "id long, source_id long, started_at timestamp, status string"),
        "collection_runs",
    )
    store = LandingSet(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no runs"):
        ingest_into(store, landed)

    def lost(*_):
        raise RuntimeError("lost between the writes")

    with monkeypatch.context() as patched:
        patched.setattr(commits, "commit", lost)
        with pytest.raises(RuntimeError):
            ingest_into(store, landed, runs)
    # Records and runs were written, but no version names them.
    assert list(tmp_path.glob("data/*/part-*")) and list(tmp_path.glob("runs/*/part-*"))
    assert store.runs() is None and store.read().count() == 0

    done = ingest_into(store, landed, runs)
    for _ in range(2):
        states = {r.id: (r.status, r.records_found) for r in store.runs().collect()}
        assert states == {1: ("success", 3), 2: ("failed", 0), 3: ("success", 0), 4: ("running", 0)}
        assert {(r.collection_run_id, r.row_number) for r in store.read().collect()} == {(1, 1), (1, 2), (1, 3)}
        assert {tuple(r) for r in store.latest().collect()} == {(7, 1), (8, 3)}
        again = ingest_into(store, landed)  # changes nothing: no run is open
    assert {(r.run_id, r.code) for r in done.rejects.collect()} == {(99, "not_found")}
    assert {r.code for r in again.rejects.collect()} == {"bad_state", "not_found"}

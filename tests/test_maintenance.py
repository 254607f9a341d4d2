from datetime import datetime, timedelta

import pytest


from noticelake.operators import maintenance as m
from noticelake.operators import rules
from noticelake.operators import runs as r
from noticelake.operators.lookups import latest_runs, list_by_source, lookup_by_id, lookup_by_name
from noticelake.sources.tables import inline
from tests import seed

NOW = datetime(2026, 7, 29, 11, 0)


def names(spark, *values):
    return inline(spark, list(enumerate(values)), "row_number long, name string")


def pairs(df, *columns):
    return sorted(tuple(x) for x in df.select(*columns).collect())


def test_category_life(spark):
    table, created, rejects = m.bulk_create(
        seed.empty(spark, "categories"), names(spark, " A ", "B", "A", "  ", "x" * 101), "categories"
    )
    assert pairs(created, "id", "name") == [(1, "A"), (2, "B")]
    assert pairs(rejects, "row_number", "code") == [
        (2, "already_exists"), (3, "name_blank"), (4, "name_too_long"),
    ]
    table = table.cache()
    asked = inline(spark, [(1,), (9,)], "id long")
    assert pairs(lookup_by_id(table, asked), "id", "name", "found") == [
        (1, "A", True), (9, None, False),
    ]
    assert pairs(lookup_by_name(table, names(spark, " B\t")), "id") == [(2,)]

    changes = inline(
        spark, [(1, 1, "B"), (2, 2, "C"), (3, 9, "D"), (4, 2, " E "), (5, 1, "A")],
        "row_number long, id long, name string",
    )
    table, rejects = m.bulk_update(table, changes, "categories")
    assert pairs(table, "id", "name") == [(1, "A"), (2, "E")]
    assert pairs(rejects, "row_number", "code") == [
        (1, "superseded"), (2, "superseded"), (3, "not_found"),
    ]
    table, rejects = m.bulk_delete(table, asked)
    assert pairs(table, "id") == [(2,)] and pairs(rejects, "id") == [(9,)]


def test_a_taken_name_is_refused_on_update(spark):
    table = inline(spark, [(1, "A", NOW), (2, "B", NOW)], m.TABLES["categories"])
    changes = inline(spark, [(1, 1, "B"), (2, 2, "Z")], "row_number long, id long, name string")
    out, rejects = m.bulk_update(table, changes, "categories")
    assert pairs(out, "id", "name") == [(1, "A"), (2, "Z")]
    assert pairs(rejects, "row_number", "code") == [(1, "already_exists")]


def test_get_or_create_gives_one_id_per_name(spark):
    table, first, _ = m.get_or_create(seed.empty(spark, "categories"), names(spark, "A", " A", "B"))
    table = table.cache()
    assert pairs(first, "row_number", "name", "id") == [(0, "A", 1), (1, "A", 1), (2, "B", 2)]
    table, second, rejects = m.get_or_create(table, names(spark, "B", "C", " "))
    assert pairs(second, "row_number", "id") == [(0, 2), (1, 3)]
    assert table.count() == 3 and pairs(rejects, "code") == [("name_blank",)]


def test_source_rules(spark):
    given = inline(
        spark,
        [
            (1, "  Portal  ", "  https://example.com  ", "html", False, None),
            (2, "   ", "https://example.com", "html", False, None),
            (3, "No scheme", "example.com", "html", False, None),
            (4, "No policy", "https://example.com", "api", True, None),
            (5, "With policy", "https://example.com", "api", True, NOW),
            (6, "Wrong type", "https://example.com", "mail", None, None),
        ],
        "row_number long, name string, base_url string, source_type string,"
        "collection_allowed boolean, policy_checked_at timestamp",
    )
    _, created, rejects = m.bulk_create(seed.empty(spark, "sources"), given, "sources")
    assert pairs(created, "name", "base_url", "is_active") == [
        ("Portal", "https://example.com", True), ("With policy", "https://example.com", True),
    ]
    assert pairs(rejects, "row_number", "code") == [
        (2, "name_blank"), (3, "base_url_invalid"), (4, "policy_date_missing"),
        (6, "source_type_invalid"),
    ]


def test_run_life(spark):
    sources = inline(spark, [(10, "S")], "id long, name string")
    requests = inline(
        spark, [(1, 10, NOW), (2, 11, NOW), (3, 10, NOW)],
        "row_number long, source_id long, started_at timestamp",
    )
    runs, started, rejects = r.start_runs(seed.empty(spark, "collection_runs"), sources, requests)
    runs = runs.cache()
    assert pairs(started, "id", "source_id", "status", "records_found") == [
        (1, 10, "running", 0), (2, 10, "running", 0),
    ]
    assert pairs(rejects, "row_number", "code") == [(2, "source_not_found")]

    later = [NOW + timedelta(minutes=i) for i in range(4)]
    events = inline(
        spark,
        [
            (1, 1, "success", later[1], 10, 6, 2, 1, "dropped"),
            (2, 1, "success", later[2], 9, 9, 9, 9, None),
            (3, 2, "partial", later[1], 5, 3, 0, 1, "   "),
            (4, 2, "failed", later[2], None, None, None, None, "  A fonte não respondeu. "),
            (5, 9, "success", later[1], 0, 0, 0, 0, None),
            (6, 2, "success", later[1], -1, 0, 0, 0, None),
            (7, 2, "running", later[1], 0, 0, 0, 0, "x"),
        ],
        "row_number long, run_id long, status string, finished_at timestamp, records_found int,"
        "records_inserted int, records_updated int, records_rejected int, error_message string",
    )
    closed, rejects = r.finish_runs(runs, events)
    closed = closed.cache()
    assert pairs(closed, "id", "status", "finished_at", *r.COUNTS) == [
        (1, "success", later[1], 10, 6, 2, 1), (2, "failed", later[2], 0, 0, 0, 0),
    ]
    messages = {x.id: x.error_message for x in closed.collect()}
    assert messages == {1: None, 2: "A fonte não respondeu."}
    assert pairs(rejects, "row_number", "code") == [
        (2, "bad_state"), (3, "blank_message"), (5, "not_found"), (6, "count_negative"),
        (7, "status_invalid"),
    ]
    again, rejects = r.finish_runs(closed, events.where("row_number = 1"))
    assert pairs(rejects, "code") == [("bad_state",)]
    assert pairs(again, "id", "status") == pairs(closed, "id", "status")


def test_latest_runs_and_limits(spark):
    runs = spark.range(100).selectExpr(
        "id", "id % 3 AS source_id", "timestamp_micros(id * 1000000) AS started_at"
    )
    assert pairs(latest_runs(runs, 2), "source_id", "id") == [
        (0, 96), (0, 99), (1, 94), (1, 97), (2, 95), (2, 98),
    ]
    assert [x.id for x in list_by_source(runs, 1, 2).collect()] == [97, 94]
    for bad in (0, -1, 501):
        with pytest.raises(ValueError):
            latest_runs(runs, bad)
        with pytest.raises(ValueError):
            list_by_source(runs, 1, bad)


def test_delete_follows_foreign_keys(spark):
    tables = {
        "sources": inline(spark, [(1,), (2,), (3,)], "id long"),
        "collection_runs": inline(spark, [(7, 1), (8, 1)], "id long, source_id long"),
        "notices": inline(
            spark, [(1, 2, 7), (2, 2, None), (3, 2, 8)],
            "id long, source_id long, last_collection_run_id long",
        ),
        "categories": inline(spark, [(1,), (2,)], "id long"),
        "notice_categories": inline(
            spark, [(1, 1), (1, 2), (2, 1)], "notice_id long, category_id long"
        ),
    }
    ids = inline(spark, [(1,), (2,), (3,), (9,)], "id long")
    out, rejects = m.apply_delete(tables, "sources", ids)
    assert pairs(out["sources"], "id") == [(1,), (2,)]
    assert pairs(rejects, "id", "code") == [
        (1, "used_by_collection_runs"), (2, "used_by_notices"), (9, "not_found"),
    ]
    out, _ = m.apply_delete(tables, "collection_runs", inline(spark, [(7,)], "id long"))
    kept = {x.id: x.last_collection_run_id for x in out["notices"].collect()}
    assert kept == {1: None, 2: None, 3: 8}
    out, _ = m.apply_delete(tables, "notices", inline(spark, [(1,)], "id long"))
    assert pairs(out["notice_categories"], "notice_id", "category_id") == [(2, 1)]
    out, _ = m.apply_delete(tables, "categories", inline(spark, [(1,)], "id long"))
    assert pairs(out["notice_categories"], "notice_id", "category_id") == [(1, 2)]


def test_upsert_never_breaks_a_unique_key(spark):
    """Random batches on top of each other: keys stay unique, rejects are accounted for."""
    table = seed.empty(spark, "notices")
    for step in range(3):
        new = spark.range(120).selectExpr(
            "id AS row_number",
            "id % 3 AS source_id",
            f"CASE WHEN id % 5 != 0 THEN concat('E', hash(id, {step}, 1) % 30) END AS external_id",
            "'t' AS title", "'o' AS organization", "'n' AS notice_number",
            "date '2026-01-01' AS publication_date", "date '2026-01-02' AS registration_deadline",
            f"concat('https://h/', hash(id, {step}, 2) % 40) AS url", "'open' AS status",
            f"concat('h', hash(id, {step}, 3) % 50) AS content_hash",
            f"timestamp_micros({step} * 1000000) AS seen_at",
            "cast(NULL AS bigint) AS last_collection_run_id", "'{}' AS raw_payload",
        )
        before = table.count()
        table, rejects = m.upsert_notices(table, new)
        table = table.checkpoint()
        assert rules.table_unique_violations(table, "notices").count() == 0
        assert rejects.select("row_number").distinct().count() == rejects.count() < 120
        assert before < table.count() <= before + 120 - rejects.count()


def test_orphans_and_unique_rules_skip_nulls(spark):
    parent = inline(spark, [(1,)], "id long")
    child = inline(spark, [(1, 1), (2, 5), (3, None)], "id long, fk long")
    assert pairs(rules.orphans(child, "fk", parent), "id") == [(2,)]
    doubled = inline(spark, [(1, "a"), (1, "a"), (2, None), (2, None)], "s long, k string")
    assert pairs(rules.unique_violations(doubled, ["s", "k"]), "s", "k", "holders") == [
        (1, "a", 2)
    ]


"""Build the tables from nothing with the bulk operators, then run the reports."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from noticelake.operators import maintenance as m
from noticelake.operators import runs as r
from noticelake.plans.load import load
from noticelake.plans.reports import reports
from tests import seed


def run_rows(spark, sources):
    """A run of 40 s that found two notices, and one of 90 s that found four."""
    found = {seed.HARBOUR: (1, 2, 40), seed.ORCHARD: (2, 4, 90)}
    rows = [
        (n, name, seed.START[name], seed.START[name] + timedelta(seconds=s), k)
        for name, (n, k, s) in found.items()
    ]
    frame = seed.inline(
        spark, rows, "row_number long, name string, started_at timestamp, finished_at timestamp, found int"
    )
    ids = sources.select(F.col("id").alias("source_id"), "name")
    return frame.join(ids, "name").selectExpr(
        "row_number", "source_id", "started_at", "finished_at", "'success' AS status",
        "found AS records_found", "found - 1 AS records_inserted", "1 AS records_updated",
    )


@pytest.fixture(scope="module")
def tables(spark):
    sources, _ = m.upsert_sources(seed.empty(spark, "sources"), seed.source_rows(spark))
    sources = sources.cache()
    names = seed.inline(
        spark, [(i, n) for i, n in enumerate(seed.NAMES)], "row_number long, name string"
    )
    categories, refused = m.insert_ignore(seed.empty(spark, "categories"), names, ["name"], "categories")
    assert refused.count() == 0
    runs, refused = r.insert_missing_runs(
        seed.empty(spark, "collection_runs"), run_rows(spark, sources), sources
    )
    assert refused.count() == 0
    found = {
        "sources": sources,
        "categories": categories.cache(),
        "collection_runs": runs.cache(),
        "notices": seed.empty(spark, "notices"),
        "notice_categories": seed.empty(spark, "notice_categories"),
    }
    loaded = load(seed.notice_rows(spark), seed.mapping_rows(spark), found)
    assert loaded.rejects.count() == 0 and loaded.mapping_rejects.count() == 0
    found["notices"] = loaded.notices.cache()
    found["notice_categories"] = loaded.links.cache()
    return found


def rows(df):
    return [tuple(row) for row in df.collect()]


def test_reports(tables):
    out = reports(tables)
    first = rows(out["notices_with_source"])
    # By deadline, the one without a deadline last.
    assert [x[1] for x in first] == [
        "Tratorista", "Vigia do cais", "Podador de pereiras", "Operador de guindaste", "Apicultor", "Enxertador",
    ]
    assert first[0][2] == seed.ORCHARD and str(first[0][4]) == "2025-03-18" and first[-1][4] is None
    by_notice = dict(rows(out["notice_categories"]))
    assert by_notice["Tratorista"] == "Horticultura, Maquinaria" and len(by_notice) == 6
    assert by_notice["Vigia do cais"] == "Turno da noite, Vigilância"
    counted = {x[0]: x[1:] for x in rows(out["notices_per_source"])}
    assert counted == {seed.ORCHARD: (4, 2, 1), seed.HARBOUR: (2, 1, 0), seed.MILL: (0, 0, 0)}
    assert sorted(rows(out["popular_categories"])) == [("Horticultura", 3), ("Maquinaria", 2), ("Turno da noite", 3)]
    assert rows(out["sources_above_average"]) == [(seed.ORCHARD, 4)]
    assert rows(out["collection_runs"]) == [
        (seed.ORCHARD, "success", 4, 3, 1, 0, 90.0), (seed.HARBOUR, "success", 2, 1, 1, 0, 40.0),
    ]
    assert [x[1] for x in rows(out["open_notices"])] == [
        "Podador de pereiras", "Operador de guindaste", "Enxertador",
    ]


def test_loading_again_changes_nothing_but_the_last_sighting(spark, tables):
    later = seed.notice_rows(spark).withColumn("seen_at", F.expr("seen_at + INTERVAL 3 HOURS"))
    again = load(later, seed.mapping_rows(spark), tables)
    key = ["id", "url", "first_seen_at", "content_hash"]
    assert sorted(rows(again.notices.select(*key))) == sorted(rows(tables["notices"].select(*key)))
    assert again.notices.where("last_seen_at > first_seen_at").count() == 6
    assert again.links.count() == 10 and again.rejects.count() == 0
    earlier = seed.notice_rows(spark).withColumn("seen_at", F.expr("seen_at - INTERVAL 3 HOURS"))
    back = load(earlier, seed.mapping_rows(spark), tables)
    assert back.notices.where("last_seen_at = first_seen_at").count() == 6


def test_load_refuses_what_it_cannot_place(spark, tables):
    """Unknown sources and mapping names are refused, and tied runs give one id."""
    tied = tables["collection_runs"].selectExpr("id + 50 AS id", *tables["collection_runs"].columns[1:])
    runs = tables["collection_runs"].unionByName(tied)
    stray = seed.notice_rows(spark).where("row_number = 2").selectExpr(
        "99 AS row_number", "'Ninguém' AS source_name", *seed.notice_rows(spark).columns[2:]
    )
    mapping = seed.inline(
        spark,
        [
            ("Ninguém", "H/77", seed.NAMES[0]), (seed.HARBOUR, "H/0", seed.NAMES[0]),
            (seed.HARBOUR, None, seed.NAMES[0]), (seed.HARBOUR, "H/77", "Navegação"),
        ],
        "source_name string, external_id string, category_name string",
    )
    batch = seed.notice_rows(spark).unionByName(stray)
    out = load(batch, mapping, {**tables, "collection_runs": runs})
    assert rows(out.rejects) == [(99, "source_not_found")]
    assert sorted(rows(out.mapping_rejects.select("code"))) == [
        ("category_not_found",), ("notice_not_found",), ("notice_not_found",), ("source_not_found",),
    ]
    assert out.notices.count() == out.notices.select("id").distinct().count() == 6
    assert out.notices.where("last_collection_run_id > 50").count() == 6


def test_names_list_in_language_order(spark):
    from noticelake.operators.lookups import list_all

    names = seed.inline(
        spark, [(1, "Zebra"), (2, "Área"), (3, "Banco"), (4, "azul")], "id long, name string"
    )
    assert [x[1] for x in rows(list_all(names, "UNICODE"))] == ["Área", "azul", "Banco", "Zebra"]
    assert [x[1] for x in rows(list_all(names))] == ["Banco", "Zebra", "azul", "Área"]

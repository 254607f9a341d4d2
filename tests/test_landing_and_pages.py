import json
import os
import random
import re
import time
import tracemalloc
from datetime import datetime
from pathlib import Path
from urllib.parse import urlparse

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from noticelake.operators import pages as p
from noticelake.operators.maintenance import fit_table
from noticelake.plans.export import transform_and_export
from noticelake.plans.ingest import ingest
from noticelake.plans.transform import transform
from noticelake.sources import documents, exports, landing
from noticelake.schemas import CLEAN_COLUMNS, REJECT_COLUMNS
from noticelake.session import apply_settings, shared_dir

GOOD = {"external_id": "A", "title": 'Título "com" aspas, e vírgula', "url": "https://h/1"}


def document(records, **more):
    head = {"source_id": 10, "collection_run_id": 20, "saved_at": "2026-07-29T08:00:00+00:00",
            "pages_fetched": 1, "record_count": 1}
    return json.dumps({**head, "records": records, **more}, ensure_ascii=False, indent=2)


def write_files(root):
    files = {
        "source_10/run_20_a.json": document([GOOD, {"title": " "}]),
        "source_10/run_21_b.json": document("x"),
        "source_11/run_22_c.json": document([GOOD, 5]),
        "source_11/run_23_d.json": "{bad",
        "source_11/run_24_e.json": json.dumps([{"records": []}]),
        "source_11/run_25_f.json": json.dumps({"source_id": 1}),
        "source_11/run_26_g.json": document([]),
        "source_11/other.json": document([GOOD]),
    }
    for age, (name, body) in enumerate(files.items()):
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(body, encoding="utf-8")
        os.utime(path, (1_700_000_000 - age, 1_700_000_000 - age))


def test_raw_files(spark, tmp_path):
    write_files(tmp_path)
    files = landing.scan_raw(spark, str(tmp_path))
    assert files.count() == 7
    assert landing.latest_raw(files).first().path.endswith("run_20_a.json")
    for found in (landing.read_raw(spark, str(tmp_path)), landing.validate_raw(files)):
        got = {(r.source_id, r.collection_run_id, r.saved_at, r.found) for r in found.usable.collect()}
        saved = datetime(2026, 7, 29, 8)
        assert got == {(10, 20, saved, 2), (10, 20, saved, 0)}
        codes = {r.path[-6]: r.code for r in found.unusable.collect()}
        assert codes == {
            "b": "records_not_list", "c": "record_not_object", "d": "not_json_object",
            "e": "not_json_object", "f": "records_not_list",
        }
        rows = found.records.select("row_number", F.to_json("record")).collect()
        assert [json.loads(r[1]) for r in sorted(rows)] == [GOOD, {"title": " "}]


def test_malformed_documents_are_told_from_wrong_ones(spark):
    bodies = {
        '{"records": [{"a": 1}]}\n': None,
        '{"records": [{"a": 1, "a": 2}]}': None,
        '{"records": [1': "not_json_object",
        '{"records": [],}': "not_json_object",
        "{'records': []}": "not_json_object",
        '{"records": []} x': "not_json_object",
        '{"records": [{"a": NaN}]}': "not_json_object",
        "": "not_json_object",
        '"text"': "not_json_object",
        '{"records": {"a": 1}}': "records_not_list",
        '{"records": null}': "records_not_list",
        '{"records": [null]}': "record_not_object",
        '{"source_id": "x", "records": []}': None,
    }
    files = spark.createDataFrame(
        [(str(i), None, body) for i, body in enumerate(bodies)],
        "path string, modified_at timestamp, body string",
    )
    found = landing.validate_raw(files)
    got = {int(r.path): r.code for r in found.usable.withColumn("code", F.lit(None)).unionByName(found.unusable, True).collect()}
    assert [got[i] for i in range(len(bodies))] == list(bodies.values())
    assert {r.path for r in found.usable.where("source_id IS NULL").collect()} == {"0", "1", "12"}


def test_files_and_commas(spark, tmp_path):
    """The text is split at commas: those at the end, in strings and in escapes are where that could go wrong."""
    records = [{"external_id": "a,b", "title": ",,", "url": 'x"],}'}, {"title": "\\\\,", "n": [1, {"m": [",", 2]}]}, {}]
    bodies = {
        "good": json.dumps({"other": [{"records": [1]}, "a,b" * 50_000], "records": records, "record_count": 3}),
        "twice": json.dumps({"records": [5, 6]})[:-1] + "," + json.dumps({"records": records})[1:],
        "empty_last": json.dumps({"records": [5, 6]})[:-1] + ', "records": []}',
        "comma": json.dumps({"records": records}) + ",",
        "commas": json.dumps({"records": records}) + ",,",
        "escape": '{"records": [{"a": "x\\, y"}]}',
        "empty": "",
    }
    for name, body in bodies.items():
        (tmp_path / f"run_{name}.json").write_text(body, encoding="utf-8")
    found = landing.read_raw(spark, str(tmp_path))
    usable = {r.path.rsplit("run_")[-1][:-5]: r.found for r in found.usable.collect()}
    assert usable == {"good": 3, "twice": 3, "empty_last": 0}
    got = {}
    for r in found.records.select("path", "row_number", F.to_json("record").alias("text")).collect():
        got.setdefault(r.path.rsplit("run_")[-1][:-5], {})[r.row_number] = json.loads(r.text)
    assert got == {name: dict(enumerate(records, 1)) for name in ("good", "twice")}
    assert {r.code for r in found.unusable.collect()} == {"not_json_object"}


def test_scanner_agrees_with_a_parser():
    r = random.Random(7)

    def value(depth=0):
        k = r.random()
        if depth > 3 or k < 0.4:
            return r.choice([1, -2.5, "a,b", "]}[{", 'q"\\', None, True, "é\n", ""])
        if k < 0.7:
            return [value(depth + 1) for _ in range(r.randint(0, 3))]
        return {r.choice(["records", "x", "source_id", "y,"]): value(depth + 1) for _ in range(r.randint(0, 3))}

    for _ in range(5000):
        text = json.dumps(value(), ensure_ascii=r.random() < 0.5, indent=r.choice([None, 2]))
        if r.random() < 0.4:
            at = r.randrange(len(text))
            text = text[:at] + r.choice(["", ",", "]", "}", '"', "x", "\\"]) + text[at + 1 :]
        scanner, found = documents.Scanner(), []
        for i, part in enumerate(text.split(",")):
            found += [(scanner.generation, *x) for x in scanner.feed("," * (i > 0) + part)]
        try:
            parsed = json.loads(text)
            records = [json.loads(x) for generation, _, x in found if generation == scanner.generation]
        except ValueError:
            parsed = None
        if not isinstance(parsed, dict):
            assert not scanner.finish() or parsed is None
            continue
        assert scanner.finish() and scanner.is_list == isinstance(parsed.get("records"), list)
        if scanner.is_list:
            assert records == parsed["records"]


def test_scanner_holds_a_record_at_most():
    """A document of 64 MB in small parts; what is held stays that of one record."""
    scanner, most, n = documents.Scanner(), 0, 0
    record = json.dumps({"title": "x" * 1000, "n": list(range(20))})
    list(scanner.feed('{"junk": "'))
    for _ in range(2000):
        list(scanner.feed("y" * 1000))
    list(scanner.feed('", "records": ['))
    tracemalloc.start()
    for i in range(60_000):
        n += len(list(scanner.feed(("," if i else "") + record)))
    list(scanner.feed("]}"))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert scanner.finish() and n == 59_999 and most < 1 << 20


def test_scanner_passes_over_strings_and_commas(monkeypatch):
    """A record of many fields takes a few searches, and the text is the same in one part or many."""
    searched, pattern = [], documents._STRUCTURE

    class Counting:
        def search(self, text, at):
            searched.append(at)
            return pattern.search(text, at)

    monkeypatch.setattr(documents, "_STRUCTURE", Counting())
    record = {f"f{i}": 'a, "b" \\ ]}' for i in range(50)}
    text = json.dumps({"records": [record] * 20})
    whole = list(documents.Scanner().feed(text))
    assert len(searched) <= 20 * 3 and [json.loads(x) for _, x in whole] == [record] * 20
    scanner, found = documents.Scanner(), []
    for i, part in enumerate(text.split(",")):
        found += scanner.feed("," * (i > 0) + part)
    assert found == whole


def test_files_are_listed_by_few_tasks_and_judged_once(spark, tmp_path):
    for i in range(150):
        (tmp_path / f"d{i}").mkdir()
        (tmp_path / f"d{i}" / "run_1.json").write_text(document([GOOD] * (i % 3)) if i % 10 else "{")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "files")
    try:
        apply_settings(spark)
        found = landing.list_raw(spark, str(tmp_path))
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("listing")]
        tasks = [tracker.getStageInfo(s).numTasks for j in jobs for s in j.stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found.count() == 150 and tasks and max(tasks) <= 64
    read = landing.read_raw(spark, str(tmp_path))
    assert read.unusable.count() == 15 and read.usable.count() == 135
    assert read.records.count() == sum(i % 3 for i in range(150) if i % 10)
    for df in (read.usable, read.unusable, read.records):
        assert "binaryFile" not in df._jdf.queryExecution().executedPlan().toString()


def test_transform_and_export(spark, tmp_path):
    write_files(tmp_path / "raw")
    done = transform_and_export(spark, str(tmp_path / "raw"), str(tmp_path / "out"))
    metrics = done.metrics.first()
    assert (metrics.input_count, metrics.valid_count, metrics.rejected_count) == (2, 1, 1)
    valid = exports.read_export(spark, done.valid_path, CLEAN_COLUMNS).first()
    assert valid.title == GOOD["title"] and valid.url == "https://h/1"
    assert json.loads(valid.raw_payload) == GOOD
    rejected = exports.read_export(spark, done.rejected_path, REJECT_COLUMNS).first()
    assert rejected.row_number == "2"
    assert rejected.reasons == "Título ausente ou inválido. | URL ausente ou inválida."


def shuffle_files(spark):
    """The shuffle files that the session holds."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {p for d in folders for p in Path(d).rglob("shuffle_*") if p.is_file()}


def test_an_export_deals_records_out_once_and_leaves_its_files_alone(spark, tmp_path):
    many = [{"external_id": f"id-{i % 32_900}", "title": "t", "url": f"https://h/{i}"} for i in range(33_000)]
    texts = {
        "many": document(many),
        "bad": document(many[:50])[:-1],
        "twice": document([GOOD, GOOD])[:-1] + "," + document([GOOD])[1:],
        "emptied": document([GOOD])[:-1] + "," + document([])[1:],
        "none": document([]),
    }
    (tmp_path / "raw").mkdir()
    for name, text in texts.items():
        (tmp_path / "raw" / f"run_{name}.json").write_text(text, encoding="utf-8")
    shared = Path(urlparse(spark.sparkContext.getCheckpointDir() or shared_dir(spark)).path)
    before = shuffle_files(spark), {*shared.rglob("*.parquet")}
    done = transform_and_export(spark, str(tmp_path / "raw"), str(tmp_path / "out"), latest_only=False)
    for _ in range(50):  # shuffles are removed while the code goes on
        if shuffle_files(spark) <= before[0]:
            break
        time.sleep(0.2)
    assert shuffle_files(spark) <= before[0] and {*shared.rglob("*.parquet")} == before[1]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
    counted = {Path(r.path).stem: tuple(r)[1:] for r in done.metrics.collect()}
    assert counted == {"run_many": (33_000, 32_900, 100, 100), "run_twice": (1, 1, 0, 0)}
    rejected = exports.read_export(spark, done.rejected_path, REJECT_COLUMNS)
    assert {int(r.row_number) for r in rejected.collect()} == set(range(32_901, 33_001))
    assert exports.read_export(spark, done.valid_path, CLEAN_COLUMNS).count() == 32_901

    read = landing.read_raw(spark, str(tmp_path / "raw"))
    tagged = transform(read.scanned, ("file", "generation"), read.lists).tagged
    plan = tagged._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    dealt = [step for step in plan.split("\n\n") if re.match(r"\(\d+\) Exchange\n", step) and "record#" in step]
    assert len(dealt) == 1 and "title" not in dealt[0]


def test_parts_of_a_block_travel_as_chunks():
    def batch(rows):
        types = dict.fromkeys(("file", "block", "place", "size"), pa.int64()) | {"octets": pa.int32(), "part": pa.string()}
        return pa.RecordBatch.from_pylist([dict(zip(types, row)) for row in rows], pa.schema(types))

    large = "x" * (1 << 18)
    texts = [(1, 0, "a"), (1, 0, ""), (1, 0, "é"), (1, 9, "b"), (2, 9, "c"), (2, 9, large), (2, 9, "d"), (2, 9, "e")]
    rows = [(f, b, i, None, len(text.encode()), text) for i, (f, b, text) in enumerate(texts)]
    (made,) = documents._join_parts(iter([batch(rows), batch(rows[:0])]))
    got = [(r["file"], r["block"], r["place"], r["size"], r["octets"], r["part"]) for r in made.to_pylist()]
    assert got == [
        (1, 0, 0, None, 5, "a,,é"), (1, 9, 3, None, 1, "b"), (2, 9, 4, None, 1, "c"),
        (2, 9, 5, None, 4 + len(large), f"{large},d,e"),
    ]


def page(number, items, total_pages=2, total_items=3, **changes):
    pagination = {"page": number, "page_size": 2, "total_pages": total_pages,
                  "total_items": total_items, **changes}
    return json.dumps({"items": items, "pagination": pagination})


A, B, C = {"external_id": "1"}, {"external_id": "2"}, {"external_id": "3"}
RUNS = {
    1: ([page(1, [A, B]), page(2, [C])], None),
    2: ([page(1, "invalid"), page(2, [C])], "items_not_list"),
    3: ([page(1, [A, B]), page(2, [C], total_pages=3)], "total_pages_changed"),
    4: ([page(1, [A, B]), page(2, [C], total_items=4)], "total_items_changed"),
    5: ([page(1, [A, B])], "page_missing"),
    6: ([page(1, [A, B], total_items=9), page(2, [C], total_items=9)], "count_mismatch"),
    7: ([page(1, [A, B], page=True), page(2, [C])], "page_not_integer"),
    8: ([page(1, [A, B], page_size=2.0), page(2, [C])], "page_size_not_integer"),
    9: ([page(1, [A, 7]), page(2, [C])], "item_not_object"),
    10: ([page(2, [A, B]), page(2, [C])], "page_mismatch"),
    11: (["[]"], "root_not_object"),
    12: ([json.dumps({"items": [], "pagination": []})], "pagination_not_object"),
    13: ([page(1, [], total_pages=0, total_items=0)], "total_pages_not_positive"),
    14: ([page(1, [], total_pages=1, total_items=-1)], "total_items_negative"),
    15: ([page(1, [], total_pages=1, total_items=0)], None),
    16: ([page(1, [A], total_pages=1, total_items=1), page(2, [B], total_pages=1, total_items=1)],
         "page_beyond_total"),
    17: ([page(1, [A, B], page_size=0), page(2, [C])], "page_size_not_positive"),
}


def landed(spark):
    rows = [(1, run, i + 1, body) for run, (bodies, _) in RUNS.items() for i, body in enumerate(bodies)]
    rows.append((1, 18, 1, page(1, [A], total_pages=1, total_items=1)))
    rows.append((1, 18, 1, page(1, [A], total_pages=1, total_items=1)))
    return spark.createDataFrame(
        rows, "source_id long, collection_run_id long, requested_page int, body string"
    )


def test_page_checks(spark):
    verdicts = p.run_verdicts(p.parse_pages(landed(spark)))
    got = {r.collection_run_id: r.code for r in verdicts.collect()}
    assert got == {**{run: code for run, (_, code) in RUNS.items()}, 18: "page_repeated"}


def test_ingest(spark, tmp_path):
    runs = fit_table(
        spark.range(1, 20).selectExpr("id", "1 AS source_id", "timestamp '2026-01-01' AS started_at"),
        "collection_runs",
    )
    root = str(tmp_path / "landed")
    done = ingest(landed(spark), runs, root)
    table = {r.id: r for r in done.runs.collect()}
    assert table[1].status == "success" and table[1].records_found == 3
    assert table[1].records_inserted == 0 and table[1].error_message is None
    assert table[15].status == "success" and table[15].records_found == 0
    assert table[2].status == "failed" and table[2].records_found == 0
    assert table[2].error_message == (
        "InvalidAPIResponseError: O campo 'items' deve ser uma lista."
    )
    assert table[10].error_message.endswith("a página 2, mas a página 1 foi solicitada.")
    assert table[19].status == "running" and done.rejects.count() == 0

    back = landing.read_landed(spark, root).orderBy("row_number").collect()
    assert [(r.source_id, r.collection_run_id, r.row_number) for r in back] == [
        (1, 1, 1), (1, 1, 2), (1, 1, 3),
    ]
    assert [json.loads(str(r.record.toJson()))["external_id"] for r in back] == ["1", "2", "3"]
    ingest(landed(spark), runs, root)
    assert landing.read_landed(spark, root).count() == 3
    assert back[0].pages_fetched == 2 and back[0].record_count == 3
    assert landing.latest_landed(landing.read_landed(spark, root)).first().collection_run_id == 1


def test_records_keep_page_order_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(p, "BLOCK", 3)
    sizes = [(i * 7) % 4 for i in range(1, 41)]
    total, made, rows = sum(sizes), 0, []
    for number, size in enumerate(sizes, 1):
        items = [{"external_id": str(made + j + 1)} for j in range(size)]
        made += size
        rows.append((1, 1, number, page(number, items, total_pages=40, total_items=total)))
    frame = spark.createDataFrame(
        rows, "source_id long, collection_run_id long, requested_page int, body string"
    ).repartition(7)
    parsed = p.parse_pages(frame)
    assert p.run_verdicts(parsed).first().code is None
    records = p.explode_pages(parsed).selectExpr(
        "row_number", "variant_get(record, '$.external_id', 'bigint') AS e"
    ).collect()
    assert sorted((r.row_number, r.e) for r in records) == [(i, i) for i in range(1, total + 1)]


def test_a_record_above_the_size_limit_harms_itself_alone(spark, tmp_path):
    good = {"external_id": "g", "title": "t", "url": "https://h/1"}
    head = '{"source_id": 1, "collection_run_id": 2, "pages_fetched": 1, "record_count": 2, "records": ['
    with open(tmp_path / "run_big.json", "w") as out:
        out.write(head + json.dumps(good) + ', {"external_id": "b", "title": "')
        for _ in range(135):
            out.write("x" * (1 << 20))
        out.write('"}]}')
    found = landing.read_raw(spark, str(tmp_path))
    records = found.records.select("row_number", F.col("record").isNull().alias("lost"))
    assert sorted(tuple(r) for r in records.collect()) == [(1, False), (2, True)]
    assert found.unusable.count() == 0


def test_a_lost_record_has_its_own_reason(spark):
    raw = spark.createDataFrame([(1, None), (2, '{"title": "t", "url": "https://h/1"}')], "row_number long, body string")
    batch = transform(raw.select("row_number", F.try_parse_json("body").alias("record")))
    assert [r.reasons[0] for r in batch.rejected.collect()] == ["record_too_large"]
    assert batch.valid.count() == 1


def test_page_that_is_no_json_has_its_own_code(spark):
    rows = [(1, 1, 1, "<html>"), (1, 2, 1, "[]"), (1, 3, 1, None)]
    landed = spark.createDataFrame(rows, "source_id long, collection_run_id long, requested_page long, body string")
    codes = {r.collection_run_id: r.code for r in p.parse_pages(landed).collect()}
    assert codes == {1: "not_json", 2: "root_not_object", 3: "not_json"}


def test_only_running_runs_are_written_and_empty_ones_replace(spark, tmp_path):
    def body(n, total=None):
        items = [{"external_id": str(i)} for i in range(n)]
        inner = {"page": 1, "page_size": 5, "total_pages": 1, "total_items": n if total is None else total}
        return json.dumps({"items": items, "pagination": inner})

    def landed(*rows):
        return spark.createDataFrame(
            [(s, r, 1, b) for s, r, b in rows],
            "source_id long, collection_run_id long, requested_page long, body string",
        )

    now = datetime(2025, 1, 1)
    runs = fit_table(
        spark.createDataFrame(
            [(1, 7, now, "running"), (2, 7, now, "failed"), (3, 8, now, "running")],
            "id long, source_id long, started_at timestamp, status string",
        ),
        "collection_runs",
    )
    root = str(tmp_path / "landed")
    first = ingest(landed((7, 1, body(2)), (7, 2, body(3)), (8, 3, body(0)), (9, 99, body(1))), runs, root)
    assert {r.collection_run_id for r in landing.read_landed(spark, root).collect()} == {1}
    assert {(r.run_id, r.code) for r in first.rejects.collect()} == {(2, "bad_state"), (99, "not_found")}
    states = {r.id: (r.status, r.records_found) for r in first.runs.collect()}
    assert states == {1: ("success", 2), 2: ("failed", 0), 3: ("success", 0)}
    newest = {tuple(r) for r in landing.latest_landed(landing.read_envelopes(spark, root)).collect()}
    assert newest == {(7, 1), (8, 3)}
    again = runs.where("id = 1")
    ingest(landed((7, 1, body(0))), again, root)
    assert landing.read_landed(spark, root).count() == 0 and landing.read_envelopes(spark, root).count() == 2


def test_local_folder_is_refused_on_a_cluster():
    from noticelake.session import own_dir

    assert own_dir("/w", "local[4]") == "/w/_checkpoints"
    assert own_dir("hdfs://n/w", "yarn") == "hdfs://n/w/_checkpoints"
    for warehouse, master in (("file:/w", "yarn"), ("/w", "local-cluster[2,1,512]"), ("/w", "spark://h:1")):
        with pytest.raises(ValueError):
            own_dir(warehouse, master)


def test_many_runs_share_files(spark, tmp_path):
    """Files follow records: three hundred runs are no three hundred folders."""
    root = str(tmp_path / "landed")
    made = spark.range(600).selectExpr(
        "id div 200 AS source_id", "id div 2 AS collection_run_id", "1L AS pages_fetched", "2L AS record_count",
        "id % 2 + 1 AS row_number", "parse_json(concat('{\"k\":', id, '}')) AS record",
    )
    landing.write_raw(made, root)
    assert len(list((tmp_path / "landed").glob("data/**/part-*"))) == 1
    landing.write_raw(made.where("collection_run_id = 7 AND row_number = 1").withColumn("record_count", F.lit(1)), root)
    held = landing.read_landed(spark, root).select("collection_run_id", F.expr("variant_get(record, '$.k', 'int')"))
    assert sorted(tuple(r) for r in held.collect()) == [(k // 2, k) for k in range(600) if k != 15]
    envelopes = landing.read_envelopes(spark, root)
    assert envelopes.count() == 599 and envelopes.select("collection_run_id").distinct().count() == 300

"""Plan shapes and behaviour that matter once the tables are large."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from noticelake.operators import dedupe, history, lookups, maintenance, positions, rules
from noticelake.plans import reports, transform
from noticelake.sources.tables import load_tables, save_tables
from workload import tables as t

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    save_tables(t.all_tables(spark, SF_DIR), f"{root}/v1")
    return load_tables(spark, f"{root}/v1")


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(reports.open_notices(stored["notices"]))
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,open)]" in text
    assert "ReadSchema: struct<id:bigint,title:string,registration_deadline:date,status:string>" in text


def test_no_report_is_a_cross_join(stored):
    for name, df in reports.reports(stored).items():
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_latest_runs_limits_groups_before_the_shuffle(stored):
    text = plan(lookups.latest_runs(stored["collection_runs"], 3))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_duplicate_flags_use_no_window(spark):
    frame = spark.range(10).selectExpr("id AS row_number", "'k' AS external_key", "'u' AS url")
    text = plan(dedupe.flag_duplicates(frame))
    assert "Window" not in text and "partial_min" in text


def hot(spark, rows=30_000):
    """A third of all rows share one key, a third have none, the rest are distinct."""
    return spark.range(rows, numPartitions=4).selectExpr(
        "id AS row_number",
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN concat('k', id) END AS external_key",
        "concat('https://h/', id) AS url",
    )


def test_hot_keys_are_flagged_right(spark):
    flagged = dedupe.flag_duplicates(hot(spark))
    counts = flagged.agg(F.count("*"), F.count_if("dup_external_id"), F.count_if("dup_url")).first()
    assert tuple(counts) == (30_000, 9_999, 0)
    assert flagged.where("external_key = 'hot' AND NOT is_duplicate").first().row_number == 0


def test_no_task_gets_the_hot_key(spark):
    """The rows go back over the row id, so the shuffle is even whatever the keys are."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        flagged = dedupe.flag_duplicates(hot(spark))
        sizes = [r["count"] for r in flagged.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 1.2 * min(sizes)


def test_marks_cross_the_bounds_of_bitmaps(spark):
    """Batches of very different size, one without a name; each repeat is marked and nothing else."""
    rows = spark.range(1, 100_001).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'big' WHEN id % 3 = 1 THEN NULL ELSE concat('b', id % 50) END AS batch",
        "id AS row_number", "concat('k', id % 9001) AS external_key", "CASE WHEN id % 7 = 0 THEN concat('u', id % 35) END AS url",
    )
    order = Window.partitionBy("batch", F.col("key")).orderBy("row_number")

    def later(column):
        numbered = rows.withColumn("key", F.col(column)).where("key IS NOT NULL").withColumn("n", F.row_number().over(order))
        return {(r.batch, r.row_number) for r in numbered.where("n > 1").collect()}

    flagged = dedupe.flag_duplicates(rows, within=["batch"])
    assert flagged.count() == 100_000 and flagged.columns == [*rows.columns, "dup_external_id", "dup_url", "is_duplicate"]
    for flag, column in (("dup_external_id", "external_key"), ("dup_url", "url")):
        assert {(r.batch, r.row_number) for r in flagged.where(flag).collect()} == later(column)


def test_records_are_read_twice(spark):
    """Once for the keys and once for the rows."""
    raw = t.raw_records(spark, SF_DIR).checkpoint()
    text = plan(transform.transform(raw).tagged)
    assert text.count("ArrowEvalPython") == 1 and text.count("schema_of_variant(record") <= 8 * 2


def test_hot_source_join_is_split(spark):
    """With broadcast off, a source with a third of the notices is spread over tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "12",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        notices = spark.range(200_000, numPartitions=8).selectExpr(
            "id", "concat('t', id) AS title", "'open' AS status",
            "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 500 END AS source_id",
            "date '2026-01-01' AS registration_deadline",
        )
        sources = spark.range(500).selectExpr("id", "concat('s', id) AS name")
        report = reports.notices_with_source(notices, sources)
        assert len(report.collect()) == 200_000
        assert "skewed" in plan(report)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("rows", [0, 1, 5_000])
def test_positions_are_dense_and_ordered(spark, rows):
    frame = spark.range(rows, numPartitions=7).selectExpr("id", "id % 3 AS tied")
    numbered = positions.number_rows(frame, [F.col("tied").desc(), F.col("id")])
    got = [(r.id, r.tied) for r in numbered.orderBy("position").collect()]
    assert got == sorted(((i, i % 3) for i in range(rows)), key=lambda x: (-x[1], x[0]))
    assert [r.position for r in numbered.orderBy("position").collect()] == list(range(1, rows + 1))


def test_pages_of_an_empty_and_a_full_set(spark):
    assert positions.assign_pages(spark.range(0), ["id"], 2).count() == 0
    paged = positions.assign_pages(spark.range(5), ["id"], 2)
    assert [(r.page, r.total_pages, r.total_items) for r in paged.orderBy("id").collect()] == [
        (1, 3, 5), (1, 3, 5), (2, 3, 5), (2, 3, 5), (3, 3, 5),
    ]
    assert positions.page_slice(paged, 2).count() == 2
    for bad in (lambda: positions.assign_pages(paged, ["id"], 0), lambda: positions.page_slice(paged, 0)):
        with pytest.raises(ValueError):
            bad()


def test_match_order_and_null_ids(spark):
    cur = spark.createDataFrame(
        [(1, 1, "A", "u1", "h1"), (2, 1, None, "u2", "h2"), (3, 2, "A", "u1", "h1")],
        "id long, source_id long, external_id string, url string, content_hash string",
    )
    new = spark.createDataFrame(
        [(1, 1, "A", "u2", "h2"), (2, 1, None, "u2", "h1"), (3, 1, "Z", "x", "h1"),
         (4, 1, None, "x", "x"), (5, 2, "B", "u1", "q")],
        "row_number long, source_id long, external_id string, url string, content_hash string",
    )
    got = history.match_notices(cur, new).orderBy("row_number").collect()
    assert [(r.notice_id, r.match_kind) for r in got] == [
        (1, "external_id"), (2, "url"), (1, "content_hash"), (None, "none"), (3, "url"),
    ]


def test_transform_reads_two_fields_for_the_keys(spark):
    text = plan(transform.batch_keys(t.raw_records(spark, SF_DIR)))
    assert "title" not in text.split("ArrowEvalPython")[1].split("]")[0]


def test_upserts_move_digests_and_new_notices_meet_no_table(spark):
    """Texts of keys are not shuffled, a new notice is not joined to the table, nor one that stays as it is."""
    cur = t.notices(spark, SF_DIR)
    halves = maintenance._key_halves(cur.withColumnRenamed("id", "row_number"), ["row_number", "source_id"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(maintenance._known_rows(cur, halves))
        assert "hashpartitioning(key#" in text and "hashpartitioning(source_id" not in text
        batch = cur.limit(5).withColumn("row_number", F.col("id")).withColumn("seen_at", F.col("last_seen_at"))
        text = plan(maintenance.upsert_notices(cur, batch.drop("id"))[0])
        assert "FullOuter" not in text and "Union" in text and "BroadcastHashJoin [id#" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_key_is_told_by_source_and_kind(spark):
    rows = [(1, 11, "k", "k", "k"), (2, 1, "1:k", None, "k"), (3, 11, "k", "z", None)]
    notices = spark.createDataFrame(rows, "row_number long, source_id long, url string, content_hash string, external_id string")
    found = maintenance._key_digests(maintenance._key_halves(notices, ["row_number", "source_id"]), ["row_number"]).collect()
    assert found[0]._url == found[2]._url and found[1]._hash is None and len(found[0]._url) == 16
    assert len({x for r in found for x in r[1:] if x is not None}) == 6


def test_groups_of_a_unique_key_weigh_something(spark):
    """Ids in sequence took a few bits each, so one task had nine million of them."""
    rows = spark.range(0, 400_000, 1, 4).select((F.col("id") - F.when(F.col("id") == 399_999, 1).otherwise(0)).alias("id"))
    found = rules.unique_violations(rows, ["id"])
    assert [tuple(r) for r in found.collect()] == [(399_998, 2)] and found.columns == ["id", "holders"]
    assert "hashpartitioning(id#" in plan(found) and "xxhash64(id#" in plan(found)

"""The five notice tables, raw records and landed pages, derived from whole test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticelake.operators.maintenance import fit_table
from noticelake.session import shuffles_removed


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for costly row work where a small file arrives in fewer partitions."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers; suppliers never have notices."""
    customers = read(spark, sf_dir, "customer").selectExpr(
        "2 * c_custkey + 2 AS id",
        "c_name AS name",
        "concat('https://portal.example.com/c/', c_custkey) AS base_url",
        "c_custkey AS k",
        "c_acctbal AS balance",
    )
    suppliers = read(spark, sf_dir, "supplier").selectExpr(
        "2 * s_suppkey + 1 AS id",
        "s_name AS name",
        "concat('ftp://portal.example.com/s/', s_suppkey) AS base_url",
        "s_suppkey AS k",
        "s_acctbal AS balance",
    )
    rows = customers.unionByName(suppliers).selectExpr(
        "id",
        "name",
        "base_url",
        "CASE k % 5 WHEN 0 THEN 'api' WHEN 1 THEN 'html' WHEN 2 THEN 'browser'"
        " WHEN 3 THEN 'file' ELSE 'mail' END AS source_type",
        "balance > 0 AS collection_allowed",
        "CASE WHEN balance < 5000 THEN timestamp '2024-01-01 00:00:00' END AS policy_checked_at",
        "k % 3 != 0 AS is_active",
        "timestamp '2024-01-01 00:00:00' AS created_at",
    )
    return fit_table(rows, "sources")


def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey + 1 AS id",
        "2 * o_custkey + 2 AS source_id",
        "CASE WHEN o_orderkey % 13 != 0 THEN concat('ORD-', o_orderkey) END AS external_id",
        "concat('Notice ', o_orderpriority, ' ', o_orderkey) AS title",
        "concat('Office ', o_custkey % 25) AS organization",
        "concat(o_orderkey % 1000, '/', year(o_orderdate)) AS notice_number",
        "cast(o_orderdate AS date) AS publication_date",
        "CASE WHEN o_orderkey % 5 != 0 THEN"
        " date_add(cast(o_orderdate AS date), cast(o_orderkey % 60 AS int)) END"
        " AS registration_deadline",
        "concat('https://portal.example.com/notices/', o_orderkey) AS url",
        "CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'closed' ELSE 'unknown' END"
        " AS status",
        "sha2(concat('v1-', o_orderkey), 256) AS content_hash",
        "cast(o_orderdate AS timestamp) AS first_seen_at",
        "cast(o_orderdate AS timestamp) + INTERVAL 1 DAY AS last_seen_at",
        "CASE WHEN o_orderkey % 7 != 0 THEN o_orderkey % 1000 + 1 END AS last_collection_run_id",
        "concat('{\"k\":', o_orderkey, '}') AS raw_payload",
    )
    return fit_table(rows, "notices")


def collection_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (
        read(spark, sf_dir, "events")
        .withColumn("started_at", F.col("ts").cast("timestamp"))
        .selectExpr(
            "event_id + 1 AS id",
            "2 * user_id + 2 AS source_id",
            "started_at",
            "CASE WHEN event_type != 'view' THEN timestamp_micros(unix_micros(started_at)"
            " + cast(round(value * 1e6) AS bigint)) END AS finished_at",
            "CASE event_type WHEN 'view' THEN 'running' WHEN 'error' THEN 'failed'"
            " WHEN 'signup' THEN 'partial' ELSE 'success' END AS status",
            "event_id % 50 AS records_found",
            "event_id % 20 AS records_inserted",
            "event_id % 10 AS records_updated",
            "event_id % 5 AS records_rejected",
            "CASE WHEN event_type IN ('error', 'signup') THEN concat('note ', event_id) END"
            " AS error_message",
        )
    )
    return fit_table(rows, "collection_runs")


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").selectExpr(
        "p_partkey + 1 AS id",
        "concat(p_name, ' ', p_brand, ' ', p_partkey) AS name",
        "timestamp '2024-01-01 00:00:00' AS created_at",
    )
    return fit_table(rows, "categories")


def notice_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (
        read(spark, sf_dir, "lineitem")
        .selectExpr("l_orderkey + 1 AS notice_id", "l_partkey + 1 AS category_id")
        .distinct()
    )
    return fit_table(rows, "notice_categories")


def all_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "sources": sources(spark, sf_dir),
        "collection_runs": collection_runs(spark, sf_dir),
        "notices": notices(spark, sf_dir),
        "categories": categories(spark, sf_dir),
        "notice_categories": notice_categories(spark, sf_dir),
    }


# --- Raw records ----------------------------------------------------------------------

RAW_FIELDS = {
    "external_id": (
        "CASE WHEN k % 13 = 0 THEN NULL WHEN k % 3 = 0 THEN upper(ext) ELSE ext END"
    ),
    "title": (
        "CASE WHEN k % 29 = 0 THEN '   '"
        " ELSE concat('  Notice   for ', o_orderpriority, '  ', k) END"
    ),
    "url": (
        "CASE WHEN k % 23 = 0 THEN concat('example.com/', k)"
        " ELSE concat('https://EXAMPLE.com/notices/', CASE WHEN k % 17 = 1 THEN k - 1 ELSE k END,"
        " CASE WHEN k % 4 = 0 THEN '/#doc' ELSE '' END) END"
    ),
    "status": (
        "CASE WHEN k % 7 = 0 THEN NULL WHEN k % 31 = 0 THEN 'pending' WHEN k % 41 = 0 THEN '  '"
        " WHEN o_orderstatus = 'O' THEN ' OPEN ' WHEN o_orderstatus = 'F' THEN 'Closed'"
        " ELSE 'suspended  ' END"
    ),
    "publication_date": (
        "CASE WHEN k % 37 = 0 THEN '2026-02-31' ELSE date_format(o_orderdate, 'yyyy-MM-dd') END"
    ),
    "registration_deadline": (
        "CASE WHEN k % 5 != 0 THEN date_format("
        "date_add(cast(o_orderdate AS date), cast(k % 60 AS int) - 5), 'yyyy-MM-dd') END"
    ),
}


def raw_text(
    spark: SparkSession, sf_dir: str, orders: DataFrame | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """One dirty JSON record per order: ``row_number``, ``batch_id``, ``body``, and columns of ``orders`` to keep."""
    orders = spread(read(spark, sf_dir, "orders")) if orders is None else orders
    base = orders.selectExpr(
        "*",
        "o_orderkey AS k",
        "concat('  Ord-', CASE WHEN o_orderkey % 19 = 2 THEN o_orderkey - 2 ELSE o_orderkey END,"
        " ' ') AS ext",
    )
    fields = base.selectExpr(
        "k",
        "cast(substr(o_orderpriority, 1, 1) AS bigint) AS batch_id",
        *keep,
        *[f"{text} AS {name}" for name, text in RAW_FIELDS.items()],
    )
    flat = F.struct(*RAW_FIELDS)
    rest = [name for name in RAW_FIELDS if name != "external_id"]
    nested = F.struct(F.struct(F.col("external_id").alias("id")).alias("external"), *rest)
    numeric = F.struct(F.col("k").alias("external_id"), *rest)
    bad_title = F.struct(
        "external_id", F.col("k").alias("title"), *[n for n in rest if n != "title"]
    )
    body = (
        F.when(F.col("k") % 11 == 5, F.to_json(nested))
        .when(F.col("k") % 43 == 1, F.to_json(numeric))
        .when(F.col("k") % 53 == 1, F.to_json(bad_title))
        .otherwise(F.to_json(flat))
    )
    return fields.select(
        (F.col("k") + 1).alias("row_number"), "batch_id", body.alias("body"), *keep
    )


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_text(spark, sf_dir).select(
        "row_number", "batch_id", F.try_parse_json("body").alias("record")
    )


# --- Landed pages ------------------------------------------------------------------------

PAGE_SIZE = 4
DEFECT = (
    "CASE WHEN c % 11 = 3 THEN 'count' WHEN c % 13 = 5 THEN 'missing'"
    " WHEN c % 17 = 7 THEN 'items' WHEN c % 19 = 4 THEN 'boolean'"
    " WHEN c % 23 = 6 THEN 'changed' WHEN c % 29 = 8 THEN 'size'"
    " WHEN c % 31 = 9 THEN 'element' WHEN c % 37 = 10 THEN 'twice'"
    " WHEN c % 41 = 11 THEN 'shifted' ELSE 'none' END"
)


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run per customer, its orders in pages of four; some runs have a defect."""
    orders = read(spark, sf_dir, "orders").selectExpr("o_orderkey AS k", "o_custkey AS c")
    customer = Window.partitionBy("c")
    items = (
        orders.withColumn("pos", F.row_number().over(customer.orderBy("k")))
        .withColumn("n", F.count("*").over(customer))
        .withColumn("requested_page", F.expr(f"(pos - 1) div {PAGE_SIZE} + 1"))
    )
    pages = items.groupBy("c", "n", "requested_page").agg(
        F.array_sort(
            F.collect_list(F.struct("pos", F.concat(F.lit("Ord-"), "k").alias("external_id")))
        ).alias("items")
    )
    shaped = pages.selectExpr(
        "*",
        f"{DEFECT} AS defect",
        f"cast(ceil(n / {PAGE_SIZE}) AS bigint) AS pages",
        "to_json(items) AS listed",
    ).selectExpr(
        "c",
        "requested_page",
        "defect",
        "pages",
        "CASE WHEN defect = 'items' AND requested_page = 1 THEN '\"x\"'"
        " WHEN defect = 'element' AND requested_page = 1 THEN '[7]' ELSE listed END AS items",
        "CASE WHEN defect = 'boolean' AND requested_page = pages THEN 'true'"
        " WHEN defect = 'shifted' THEN cast(requested_page + 1 AS string)"
        " ELSE cast(requested_page AS string) END AS page",
        f"CASE WHEN defect = 'size' THEN 0 ELSE {PAGE_SIZE} END AS size",
        "CASE WHEN defect = 'changed' AND requested_page > 1 THEN pages + 5 ELSE pages END"
        " AS total_pages",
        "CASE WHEN defect = 'count' THEN n + 1 ELSE n END AS total_items",
    )
    copies = (
        "CASE WHEN defect = 'missing' AND requested_page = 2 THEN array()"
        " WHEN defect = 'twice' AND requested_page = 1 THEN array(1, 2) ELSE array(1) END"
    )
    return shaped.selectExpr(
        "2 * c + 2 AS source_id",
        "2 * c + 2 AS collection_run_id",
        "requested_page",
        "concat('{\"items\":', items, ',\"pagination\":{\"page\":', page, ',\"page_size\":', size,"
        " ',\"total_pages\":', total_pages, ',\"total_items\":', total_items, '}}') AS body",
        f"explode({copies}) AS copy",
    ).drop("copy")


def open_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running run per customer, for the landed pages."""
    rows = read(spark, sf_dir, "customer").selectExpr(
        "2 * c_custkey + 2 AS id",
        "2 * c_custkey + 2 AS source_id",
        "timestamp '2024-01-01 00:00:00' AS started_at",
    )
    return fit_table(rows, "collection_runs")


# --- Raw documents ---------------------------------------------------------------------------


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landing document per conversation: ``run_id`` and its JSON text; some unusable."""
    turns = read(spark, sf_dir, "conversations")
    record = F.struct(
        F.concat_ws("-", "conv_id", "turn").alias("external_id"),
        F.col("text").alias("title"),
        F.concat(F.lit("https://talk.example.com/"), "conv_id", F.lit("/"), "turn").alias("url"),
    )
    documents = turns.groupBy("conv_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("turn", record.alias("r")))), lambda x: x["r"]
        ).alias("records")
    )
    head = (
        "concat('{\"source_id\":', conv_id % 10, ',\"collection_run_id\":', conv_id,"
        " ',\"saved_at\":\"2026-07-29T08:00:00+00:00\",\"pages_fetched\":1,\"record_count\":',"
        " size(records), ',\"records\":',"
    )
    return documents.selectExpr(
        "conv_id AS run_id",
        f"""CASE WHEN conv_id % 7 = 3 THEN {head} '"none"}}')
            WHEN conv_id % 11 = 4 THEN {head} '[1]}}')
            WHEN conv_id % 13 = 5 THEN {head} to_json(records))
            ELSE {head} to_json(records), '}}') END AS value""",
    )


RECORDS_PER_FILE = 500
RECORDS_PER_TASK = 250_000


def write_raw_files(spark: SparkSession, sf_dir: str, root: str, files: str = "true") -> None:
    """The raw records as one JSON document for each 500 of them, in ``doc=<n>``; one in ten is cut short."""
    # Orders are dealt out by document as they are; their text, several times as long, is made after.
    orders = read(spark, sf_dir, "orders").withColumn("doc", F.expr(f"o_orderkey div {RECORDS_PER_FILE}")).where(files)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), orders.count() // RECORDS_PER_TASK)
    dealt = orders.repartition(n, "doc")
    documents = (
        raw_text(spark, sf_dir, dealt, ("doc",))
        .groupBy("doc")
        .agg(F.array_sort(F.collect_list(F.struct("row_number", "body"))).alias("rows"))
    )
    text = documents.selectExpr(
        "doc",
        "concat('{\"source_id\":1,\"collection_run_id\":', doc, ',\"saved_at\":\"2026-07-29T08:00:00+00:00\",'"
        " '\"pages_fetched\":1,\"record_count\":', size(rows), ',\"records\":[', array_join(rows.body, ','),"
        " CASE WHEN doc % 10 = 3 THEN '' ELSE ']}' END) AS value",
    )
    with shuffles_removed(spark):
        text.write.partitionBy("doc").text(root)

"""Every operator as a query over the mapped tables, with the same question in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake import functions as fn
from noticelake.operators import dedupe, history, lookups, maintenance, pages, positions, rules, runs
from noticelake.plans import export, ingest, load, reports, transform
from noticelake.schemas import CLEAN_COLUMNS, REJECT_COLUMNS
from noticelake.session import apply_settings, scratch_path
from noticelake.sources import commits, exports, landing, tables as stored
from noticelake.sources.landingset import LandingSet
from noticelake.sources.listinglog import ListingLog
from noticelake.sources.noticestore import NoticeStore
from workload import tables as t
from workload.sql import PAYLOADS, with_tables, with_transform

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(apply_settings(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def day(name: str, alias: str | None = None) -> Column:
    return fn.iso_text(F.col(name)).alias(alias or name)


def moment(name: str, alias: str | None = None) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(alias or name)


def sql_day(name: str, alias: str | None = None) -> str:
    return f"strftime({name}, '%Y-%m-%d') AS {alias or name.split('.')[-1]}"


def sql_moment(name: str, alias: str | None = None) -> str:
    return f"strftime({name}, '%Y-%m-%d %H:%M:%S.%f') AS {alias or name.split('.')[-1]}"


# --- Reports ------------------------------------------------------------------------------


@query(
    "report_notices_with_source",
    with_tables("t_sources", "t_notices")
    + f"""SELECT n.id, n.title, s.name AS source_name, n.status,
        {sql_day('n.registration_deadline')}
    FROM t_notices n JOIN t_sources s ON s.id = n.source_id""",
)
def _(spark, d):
    out = reports.notices_with_source(t.notices(spark, d), t.sources(spark, d))
    return out.withColumn("registration_deadline", day("registration_deadline"))


@query(
    "report_notice_categories",
    with_tables("t_notices", "t_links", "t_categories")
    + """SELECT n.title, string_agg(c.name, ', ' ORDER BY c.name) AS categories
    FROM t_notices n JOIN t_links l ON l.notice_id = n.id
    JOIN t_categories c ON c.id = l.category_id GROUP BY n.id, n.title""",
)
def _(spark, d):
    return reports.notice_categories_list(
        t.notices(spark, d), t.notice_categories(spark, d), t.categories(spark, d)
    )


@query(
    "report_notices_per_source",
    with_tables("t_sources", "t_notices")
    + """SELECT s.name, count(n.id) AS total_notices,
        count(n.id) FILTER (WHERE n.status = 'open') AS open_notices,
        count(n.id) FILTER (WHERE n.status = 'closed') AS closed_notices
    FROM t_sources s LEFT JOIN t_notices n ON n.source_id = s.id GROUP BY s.id, s.name""",
)
def _(spark, d):
    return reports.notices_per_source(t.sources(spark, d), t.notices(spark, d))


@query(
    "report_popular_categories",
    with_tables("t_categories", "t_links")
    + """SELECT c.name, count(l.notice_id) AS total_notices
    FROM t_categories c LEFT JOIN t_links l ON l.category_id = c.id
    GROUP BY c.id, c.name HAVING count(l.notice_id) >= 2""",
)
def _(spark, d):
    return reports.popular_categories(t.categories(spark, d), t.notice_categories(spark, d))


@query(
    "report_sources_above_average",
    with_tables("t_sources", "t_notices")
    + """SELECT s.name,
        (SELECT count(*) FROM t_notices n WHERE n.source_id = s.id) AS total_notices
    FROM t_sources s
    WHERE (SELECT count(*) FROM t_notices n WHERE n.source_id = s.id) >
        (SELECT avg(c) FROM (SELECT count(*) AS c FROM t_notices GROUP BY source_id))""",
)
def _(spark, d):
    return reports.sources_above_average(t.sources(spark, d), t.notices(spark, d))


@query(
    "report_collection_runs",
    with_tables("t_sources", "t_runs")
    + """SELECT s.name, r.status, r.records_found, r.records_inserted, r.records_updated,
        r.records_rejected,
        (epoch_us(r.finished_at) - epoch_us(r.started_at)) / 1e6 AS duration_seconds
    FROM t_runs r JOIN t_sources s ON s.id = r.source_id""",
)
def _(spark, d):
    return reports.run_report(t.collection_runs(spark, d), t.sources(spark, d))


@query(
    "report_open_notices",
    with_tables("t_notices")
    + f"""SELECT id, title, {sql_day('registration_deadline')}
    FROM t_notices WHERE status = 'open'""",
)
def _(spark, d):
    out = reports.open_notices(t.notices(spark, d))
    return out.withColumn("registration_deadline", day("registration_deadline"))


@query(
    "report_bundle_sizes",
    with_tables("t_sources", "t_notices", "t_runs", "t_categories", "t_links")
    + """SELECT 'notices_with_source' AS report, count(*) AS rows
        FROM t_notices n JOIN t_sources s ON s.id = n.source_id
    UNION ALL SELECT 'notice_categories', count(DISTINCT n.id) FROM t_notices n
        JOIN t_links l ON l.notice_id = n.id JOIN t_categories c ON c.id = l.category_id
    UNION ALL SELECT 'notices_per_source', count(*) FROM t_sources
    UNION ALL SELECT 'popular_categories', count(*) FROM (SELECT category_id FROM t_links
        GROUP BY category_id HAVING count(*) >= 2)
    UNION ALL SELECT 'sources_above_average', count(*) FROM (
        SELECT count(*) AS c FROM t_notices GROUP BY source_id) WHERE c > (SELECT avg(c) FROM (
        SELECT count(*) AS c FROM t_notices GROUP BY source_id))
    UNION ALL SELECT 'collection_runs', count(*) FROM t_runs r
        JOIN t_sources s ON s.id = r.source_id
    UNION ALL SELECT 'open_notices', count(*) FROM t_notices WHERE status = 'open'""",
)
def _(spark, d):
    parts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("report"), "rows")
        for name, df in reports.reports(t.all_tables(spark, d)).items()
    ]
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# --- Transform ------------------------------------------------------------------------------

VALID_SQL = f"""SELECT row_number, external_id, title, {sql_day('publication_date')},
    {sql_day('registration_deadline')}, url, status, content_hash FROM valid"""


def _valid_texts(valid: DataFrame, *extra: str) -> DataFrame:
    return valid.select(
        *extra,
        "row_number",
        "external_id",
        "title",
        day("publication_date"),
        day("registration_deadline"),
        "url",
        "status",
        "content_hash",
    )


@query("transform_valid", with_transform() + VALID_SQL)
def _(spark, d):
    return _valid_texts(transform.transform(t.raw_records(spark, d)).valid)


@query(
    "transform_valid_per_batch",
    with_transform("batch_id,") + VALID_SQL.replace("SELECT ", "SELECT batch_id, ", 1),
)
def _(spark, d):
    batch = transform.transform(t.raw_records(spark, d), within=["batch_id"])
    return _valid_texts(batch.valid, "batch_id")


@query(
    "transform_rejected",
    with_transform() + "SELECT row_number, external_id, reasons FROM tagged WHERE reasons <> ''",
)
def _(spark, d):
    rejected = transform.transform(t.raw_records(spark, d)).rejected
    return rejected.select(
        "row_number", "external_id", F.array_join("reasons", ",").alias("reasons")
    )


METRICS_SQL = """count(*) AS input_count,
    count(*) FILTER (WHERE reasons = '') AS valid_count,
    count(*) FILTER (WHERE reasons <> '') AS rejected_count,
    count(*) FILTER (WHERE is_duplicate) AS duplicate_count FROM tagged"""


@query("transform_metrics", with_transform() + "SELECT " + METRICS_SQL)
def _(spark, d):
    return transform.transform(t.raw_records(spark, d)).metrics


@query(
    "transform_metrics_per_batch",
    with_transform("batch_id,") + f"SELECT batch_id, {METRICS_SQL} GROUP BY batch_id",
)
def _(spark, d):
    return transform.transform(t.raw_records(spark, d), within=["batch_id"]).metrics


@query(
    "transform_reason_summary",
    with_transform()
    + """SELECT code, count(*) AS rows
    FROM (SELECT unnest(string_split(reasons, ',')) AS code FROM tagged WHERE reasons <> '')
    GROUP BY code""",
)
def _(spark, d):
    return transform.reason_summary(transform.transform(t.raw_records(spark, d)).tagged)


@query(
    "transform_reasons_by_row",
    with_transform() + "SELECT row_number, reasons, is_duplicate FROM tagged",
)
def _(spark, d):
    tagged = transform.tag_rejections(transform.flag_batch(t.raw_records(spark, d)))
    return tagged.select(
        "row_number", F.array_join("reasons", ",").alias("reasons"), "is_duplicate"
    )


@query(
    "raw_expected_fields",
    with_tables("raw")
    + """SELECT row_number, external_id, title, url, status, publication_date,
        registration_deadline, NULL::VARCHAR AS organization, status IS NOT NULL AS status_provided,
        registration_deadline IS NOT NULL AS registration_deadline_provided FROM raw""",
)
def _(spark, d):
    out = transform.project_expected(t.raw_records(spark, d), keep=["row_number"])
    return out.select(
        "row_number",
        "external_id",
        "title",
        "url",
        "status",
        "publication_date",
        "registration_deadline",
        "organization",
        "status_provided",
        "registration_deadline_provided",
    )


@query(
    "raw_clean_fields",
    with_tables("raw", "clean")
    + f"""SELECT row_number, external_id, external_key, title, url, status_text,
        {sql_day('publication_date')}, {sql_day('registration_deadline')} FROM clean""",
)
def _(spark, d):
    return transform.clean_records(t.raw_records(spark, d)).select(
        "row_number",
        "external_id",
        "external_key",
        "title",
        "url",
        "status_text",
        day("publication_date"),
        day("registration_deadline"),
    )


@query(
    "flag_duplicate_external_id",
    with_transform() + "SELECT row_number, dup_external_id FROM tagged",
)
def _(spark, d):
    keys = transform.batch_keys(t.raw_records(spark, d))
    return dedupe.flag_dup_external_id(keys).select("row_number", "dup_external_id")


@query("flag_duplicate_url", with_transform() + "SELECT row_number, dup_url FROM tagged")
def _(spark, d):
    keys = transform.batch_keys(t.raw_records(spark, d))
    return dedupe.flag_dup_url(keys).select("row_number", "dup_url")


@query(
    "flag_duplicates",
    with_transform()
    + "SELECT row_number, dup_external_id, dup_url, is_duplicate FROM tagged",
)
def _(spark, d):
    keys = transform.batch_keys(t.raw_records(spark, d))
    return dedupe.flag_duplicates(keys).select(
        "row_number", "dup_external_id", "dup_url", "is_duplicate"
    )


@query(
    "flag_duplicate_texts",
    """SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1 AS repeated
    FROM documents""",
)
def _(spark, d):
    documents = t.read(spark, d, "documents").select("doc_id", "text")
    return dedupe.flag_repeats(documents, {"repeated": "text"}, "doc_id").select(
        "doc_id", "repeated"
    )


# --- Landing and pages ------------------------------------------------------------------


def _documents_on_disk(spark: SparkSession, d: str) -> landing.Documents:
    """Write one file per raw document and read the files."""
    root = scratch_path(spark, "raw")
    documents = t.raw_documents(spark, d)
    documents.select("value").write.option("maxRecordsPerFile", 1).text(root)
    return landing.read_raw(spark, root, pattern="part-*")


DOCUMENTS_SQL = """WITH docs AS (SELECT conv_id, conv_id % 10 AS source_id, count(*) AS n,
    CASE WHEN conv_id % 7 = 3 THEN 'records_not_list' WHEN conv_id % 11 = 4
        THEN 'record_not_object' WHEN conv_id % 13 = 5 THEN 'not_json_object' ELSE 'ok' END AS code
    FROM conversations GROUP BY conv_id)"""


@query(
    "raw_documents_usable",
    DOCUMENTS_SQL
    + """ SELECT source_id, conv_id AS collection_run_id, n AS record_count, n AS found
    FROM docs WHERE code = 'ok'""",
)
def _(spark, d):
    usable = _documents_on_disk(spark, d).usable
    return usable.select("source_id", "collection_run_id", "record_count", "found")


@query(
    "raw_documents_unusable",
    DOCUMENTS_SQL + " SELECT code, count(*) AS files FROM docs WHERE code <> 'ok' GROUP BY code",
)
def _(spark, d):
    return _documents_on_disk(spark, d).unusable.groupBy("code").agg(F.count("*").alias("files"))


@query(
    "raw_documents_records",
    DOCUMENTS_SQL
    + """ SELECT d.conv_id AS collection_run_id,
        row_number() OVER (PARTITION BY d.conv_id ORDER BY c.turn) AS row_number,
        c.conv_id || '-' || c.turn AS external_id, c.text AS title
    FROM docs d JOIN conversations c ON c.conv_id = d.conv_id WHERE d.code = 'ok'""",
)
def _(spark, d):
    return _documents_on_disk(spark, d).records.select(
        "collection_run_id",
        "row_number",
        F.expr("variant_get(record, '$.external_id', 'string')").alias("external_id"),
        F.expr("variant_get(record, '$.title', 'string')").alias("title"),
    )


@query(
    "raw_latest_file",
    """SELECT user_id, 'run_' || arg_max(event_id, ts) || '.json' AS path
    FROM events GROUP BY user_id""",
)
def _(spark, d):
    files = t.read(spark, d, "events").select(
        "user_id",
        F.format_string("run_%d.json", "event_id").alias("path"),
        F.col("ts").alias("modified_at"),
    )
    return landing.latest_raw(files, by=["user_id"])


PAGE_ITEMS_SQL = """, items AS (SELECT 2 * o_custkey + 2 AS run_id, 'Ord-' || o_orderkey AS ext,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS row_number FROM orders)"""


@query(
    "page_problems",
    with_tables("runs_paged", "verdicts")
    + """SELECT run_id AS collection_run_id, p AS requested_page,
        CASE WHEN p <= pages THEN CASE
            WHEN defect = 'items' AND p = 1 THEN 'items_not_list'
            WHEN defect = 'element' AND p = 1 THEN 'item_not_object'
            WHEN defect = 'boolean' AND p = pages THEN 'page_not_integer'
            WHEN defect = 'size' THEN 'page_size_not_positive'
            WHEN defect = 'shifted' THEN 'page_mismatch' END END AS code
    FROM (SELECT *, unnest(generate_series(1, pages)) AS p FROM verdicts)
    WHERE NOT (defect = 'missing' AND p = 2)
    UNION ALL SELECT run_id, 1, NULL FROM verdicts WHERE defect = 'twice'""",
)
def _(spark, d):
    return pages.parse_pages(t.landed_pages(spark, d)).select(
        "collection_run_id", F.col("requested_page").cast("long").alias("requested_page"), "code"
    )


@query(
    "page_run_verdicts",
    with_tables("runs_paged", "verdicts")
    + "SELECT run_id AS collection_run_id, code FROM verdicts",
)
def _(spark, d):
    verdicts = pages.run_verdicts(pages.parse_pages(t.landed_pages(spark, d)))
    return verdicts.select("collection_run_id", F.coalesce("code", F.lit("ok")).alias("code"))


@query(
    "page_extraction_metrics",
    with_tables("runs_paged", "verdicts")
    + """SELECT run_id AS collection_run_id, pages AS pages_fetched, n AS total_items,
        n AS records_found FROM verdicts WHERE code = 'ok'""",
)
def _(spark, d):
    parsed = pages.parse_pages(t.landed_pages(spark, d))
    complete = pages.run_verdicts(parsed).where("code IS NULL").select(*pages.RUN)
    kept = parsed.join(complete, list(pages.RUN), "left_semi")
    return pages.extraction_metrics(kept).drop("source_id")


RECORDS_SQL = """SELECT v.run_id AS collection_run_id, i.row_number, i.ext AS external_id
    FROM verdicts v JOIN items i ON i.run_id = v.run_id WHERE v.code = 'ok'"""


def _page_records_sql(select: str) -> str:
    return with_tables("runs_paged", "verdicts").rstrip() + PAGE_ITEMS_SQL + select


def _record_ids(records: DataFrame) -> DataFrame:
    return records.select(
        "collection_run_id",
        F.col("row_number").cast("long").alias("row_number"),
        F.expr("variant_get(record, '$.external_id', 'string')").alias("external_id"),
    )


@query("page_records_in_order", _page_records_sql(RECORDS_SQL))
def _(spark, d):
    return _record_ids(ingest.ingest(t.landed_pages(spark, d), t.open_runs(spark, d)).records)


@query("ingest_landing_set", _page_records_sql(RECORDS_SQL))
def _(spark, d):
    root = scratch_path(spark, "landed")
    ingest.ingest(t.landed_pages(spark, d), t.open_runs(spark, d), root)
    return _record_ids(landing.read_landed(spark, root))


@query("ingest_store_records", ORACLES["ingest_landing_set"])
def _(spark, d):
    store = LandingSet(spark, scratch_path(spark, "landing_set"))
    return _record_ids(ingest.ingest_into(store, t.landed_pages(spark, d), t.open_runs(spark, d)).records)


@query(
    "ingest_latest_run",
    with_tables("runs_paged", "verdicts")
    + "SELECT run_id AS source_id, run_id AS collection_run_id FROM verdicts WHERE code = 'ok'",
)
def _(spark, d):
    root = scratch_path(spark, "landed")
    ingest.ingest(t.landed_pages(spark, d), t.open_runs(spark, d), root)
    return landing.latest_landed(landing.read_landed(spark, root))


@query(
    "ingest_closed_runs",
    with_tables("runs_paged", "verdicts")
    + """SELECT 2 * c.c_custkey + 2 AS id,
        CASE WHEN code IS NULL THEN 'running' WHEN code = 'ok' THEN 'success' ELSE 'failed' END
            AS status,
        CASE WHEN code = 'ok' THEN n ELSE 0 END AS records_found,
        CASE WHEN code <> 'ok' THEN CASE code WHEN 'page_missing' THEN 'DataExtractionError: '
            ELSE 'InvalidAPIResponseError: ' END || CASE code
            WHEN 'count_mismatch' THEN
                'A quantidade recebida não corresponde ao total informado pela API.'
            WHEN 'page_missing' THEN 'A página não pôde ser obtida.'
            WHEN 'items_not_list' THEN 'O campo ''items'' deve ser uma lista.'
            WHEN 'page_not_integer' THEN 'O campo ''page'' deve ser inteiro.'
            WHEN 'total_pages_changed' THEN 'O total de páginas mudou durante a extração.'
            WHEN 'page_size_not_positive' THEN 'O tamanho da página deve ser positivo.'
            WHEN 'item_not_object' THEN 'Cada item da resposta deve ser um objeto JSON.'
            WHEN 'page_repeated' THEN 'A página foi gravada mais de uma vez.'
            WHEN 'page_mismatch' THEN
                'A API retornou a página 2, mas a página 1 foi solicitada.' END
            END AS error_message
    FROM customer c LEFT JOIN verdicts v ON v.run_id = 2 * c.c_custkey + 2""",
)
def _(spark, d):
    return _closed(ingest.ingest(t.landed_pages(spark, d), t.open_runs(spark, d)).runs)


def _closed(runs: DataFrame) -> DataFrame:
    return runs.select(
        "id", "status", F.col("records_found").cast("long").alias("records_found"), "error_message"
    )


@query("ingest_store_runs", ORACLES["ingest_closed_runs"])
def _(spark, d):
    store = LandingSet(spark, scratch_path(spark, "landing_set"))
    ingest.ingest_into(store, t.landed_pages(spark, d), t.open_runs(spark, d))
    # Again, with the runs table that was committed: nothing runs any more, so nothing changes.
    ingest.ingest_into(store, t.landed_pages(spark, d))
    return _closed(store.runs())


@query(
    "assign_pages",
    """SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 50 + 1
        AS page, 50 AS page_size, count(*) OVER () AS total_items,
        greatest(1, ceil(count(*) OVER () / 50.0)::BIGINT) AS total_pages FROM orders""",
)
def _(spark, d):
    orders = t.read(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return positions.assign_pages(orders, ["o_orderdate", "o_orderkey"], 50).drop("o_orderdate")


# --- Exports -------------------------------------------------------------------------------


def _payload(df: DataFrame) -> DataFrame:
    return df.drop("raw_payload")


@query(
    "export_valid_csv",
    with_transform()
    + f"""SELECT external_id, title, NULL::VARCHAR AS organization,
        NULL::VARCHAR AS notice_number, {sql_day('publication_date')},
        {sql_day('registration_deadline')}, url, status, content_hash FROM valid""",
)
def _(spark, d):
    path = scratch_path(spark, "valid")
    exports.export_valid(transform.transform(t.raw_records(spark, d)).valid, path)
    return _payload(exports.read_export(spark, path, CLEAN_COLUMNS))


REASONS_SQL = """array_to_string(list_transform(string_split(reasons, ','), lambda c: CASE c
    WHEN 'title_missing' THEN 'Título ausente ou inválido.'
    WHEN 'url_invalid' THEN 'URL ausente ou inválida.'
    WHEN 'status_invalid' THEN 'Status inválido.'
    WHEN 'publication_date_invalid' THEN 'Data de publicação inválida.'
    WHEN 'deadline_invalid' THEN 'Prazo de inscrição inválido.'
    WHEN 'deadline_before_publication' THEN
        'O prazo de inscrição não pode ser anterior à data de publicação.'
    WHEN 'duplicate_in_batch' THEN 'Registro duplicado dentro do lote.' END), ' | ')"""


@query(
    "export_rejected_csv",
    with_transform()
    + f"""SELECT CAST(row_number AS VARCHAR) AS row_number, external_id, {REASONS_SQL} AS reasons
    FROM tagged WHERE reasons <> ''""",
)
def _(spark, d):
    path = scratch_path(spark, "rejected")
    exports.export_rejected(transform.transform(t.raw_records(spark, d)).rejected, path)
    return _payload(exports.read_export(spark, path, REJECT_COLUMNS))


@query(
    "export_landed_runs",
    _page_records_sql(
        """SELECT v.run_id AS collection_run_id, i.n AS input_count, CAST(0 AS BIGINT) AS valid_count,
        i.n AS rejected_count, CAST(0 AS BIGINT) AS duplicate_count
    FROM verdicts v JOIN (SELECT run_id, count(*) AS n FROM items GROUP BY run_id) i
        ON i.run_id = v.run_id WHERE v.code = 'ok'"""
    ),
)
def _(spark, d):
    root, out = scratch_path(spark, "landed"), scratch_path(spark, "exports")
    ingest.ingest(t.landed_pages(spark, d), t.open_runs(spark, d), root)
    return export.transform_landed(spark, root, out).metrics.drop("source_id")


# Documents of 500 records, each a batch of its own; one in ten is cut short.
_DOC = f"(row_number - 1) // {t.RECORDS_PER_FILE}"
RAW_FILES_SQL = with_transform(f"{_DOC},", payloads=PAYLOADS)


def _raw_files_exported(spark: SparkSession, d: str) -> export.Exported:
    root, out = scratch_path(spark, "raw_files"), scratch_path(spark, "exports")
    t.write_raw_files(spark, d, root)
    return export.transform_and_export(spark, root, out, latest_only=False, pattern="part-*")


@query(
    "export_raw_files",
    RAW_FILES_SQL
    + f"""SELECT 'valid' AS kind, NULL::VARCHAR AS row_number, external_id, title,
        {sql_day('publication_date')}, {sql_day('registration_deadline')}, url, status, content_hash,
        NULL::VARCHAR AS reasons, raw_payload
    FROM valid JOIN payloads USING (row_number) WHERE {_DOC} % 10 <> 3
    UNION ALL
    SELECT 'rejected', CAST((row_number - 1) % {t.RECORDS_PER_FILE} + 1 AS VARCHAR), external_id, NULL, NULL, NULL,
        NULL, NULL, NULL, {REASONS_SQL}, raw_payload
    FROM tagged JOIN payloads USING (row_number) WHERE reasons <> '' AND {_DOC} % 10 <> 3""",
)
def _(spark, d):
    done = _raw_files_exported(spark, d)
    valid = exports.read_export(spark, done.valid_path, CLEAN_COLUMNS).drop("organization", "notice_number")
    rejected = exports.read_export(spark, done.rejected_path, REJECT_COLUMNS)
    return (
        valid.withColumn("kind", F.lit("valid"))
        .unionByName(rejected.withColumn("kind", F.lit("rejected")), allowMissingColumns=True)
    )


@query(
    "export_raw_files_metrics",
    RAW_FILES_SQL
    + f"""SELECT CAST({_DOC} AS VARCHAR) AS doc, count(*) AS input_count,
        count(*) FILTER (WHERE reasons = '') AS valid_count, count(*) FILTER (WHERE reasons <> '') AS rejected_count,
        count(*) FILTER (WHERE is_duplicate) AS duplicate_count, NULL::VARCHAR AS code
    FROM tagged WHERE {_DOC} % 10 <> 3 GROUP BY {_DOC}
    UNION ALL
    SELECT DISTINCT CAST({_DOC} AS VARCHAR), NULL::BIGINT, NULL::BIGINT, NULL::BIGINT, NULL::BIGINT, 'not_json_object'
    FROM raw WHERE {_DOC} % 10 = 3""",
)
def _(spark, d):
    done = _raw_files_exported(spark, d)
    doc = F.regexp_extract("path", r"doc=(\d+)/", 1).alias("doc")
    counted = done.metrics.select(doc, "input_count", "valid_count", "rejected_count", "duplicate_count")
    return counted.unionByName(done.unusable.select(doc, "code"), allowMissingColumns=True)


@query(
    "raw_latest_file_listed",
    f"""SELECT DISTINCT doc, CASE WHEN doc % 3 = 0 THEN 'later' ELSE 'first' END AS written
    FROM (SELECT o_orderkey // {t.RECORDS_PER_FILE} AS doc FROM orders)""",
)
def _(spark, d):
    root = scratch_path(spark, "raw_files")
    t.write_raw_files(spark, d, f"{root}/first")
    t.write_raw_files(spark, d, f"{root}/later", "doc % 3 = 0")
    listed = landing.list_raw(spark, root, pattern="part-*")
    doc = F.regexp_extract("path", r"doc=(\d+)/", 1).cast("long")
    newest = landing.latest_raw(listed.withColumn("doc", doc), by=["doc"])
    return newest.select("doc", F.regexp_extract("path", r"/(first|later)/", 1).alias("written"))


@query(
    "raw_files_discovered",
    f"""SELECT DISTINCT doc, CASE WHEN doc % 3 = 0 THEN 1 WHEN doc % 3 = 1 THEN 2 ELSE 3 END AS found_by,
        CASE WHEN doc % 3 = 2 THEN 'day-2' ELSE 'day-1' END AS folder
    FROM (SELECT o_orderkey // {t.RECORDS_PER_FILE} AS doc FROM orders)""",
)
def _(spark, d):
    root = scratch_path(spark, "raw_days")
    log = ListingLog(spark, scratch_path(spark, "raw_days_log"), root, pattern="part-*")
    # A folder that fills in two steps, then the next one.
    for n, folder in enumerate(("day-1/a", "day-1/b", "day-2/a")):
        t.write_raw_files(spark, d, f"{root}/{folder}", f"doc % 3 = {n}")
        log.commit(log.look())
    # The log says by which commit each file was found.
    parts = commits.history(spark, log.log).select("version", F.get_json_object("entry", "$.part").alias("part"))
    found = log.files().withColumn("part", F.regexp_extract("_metadata.file_path", r"(files/[0-9a-f]+)/", 1))
    doc = F.regexp_extract("path", r"doc=(\d+)/", 1).cast("long").alias("doc")
    return found.join(parts, "part").select(doc, F.col("version").cast("int").alias("found_by"), "folder")


# --- Stored tables, lookups and listings -------------------------------------------------------


@query(
    "tables_stored_and_loaded",
    with_tables("t_sources", "t_notices", "t_runs", "t_categories", "t_links")
    + """SELECT 'sources' AS name, count(*) AS rows, CAST(sum(id) AS BIGINT) AS ids FROM t_sources
    UNION ALL SELECT 'collection_runs', count(*), CAST(sum(id) AS BIGINT) FROM t_runs
    UNION ALL SELECT 'notices', count(*), CAST(sum(id) AS BIGINT) FROM t_notices
    UNION ALL SELECT 'categories', count(*), CAST(sum(id) AS BIGINT) FROM t_categories
    UNION ALL SELECT 'notice_categories', count(*), CAST(sum(notice_id) AS BIGINT) FROM t_links""",
)
def _(spark, d):
    root = scratch_path(spark, "tables")
    stored.save_tables(t.all_tables(spark, d), root)
    parts = [
        df.agg(
            F.lit(name).alias("name"),
            F.count("*").alias("rows"),
            F.sum(df.columns[0]).alias("ids"),
        )
        for name, df in stored.load_tables(spark, root).items()
    ]
    return _union(parts)


_STORED = {
    "sources": ("t_sources", ("id", "name", "base_url", "source_type", "terms_url")),
    "collection_runs": ("t_runs", ("id", "source_id", "status", "records_found", "records_rejected", "error_message")),
    "notices": ("t_notices", ("id", "source_id", "external_id", "title", "url", "status", "content_hash", "raw_payload")),
    "categories": ("t_categories", ("id", "name")),
    "notice_categories": ("t_links", ("notice_id", "category_id")),
}


def _stored_sql(name: str, view: str, columns: tuple[str, ...]) -> str:
    texts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns)
    return f"SELECT '{name}' AS name, concat_ws('|', {texts}) AS content FROM {view}"


@query(
    "tables_loaded_rows",
    with_tables("t_sources", "t_notices", "t_runs", "t_categories", "t_links")
    + " UNION ALL ".join(_stored_sql(name, *of) for name, of in _STORED.items()),
)
def _(spark, d):
    root = scratch_path(spark, "tables")
    stored.save_tables(t.all_tables(spark, d), root)
    found = stored.load_tables(spark, root)
    texts = {
        name: [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns] for name, (_, columns) in _STORED.items()
    }
    return _union([found[n].select(F.lit(n).alias("name"), F.concat_ws("|", *c).alias("content")) for n, c in texts.items()])


@query(
    "inline_status_labels",
    with_tables("t_notices")
    + """SELECT v.label, count(n.id) AS notices
    FROM (VALUES ('open', 'Aberto'), ('closed', 'Encerrado'), ('cancelled', 'Cancelado'))
        AS v(status, label) LEFT JOIN t_notices n ON n.status = v.status GROUP BY v.label""",
)
def _(spark, d):
    rows = [("open", "Aberto"), ("closed", "Encerrado"), ("cancelled", "Cancelado")]
    labels = stored.inline(spark, rows, "status string, label string")
    counts = t.notices(spark, d).groupBy("status").agg(F.count("id").alias("notices"))
    return labels.join(counts, "status", "left").select(
        "label", F.coalesce("notices", F.lit(0)).alias("notices")
    )


@query(
    "lookup_by_id",
    with_tables("t_notices")
    + """SELECT w.id, coalesce(n.title, '') AS title, n.id IS NOT NULL AS found
    FROM (SELECT DISTINCT l_orderkey * 3 AS id FROM lineitem) w
    LEFT JOIN t_notices n ON n.id = w.id""",
)
def _(spark, d):
    ids = t.read(spark, d, "lineitem").select((F.col("l_orderkey") * 3).alias("id")).distinct()
    return lookups.lookup_by_id(t.notices(spark, d), ids).select(
        "id", F.coalesce("title", F.lit("")).alias("title"), "found"
    )


@query(
    "lookup_by_name",
    with_tables("t_sources")
    + """SELECT s.id, s.name FROM t_sources s
    JOIN (SELECT DISTINCT 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS name
        FROM events) w ON w.name = s.name""",
)
def _(spark, d):
    names = t.read(spark, d, "events").select(
        F.format_string("  Customer#%09d\t", "user_id").alias("name")
    )
    return lookups.lookup_by_name(t.sources(spark, d), names).select("id", "name")


@query(
    "list_all_categories",
    with_tables("t_categories") + "SELECT id, name FROM t_categories",
)
def _(spark, d):
    return lookups.list_all(t.categories(spark, d), collation="UNICODE").select("id", "name")


@query(
    "list_runs_of_source",
    with_tables("t_runs")
    + """SELECT id, status FROM t_runs WHERE source_id = 20
    ORDER BY started_at DESC, id DESC LIMIT 5""",
)
def _(spark, d):
    return lookups.list_by_source(t.collection_runs(spark, d), 20, 5).select("id", "status")


@query(
    "latest_runs_per_source",
    with_tables("t_runs")
    + """SELECT source_id, id, recency FROM (SELECT *, row_number() OVER (
        PARTITION BY source_id ORDER BY started_at DESC, id DESC) AS recency FROM t_runs)
    WHERE recency <= 3""",
)
def _(spark, d):
    latest = lookups.latest_runs(t.collection_runs(spark, d), 3)
    return latest.select("source_id", "id", F.col("recency").cast("long").alias("recency"))


# --- Scalar functions ------------------------------------------------------------------------


@query(
    "fn_trim",
    """SELECT doc_id, trim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ' ||
        chr(133) || chr(160)) AS trimmed FROM documents""",
)
def _(spark, d):
    return t.read(spark, d, "documents").select(
        "doc_id", fn.clean_trim(F.col("text")).alias("trimmed")
    )


@query(
    "fn_squeeze",
    r"""SELECT doc_id, nullif(trim(regexp_replace(text, '[\s\x{a0}\x{85}\x0b]+', ' ', 'g')), '')
        AS squeezed FROM documents""",
)
def _(spark, d):
    return t.read(spark, d, "documents").select(
        "doc_id", fn.squeeze(F.col("text")).alias("squeezed")
    )


@query("fn_nfkc", "SELECT doc_id, nfc_normalize(text) AS form FROM documents")
def _(spark, d):
    return t.read(spark, d, "documents").select("doc_id", fn.nfkc(F.col("text")).alias("form"))


@query(
    "fn_normalize_text",
    r"""SELECT conv_id, turn, nullif(trim(regexp_replace(nfc_normalize(text),
        '[\s\x{a0}\x{85}\x0b]+', ' ', 'g')), '') AS form FROM conversations""",
)
def _(spark, d):
    return t.read(spark, d, "conversations").select(
        "conv_id", "turn", fn.normalize_text(F.col("text")).alias("form")
    )


@query(
    "fn_casefold",
    "SELECT doc_id, replace(lower(nfc_normalize(text)), 'ß', 'ss') AS folded FROM documents",
)
def _(spark, d):
    return t.read(spark, d, "documents").select(
        "doc_id", fn.casefold(F.col("text")).alias("folded")
    )


@query(
    "fn_normalize_status",
    "SELECT p_partkey, lower(trim(p_type)) AS status FROM part",
)
def _(spark, d):
    padded = F.concat(F.lit(" \t"), "p_type", F.lit("  "))
    return t.read(spark, d, "part").select(
        "p_partkey", fn.normalize_status(padded).alias("status")
    )


@query(
    "fn_canonical_url",
    r"""SELECT page_id, 'https://' || lower(regexp_extract(url, '://([^/?#]+)', 1)) ||
        CASE WHEN path IN ('', '/') THEN '/' ELSE regexp_replace(path, '/+$', '') END ||
        CASE WHEN q <> '' THEN '?' || q ELSE '' END AS canonical
    FROM (SELECT page_id, url, regexp_extract(url, '://[^/?#]+([^?#]*)', 1) AS path,
        regexp_extract(url, '\?([^#]*)', 1) AS q FROM pages) WHERE url LIKE 'https://%'
    UNION ALL SELECT page_id, 'http://' || lower(regexp_extract(url, '://([^/?#]+)', 1)) ||
        CASE WHEN path IN ('', '/') THEN '/' ELSE regexp_replace(path, '/+$', '') END ||
        CASE WHEN q <> '' THEN '?' || q ELSE '' END AS canonical
    FROM (SELECT page_id, url, regexp_extract(url, '://[^/?#]+([^?#]*)', 1) AS path,
        regexp_extract(url, '\?([^#]*)', 1) AS q FROM pages) WHERE url NOT LIKE 'https://%'""",
)
def _(spark, d):
    shouted = F.regexp_replace("url", "example", "EXAMPLE")
    shouted = F.regexp_replace(shouted, "^http", "HTTP")
    return t.read(spark, d, "pages").select("page_id", fn.canonical_url(shouted).alias("canonical"))


@query(
    "fn_http_prefix",
    with_tables("t_sources")
    + """SELECT id, base_url LIKE 'http://%' OR base_url LIKE 'https://%' AS ok FROM t_sources""",
)
def _(spark, d):
    return t.sources(spark, d).select("id", fn.has_http_prefix(F.col("base_url")).alias("ok"))


@query(
    "fn_parse_iso_date",
    """SELECT o_orderkey, strftime(CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN NULL
        WHEN 2 THEN NULL ELSE CAST(o_orderdate AS DATE) END, '%Y-%m-%d') AS day FROM orders""",
)
def _(spark, d):
    text = F.expr(
        "CASE o_orderkey % 6 WHEN 0 THEN date_format(o_orderdate, 'yyyyMMdd')"
        " WHEN 1 THEN date_format(o_orderdate, 'yyyy-MM') WHEN 2 THEN '2026-02-31'"
        " WHEN 3 THEN date_format(o_orderdate, 'yyyy-M-d')"
        " ELSE date_format(o_orderdate, 'yyyy-MM-dd') END"
    )
    return t.read(spark, d, "orders").select(
        "o_orderkey", fn.iso_text(fn.parse_iso_date(text)).alias("day")
    )


@query(
    "fn_deadline_ok",
    with_tables("raw", "clean")
    + """SELECT row_number, coalesce(registration_deadline >= publication_date, true) AS ok
    FROM clean""",
)
def _(spark, d):
    clean = transform.clean_records(t.raw_records(spark, d))
    ok = fn.deadline_ok(F.col("publication_date"), F.col("registration_deadline"))
    return clean.select("row_number", ok.alias("ok"))


@query(
    "fn_run_duration",
    with_tables("t_runs")
    + """SELECT id, (epoch_us(finished_at) - epoch_us(started_at)) / 1e6 AS seconds,
        finished_at IS NOT NULL AS finished FROM t_runs""",
)
def _(spark, d):
    return t.collection_runs(spark, d).select(
        "id",
        fn.duration_seconds(F.col("started_at"), F.col("finished_at")).alias("seconds"),
        fn.is_finished(F.col("finished_at")).alias("finished"),
    )


@query(
    "fn_greatest",
    with_tables("t_runs")
    + f"SELECT id, {sql_moment('greatest(started_at, finished_at)', 'later')} FROM t_runs",
)
def _(spark, d):
    later = t.collection_runs(spark, d).withColumn("later", F.greatest("started_at", "finished_at"))
    return later.select("id", moment("later"))


@query(
    "fn_content_hash",
    with_tables("t_notices")
    + """SELECT id, sha256('{"external_id":"' || coalesce(external_id, '') ||
        '","notice_number":"' || notice_number || '","organization":"' || organization ||
        '","publication_date":"' || strftime(publication_date, '%Y-%m-%d') ||
        '","registration_deadline":"' ||
        coalesce(strftime(registration_deadline, '%Y-%m-%d'), '') || '","status":"' || status ||
        '","title":"' || title || '","url":"' || url || '"}') AS hash FROM t_notices""",
)
def _(spark, d):
    return t.notices(spark, d).select("id", fn.content_hash().alias("hash"))


@query(
    "fn_payload_json",
    """SELECT event_id, '{"a":"' || event_type || '","k":' || json_extract_string(props, '$.k')
        || '}' AS payload FROM events""",
)
def _(spark, d):
    text = F.concat(
        F.lit('{"k" : '),
        F.get_json_object("props", "$.k"),
        F.lit(', "a" : "'),
        F.col("event_type"),
        F.lit('"}'),
    )
    return t.read(spark, d, "events").select(
        "event_id", fn.payload_json(fn.parse_payload(text)).alias("payload")
    )


@query(
    "fn_json_integer",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
        false AS fraction_is_integer FROM events""",
)
def _(spark, d):
    root = fn.parse_payload(F.col("props"))
    fraction = fn.parse_payload(F.concat(F.format_number("value", 1), F.lit("5e0")))
    return t.read(spark, d, "events").select(
        "event_id",
        fn.json_int(F.try_variant_get(root, "$.k", "variant")).alias("k"),
        fn.json_int(fraction).isNotNull().alias("fraction_is_integer"),
    )


@query(
    "fn_utc_stamp",
    "SELECT event_id, strftime(ts, '%Y%m%dT%H%M%SZ') AS stamp FROM events",
)
def _(spark, d):
    utc = F.to_timestamp_ltz(F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("Z")))
    return t.read(spark, d, "events").select("event_id", fn.utc_stamp(utc).alias("stamp"))


@query(
    "fn_error_text",
    "SELECT event_id, event_type || ': ' || props AS message FROM events",
)
def _(spark, d):
    return t.read(spark, d, "events").select(
        "event_id", fn.error_text(F.col("event_type"), F.col("props")).alias("message")
    )


@query(
    "fn_literals",
    """SELECT o_orderkey, repeat(lower(o_orderstatus), 64) AS filler,
        o_orderdate >= DATE '1998-01-01' AS recent,
        epoch_us(TIMESTAMP '2026-07-29 11:00:00') AS zoned FROM orders""",
)
def _(spark, d):
    return t.read(spark, d, "orders").select(
        "o_orderkey",
        F.repeat(F.lower("o_orderstatus"), 64).alias("filler"),
        (F.col("o_orderdate") >= F.expr("DATE '1998-01-01'")).alias("recent"),
        F.expr("unix_micros(TIMESTAMP '2026-07-29 08:00:00-03')").alias("zoned"),
    )


@query(
    "status_membership_and_default",
    with_tables("raw", "clean")
    + """SELECT row_number, coalesce(status_text IN
        ('unknown', 'open', 'closed', 'suspended', 'cancelled'), false) AS allowed,
        coalesce(status_text, 'unknown') AS status FROM clean""",
)
def _(spark, d):
    from noticelake.schemas import DEFAULT_STATUS, NOTICE_STATUSES

    text = F.col("status_text")
    return transform.clean_records(t.raw_records(spark, d)).select(
        "row_number",
        fn.is_allowed(text, NOTICE_STATUSES).alias("allowed"),
        fn.fill_default(text, DEFAULT_STATUS).alias("status"),
    )


# --- Rules -------------------------------------------------------------------------------------


@query(
    "rules_sources",
    with_tables("t_sources")
    + """SELECT id, 'base_url_invalid' AS code FROM t_sources WHERE base_url NOT LIKE 'http%://%'
    UNION ALL SELECT id, 'policy_date_missing' FROM t_sources
        WHERE collection_allowed AND policy_checked_at IS NULL
    UNION ALL SELECT id, 'source_type_invalid' FROM t_sources WHERE source_type = 'mail'""",
)
def _(spark, d):
    return rules.violations(t.sources(spark, d), rules.source_rules(), ["id"])


@query(
    "rules_categories",
    """SELECT doc_id AS id, 'name_too_long' AS code FROM documents WHERE length(trim(text, chr(9)
        || chr(10) || chr(11) || chr(12) || chr(13) || ' ' || chr(133) || chr(160))) > 100
    UNION ALL SELECT doc_id, 'name_blank' FROM documents WHERE trim(text, chr(9)
        || chr(10) || chr(11) || chr(12) || chr(13) || ' ' || chr(133) || chr(160)) = ''""",
)
def _(spark, d):
    named = t.read(spark, d, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("name")
    )
    return rules.violations(named, rules.category_rules(), ["id"])


@query(
    "rules_runs",
    with_tables("t_runs")
    + """SELECT id, 'count_negative' AS code FROM t_runs WHERE records_found < 5
    UNION ALL SELECT id, 'finished_before_started' FROM t_runs
        WHERE finished_at < started_at + INTERVAL 10 SECOND""",
)
def _(spark, d):
    shifted = (
        t.collection_runs(spark, d)
        .withColumn("records_found", F.col("records_found") - 5)
        .withColumn("started_at", F.expr("started_at + INTERVAL 10 SECOND"))
    )
    return rules.violations(shifted, rules.run_rules(), ["id"])


@query(
    "rules_notices",
    """SELECT id, code FROM (SELECT o_orderkey + 1 AS id, CASE WHEN o_orderstatus = 'P'
        THEN 'status_invalid' END AS code FROM orders
    UNION ALL SELECT o_orderkey + 1, CASE WHEN o_orderkey % 60 < 5 AND o_orderkey % 5 <> 0
        THEN 'deadline_before_publication' END FROM orders
    UNION ALL SELECT o_orderkey + 1, CASE WHEN o_orderkey % 2 = 0
        THEN 'last_seen_before_first' END FROM orders) WHERE code IS NOT NULL""",
)
def _(spark, d):
    bent = (
        t.notices(spark, d)
        .withColumn("status", F.expr("CASE status WHEN 'unknown' THEN 'paused' ELSE status END"))
        .withColumn("publication_date", F.date_add("publication_date", 5))
        .withColumn(
            "first_seen_at",
            F.expr("CASE WHEN id % 2 = 1 THEN first_seen_at + INTERVAL 2 DAY ELSE first_seen_at END"),
        )
    )
    return rules.violations(bent, rules.notice_rules(), ["id"])


@query(
    "rules_required_and_length",
    with_tables("t_notices")
    + """SELECT id, 'organization_too_long' AS code FROM t_notices
        WHERE length(repeat(organization, 30)) > 255
    UNION ALL SELECT id, 'title_null' FROM t_notices WHERE external_id IS NULL
    UNION ALL SELECT id, 'content_hash_too_long' FROM t_notices WHERE status = 'open'""",
)
def _(spark, d):
    bent = (
        t.notices(spark, d)
        .withColumn("organization", F.repeat("organization", 30))
        .withColumn("title", F.when(F.col("external_id").isNotNull(), F.col("title")))
        .withColumn(
            "content_hash",
            F.expr("CASE WHEN status = 'open' THEN concat(content_hash, 'x') ELSE content_hash END"),
        )
    )
    limits = [*rules.required_rules("notices"), *rules.length_rules("notices")]
    return rules.violations(bent, limits, ["id"])


@query(
    "rules_unique_text",
    "SELECT text, count(*) AS holders FROM documents GROUP BY text HAVING count(*) > 1",
)
def _(spark, d):
    return rules.unique_violations(t.read(spark, d, "documents").select("text"), ["text"])


@query(
    "rules_unique_keys",
    with_tables("t_notices")
    + """SELECT 'source_id,external_id' AS key_columns, '{"source_id":' || source_id ||
        ',"external_id":"E-' || (id % 7) || '"}' AS key_value, count(*) AS holders
    FROM t_notices WHERE external_id IS NOT NULL GROUP BY source_id, id % 7 HAVING count(*) > 1
    UNION ALL SELECT 'source_id,url', '{"source_id":' || source_id ||
        ',"url":"u' || (id % 5) || '"}', count(*)
    FROM t_notices GROUP BY source_id, id % 5 HAVING count(*) > 1""",
)
def _(spark, d):
    bent = (
        t.notices(spark, d)
        .withColumn("external_id", F.expr("nvl2(external_id, concat('E-', id % 7), NULL)"))
        .withColumn("url", F.expr("concat('u', id % 5)"))
    )
    return rules.table_unique_violations(bent, "notices")


@query(
    "orphan_runs",
    with_tables("t_sources", "t_runs")
    + """SELECT id, source_id * 11 AS source_id FROM t_runs
    WHERE source_id * 11 NOT IN (SELECT id FROM t_sources)""",
)
def _(spark, d):
    bent = t.collection_runs(spark, d).withColumn("source_id", F.col("source_id") * 11)
    return rules.orphans(bent, "source_id", t.sources(spark, d)).select("id", "source_id")


@query(
    "orphan_notice_runs",
    with_tables("t_runs", "t_notices")
    + """SELECT id FROM t_notices WHERE last_collection_run_id * 37 IS NOT NULL
    AND last_collection_run_id * 37 NOT IN (SELECT id FROM t_runs)""",
)
def _(spark, d):
    bent = t.notices(spark, d).withColumn(
        "last_collection_run_id", F.col("last_collection_run_id") * 37
    )
    return rules.orphans(bent, "last_collection_run_id", t.collection_runs(spark, d)).select("id")


# --- Table maintenance ---------------------------------------------------------------------------

UPSERT_SQL = {
    "incoming": """
        SELECT o_orderkey + 1 AS row_number, 2 * o_custkey + 2 AS source_id,
            CASE WHEN o_orderkey % 47 = 3 THEN 'SAME' WHEN o_orderkey % 6 = 1 THEN 'NEW-' || o_orderkey
                WHEN o_orderkey % 13 <> 0 THEN 'ORD-' || o_orderkey END AS external_id,
            CASE WHEN o_orderkey % 97 <> 5 THEN 'Changed ' || o_orderkey END AS title,
            'Desk ' || (o_orderkey % 9) AS organization,
            CASE WHEN o_orderkey % 61 = 2 THEN repeat('9', 101) ELSE 'N' || o_orderkey END
                AS notice_number,
            CASE WHEN o_orderkey % 5 = 0 THEN 'https://portal.example.com/fresh/' || o_orderkey
                WHEN o_orderkey % 7 = 1 THEN 'https://portal.example.com/notices/same'
                ELSE 'https://portal.example.com/notices/' || o_orderkey END AS url,
            CASE WHEN o_orderkey % 89 = 7 THEN 'pending' ELSE 'open' END AS status,
            CASE WHEN o_orderkey % 53 = 9 THEN 'v2-same' WHEN o_orderkey % 4 = 0
                THEN 'v1-' || o_orderkey ELSE 'v2-' || o_orderkey END AS hash_text,
            o_orderdate + (o_orderkey % 3) * INTERVAL 1 DAY AS seen_at,
            CAST(o_orderdate AS DATE) + CASE WHEN o_orderkey % 83 = 11 THEN -1 ELSE 30 END
                AS registration_deadline,
            CAST(o_orderdate AS DATE) AS publication_date, '{"n":' || o_orderkey || '}' AS raw_payload
        FROM orders""",
    "ranked": "SELECT *, sha256(hash_text) AS content_hash FROM incoming",
    "ruled": """
        SELECT r.*, CASE WHEN r.status = 'pending' THEN 'status_invalid'
            WHEN r.registration_deadline < r.publication_date THEN 'deadline_before_publication'
            WHEN r.title IS NULL THEN 'title_null'
            WHEN length(r.notice_number) > 100 THEN 'notice_number_too_long'
            WHEN h.id IS NOT NULL THEN 'hash_taken'
            WHEN e.id IS NOT NULL THEN 'external_id_taken' END AS refused
        FROM ranked r
        LEFT JOIN t_notices h ON h.source_id = r.source_id AND h.content_hash = r.content_hash
            AND h.url <> r.url
        LEFT JOIN t_notices e ON e.source_id = r.source_id AND e.external_id = r.external_id
            AND e.url <> r.url""",
    "judged": """
        SELECT row_number, coalesce(refused, CASE
            WHEN row_number() OVER (PARTITION BY source_id, url, refused IS NULL
                ORDER BY row_number) > 1 THEN 'duplicate_url'
            WHEN row_number() OVER (PARTITION BY source_id, content_hash, refused IS NULL
                ORDER BY row_number) > 1 THEN 'duplicate_hash'
            WHEN external_id IS NOT NULL AND row_number() OVER (PARTITION BY source_id,
                external_id, refused IS NULL ORDER BY row_number) > 1 THEN 'duplicate_external_id'
            ELSE 'ok' END) AS code, * EXCLUDE (row_number) FROM ruled""",
}


def incoming_notices(spark: SparkSession, d: str) -> DataFrame:
    return t.read(spark, d, "orders").selectExpr(
        "o_orderkey + 1 AS row_number",
        "2 * o_custkey + 2 AS source_id",
        "CASE WHEN o_orderkey % 47 = 3 THEN 'SAME' WHEN o_orderkey % 6 = 1 THEN concat('NEW-', o_orderkey)"
        " WHEN o_orderkey % 13 != 0 THEN concat('ORD-', o_orderkey) END AS external_id",
        "CASE WHEN o_orderkey % 97 != 5 THEN concat('Changed ', o_orderkey) END AS title",
        "concat('Desk ', o_orderkey % 9) AS organization",
        "CASE WHEN o_orderkey % 61 = 2 THEN repeat('9', 101) ELSE concat('N', o_orderkey) END AS notice_number",
        "CASE WHEN o_orderkey % 5 = 0 THEN concat('https://portal.example.com/fresh/', o_orderkey)"
        " WHEN o_orderkey % 7 = 1 THEN 'https://portal.example.com/notices/same'"
        " ELSE concat('https://portal.example.com/notices/', o_orderkey) END AS url",
        "CASE WHEN o_orderkey % 89 = 7 THEN 'pending' ELSE 'open' END AS status",
        "sha2(CASE WHEN o_orderkey % 53 = 9 THEN 'v2-same' WHEN o_orderkey % 4 = 0"
        " THEN concat('v1-', o_orderkey) ELSE concat('v2-', o_orderkey) END, 256) AS content_hash",
        "cast(o_orderdate AS timestamp) + (o_orderkey % 3) * INTERVAL 1 DAY AS seen_at",
        "date_add(cast(o_orderdate AS date), CASE WHEN o_orderkey % 83 = 11 THEN -1 ELSE 30 END)"
        " AS registration_deadline",
        "cast(o_orderdate AS date) AS publication_date",
        "cast(7 AS bigint) AS last_collection_run_id",
        "concat('{\"n\":', o_orderkey, '}') AS raw_payload",
    )


_TAKEN = ("external_id", "title", "organization", "notice_number", "status", "content_hash", "raw_payload")


@query(
    "upsert_notices",
    with_tables("t_notices", **UPSERT_SQL)
    + f"""SELECT n.id, n.source_id, n.url,
        {", ".join(f"CASE WHEN j.url IS NULL THEN n.{c} ELSE j.{c} END AS {c}" for c in _TAKEN)},
        {sql_day("CASE WHEN j.url IS NULL THEN n.publication_date ELSE j.publication_date END", "published")},
        {sql_day("CASE WHEN j.url IS NULL THEN n.registration_deadline ELSE j.registration_deadline END", "deadline")},
        CASE WHEN j.url IS NULL THEN n.last_collection_run_id ELSE 7 END AS last_collection_run_id,
        {sql_moment('n.first_seen_at')}, {sql_moment('greatest(n.last_seen_at, j.seen_at)', 'last_seen_at')}
    FROM t_notices n LEFT JOIN (SELECT * FROM judged WHERE code = 'ok') j
        ON j.source_id = n.source_id AND j.url = n.url
    UNION ALL
    SELECT (SELECT max(id) FROM t_notices) + row_number() OVER (ORDER BY j.row_number),
        j.source_id, j.url, {", ".join(f"j.{c}" for c in _TAKEN)},
        {sql_day("j.publication_date", "published")}, {sql_day("j.registration_deadline", "deadline")}, 7,
        {sql_moment('j.seen_at', 'a')}, {sql_moment('j.seen_at', 'b')}
    FROM judged j LEFT JOIN t_notices n ON n.source_id = j.source_id AND n.url = j.url
    WHERE j.code = 'ok' AND n.id IS NULL""",
)
def _(spark, d):
    return _upserted(maintenance.upsert_notices(t.notices(spark, d), incoming_notices(spark, d))[0])


def _upserted(table: DataFrame) -> DataFrame:
    return table.select(
        "id",
        "source_id",
        "url",
        *_TAKEN,
        day("publication_date", "published"),
        day("registration_deadline", "deadline"),
        "last_collection_run_id",
        moment("first_seen_at"),
        moment("last_seen_at"),
    )


def _stored_notices(spark: SparkSession, d: str) -> NoticeStore:
    store = NoticeStore(spark, scratch_path(spark, "notices"))
    store.create(t.notices(spark, d))
    return store


@query("upsert_notices_stored", ORACLES["upsert_notices"])
def _(spark, d):
    store = _stored_notices(spark, d)
    store.upsert(incoming_notices(spark, d))
    return _upserted(store.read())


@query(
    "upsert_notices_rejects",
    with_tables("t_notices", **UPSERT_SQL)
    + "SELECT row_number, code FROM judged WHERE code <> 'ok'",
)
def _(spark, d):
    return maintenance.upsert_notices(t.notices(spark, d), incoming_notices(spark, d))[1]


SOURCE_CHANGES_SQL = {
    "changes": """
        SELECT c_custkey + 1 AS row_number,
            CASE WHEN c_custkey % 9 = 4 THEN 'Fresh ' || (c_custkey // 18) ELSE c_name END AS name,
            'https://changed.example.com/' || c_custkey AS base_url
        FROM customer""",
}


def source_changes(spark: SparkSession, d: str) -> DataFrame:
    return t.read(spark, d, "customer").selectExpr(
        "c_custkey + 1 AS row_number",
        "CASE WHEN c_custkey % 9 = 4 THEN concat('  Fresh ', c_custkey div 18) ELSE c_name END"
        " AS name",
        "concat('https://changed.example.com/', c_custkey, ' ') AS base_url",
        "'api' AS source_type",
        "false AS collection_allowed",
        "cast(NULL AS timestamp) AS policy_checked_at",
        "true AS is_active",
    )


@query(
    "upsert_sources",
    with_tables("t_sources", **SOURCE_CHANGES_SQL)
    + """, firsts AS (SELECT name, min(row_number) AS row_number FROM changes GROUP BY name),
    good AS (SELECT c.* FROM changes c JOIN firsts f ON f.row_number = c.row_number)
    SELECT s.id, s.name, coalesce(g.base_url, s.base_url) AS base_url,
        CASE WHEN g.name IS NULL THEN s.source_type ELSE 'api' END AS source_type
    FROM t_sources s LEFT JOIN good g ON g.name = s.name
    UNION ALL
    SELECT (SELECT max(id) FROM t_sources) + row_number() OVER (ORDER BY g.row_number), g.name,
        g.base_url, 'api' FROM good g WHERE g.name NOT IN (SELECT name FROM t_sources)""",
)
def _(spark, d):
    table, _ = maintenance.upsert_sources(t.sources(spark, d), source_changes(spark, d))
    return table.select("id", "name", "base_url", "source_type")


@query(
    "bulk_create_sources",
    with_tables("t_sources", **SOURCE_CHANGES_SQL)
    + """, firsts AS (SELECT name, min(row_number) AS row_number FROM changes
        WHERE name NOT IN (SELECT name FROM t_sources) GROUP BY name)
    SELECT (SELECT max(id) FROM t_sources) + row_number() OVER (ORDER BY f.row_number) AS id,
        c.name, c.base_url FROM firsts f JOIN changes c ON c.row_number = f.row_number""",
)
def _(spark, d):
    _, created, _ = maintenance.bulk_create(
        t.sources(spark, d), source_changes(spark, d), "sources"
    )
    return created.select("id", "name", "base_url")


@query(
    "get_or_create_sources",
    with_tables("t_sources", **SOURCE_CHANGES_SQL)
    + """, grown AS (SELECT id, name FROM t_sources UNION ALL
    SELECT (SELECT max(id) FROM t_sources) + row_number() OVER (ORDER BY first), name
    FROM (SELECT name, min(row_number) AS first FROM changes
        WHERE name NOT IN (SELECT name FROM t_sources) GROUP BY name))
    SELECT c.row_number, c.name, g.id FROM changes c JOIN grown g ON g.name = c.name""",
)
def _(spark, d):
    return maintenance.get_or_create(t.sources(spark, d), source_changes(spark, d), "sources")[1]


@query(
    "bulk_create_sources_rejects",
    with_tables("t_sources", **SOURCE_CHANGES_SQL)
    + """SELECT row_number, 'already_exists' AS code FROM (SELECT *, row_number() OVER (
        PARTITION BY name ORDER BY row_number) AS n FROM changes)
    WHERE n > 1 OR name IN (SELECT name FROM t_sources)""",
)
def _(spark, d):
    return maintenance.bulk_create(t.sources(spark, d), source_changes(spark, d), "sources")[2]


LABELS_SQL = {
    "labels_in": """
        SELECT event_id + 1 AS row_number, CASE WHEN event_id % 3 = 0
            THEN event_type || ' ' || (event_id % 100) ELSE p.name END AS name
        FROM events LEFT JOIN t_categories p ON p.id = event_id % 50 + 1""",
}


def label_names(spark: SparkSession, d: str) -> DataFrame:
    known = t.categories(spark, d).select(F.col("id").alias("category_id"), "name")
    return (
        t.read(spark, d, "events")
        .withColumn("category_id", F.expr("event_id % 50 + 1"))
        .join(known, "category_id", "left")
        .selectExpr(
            "event_id + 1 AS row_number",
            "CASE WHEN event_id % 3 = 0 THEN concat(event_type, ' ', event_id % 100)"
            " ELSE name END AS name",
        )
    )


@query(
    "insert_ignore_categories",
    with_tables("t_categories", **LABELS_SQL)
    + """SELECT id, name FROM t_categories UNION ALL
    SELECT (SELECT max(id) FROM t_categories) + row_number() OVER (ORDER BY first), name
    FROM (SELECT name, min(row_number) AS first FROM labels_in
        WHERE name NOT IN (SELECT name FROM t_categories) GROUP BY name)""",
)
def _(spark, d):
    table, _ = maintenance.insert_ignore(
        t.categories(spark, d), label_names(spark, d), ["name"], "categories"
    )
    return table.select("id", "name")


@query(
    "insert_ignore_links",
    with_tables("t_links")
    + """SELECT notice_id, category_id FROM t_links UNION
    SELECT l_orderkey + 1, l_suppkey + 1 FROM lineitem""",
)
def _(spark, d):
    new = t.read(spark, d, "lineitem").selectExpr(
        "l_orderkey + 1 AS notice_id", "l_suppkey + 1 AS category_id"
    )
    return maintenance.insert_ignore(
        t.notice_categories(spark, d), new, ["notice_id", "category_id"], "notice_categories"
    )[0]


@query(
    "insert_ignore_rejects",
    with_tables("t_links", "t_notices")
    + """SELECT DISTINCT notice_id, category_id, CASE WHEN category_id IS NULL THEN 'category_id_null'
        ELSE 'notice_not_found' END AS code
    FROM (SELECT CASE WHEN l_linenumber = 3 THEN -l_orderkey - 1 ELSE l_orderkey + 1 END AS notice_id,
        CASE WHEN l_linenumber <> 2 THEN l_suppkey + 1 END AS category_id FROM lineitem)
    WHERE category_id IS NULL OR notice_id < 0""",
)
def _(spark, d):
    new = t.read(spark, d, "lineitem").selectExpr(
        "CASE WHEN l_linenumber = 3 THEN -l_orderkey - 1 ELSE l_orderkey + 1 END AS notice_id",
        "CASE WHEN l_linenumber != 2 THEN l_suppkey + 1 END AS category_id",
    )
    return maintenance.insert_ignore(
        t.notice_categories(spark, d),
        new,
        ["notice_id", "category_id"],
        "notice_categories",
        parents={"notice_id": (t.notices(spark, d), "notice_not_found")},
    )[1]


@query(
    "get_or_create_categories",
    with_tables("t_categories", **LABELS_SQL)
    + """, grown AS (SELECT id, name FROM t_categories UNION ALL
    SELECT (SELECT max(id) FROM t_categories) + row_number() OVER (ORDER BY first), name
    FROM (SELECT name, min(row_number) AS first FROM labels_in
        WHERE name NOT IN (SELECT name FROM t_categories) GROUP BY name))
    SELECT l.row_number, l.name, g.id FROM labels_in l JOIN grown g ON g.name = l.name""",
)
def _(spark, d):
    padded = label_names(spark, d).withColumn("name", F.concat(F.lit(" "), "name", F.lit("\n")))
    return maintenance.get_or_create(t.categories(spark, d), padded)[1]


RENAMES_SQL = {
    "renames": """
        SELECT c_custkey + 1 AS row_number,
            CASE WHEN c_custkey % 10 = 9 THEN -c_custkey ELSE 2 * c_custkey + 2 END AS id,
            CASE WHEN c_custkey % 10 = 3 THEN 'Customer#000000000'
                WHEN c_custkey % 10 = 5 THEN 'Shared ' || (c_custkey // 20)
                WHEN c_custkey % 10 = 7 THEN c_name ELSE c_name || ' II' END AS name,
            'https://renamed.example.com/' || c_custkey AS base_url, c_custkey AS k
        FROM customer""",
    "judged": """
        SELECT *, CASE WHEN k % 10 = 9 THEN 'not_found' WHEN k % 10 = 3 THEN 'already_exists'
            WHEN row_number() OVER (PARTITION BY name ORDER BY row_number) > 1
                THEN 'already_exists' ELSE 'ok' END AS code
        FROM renames""",
}


def renames(spark: SparkSession, d: str) -> DataFrame:
    return t.read(spark, d, "customer").selectExpr(
        "c_custkey + 1 AS row_number",
        "CASE WHEN c_custkey % 10 = 9 THEN -c_custkey ELSE 2 * c_custkey + 2 END AS id",
        "CASE WHEN c_custkey % 10 = 3 THEN 'Customer#000000000'"
        " WHEN c_custkey % 10 = 5 THEN concat('Shared ', c_custkey div 20)"
        " WHEN c_custkey % 10 = 7 THEN c_name ELSE concat(c_name, ' II') END AS name",
        "concat('https://renamed.example.com/', c_custkey) AS base_url",
        "'html' AS source_type",
        "false AS collection_allowed",
        "false AS is_active",
    )


@query(
    "bulk_update_sources",
    with_tables("t_sources", **RENAMES_SQL)
    + """SELECT s.id, coalesce(j.name, s.name) AS name,
        coalesce(j.base_url, s.base_url) AS base_url, s.is_active AND j.id IS NULL AS is_active
    FROM t_sources s LEFT JOIN (SELECT * FROM judged WHERE code = 'ok') j ON j.id = s.id""",
)
def _(spark, d):
    table, _ = maintenance.bulk_update(t.sources(spark, d), renames(spark, d), "sources")
    return table.select("id", "name", "base_url", "is_active")


@query(
    "bulk_update_sources_rejects",
    with_tables("t_sources", **RENAMES_SQL)
    + "SELECT row_number, code FROM judged WHERE code <> 'ok'",
)
def _(spark, d):
    return maintenance.bulk_update(t.sources(spark, d), renames(spark, d), "sources")[1]


def _user_ids(spark: SparkSession, d: str) -> DataFrame:
    return t.read(spark, d, "events").select((F.col("user_id") * 26 + 2).alias("id"))


@query(
    "bulk_delete_sources",
    with_tables("t_sources")
    + """SELECT id, name FROM t_sources
    WHERE id NOT IN (SELECT user_id * 26 + 2 FROM events)""",
)
def _(spark, d):
    kept, _ = maintenance.bulk_delete(t.sources(spark, d), _user_ids(spark, d))
    return kept.select("id", "name")


@query(
    "bulk_delete_sources_rejects",
    with_tables("t_sources")
    + """SELECT DISTINCT user_id * 26 + 2 AS id, 'not_found' AS code FROM events
    WHERE user_id * 26 + 2 NOT IN (SELECT id FROM t_sources)""",
)
def _(spark, d):
    return maintenance.bulk_delete(t.sources(spark, d), _user_ids(spark, d))[1]


@query(
    "delete_sources_restricted",
    with_tables("t_sources", "t_runs", "t_notices")
    + """SELECT id, CASE WHEN id IN (SELECT source_id FROM t_runs) THEN 'used_by_collection_runs'
        WHEN id IN (SELECT source_id FROM t_notices) THEN 'used_by_notices' ELSE 'deleted' END
        AS outcome FROM t_sources""",
)
def _(spark, d):
    tables = t.all_tables(spark, d)
    out, rejects = maintenance.apply_delete(tables, "sources", tables["sources"].select("id"))
    gone = tables["sources"].select("id").join(out["sources"].select("id"), "id", "left_anti")
    return gone.withColumn("outcome", F.lit("deleted")).unionByName(
        rejects.withColumnRenamed("code", "outcome")
    )


@query(
    "delete_runs_set_null",
    with_tables("t_runs", "t_notices")
    + """SELECT n.id, coalesce(CASE WHEN r.status <> 'failed' THEN n.last_collection_run_id END, 0)
        AS last_run FROM t_notices n LEFT JOIN t_runs r ON r.id = n.last_collection_run_id""",
)
def _(spark, d):
    tables = t.all_tables(spark, d)
    failed = tables["collection_runs"].where("status = 'failed'").select("id")
    out, _ = maintenance.apply_delete(tables, "collection_runs", failed)
    return out["notices"].select(
        "id", F.coalesce("last_collection_run_id", F.lit(0)).alias("last_run")
    )


@query(
    "delete_notices_cascade",
    with_tables("t_notices", "t_links")
    + """SELECT l.notice_id, l.category_id FROM t_links l
    LEFT JOIN t_notices n ON n.id = l.notice_id AND n.status = 'closed' WHERE n.id IS NULL""",
)
def _(spark, d):
    tables = t.all_tables(spark, d)
    closed = tables["notices"].where("status = 'closed'").select("id")
    out, _ = maintenance.apply_delete(tables, "notices", closed)
    return out["notice_categories"]


# --- Runs --------------------------------------------------------------------------------------


def run_requests(spark: SparkSession, d: str) -> DataFrame:
    return t.read(spark, d, "events").select(
        (F.col("event_id") + 1).alias("row_number"),
        (F.col("user_id") * 26 + 2).alias("source_id"),
        F.col("ts").cast("timestamp").alias("started_at"),
    )


@query(
    "start_runs",
    with_tables("t_sources", "t_runs")
    + f"""SELECT (SELECT max(id) FROM t_runs) + row_number() OVER (ORDER BY event_id) AS id,
        user_id * 26 + 2 AS source_id, {sql_moment('ts', 'started_at')}, 'running' AS status,
        0 AS records_found
    FROM events WHERE user_id * 26 + 2 IN (SELECT id FROM t_sources)""",
)
def _(spark, d):
    _, started, _ = runs.start_runs(
        t.collection_runs(spark, d), t.sources(spark, d), run_requests(spark, d)
    )
    return started.select("id", "source_id", moment("started_at"), "status", "records_found")


@query(
    "start_runs_rejects",
    with_tables("t_sources")
    + """SELECT event_id + 1 AS row_number, 'source_not_found' AS code FROM events
    WHERE user_id * 26 + 2 NOT IN (SELECT id FROM t_sources)""",
)
def _(spark, d):
    return runs.start_runs(
        t.collection_runs(spark, d), t.sources(spark, d), run_requests(spark, d)
    )[2]


CLOSING_SQL = {
    "closing": """
        SELECT 2 * e.event_id + c AS row_number,
            CASE WHEN e.event_id % 10 = 8 THEN -e.event_id - 1 ELSE e.event_id + 1 END AS run_id,
            CASE WHEN e.event_id % 12 = 5 AND c = 1 THEN TIMESTAMP '2100-01-01' ELSE
                e.ts + c * INTERVAL 1 MINUTE - CASE WHEN e.event_id % 10 = 6 THEN INTERVAL 1 HOUR
                ELSE INTERVAL 0 HOUR END END AS finished_at,
            e.ts AS started_at, e.event_type,
            CASE e.event_id % 3 WHEN 0 THEN 'success' WHEN 1 THEN 'partial' ELSE 'failed' END
                AS status,
            CASE WHEN e.event_id % 7 = 0 AND c = 1 THEN ' ' ELSE ' note ' || e.event_id END AS message,
            CASE WHEN e.event_id % 17 = 0 THEN -1 ELSE e.event_id % 40 END AS found
        FROM events e, (VALUES (1), (2)) v(c)""",
    "coded": """
        SELECT *, CASE
            WHEN status <> 'success' AND trim(message) = '' THEN 'blank_message'
            WHEN found < 0 THEN 'count_negative'
            WHEN run_id < 0 THEN 'not_found'
            WHEN event_type <> 'view' THEN 'bad_state'
            WHEN finished_at < started_at THEN 'finished_before_started' ELSE 'ok' END AS code
        FROM closing""",
    "winners": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id
            ORDER BY finished_at, row_number) AS n FROM coded WHERE code = 'ok') WHERE n = 1""",
}


def later() -> Column:
    return F.lit("2100-01-01 00:00:00").cast("timestamp")


def closing_events(spark: SparkSession, d: str) -> DataFrame:
    return (
        t.read(spark, d, "events")
        .withColumn("c", F.explode(F.array(F.lit(1), F.lit(2))))
        .selectExpr(
            "2 * event_id + c AS row_number",
            "CASE WHEN event_id % 10 = 8 THEN -event_id - 1 ELSE event_id + 1 END AS run_id",
            # No time means now, which the query sets after all times in the data.
            "CASE WHEN event_id % 12 != 5 OR c != 1 THEN cast(ts AS timestamp) + c * INTERVAL 1 MINUTE"
            " - CASE WHEN event_id % 10 = 6 THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END"
            " END AS finished_at",
            "CASE event_id % 3 WHEN 0 THEN 'success' WHEN 1 THEN 'partial' ELSE 'failed' END"
            " AS status",
            "CASE WHEN event_id % 7 = 0 AND c = 1 THEN ' ' ELSE concat(' note ', event_id) END"
            " AS error_message",
            "CASE WHEN event_id % 17 = 0 THEN -1 ELSE event_id % 40 END AS records_found",
            "cast(NULL AS bigint) AS records_inserted",
            "cast(NULL AS bigint) AS records_updated",
            "0 AS records_rejected",
        )
    )


@query(
    "finish_runs",
    with_tables("t_runs", **CLOSING_SQL)
    + f"""SELECT r.id, coalesce(w.status, r.status) AS status,
        {sql_moment('coalesce(w.finished_at, r.finished_at)', 'finished_at')},
        CASE WHEN w.run_id IS NULL THEN r.records_found ELSE w.found END AS records_found,
        CASE WHEN w.run_id IS NULL THEN r.records_inserted ELSE 0 END AS records_inserted,
        CASE WHEN w.run_id IS NULL THEN r.error_message
            WHEN w.status = 'success' THEN NULL ELSE trim(w.message) END AS error_message
    FROM t_runs r LEFT JOIN winners w ON w.run_id = r.id""",
)
def _(spark, d):
    table, _ = runs.finish_runs(t.collection_runs(spark, d), closing_events(spark, d), later())
    return table.select(
        "id",
        "status",
        moment("finished_at"),
        F.col("records_found").cast("long").alias("records_found"),
        F.col("records_inserted").cast("long").alias("records_inserted"),
        "error_message",
    )


@query(
    "finish_runs_rejects",
    with_tables("t_runs", **CLOSING_SQL)
    + """SELECT row_number, run_id, CASE WHEN code = 'ok' THEN 'bad_state' ELSE code END AS code
    FROM coded WHERE row_number NOT IN (SELECT row_number FROM winners)""",
)
def _(spark, d):
    return runs.finish_runs(t.collection_runs(spark, d), closing_events(spark, d), later())[1]


@query(
    "insert_missing_runs",
    with_tables("t_runs")
    + f"""SELECT id, source_id, {sql_moment('started_at')} FROM t_runs UNION ALL
    SELECT (SELECT max(id) FROM t_runs) + row_number() OVER (ORDER BY first),
        source_id, {sql_moment('started_at', 'a')}
    FROM (SELECT 2 * user_id + 2 AS source_id, ts + (event_id % 2) * INTERVAL 1 HOUR AS started_at,
            min(event_id) AS first FROM events GROUP BY ALL) n
    WHERE NOT EXISTS (SELECT 1 FROM t_runs r
        WHERE r.source_id = n.source_id AND r.started_at = n.started_at)""",
)
def _(spark, d):
    new = t.read(spark, d, "events").selectExpr(
        "event_id AS row_number",
        "2 * user_id + 2 AS source_id",
        "cast(ts AS timestamp) + (event_id % 2) * INTERVAL 1 HOUR AS started_at",
        "'success' AS status",
    )
    table, _ = runs.insert_missing_runs(t.collection_runs(spark, d), new)
    return table.select("id", "source_id", moment("started_at"))


@query(
    "insert_missing_runs_rejects",
    """SELECT event_id AS row_number, CASE WHEN event_id % 9 = 4 THEN 'count_negative'
        ELSE 'source_not_found' END AS code
    FROM events WHERE event_id % 9 = 4 OR user_id NOT IN (SELECT c_custkey FROM customer)""",
)
def _(spark, d):
    new = t.read(spark, d, "events").selectExpr(
        "event_id AS row_number",
        "2 * user_id + 2 AS source_id",
        "cast(ts AS timestamp) + INTERVAL 1 HOUR AS started_at",
        "'success' AS status",
        "CASE WHEN event_id % 9 = 4 THEN -1 ELSE 0 END AS records_found",
    )
    owners = t.read(spark, d, "customer").selectExpr("2 * c_custkey + 2 AS id")
    return runs.insert_missing_runs(t.collection_runs(spark, d), new, owners)[1]


# --- Matching, history, load ---------------------------------------------------------------------


@query(
    "match_notices",
    with_tables("t_notices", **UPSERT_SQL)
    + """SELECT r.row_number, CAST(coalesce(e.id, u.id, h.id, 0) AS BIGINT) AS notice_id,
        CASE WHEN e.id IS NOT NULL THEN 'external_id' WHEN u.id IS NOT NULL THEN 'url'
            WHEN h.id IS NOT NULL THEN 'content_hash' ELSE 'none' END AS match_kind
    FROM ranked r
    LEFT JOIN t_notices e ON e.source_id = r.source_id AND e.external_id = r.external_id
    LEFT JOIN t_notices u ON u.source_id = r.source_id AND u.url = r.url
    LEFT JOIN t_notices h ON h.source_id = r.source_id AND h.content_hash = r.content_hash""",
)
def _(spark, d):
    matched = history.match_notices(t.notices(spark, d), incoming_notices(spark, d))
    return matched.select(
        "row_number", F.coalesce("notice_id", F.lit(0)).alias("notice_id"), "match_kind"
    )


def sightings(spark: SparkSession, d: str) -> DataFrame:
    return t.read(spark, d, "lineitem").selectExpr(
        "l_suppkey AS source_id",
        "concat('https://portal.example.com/', l_partkey) AS url",
        "l_orderkey * 10 + l_linenumber AS collection_run_id",
        "cast(l_shipdate AS timestamp) AS seen_at",
    )


@query(
    "sighting_history",
    f"""SELECT l_suppkey AS source_id, 'https://portal.example.com/' || l_partkey AS url,
        {sql_moment('min(l_shipdate)', 'first_seen_at')},
        {sql_moment('max(l_shipdate)', 'last_seen_at')},
        arg_max(l_orderkey * 10 + l_linenumber,
            struct_pack(a := l_shipdate, b := l_orderkey * 10 + l_linenumber))
            AS last_collection_run_id
    FROM lineitem GROUP BY l_suppkey, l_partkey""",
)
def _(spark, d):
    return _history_texts(history.sighting_history(sightings(spark, d)))


def _history_texts(found: DataFrame) -> DataFrame:
    return found.select(
        "source_id",
        "url",
        moment("first_seen_at"),
        moment("last_seen_at"),
        "last_collection_run_id",
    )


@query("sighting_history_merged", ORACLES["sighting_history"])
def _(spark, d):
    """All sightings in three batches, the history stored between them."""
    batch = F.pmod("collection_run_id", F.lit(3))
    state = history.sighting_history(sightings(spark, d).where(batch == 1))
    for n in (0, 2):
        path = scratch_path(spark, "history")
        state.write.parquet(path)
        state = history.merge_history(spark.read.parquet(path), sightings(spark, d).where(batch == n))
    return _history_texts(state)


CHANGES_SQL = """SELECT r.row_number, CASE WHEN n.id IS NULL THEN 'insert'
    WHEN n.content_hash <> r.content_hash THEN 'update' ELSE 'unchanged' END AS change
    FROM ranked r LEFT JOIN t_notices n ON n.source_id = r.source_id AND n.url = r.url"""


@query("classify_changes", with_tables("t_notices", **UPSERT_SQL) + CHANGES_SQL)
def _(spark, d):
    return history.classify_changes(t.notices(spark, d), incoming_notices(spark, d)).select(
        "row_number", "change"
    )


@query(
    "run_record_counts",
    with_tables("t_notices", **UPSERT_SQL)
    + f"""SELECT row_number % 100 AS collection_run_id, count(*) AS records_found,
        count(*) FILTER (WHERE change = 'insert') AS records_inserted,
        count(*) FILTER (WHERE change = 'update') AS records_updated,
        CAST(0 AS BIGINT) AS records_rejected
    FROM ({CHANGES_SQL}) GROUP BY row_number % 100""",
)
def _(spark, d):
    changes = history.classify_changes(t.notices(spark, d), incoming_notices(spark, d))
    outcomes = changes.select(
        (F.col("row_number") % 100).alias("collection_run_id"), "change"
    )
    counts = history.run_counts(outcomes)
    return counts.select("collection_run_id", *[F.col(c).cast("long").alias(c) for c in runs.COUNTS])


ATTACH_SQL = {
    "seen": """
        SELECT event_id, 2 * user_id + 2 AS source_id,
            ts + (event_id % 2) * INTERVAL 1 HOUR AS run_started_at FROM events""",
}


@query(
    "attach_run",
    with_tables("t_runs", **ATTACH_SQL)
    + """SELECT s.event_id, CAST(coalesce(r.id, 0) AS BIGINT) AS run_id FROM seen s
    LEFT JOIN t_runs r ON r.source_id = s.source_id AND r.started_at = s.run_started_at""",
)
def _(spark, d):
    seen = t.read(spark, d, "events").selectExpr(
        "event_id",
        "2 * user_id + 2 AS source_id",
        "cast(ts AS timestamp) + (event_id % 2) * INTERVAL 1 HOUR AS run_started_at",
    )
    attached = load.attach_run(seen, t.collection_runs(spark, d))
    return attached.select(
        "event_id", F.coalesce("last_collection_run_id", F.lit(0)).alias("run_id")
    )


def category_mapping(spark: SparkSession, d: str) -> DataFrame:
    """Category names of each notice by natural keys, from the order lines."""
    orders = t.read(spark, d, "orders").selectExpr(
        "o_orderkey AS l_orderkey",
        "format_string('Customer#%09d', o_custkey) AS source_name",
        "concat('ORD-', o_orderkey) AS external_id",
    )
    parts = t.read(spark, d, "part").selectExpr(
        "p_partkey AS l_partkey", "concat(p_name, ' ', p_brand, ' ', p_partkey) AS category_name"
    )
    lines = t.read(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    return (
        lines.join(orders, "l_orderkey")
        .join(parts, "l_partkey")
        .select("source_name", "external_id", "category_name")
    )


@query(
    "resolve_category_links",
    with_tables("t_notices")
    + """SELECT l_orderkey + 1 AS notice_id, l_partkey + 1 AS category_id FROM lineitem
    WHERE l_orderkey + 1 IN (SELECT id FROM t_notices WHERE external_id IS NOT NULL)""",
)
def _(spark, d):
    return load.resolve_category_links(
        category_mapping(spark, d),
        t.sources(spark, d),
        t.notices(spark, d),
        t.categories(spark, d),
    )


def _valid_to_load(spark: SparkSession, d: str) -> DataFrame:
    """The transformed orders, each seen by the source of its customer."""
    owners = t.read(spark, d, "orders").selectExpr(
        "o_orderkey + 1 AS row_number",
        "format_string('Customer#%09d', o_custkey) AS source_name",
        "cast(o_orderdate AS timestamp) AS seen_at",
        "cast(o_orderdate AS timestamp) AS run_started_at",
    )
    valid = transform.transform(t.raw_records(spark, d)).valid
    return valid.withColumn("raw_payload", fn.payload_json(F.col("raw_payload"))).join(
        owners, "row_number"
    )


LOAD_SQL = {
    "incoming": """
        SELECT v.row_number, 2 * o.o_custkey + 2 AS source_id, v.external_id, v.title,
            v.url, v.status, v.content_hash FROM valid v JOIN orders o
            ON o.o_orderkey + 1 = v.row_number""",
    "accepted": """
        SELECT i.*, (SELECT max(o_orderkey) + 1 FROM orders)
            + row_number() OVER (ORDER BY i.row_number) AS id
        FROM incoming i WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey % 13 <> 0
            AND 2 * o.o_custkey + 2 = i.source_id AND 'ORD-' || o.o_orderkey = i.external_id)""",
}


def _loaded(spark: SparkSession, d: str, store: NoticeStore | None = None) -> load.Loaded:
    mapping = category_mapping(spark, d).withColumn(
        "external_id", F.regexp_replace("external_id", "^ORD", "Ord")
    )
    return load.load(_valid_to_load(spark, d), mapping, t.all_tables(spark, d), store)


@query(
    "load_notices",
    with_transform(**LOAD_SQL)
    + "SELECT id, source_id, external_id, title, url, status, content_hash FROM accepted",
)
def _(spark, d):
    return _fresh(spark, d, _loaded(spark, d))


def _fresh(spark: SparkSession, d: str, loaded: load.Loaded) -> DataFrame:
    fresh = loaded.notices.join(t.notices(spark, d).select("id"), "id", "left_anti")
    return fresh.select("id", "source_id", "external_id", "title", "url", "status", "content_hash")


@query("load_notices_stored", ORACLES["load_notices"])
def _(spark, d):
    return _fresh(spark, d, _loaded(spark, d, _stored_notices(spark, d)))


@query(
    "load_rejects",
    with_transform(**LOAD_SQL)
    + """SELECT row_number, 'external_id_taken' AS code FROM incoming
    WHERE row_number NOT IN (SELECT row_number FROM accepted)""",
)
def _(spark, d):
    return _loaded(spark, d).rejects


@query(
    "load_mapping_rejects",
    """SELECT DISTINCT source_name, external_id, code FROM (SELECT
        CASE WHEN l_orderkey % 9 = 4 THEN 'Nobody' ELSE printf('Customer#%09d', o_custkey) END
            AS source_name,
        CASE WHEN l_orderkey % 9 = 2 THEN 'LOST-' ELSE 'ORD-' END || l_orderkey AS external_id,
        CASE WHEN l_orderkey % 9 = 4 THEN 'source_not_found'
            WHEN l_orderkey % 9 = 2 OR l_orderkey % 13 = 0 THEN 'notice_not_found'
            WHEN l_orderkey % 9 = 6 THEN 'category_not_found' END AS code
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey) WHERE code IS NOT NULL""",
)
def _(spark, d):
    mapping = category_mapping(spark, d).withColumn("k", F.expr("cast(substr(external_id, 5) AS bigint) % 9"))
    broken = mapping.select(
        F.expr("CASE WHEN k = 4 THEN 'Nobody' ELSE source_name END").alias("source_name"),
        F.expr("CASE WHEN k = 2 THEN replace(external_id, 'ORD', 'LOST') ELSE external_id END").alias("external_id"),
        F.expr("CASE WHEN k = 6 THEN 'no such name' ELSE category_name END").alias("category_name"),
    )
    tables = t.all_tables(spark, d)
    judged = load.judge_mapping(broken, tables["sources"], tables["notices"], tables["categories"])
    return judged.where("code IS NOT NULL").select("source_name", "external_id", "code").distinct()


@query(
    "load_updates",
    with_tables("t_notices", **UPSERT_SQL)
    + """SELECT n.id, j.title, j.content_hash, CAST(coalesce(r.run, 0) AS BIGINT) AS run_id
    FROM (SELECT *, row_number - 1 AS k FROM judged WHERE code = 'ok') j
    JOIN t_notices n ON n.source_id = j.source_id AND n.url = j.url
    LEFT JOIN (SELECT 2 * o_orderkey + 2 AS run, o_custkey, o_orderdate FROM orders) r
        ON r.o_custkey * 2 + 2 = j.source_id AND r.run = 2 * k + 2 AND k % 2 = 0""",
)
def _(spark, d):
    """Loads whose rows update notices, with two runs for every start time of even orders."""
    orders = t.read(spark, d, "orders")
    incoming = incoming_notices(spark, d).drop("source_id", "last_collection_run_id").join(
        orders.selectExpr(
            "o_orderkey + 1 AS row_number",
            "format_string('Customer#%09d', o_custkey) AS source_name",
            "timestamp_seconds(o_orderkey) AS run_started_at",
        ),
        "row_number",
    )
    started = orders.where("o_orderkey % 2 = 0").selectExpr(
        "explode(array(2 * o_orderkey + 1, 2 * o_orderkey + 2)) AS id",
        "2 * o_custkey + 2 AS source_id",
        "timestamp_seconds(o_orderkey) AS started_at",
    )
    tables = {**t.all_tables(spark, d), "collection_runs": maintenance.fit_table(started, "collection_runs")}
    notices = load.load(incoming, category_mapping(spark, d).limit(0), tables).notices
    return notices.where("title LIKE 'Changed%'").join(tables["notices"].select("id"), "id").select(
        "id", "title", "content_hash", F.coalesce("last_collection_run_id", F.lit(0)).alias("run_id")
    )


@query(
    "load_links",
    with_transform(**LOAD_SQL)
    + """SELECT DISTINCT l_orderkey + 1 AS notice_id, l_partkey + 1 AS category_id FROM lineitem
    UNION ALL
    SELECT DISTINCT a.id, l.l_partkey + 1 FROM accepted a JOIN orders o
        ON 2 * o.o_custkey + 2 = a.source_id AND 'Ord-' || o.o_orderkey = a.external_id
    JOIN lineitem l ON l.l_orderkey = o.o_orderkey""",
)
def _(spark, d):
    return _loaded(spark, d).links

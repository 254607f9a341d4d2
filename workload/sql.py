"""The mapped tables as SQL, for checking the queries on another engine."""

from __future__ import annotations

TABLES = {
    "t_sources": """
        SELECT id, name, base_url,
            CASE k % 5 WHEN 0 THEN 'api' WHEN 1 THEN 'html' WHEN 2 THEN 'browser'
                WHEN 3 THEN 'file' ELSE 'mail' END AS source_type,
            NULL::VARCHAR AS terms_url, NULL::VARCHAR AS robots_url,
            balance > 0 AS collection_allowed,
            CASE WHEN balance < 5000 THEN TIMESTAMP '2024-01-01 00:00:00' END AS policy_checked_at,
            k % 3 <> 0 AS is_active,
            TIMESTAMP '2024-01-01 00:00:00' AS created_at
        FROM (
            SELECT 2 * c_custkey + 2 AS id, c_name AS name,
                'https://portal.example.com/c/' || c_custkey AS base_url,
                c_custkey AS k, c_acctbal AS balance
            FROM customer
            UNION ALL
            SELECT 2 * s_suppkey + 1, s_name, 'ftp://portal.example.com/s/' || s_suppkey,
                s_suppkey, s_acctbal
            FROM supplier)""",
    "t_notices": """
        SELECT o_orderkey + 1 AS id,
            2 * o_custkey + 2 AS source_id,
            CASE WHEN o_orderkey % 13 <> 0 THEN 'ORD-' || o_orderkey END AS external_id,
            'Notice ' || o_orderpriority || ' ' || o_orderkey AS title,
            'Office ' || (o_custkey % 25) AS organization,
            (o_orderkey % 1000) || '/' || year(o_orderdate) AS notice_number,
            CAST(o_orderdate AS DATE) AS publication_date,
            CASE WHEN o_orderkey % 5 <> 0
                THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INTEGER) END
                AS registration_deadline,
            'https://portal.example.com/notices/' || o_orderkey AS url,
            CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'closed' ELSE 'unknown' END
                AS status,
            sha256('v1-' || o_orderkey) AS content_hash,
            CAST(o_orderdate AS TIMESTAMP) AS first_seen_at,
            CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 DAY AS last_seen_at,
            CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 1000 + 1 END AS last_collection_run_id,
            '{"k":' || o_orderkey || '}' AS raw_payload
        FROM orders""",
    "t_runs": """
        SELECT event_id + 1 AS id, 2 * user_id + 2 AS source_id, ts AS started_at,
            CASE WHEN event_type <> 'view'
                THEN ts + to_microseconds(CAST(round(value * 1e6) AS BIGINT)) END AS finished_at,
            CASE event_type WHEN 'view' THEN 'running' WHEN 'error' THEN 'failed'
                WHEN 'signup' THEN 'partial' ELSE 'success' END AS status,
            event_id % 50 AS records_found, event_id % 20 AS records_inserted,
            event_id % 10 AS records_updated, event_id % 5 AS records_rejected,
            CASE WHEN event_type IN ('error', 'signup') THEN 'note ' || event_id END
                AS error_message
        FROM events""",
    "t_categories": """
        SELECT p_partkey + 1 AS id, p_name || ' ' || p_brand || ' ' || p_partkey AS name,
            TIMESTAMP '2024-01-01 00:00:00' AS created_at
        FROM part""",
    "t_links": """
        SELECT DISTINCT l_orderkey + 1 AS notice_id, l_partkey + 1 AS category_id
        FROM lineitem""",
}

RAW = {
    "raw": """
        SELECT k + 1 AS row_number, batch_id,
            CASE WHEN nested OR NOT numeric_id THEN ext ELSE CAST(k AS VARCHAR) END AS external_id,
            CASE WHEN NOT nested AND NOT numeric_id AND k % 53 = 1 THEN NULL ELSE title END AS title,
            url, status, publication_date, registration_deadline
        FROM (
            SELECT o_orderkey AS k,
                CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS batch_id,
                o_orderkey % 11 = 5 AS nested,
                o_orderkey % 43 = 1 AS numeric_id,
                CASE WHEN o_orderkey % 13 = 0 THEN NULL
                    WHEN o_orderkey % 3 = 0 THEN upper('  Ord-' ||
                        CASE WHEN o_orderkey % 19 = 2 THEN o_orderkey - 2 ELSE o_orderkey END || ' ')
                    ELSE '  Ord-' ||
                        CASE WHEN o_orderkey % 19 = 2 THEN o_orderkey - 2 ELSE o_orderkey END || ' '
                    END AS ext,
                CASE WHEN o_orderkey % 29 = 0 THEN '   '
                    ELSE '  Notice   for ' || o_orderpriority || '  ' || o_orderkey END AS title,
                CASE WHEN o_orderkey % 23 = 0 THEN 'example.com/' || o_orderkey
                    ELSE 'https://EXAMPLE.com/notices/' ||
                        CASE WHEN o_orderkey % 17 = 1 THEN o_orderkey - 1 ELSE o_orderkey END ||
                        CASE WHEN o_orderkey % 4 = 0 THEN '/#doc' ELSE '' END
                    END AS url,
                CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN 'pending'
                    WHEN o_orderkey % 41 = 0 THEN '  ' WHEN o_orderstatus = 'O' THEN ' OPEN '
                    WHEN o_orderstatus = 'F' THEN 'Closed' ELSE 'suspended  ' END AS status,
                CASE WHEN o_orderkey % 37 = 0 THEN '2026-02-31'
                    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS publication_date,
                CASE WHEN o_orderkey % 5 <> 0 THEN strftime(CAST(o_orderdate AS DATE)
                    + (CAST(o_orderkey % 60 AS INTEGER) - 5), '%Y-%m-%d') END
                    AS registration_deadline
            FROM orders)""",
    "clean": """
        SELECT row_number, batch_id,
            nullif(trim(regexp_replace(external_id, '\\s+', ' ', 'g')), '') AS external_id,
            lower(nullif(trim(regexp_replace(external_id, '\\s+', ' ', 'g')), '')) AS external_key,
            nullif(trim(regexp_replace(title, '\\s+', ' ', 'g')), '') AS title,
            CASE WHEN url LIKE 'https://%' THEN 'https://example.com' ||
                regexp_replace(regexp_extract(url, '^https://[^/]+([^#]*)', 1), '/+$', '')
                END AS url,
            status IS NOT NULL AS status_provided,
            lower(nullif(trim(status), '')) AS status_text,
            publication_date IS NOT NULL AS publication_provided,
            TRY_CAST(publication_date AS DATE) AS publication_date,
            registration_deadline IS NOT NULL AS deadline_provided,
            TRY_CAST(registration_deadline AS DATE) AS registration_deadline
        FROM raw""",
}

TAGGED = {
    "flagged": """
        SELECT *,
            external_key IS NOT NULL AND row_number() OVER (
                PARTITION BY {within} external_key ORDER BY row_number) > 1 AS dup_external_id,
            url IS NOT NULL AND row_number() OVER (
                PARTITION BY {within} url ORDER BY row_number) > 1 AS dup_url
        FROM clean""",
    "tagged": """
        SELECT *, dup_external_id OR dup_url AS is_duplicate,
            concat_ws(',',
                CASE WHEN title IS NULL THEN 'title_missing' END,
                CASE WHEN url IS NULL THEN 'url_invalid' END,
                CASE WHEN status_provided AND (status_text IS NULL OR status_text NOT IN
                    ('unknown', 'open', 'closed', 'suspended', 'cancelled'))
                    THEN 'status_invalid' END,
                CASE WHEN publication_provided AND publication_date IS NULL
                    THEN 'publication_date_invalid' END,
                CASE WHEN deadline_provided AND registration_deadline IS NULL
                    THEN 'deadline_invalid' END,
                CASE WHEN registration_deadline < publication_date
                    THEN 'deadline_before_publication' END,
                CASE WHEN dup_external_id OR dup_url THEN 'duplicate_in_batch' END) AS reasons
        FROM flagged""",
    "valid": """
        SELECT row_number, batch_id, external_id, title, publication_date,
            registration_deadline, url, coalesce(status_text, 'unknown') AS status,
            sha256('{"external_id":"' || coalesce(external_id, '') ||
                '","notice_number":"","organization":"","publication_date":"' ||
                coalesce(strftime(publication_date, '%Y-%m-%d'), '') ||
                '","registration_deadline":"' ||
                coalesce(strftime(registration_deadline, '%Y-%m-%d'), '') ||
                '","status":"' || coalesce(status_text, 'unknown') ||
                '","title":"' || title || '","url":"' || url || '"}') AS content_hash
        FROM tagged WHERE reasons = ''""",
}

PAYLOADS = """
    SELECT row_number, '{' || concat_ws(',',
        CASE WHEN k % 11 = 5 THEN '"external":{' || coalesce('"id":"' || external_id || '"', '') || '}'
            WHEN k % 43 = 1 THEN '"external_id":' || k
            ELSE '"external_id":"' || external_id || '"' END,
        '"publication_date":"' || publication_date || '"',
        '"registration_deadline":"' || registration_deadline || '"',
        '"status":"' || status || '"',
        CASE WHEN k % 11 <> 5 AND k % 43 <> 1 AND k % 53 = 1 THEN '"title":' || k
            ELSE '"title":"' || title || '"' END,
        '"url":"' || url || '"') || '}' AS raw_payload
    FROM (SELECT *, row_number - 1 AS k FROM raw)"""

PAGES = {
    "runs_paged": """
        SELECT c, n, ceil(n / 4.0)::BIGINT AS pages,
            CASE WHEN c % 11 = 3 THEN 'count' WHEN c % 13 = 5 THEN 'missing'
                WHEN c % 17 = 7 THEN 'items' WHEN c % 19 = 4 THEN 'boolean'
                WHEN c % 23 = 6 THEN 'changed' WHEN c % 29 = 8 THEN 'size'
                WHEN c % 31 = 9 THEN 'element' WHEN c % 37 = 10 THEN 'twice'
                WHEN c % 41 = 11 THEN 'shifted' ELSE 'none' END AS defect
        FROM (SELECT o_custkey AS c, count(*) AS n FROM orders GROUP BY o_custkey)""",
    "verdicts": """
        SELECT 2 * c + 2 AS run_id, n, pages, defect,
            CASE WHEN defect = 'count' THEN 'count_mismatch'
                WHEN defect = 'missing' AND pages > 1 THEN 'page_missing'
                WHEN defect = 'items' THEN 'items_not_list'
                WHEN defect = 'boolean' THEN 'page_not_integer'
                WHEN defect = 'changed' AND pages > 1 THEN 'total_pages_changed'
                WHEN defect = 'size' THEN 'page_size_not_positive'
                WHEN defect = 'element' THEN 'item_not_object'
                WHEN defect = 'twice' THEN 'page_repeated'
                WHEN defect = 'shifted' THEN 'page_mismatch' ELSE 'ok' END AS code
        FROM runs_paged""",
}


def with_tables(*names: str, **more: str) -> str:
    """A WITH clause of the named mapped tables and further named selects."""
    known = {**TABLES, **RAW, **PAGES}
    parts = {name: known[name] for name in names}
    parts.update(more)
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in parts.items()) + "\n"


def with_transform(within: str = "", **more: str) -> str:
    """A WITH clause ending in ``tagged`` and ``valid``; ``within`` is a key prefix."""
    tagged = {name: text.replace("{within}", within) for name, text in TAGGED.items()}
    return with_tables("raw", "clean", **tagged, **more)

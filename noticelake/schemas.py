"""Table schemas, allowed values, defaults and user-facing texts."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: these must equal what existing users of the data see. -------------

SOURCE_TYPES = ("api", "html", "browser", "file")
RUN_STATUSES = ("running", "success", "partial", "failed")
NOTICE_STATUSES = ("unknown", "open", "closed", "suspended", "cancelled")
DEFAULT_STATUS = "unknown"

EXPECTED_FIELDS = (
    "external_id",
    "title",
    "organization",
    "notice_number",
    "publication_date",
    "registration_deadline",
    "url",
    "status",
)

# Nested objects flatten with "_", so these (object, key) pairs land on an expected field.
NESTED_PATHS = {
    "external_id": ("external", "id"),
    "notice_number": ("notice", "number"),
    "publication_date": ("publication", "date"),
    "registration_deadline": ("registration", "deadline"),
}

REASON_TEXTS = {
    "title_missing": "Título ausente ou inválido.",
    "url_invalid": "URL ausente ou inválida.",
    "status_invalid": "Status inválido.",
    "publication_date_invalid": "Data de publicação inválida.",
    "deadline_invalid": "Prazo de inscrição inválido.",
    "deadline_before_publication": (
        "O prazo de inscrição não pode ser anterior à data de publicação."
    ),
    "duplicate_in_batch": "Registro duplicado dentro do lote.",
}
# Our own: a record above the size that one value can have.
REASON_TEXTS["record_too_large"] = "Registro maior que o limite de tamanho."

PAGE_ERROR_KIND = "InvalidAPIResponseError"
# Codes whose message names another kind.
PAGE_ERROR_KINDS = {"page_missing": "DataExtractionError"}
PAGE_ERROR_TEXTS = {
    "not_json": "A API não retornou um JSON válido.",
    "root_not_object": "A raiz da resposta deve ser um objeto JSON.",
    "items_not_list": "O campo 'items' deve ser uma lista.",
    "pagination_not_object": "O campo 'pagination' deve ser um objeto.",
    "page_not_integer": "O campo 'page' deve ser inteiro.",
    "page_size_not_integer": "O campo 'page_size' deve ser inteiro.",
    "total_pages_not_integer": "O campo 'total_pages' deve ser inteiro.",
    "total_items_not_integer": "O campo 'total_items' deve ser inteiro.",
    "page_size_not_positive": "O tamanho da página deve ser positivo.",
    "total_pages_not_positive": "O total de páginas deve ser positivo.",
    "total_items_negative": "O total de itens não pode ser negativo.",
    "page_beyond_total": "A página atual é maior que o total de páginas.",
    "item_not_object": "Cada item da resposta deve ser um objeto JSON.",
    "total_pages_changed": "O total de páginas mudou durante a extração.",
    "total_items_changed": "O total de registros mudou durante a extração.",
    "count_mismatch": (
        "A quantidade recebida não corresponde ao total informado pela API."
    ),
    # Possible only with landed pages, which can be absent, landed twice or beyond a size limit.
    "body_too_large": "A resposta é maior que o limite de tamanho.",
    "count_too_large": "A quantidade de registros é maior que o limite.",
    "page_missing": "A página não pôde ser obtida.",
    "page_repeated": "A página foi gravada mais de uma vez.",
}

RAW_FILE_ERROR_TEXTS = {
    "not_json_object": "A raiz da resposta deve ser um objeto JSON.",
    "records_not_list": "O arquivo bruto não possui uma lista válida em 'records'.",
    "record_not_object": "O arquivo bruto possui registros inválidos.",
}

# Column length limits.
LENGTH_LIMITS = {
    "sources": {"name": 150, "source_type": 20},
    "collection_runs": {"status": 20},
    "notices": {
        "external_id": 255,
        "organization": 255,
        "notice_number": 100,
        "status": 30,
        "content_hash": 64,
    },
    "categories": {"name": 100},
    "notice_categories": {},
}

MAX_RUN_LIST = 500
DEFAULT_RUN_LIST = 50
STAMP_FORMAT = "yyyyMMdd'T'HHmmss'Z'"

# --- Table schemas, keys, defaults and export columns; fixed values too ---------------


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, not required) for n, t, required in fields])


_LONG, _INT, _STR = T.LongType(), T.IntegerType(), T.StringType()
_BOOL, _DATE, _TS = T.BooleanType(), T.DateType(), T.TimestampType()

SOURCES = _schema(
    ("id", _LONG, True),
    ("name", _STR, True),
    ("base_url", _STR, True),
    ("source_type", _STR, True),
    ("terms_url", _STR, False),
    ("robots_url", _STR, False),
    ("collection_allowed", _BOOL, True),
    ("policy_checked_at", _TS, False),
    ("is_active", _BOOL, True),
    ("created_at", _TS, True),
)

COLLECTION_RUNS = _schema(
    ("id", _LONG, True),
    ("source_id", _LONG, True),
    ("started_at", _TS, True),
    ("finished_at", _TS, False),
    ("status", _STR, True),
    ("records_found", _INT, True),
    ("records_inserted", _INT, True),
    ("records_updated", _INT, True),
    ("records_rejected", _INT, True),
    ("error_message", _STR, False),
)

NOTICES = _schema(
    ("id", _LONG, True),
    ("source_id", _LONG, True),
    ("external_id", _STR, False),
    ("title", _STR, True),
    ("organization", _STR, False),
    ("notice_number", _STR, False),
    ("publication_date", _DATE, False),
    ("registration_deadline", _DATE, False),
    ("url", _STR, True),
    ("status", _STR, True),
    ("content_hash", _STR, True),
    ("first_seen_at", _TS, True),
    ("last_seen_at", _TS, True),
    ("last_collection_run_id", _LONG, False),
    ("raw_payload", _STR, True),
)

CATEGORIES = _schema(
    ("id", _LONG, True),
    ("name", _STR, True),
    ("created_at", _TS, True),
)

NOTICE_CATEGORIES = _schema(
    ("notice_id", _LONG, True),
    ("category_id", _LONG, True),
)

TABLES = {
    "sources": SOURCES,
    "collection_runs": COLLECTION_RUNS,
    "notices": NOTICES,
    "categories": CATEGORIES,
    "notice_categories": NOTICE_CATEGORIES,
}

# (child table, foreign key, parent table, what deleting the parent does)
FOREIGN_KEYS = (
    ("collection_runs", "source_id", "sources", "restrict"),
    ("notices", "source_id", "sources", "restrict"),
    ("notices", "last_collection_run_id", "collection_runs", "set_null"),
    ("notice_categories", "notice_id", "notices", "cascade"),
    ("notice_categories", "category_id", "categories", "cascade"),
)

# Keys that must be unique; rows with a null in the key never clash.
UNIQUE_KEYS = {
    "sources": (("id",), ("name",)),
    "collection_runs": (("id",),),
    "notices": (
        ("id",),
        ("source_id", "url"),
        ("source_id", "content_hash"),
        ("source_id", "external_id"),
    ),
    "categories": (("id",), ("name",)),
    "notice_categories": (("notice_id", "category_id"),),
}

# Values a new row gets where its input leaves the column out or null.
DEFAULTS = {
    "sources": {"collection_allowed": False, "is_active": True},
    "collection_runs": {
        "status": "running",
        "records_found": 0,
        "records_inserted": 0,
        "records_updated": 0,
        "records_rejected": 0,
    },
    "notices": {"status": DEFAULT_STATUS, "raw_payload": "{}"},
    "categories": {},
    "notice_categories": {},
}

CLEAN_COLUMNS = (
    "external_id",
    "title",
    "organization",
    "notice_number",
    "publication_date",
    "registration_deadline",
    "url",
    "status",
    "content_hash",
    "raw_payload",
)
REJECT_COLUMNS = ("row_number", "external_id", "reasons", "raw_payload")

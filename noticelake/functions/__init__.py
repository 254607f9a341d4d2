from noticelake.functions.dates import (
    deadline_ok,
    duration_seconds,
    is_finished,
    iso_text,
    parse_iso_date,
    utc_stamp,
)
from noticelake.functions.hashing import content_hash
from noticelake.functions.jsonvalues import (
    flattened_field,
    has_value,
    is_object,
    is_list,
    json_int,
    json_type,
    number_text,
    parse_payload,
    payload_json,
    record_fields,
    text_of,
)
from noticelake.functions.text import (
    casefold,
    clean_trim,
    error_text,
    fill_default,
    is_allowed,
    nfkc,
    normalize_status,
    normalize_text,
    squeeze,
    unicode_forms,
)
from noticelake.functions.urls import canonical_url, has_http_prefix

__all__ = [
    "canonical_url",
    "casefold",
    "clean_trim",
    "content_hash",
    "deadline_ok",
    "duration_seconds",
    "error_text",
    "fill_default",
    "flattened_field",
    "has_http_prefix",
    "has_value",
    "is_allowed",
    "is_finished",
    "is_list",
    "is_object",
    "iso_text",
    "json_int",
    "json_type",
    "nfkc",
    "normalize_status",
    "normalize_text",
    "number_text",
    "parse_iso_date",
    "parse_payload",
    "payload_json",
    "record_fields",
    "squeeze",
    "text_of",
    "unicode_forms",
    "utc_stamp",
]

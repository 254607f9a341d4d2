"""Content fingerprint of a clean notice."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticelake.functions.dates import iso_text

# Fixed value: the fingerprinted fields, in the key order of the hashed JSON text.
HASHED_FIELDS = (
    "external_id",
    "notice_number",
    "organization",
    "publication_date",
    "registration_deadline",
    "status",
    "title",
    "url",
)
_DATES = ("publication_date", "registration_deadline")



def content_hash(fields: dict[str, Column] | None = None) -> Column:
    """SHA-256 of the compact JSON of the normalised fields, nulls as empty text."""
    columns = fields or {name: F.col(name) for name in HASHED_FIELDS}
    parts = []
    for name in HASHED_FIELDS:
        value = iso_text(columns[name]) if name in _DATES else columns[name]
        parts.append(F.coalesce(value, F.lit("")).alias(name))
    return F.sha2(_lower_escapes(F.to_json(F.struct(*parts))), 256)


def _lower_escapes(text: Column) -> Column:
    """Lower-case the hex digits of ``\\u00XX`` escapes, leaving all other text alone."""
    has_escape = text.rlike(r"\\u00[01][A-F]")
    fixed = text
    for digit in "ABCDEF":
        # An escape is real only after an even number of backslashes.
        fixed = F.regexp_replace(
            fixed, rf"(?<!\\)((?:\\\\)*)\\u00([01]){digit}", rf"$1\\u00$2{digit.lower()}"
        )
    return F.when(has_escape, fixed).otherwise(text)

"""Type-aware access to JSON held as VARIANT.

Text fields accept JSON strings only, so each access looks at the JSON type first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticelake.schemas import NESTED_PATHS


def parse_payload(text: Column) -> Column:
    """JSON text to VARIANT; malformed text is null."""
    return F.try_parse_json(text)


def payload_json(value: Column) -> Column:
    """Compact JSON text with sorted keys."""
    return F.to_json(value)


def json_type(value: Column) -> Column:
    """``STRING``, ``BIGINT``, ``OBJECT<..>``, ..; ``VOID`` for JSON null, null if absent."""
    return F.schema_of_variant(value)


def is_object(value: Column) -> Column:
    return F.coalesce(json_type(value).startswith("OBJECT"), F.lit(False))


def is_list(value: Column) -> Column:
    return F.coalesce(json_type(value).startswith("ARRAY"), F.lit(False))


def record_fields(record: Column, fields: Sequence[str]) -> Column:
    """Struct of the named top-level fields, and the objects that may hold nested ones."""
    parents = [NESTED_PATHS[f][0] for f in fields if f in NESTED_PATHS]
    shape = ", ".join(f"{name}: variant" for name in [*fields, *parents])
    return F.try_variant_get(record, "$", f"struct<{shape}>")


def flattened_field(fields: Column, name: str) -> Column:
    """The value that reaches field ``name`` once nested objects are flattened with ``_``.

    ``fields`` comes from ``record_fields``. A nested value wins over a flat one, even when
    it is JSON null; a nested object only makes longer names, so it does not count.
    """
    flat = fields[name]
    if name not in NESTED_PATHS:
        return flat
    parent, child = NESTED_PATHS[name]
    nested = F.try_variant_get(fields[parent], f"$.{child}", "variant")
    nested = F.coalesce(F.when(~is_object(nested), nested), flat)
    return F.when(fields[parent].isNull(), flat).otherwise(nested)


def has_value(value: Column, kind: Column | None = None) -> Column:
    """Whether a field was provided: not absent, not JSON null, not an object."""
    kind = json_type(value) if kind is None else kind
    return F.coalesce((kind != "VOID") & ~kind.startswith("OBJECT"), F.lit(False))


def text_of(value: Column, kind: Column | None = None, allow_numeric: bool = False) -> Column:
    """The text of a JSON string; with ``allow_numeric`` also of a JSON number."""
    kind = json_type(value) if kind is None else kind
    text = F.when(kind == "STRING", value.try_cast("string"))
    if allow_numeric:
        text = text.when(kind == "BIGINT", value.try_cast("string")).when(
            kind.startswith("D") | (kind == "FLOAT"), number_text(value, kind)
        )
    return text


def number_text(value: Column, kind: Column) -> Column:
    """JSON number to text: integers as digits, others in shortest decimal form.

    Long integers arrive as decimals without a fraction.
    """
    whole = (kind == "BIGINT") | kind.rlike(r"^DECIMAL\((19|2\d|3\d),0\)$")
    number = F.array(value.try_cast("double"))
    # The lambda keeps this rare case out of the generated code of the common ones.
    return F.when(whole, value.try_cast("string")).otherwise(
        F.transform(number, lambda n: _float_text(n, n.cast("string")))[0]
    )


def _float_text(number: Column, text: Column) -> Column:
    """Shortest text of a double; plain digits from 1e-4 up to 1e16, else ``1e+16`` style."""
    exponent = F.regexp_extract(text, r"E(-?\d+)$", 1).try_cast("int")
    plain = F.regexp_replace(number.cast("string").try_cast("decimal(38,21)").cast("string"), "0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    mantissa = F.regexp_replace(F.regexp_extract(text, r"^(.*)E", 1), r"\.0$", "")
    sign = F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+"))
    digits = F.abs(exponent).cast("string")
    digits = F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits)
    return (
        F.when(text == "Infinity", F.lit("inf"))
        .when(text == "-Infinity", F.lit("-inf"))
        .when(exponent.isNull(), text)
        .when((exponent >= -4) & (exponent < 16), plain)
        .otherwise(F.concat(mantissa, sign, digits))
    )


def json_int(value: Column) -> Column:
    """A JSON integer as a long; booleans, fractions and text give null."""
    return F.when(json_type(value) == "BIGINT", value.try_cast("bigint"))

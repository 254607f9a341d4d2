"""Text clean-up as native columns, with one Arrow UDF for what the JVM side lacks.

Unicode NFKC and full case folding are not Spark built-ins. Both leave plain ASCII and
most composed Latin letters alone (folding is then ``lower``), so the UDF is handed nulls for
values of such characters and only the others travel to Python.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import lru_cache, partial
from unicodedata import combining, normalize

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The code points that count as white space in text fields, the space last.
_ASCII_SPACE = "\\t-\\r\\x1c-\\x1f"
_OTHER_SPACE = (
    "\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
)
WHITESPACE = _ASCII_SPACE + _OTHER_SPACE + "\\x20"
_EDGES = f"^[{WHITESPACE}]+|[{WHITESPACE}]+$"
# White space other than a lone space, in ASCII text and in any text.
_UNEVEN_ASCII = f"[{_ASCII_SPACE}\\x20]{{2,}}|[{_ASCII_SPACE}]"
_UNEVEN = f"[{WHITESPACE}]{{2,}}|[{_ASCII_SPACE}{_OTHER_SPACE}]"
_SUSPECT = "[\\x00-\\x1f\\x7f-\\uffff]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.transform(F.array(value), body)[0]


def clean_trim(text: Column) -> Column:
    """Drop white space of any kind from both ends."""
    return F.regexp_replace(text, _EDGES, "")


def squeeze(text: Column) -> Column:
    """Collapse white-space runs to one space; blank text becomes null.

    Most texts are even already, and two cheap tests tell so.
    """
    even = (
        F.when(~text.contains("  ") & ~text.rlike(_SUSPECT), text)
        .when(F.length(text) == F.octet_length(text), F.regexp_replace(text, _UNEVEN_ASCII, " "))
        .otherwise(F.regexp_replace(text, _UNEVEN, " "))
    )
    return F.nullif(F.trim(even), F.lit(""))


# Latin letters go up to here; beyond, every value travels.
_LATIN_END = 0x17F


@lru_cache(maxsize=2)
def stable_latin(folds: bool) -> str:
    """The non-ASCII Latin characters that NFKC leaves alone, as the inside of a character class.

    None of them joins with a neighbour either, as none is a combining mark. With ``folds``
    also those only whose case folding is what ``lower`` gives.
    """

    def kept(c: str) -> bool:
        same = normalize("NFKC", c) == c and not combining(c)
        # The capital dotted I is one letter whose lower case is two.
        return same and (not folds or (c.casefold() == c.lower() and len(c.lower()) == 1))

    return "".join(f"\\x{{{i:x}}}" for i in range(0x80, _LATIN_END + 1) if kept(chr(i)))


def travels(text: Column, folds: bool) -> Column:
    """Whether a value has a character that Python must look at."""
    return (F.length(text) != F.octet_length(text)) & text.rlike(f"[^\\x00-\\x7f{stable_latin(folds)}]")


@lru_cache(maxsize=None)
def _forms_udf(plain: tuple[str, ...], folded: tuple[str, ...]):
    """Arrow UDF giving NFKC of every input, and its case folding for some of them."""
    names = [*plain, *[f"{name}_folded" for name in folded]]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])

    def each(change, values: pa.Array) -> pa.Array:
        if values.null_count == len(values):
            return values
        return pa.array(
            [None if v is None else change(v) for v in values.to_pylist()], pa.string()
        )

    @F.arrow_udf(schema)
    def forms(*inputs: pa.Array) -> pa.Array:
        # Arrow's own utf8_normalize leaves NFKC letters decomposed, so it can't be used here.
        normal = {n: each(partial(normalize, "NFKC"), v) for n, v in zip(plain, inputs)}
        lowered = [each(str.casefold, normal[name]) for name in folded]
        return pa.StructArray.from_arrays([*normal.values(), *lowered], names=names)

    return forms


def unicode_forms(texts: dict[str, Column], folded: Sequence[str] = ()) -> Column:
    """One struct with the NFKC form of each text, plus ``<name>_folded`` where asked.

    All texts go through a single UDF call, so Python is crossed once per row batch.
    Values that need no change but to lower case come back null; the callers fill them in natively.
    """
    names = tuple(texts)
    sent = [F.when(travels(texts[name], name in folded), texts[name]) for name in names]
    return _forms_udf(names, tuple(folded))(*sent)


def nfkc(text: Column) -> Column:
    """Unicode NFKC form."""
    return F.coalesce(unicode_forms({"t": text})["t"], text)


def casefold(text: Column) -> Column:
    """NFKC form with full case folding (``ß`` becomes ``ss``)."""
    return F.coalesce(unicode_forms({"t": text}, ("t",))["t_folded"], F.lower(text))


def normalize_text(text: Column) -> Column:
    """NFKC, single spaces, blank to null."""
    return squeeze(nfkc(text))


def normalize_status(text: Column) -> Column:
    """Normalised and case-folded status text."""
    return squeeze(casefold(text))


def is_allowed(value: Column, allowed: Iterable[str]) -> Column:
    """Membership that is false, not null, for a null value."""
    return F.coalesce(value.isin(*allowed), F.lit(False))


def fill_default(value: Column, default: object) -> Column:
    return F.coalesce(value, F.lit(default))


def error_text(kind: Column, message: Column) -> Column:
    """``Kind: message``."""
    return F.concat_ws(": ", kind, message)

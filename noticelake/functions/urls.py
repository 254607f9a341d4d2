"""Canonical URLs as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticelake.functions.text import let


def _ipv6_pattern() -> str:
    """Text form of an IPv6 address: full, or shortened once by ``::``."""
    word = "[0-9a-f]{1,4}"
    octet = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
    dotted = rf"{octet}(?:\.{octet}){{3}}"
    forms = [rf"(?:{word}:){{7}}{word}", rf"(?:{word}:){{6}}{dotted}"]
    for left in range(8):
        head = f"{word}(?::{word}){{{left - 1}}}" if left else ""
        room = 7 - left
        tails = [""]
        if room >= 1:
            tails.append(f"{word}(?::{word}){{0,{room - 1}}}")
        if room >= 2:
            tails.append(f"(?:{word}:){{0,{room - 2}}}{dotted}")
        forms.append(f"{head}::(?:{'|'.join(tails)})")
    return "(?:" + "|".join(forms) + ")"


_BRACKETED = rf"^\[(?:{_ipv6_pattern()}(?:%[^%\]]+)?|v[0-9a-f]+\.[^\]]+)\](?::.*)?$"


def canonical_url(text: Column, folded: Column | None = None) -> Column:
    """Canonical form of an absolute http(s) URL, or null when it is not one.

    ``text`` is normalised text; ``folded`` is the same text case-folded and supplies the
    authority, for which ``lower`` is enough when the text is ASCII. Plain string cuts do
    the work, as they are much cheaper per row than pattern matches.
    """
    folded = F.lower(text) if folded is None else folded
    whole = F.struct(
        F.substring_index(_unpadded(text), "#", 1).alias("whole"),
        F.substring_index(F.substring_index(_unpadded(folded), "#", 1), "?", 1).alias("folded"),
    )
    return let(whole, lambda url: let(_parts(url), _joined))


def _unpadded(text: Column) -> Column:
    """Without leading control characters."""
    return F.when(text < "!", F.regexp_replace(text, r"^[\x00-\x20]+", "")).otherwise(text)


def _parts(url: Column) -> Column:
    """Scheme, authority, the rest up to the query, and the query."""
    scheme = F.when(url["folded"].startswith("https://"), F.lit("https")).when(
        url["folded"].startswith("http://"), F.lit("http")
    )
    start = F.length(scheme) + 4
    base = F.substring_index(url["whole"], "?", 1)
    return F.struct(
        scheme.alias("scheme"),
        F.substring_index(F.substr(url["folded"], start), "/", 1).alias("authority"),
        F.substr(base, start).alias("place"),
        F.substr(url["whole"], F.length(base) + 2).alias("query"),
    )


def _joined(parts: Column) -> Column:
    """The parts put together again, or null without a usable host."""
    authority, place = parts["authority"], parts["place"]
    host = F.substring_index(authority, "@", -1)
    bracketed = authority.contains("[") | authority.contains("]")
    has_host = F.when(bracketed, host.rlike(_BRACKETED)).otherwise(
        (host != "") & ~host.startswith(":")
    )
    slash = F.instr(place, "/")
    path = F.when(slash > 0, F.substr(place, slash)).otherwise(F.lit("/"))
    path = F.when(path == "/", path).otherwise(F.rtrim(path, F.lit("/")))
    query = F.when(parts["query"] != "", F.concat(F.lit("?"), parts["query"]))
    return F.when(
        has_host,
        F.concat(parts["scheme"], F.lit("://"), authority, path, F.coalesce(query, F.lit(""))),
    )


def has_http_prefix(text: Column) -> Column:
    return text.startswith("http://") | text.startswith("https://")

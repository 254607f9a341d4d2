"""Validation rules: row rules are boolean columns with a code, set rules give rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions import (
    clean_trim,
    deadline_ok,
    has_http_prefix,
    is_allowed,
)
from noticelake.schemas import (
    LENGTH_LIMITS,
    NOTICE_STATUSES,
    REASON_TEXTS,
    RUN_STATUSES,
    SOURCE_TYPES,
    TABLES,
    UNIQUE_KEYS,
)

Rule = tuple[str, Column]


# --- Record rules (raw notices) -------------------------------------------------------


def title_missing() -> Column:
    return F.col("title").isNull()


def url_invalid() -> Column:
    return F.col("url").isNull()


def status_invalid() -> Column:
    return F.col("status_provided") & ~is_allowed(F.col("status_text"), NOTICE_STATUSES)


def publication_date_invalid() -> Column:
    return F.col("publication_provided") & F.col("publication_date").isNull()


def deadline_invalid() -> Column:
    return F.col("deadline_provided") & F.col("registration_deadline").isNull()


def deadline_before_publication() -> Column:
    return ~deadline_ok(F.col("publication_date"), F.col("registration_deadline"))


def record_rules() -> list[Rule]:
    """The rules of a raw notice, in the order their reasons are listed."""
    return [
        ("record_too_large", F.col("raw_payload").isNull()),
        ("title_missing", title_missing()),
        ("url_invalid", url_invalid()),
        ("status_invalid", status_invalid()),
        ("publication_date_invalid", publication_date_invalid()),
        ("deadline_invalid", deadline_invalid()),
        ("deadline_before_publication", deadline_before_publication()),
        ("duplicate_in_batch", F.col("is_duplicate")),
    ]


def reason_codes(rules: Iterable[Rule]) -> Column:
    """Ordered array of the codes whose rule holds."""
    return F.array_compact(F.array(*[F.when(broken, F.lit(code)) for code, broken in rules]))


def first_code(rules: Iterable[Rule]) -> Column:
    """The first code whose rule holds, else null."""
    return F.coalesce(*[F.when(broken, F.lit(code)) for code, broken in rules])


def reason_texts(codes: Column, texts: dict[str, str] = REASON_TEXTS) -> Column:
    """User-facing texts of an array of codes, in the same order."""
    lookup = F.create_map(*[F.lit(part) for pair in texts.items() for part in pair])
    return F.transform(codes, lambda code: lookup[code])


# --- Table row rules --------------------------------------------------------------------


def source_rules() -> list[Rule]:
    return [
        ("name_blank", _blank("name")),
        ("base_url_invalid", ~_true(has_http_prefix(clean_trim(F.col("base_url"))))),
        (
            "policy_date_missing",
            _true(F.col("collection_allowed")) & F.col("policy_checked_at").isNull(),
        ),
        ("source_type_invalid", ~is_allowed(F.col("source_type"), SOURCE_TYPES)),
    ]


def category_rules() -> list[Rule]:
    return [
        ("name_blank", _blank("name")),
        ("name_too_long", _true(F.length(clean_trim(F.col("name"))) > 100)),
    ]


def run_rules() -> list[Rule]:
    negative = F.lit(False)
    for name in ("records_found", "records_inserted", "records_updated", "records_rejected"):
        negative = negative | _true(F.col(name) < 0)
    return [
        ("status_invalid", ~is_allowed(F.col("status"), RUN_STATUSES)),
        ("count_negative", negative),
        ("finished_before_started", _true(F.col("finished_at") < F.col("started_at"))),
    ]


def notice_rules() -> list[Rule]:
    return [
        ("status_invalid", ~is_allowed(F.col("status"), NOTICE_STATUSES)),
        ("last_seen_before_first", _true(F.col("last_seen_at") < F.col("first_seen_at"))),
        ("deadline_before_publication", deadline_before_publication()),
    ]


def required_rules(table: str) -> list[Rule]:
    """NOT NULL columns of a table."""
    return [
        (f"{field.name}_null", F.col(field.name).isNull())
        for field in TABLES[table].fields
        if not field.nullable
    ]


def length_rules(table: str) -> list[Rule]:
    return [
        (f"{name}_too_long", _true(F.length(name) > limit))
        for name, limit in LENGTH_LIMITS[table].items()
    ]


TABLE_RULES = {
    "sources": source_rules,
    "collection_runs": run_rules,
    "notices": notice_rules,
    "categories": category_rules,
    "notice_categories": list,
}


def table_rules(table: str) -> list[Rule]:
    """Every row rule of a table."""
    return [*required_rules(table), *length_rules(table), *TABLE_RULES[table]()]


def violations(df: DataFrame, rules: Sequence[Rule], id_columns: Sequence[str]) -> DataFrame:
    """One row per broken rule: the id columns and the code. No shuffle."""
    return df.select(*id_columns, F.explode(reason_codes(rules)).alias("code"))


# --- Set rules ----------------------------------------------------------------------------


def unique_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values held by more than one row; keys with a null part never clash."""
    complete = df
    for name in key:
        complete = complete.where(F.col(name).isNotNull())
    # Keys in sequence shrink to a few bits in a shuffle, and tasks that are joined up to a number of
    # bytes then hold too many of them. A hash beside the key cannot shrink.
    counts = complete.groupBy(*key, F.xxhash64(*key).alias("_hash")).agg(F.count("*").alias("holders"))
    return counts.where("holders > 1").drop("_hash")


def table_unique_violations(df: DataFrame, table: str) -> DataFrame:
    """Violations of all unique keys of a table, the key written as JSON text."""
    found = None
    for key in UNIQUE_KEYS[table]:
        part = unique_violations(df, key).select(
            F.lit(",".join(key)).alias("key_columns"),
            F.to_json(F.struct(*key)).alias("key_value"),
            "holders",
        )
        found = part if found is None else found.unionByName(part)
    return found


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame) -> DataFrame:
    """Child rows whose set foreign key names no parent."""
    parents = parent.select(F.col("id").alias(foreign_key))
    return child.where(F.col(foreign_key).isNotNull()).join(parents, foreign_key, "left_anti")


def _blank(name: str) -> Column:
    return F.coalesce(clean_trim(F.col(name)) == "", F.lit(True))


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))

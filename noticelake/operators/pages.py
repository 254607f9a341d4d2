"""Landed API pages: envelope checks, run checks and the ordered record set.

A landed page is a row ``source_id, collection_run_id, requested_page, body`` where
``body`` is the JSON text of one response.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticelake.functions import (
    error_text,
    is_list,
    is_object,
    json_int,
    parse_payload,
)
from noticelake.operators.rules import Rule, first_code
from noticelake.schemas import PAGE_ERROR_KIND, PAGE_ERROR_KINDS, PAGE_ERROR_TEXTS

RUN = ("source_id", "collection_run_id")
PAGE_INTEGERS = ("page", "page_size", "total_pages", "total_items")

# Pages per offset block; keeps each window group small however long a run is.
BLOCK = 1_000

# The most that one VARIANT holds, and the most that a count column holds.
MAX_BODY = 128 << 20
MAX_COUNT = 2**31 - 1


def parse_pages(landed: DataFrame) -> DataFrame:
    """Add ``items``, the pagination integers, ``item_count`` and the first page ``code``."""
    root = (
        landed.withColumn("_root", parse_payload(F.col("body")))
        .withColumn("_too_large", F.octet_length("body") > MAX_BODY)
        .drop("body")
    )
    fields = root.withColumn("items", F.try_variant_get("_root", "$.items", "variant")).withColumn(
        "_pagination", F.try_variant_get("_root", "$.pagination", "variant")
    )
    for name in PAGE_INTEGERS:
        value = F.try_variant_get("_pagination", f"$.{name}", "variant")
        fields = fields.withColumn(name, json_int(value))
    listed = F.when(is_list(F.col("items")), F.try_variant_get("items", "$", "array<variant>"))
    measured = fields.withColumn("_list", listed).withColumn(
        "item_count", F.coalesce(F.size("_list"), F.lit(0))
    )
    return (
        measured.withColumn("code", first_code(page_rules()))
        .withColumn("item_count", F.when(F.col("code").isNull(), F.col("item_count")).otherwise(0))
        .drop("_root", "_too_large", "_pagination", "_list")
    )


def page_rules() -> list[Rule]:
    """Rules of one page, in the order they are looked at."""
    c = F.col
    bad_items = F.exists("_list", lambda item: ~is_object(item))
    return [
        ("body_too_large", c("_root").isNull() & c("_too_large")),
        ("not_json", c("_root").isNull()),
        ("root_not_object", ~is_object(c("_root"))),
        ("items_not_list", c("_list").isNull()),
        ("pagination_not_object", ~is_object(c("_pagination"))),
        *[(f"{name}_not_integer", c(name).isNull()) for name in PAGE_INTEGERS],
        ("page_mismatch", c("page") != c("requested_page")),
        ("page_size_not_positive", c("page_size") <= 0),
        ("total_pages_not_positive", c("total_pages") <= 0),
        ("total_items_negative", c("total_items") < 0),
        ("page_beyond_total", c("page") > c("total_pages")),
        ("item_not_object", F.coalesce(bad_items, F.lit(False))),
    ]


def page_message(code: Column, page: Column, requested: Column) -> Column:
    """Error text of a page or run code."""
    lookup = F.create_map(*[F.lit(p) for pair in PAGE_ERROR_TEXTS.items() for p in pair])
    # Fixed value: the message that names both page numbers.
    mismatch = F.format_string(
        "A API retornou a página %d, mas a página %d foi solicitada.", page, requested
    )
    text = F.when(code == "page_mismatch", mismatch).otherwise(F.try_element_at(lookup, code))
    kinds = F.create_map(*[F.lit(p) for pair in PAGE_ERROR_KINDS.items() for p in pair])
    return error_text(F.coalesce(F.try_element_at(kinds, code), F.lit(PAGE_ERROR_KIND)), text)


def run_verdicts(pages: DataFrame) -> DataFrame:
    """One row per run: counters, and ``code`` / ``error_message`` when a check failed.

    The earliest failing page decides; then repeated pages, missing pages, and last the
    announced total. Pages are first merged by page number and then by the totals they
    announce, so even a run with most of all pages reaches its final group as a few rows.
    """
    c = F.col
    page = c("requested_page")
    failing = F.when(
        c("code").isNotNull(), F.struct(page, F.lit(0).alias("late"), "code", "page")
    )
    by_page = (
        pages.withColumn("failing", failing)
        .groupBy(*RUN, "requested_page")
        .agg(
            F.count("*").alias("copies"),
            F.min("failing").alias("failing"),
            F.min(F.struct("total_pages", "total_items")).alias("totals"),
            F.sum("item_count").alias("item_count"),
        )
    )
    by_totals = by_page.groupBy(*RUN, "totals").agg(
        F.min(page).alias("low"),
        F.max(page).alias("high"),
        F.count("*").alias("distinct_pages"),
        F.sum("copies").alias("pages_landed"),
        F.min("failing").alias("failing"),
        F.sum("item_count").alias("item_count"),
    )
    opening = by_totals.groupBy(*RUN).agg(F.min_by("totals", "low").alias("opening"))
    change = first_code(
        [
            ("total_pages_changed", c("totals.total_pages") != c("opening.total_pages")),
            ("total_items_changed", c("totals.total_items") != c("opening.total_items")),
        ]
    )
    changing = F.struct(
        c("low").alias("requested_page"),
        F.lit(1).alias("late"),
        change.alias("code"),
        F.lit(None).cast("bigint").alias("page"),
    )
    runs = (
        by_totals.join(opening, list(RUN))
        .withColumn("failing", F.least("failing", F.when(change.isNotNull(), changing)))
        .groupBy(*RUN)
        .agg(
            F.min("failing").alias("_bad"),
            F.sum("pages_landed").alias("pages_landed"),
            F.sum("distinct_pages").alias("_distinct"),
            F.min("low").alias("_low"),
            F.max("high").alias("_high"),
            F.sum("item_count").alias("records_found"),
            F.max("opening.total_pages").alias("pages_fetched"),
            F.max("opening.total_items").alias("total_items"),
        )
    )
    complete = (
        (c("_low") == 1)
        & (c("_high") == c("pages_fetched"))
        & (c("_distinct") == c("pages_fetched"))
    )
    run_rules = [
        ("page_repeated", c("pages_landed") > c("_distinct")),
        ("page_missing", ~complete),
        ("count_mismatch", c("records_found") != c("total_items")),
        ("count_too_large", c("records_found") > MAX_COUNT),
    ]
    code = F.coalesce(c("_bad.code"), first_code(run_rules))
    message = page_message(c("code"), c("_bad.page"), c("_bad.requested_page"))
    return (
        runs.withColumn("code", code)
        .withColumn("error_message", F.when(c("code").isNotNull(), message))
        .withColumn("failed_page", c("_bad.requested_page"))
        .select(
            *RUN,
            "pages_fetched",
            "total_items",
            "records_found",
            "pages_landed",
            "failed_page",
            "code",
            "error_message",
        )
    )


def extraction_metrics(pages: DataFrame) -> DataFrame:
    """Pages, announced total and received records per run."""
    return pages.groupBy(*RUN).agg(
        F.count("*").alias("pages_fetched"),
        F.max("total_items").alias("total_items"),
        F.sum("item_count").alias("records_found"),
    )


def explode_pages(pages: DataFrame, complete: DataFrame | None = None) -> DataFrame:
    """The records of runs, ``row_number`` counting through their pages in order.

    ``complete`` limits the result to its runs and may carry columns to add. Offsets are
    prefix sums in two steps, within blocks of pages and over the block totals, so the
    pages of a very long run are never sorted in one task; page bodies are shuffled once,
    by run and block.
    """
    block = F.floor((F.col("requested_page") - 1) / BLOCK)
    sizes = (
        pages.select(*RUN, block.alias("_block"), "item_count")
        .groupBy(*RUN, "_block")
        .agg(F.sum("item_count").alias("_n"))
    )
    extra = []
    if complete is not None:
        extra = [name for name in complete.columns if name not in RUN]
        sizes = sizes.join(complete, list(RUN))
    before_block = Window.partitionBy(*RUN).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    base = F.coalesce(F.sum("_n").over(before_block), F.lit(0))
    blocks = sizes.select(*RUN, "_block", base.alias("_base"), *extra)
    before_page = Window.partitionBy(*RUN, "_block").orderBy("requested_page").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offset = F.coalesce(F.sum("item_count").over(before_page), F.lit(0)) + F.col("_base")
    placed = (
        pages.withColumn("_block", block)
        .join(blocks, [*RUN, "_block"])
        .withColumn("_offset", offset)
    )
    return placed.select(
        *RUN,
        *extra,
        "_offset",
        F.posexplode(F.try_variant_get("items", "$", "array<variant>")).alias("_pos", "record"),
    ).select(*RUN, *extra, (F.col("_offset") + F.col("_pos") + 1).alias("row_number"), "record")

"""Valid notices and their category mapping into the tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelake.operators.maintenance import insert_ignore, upsert_notices
from noticelake.operators.rules import first_code
from noticelake.session import shared_dir
from noticelake.sources.noticestore import NoticeStore


@dataclass(frozen=True)
class Loaded:
    """The two tables, refused rows (``row_number, code``) and refused mapping rows."""

    notices: DataFrame
    links: DataFrame
    rejects: DataFrame
    mapping_rejects: DataFrame


def attach_source(data: DataFrame, sources: DataFrame) -> DataFrame:
    """Resolve ``source_name``; an unknown one gives a null ``source_id``."""
    names = sources.select(F.col("name").alias("source_name"), F.col("id").alias("source_id"))
    return data.join(names, "source_name", "left")


def attach_run(data: DataFrame, runs: DataFrame) -> DataFrame:
    """Add the id of the run of the same source and start time, null when there is none.

    Of several such runs the one registered last counts.
    """
    starts = runs.groupBy("source_id", F.col("started_at").alias("run_started_at")).agg(
        F.max("id").alias("last_collection_run_id")
    )
    return data.join(starts, ["source_id", "run_started_at"], "left")


def judge_mapping(
    mapping: DataFrame, sources: DataFrame, notices: DataFrame, categories: DataFrame
) -> DataFrame:
    """Mapping rows with ``notice_id``, ``category_id`` and a ``code`` where one is missing."""
    found = notices.where("external_id IS NOT NULL").select(
        F.col("source_id").alias("_source"), F.col("external_id").alias("_external"), F.col("id").alias("notice_id")
    )
    named = categories.select(F.col("name").alias("category_name"), F.col("id").alias("category_id"))
    known = attach_source(mapping, sources)
    same = (known["source_id"] == F.col("_source")) & (known["external_id"] == F.col("_external"))
    return (
        known.join(found, same, "left")
        .join(named, "category_name", "left")
        .withColumn(
            "code",
            first_code(
                [
                    ("source_not_found", F.col("source_id").isNull()),
                    ("notice_not_found", F.col("notice_id").isNull()),
                    ("category_not_found", F.col("category_id").isNull()),
                ]
            ),
        )
        .select("source_name", "external_id", "category_name", "notice_id", "category_id", "code")
    )


def resolve_category_links(
    mapping: DataFrame, sources: DataFrame, notices: DataFrame, categories: DataFrame
) -> DataFrame:
    """Links by surrogate keys from (source name, external id, category name)."""
    judged = judge_mapping(mapping, sources, notices, categories)
    return judged.where("code IS NULL").select("notice_id", "category_id")


def load(
    valid: DataFrame, mapping: DataFrame, tables: dict[str, DataFrame], store: NoticeStore | None = None
) -> Loaded:
    """Upsert notices and add their category links.

    With a ``store`` the notices are those it has, and only its files that hold what changes
    are rewritten; they are then committed, and the links are what is left to save.

    ``valid`` has ``row_number``, ``source_name``, ``run_started_at``, ``seen_at`` and the
    clean notice columns with ``raw_payload`` as JSON text. Rows of unknown sources are
    refused as ``source_not_found``, as are mapping rows that name nothing.
    """
    shared_dir(valid.sparkSession)
    # The upsert looks at the batch twice; what made it runs once. Sources and runs are found for
    # row numbers alone, and the wide rows stay where they are.
    incoming = valid.checkpoint()
    named = attach_source(incoming.select("row_number", "source_name", "run_started_at"), tables["sources"])
    found = attach_run(named, tables["collection_runs"])
    attached = found.select("row_number", "source_id", "last_collection_run_id").checkpoint()
    placed = attached.where("source_id IS NOT NULL")
    rows = incoming.drop("source_id", "last_collection_run_id")
    if store is None:
        notices, rejects = upsert_notices(tables["notices"], rows, placed=placed)
    else:
        rejects = store.upsert(rows, placed=placed).rejects
        notices = store.read()
    lost = attached.where("source_id IS NULL").select("row_number", F.lit("source_not_found").alias("code"))
    judged = judge_mapping(mapping, tables["sources"], notices, tables["categories"])
    links = judged.where("code IS NULL").select("notice_id", "category_id")
    merged, _ = insert_ignore(
        tables["notice_categories"], links, ["notice_id", "category_id"], "notice_categories"
    )
    refused = judged.where("code IS NOT NULL").select("source_name", "external_id", "category_name", "code")
    return Loaded(notices, merged, rejects.unionByName(lost), refused)

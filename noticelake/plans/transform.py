"""Raw records to valid notices, rejects and counters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelake.functions import (
    canonical_url,
    content_hash,
    fill_default,
    flattened_field,
    has_value,
    json_type,
    parse_iso_date,
    record_fields,
    squeeze,
    text_of,
    unicode_forms,
)
from noticelake.operators.dedupe import BATCH_KEYS, flag_duplicates
from noticelake.operators.rules import reason_codes, record_rules
from noticelake.schemas import DEFAULT_STATUS, EXPECTED_FIELDS
from noticelake.session import shared_dir

FOLDED = ("external_id", "url", "status")
NUMERIC = ("external_id",)


@dataclass(frozen=True)
class Transformed:
    """Tagged rows and the views on them; persist or write ``tagged`` to use several."""

    tagged: DataFrame
    within: tuple[str, ...]

    @property
    def valid(self) -> DataFrame:
        return valid_notices(self.tagged, self.within)

    @property
    def rejected(self) -> DataFrame:
        return rejected_records(self.tagged, self.within)

    @property
    def metrics(self) -> DataFrame:
        return batch_metrics(self.tagged, self.within)


def transform(raw: DataFrame, within: Sequence[str] = (), batches: DataFrame | None = None) -> Transformed:
    """Clean a batch of raw records.

    ``raw`` has ``row_number`` and ``record`` (VARIANT). With ``within`` many batches are
    done at once: those columns tell them apart and duplicates are judged inside each.
    ``batches`` may name those that are wanted, as for ``flag_repeats``.
    """
    tagged = tag_rejections(flag_batch(raw, within, batches))
    return Transformed(tagged, tuple(within))


def project_expected(
    raw: DataFrame, fields: Sequence[str] = EXPECTED_FIELDS, keep: Sequence[str] = ()
) -> DataFrame:
    """The expected fields as text, ``<field>_provided``, and whatever ``keep`` names.

    Absent fields are null. Nested objects are flattened, and only JSON strings count as
    text (numbers too for the external id).
    """
    whole = raw.select(*keep, record_fields(F.col("record"), fields).alias("_fields"))
    values = whole.select(*keep, *[flattened_field(F.col("_fields"), f).alias(f) for f in fields])
    typed = values.select(
        *keep, *fields, *[json_type(F.col(f)).alias(f"_type_{f}") for f in fields]
    )
    return typed.select(
        *keep,
        *[text_of(F.col(f), F.col(f"_type_{f}"), f in NUMERIC).alias(f) for f in fields],
        *[has_value(F.col(f), F.col(f"_type_{f}")).alias(f"{f}_provided") for f in fields],
    )


def normalize_fields(
    raw: DataFrame, fields: Sequence[str] = EXPECTED_FIELDS, keep: Sequence[str] = ()
) -> DataFrame:
    """Normalised text of each field, and ``<field>_folded`` for those compared by case."""
    folded = [f for f in fields if f in FOLDED]
    provided = [f"{f}_provided" for f in fields]
    expected = project_expected(raw, fields, keep)
    forms = expected.withColumn(
        "_forms", unicode_forms({f: F.col(f) for f in fields}, folded)
    )
    plain = forms.select(
        *keep,
        *provided,
        *[squeeze(F.coalesce(F.col("_forms")[f], F.col(f))).alias(f) for f in fields],
        *[squeeze(F.col("_forms")[f"{f}_folded"]).alias(f"{f}_folded") for f in folded],
    )
    return plain.select(
        *keep,
        *provided,
        *fields,
        *[F.coalesce(f"{f}_folded", F.lower(f)).alias(f"{f}_folded") for f in folded],
    )


def clean_records(raw: DataFrame, within: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Raw records with clean fields, the inputs of the rules, the duplicate keys, and what ``keep`` names."""
    rows = normalize_fields(raw, keep=[*within, "row_number", "record", *keep])
    return rows.select(
        *within,
        "row_number",
        "external_id",
        F.col("external_id_folded").alias("external_key"),
        "title",
        "organization",
        "notice_number",
        parse_iso_date(F.col("publication_date")).alias("publication_date"),
        parse_iso_date(F.col("registration_deadline")).alias("registration_deadline"),
        canonical_url(F.col("url"), F.col("url_folded")).alias("url"),
        fill_default(F.col("status_folded"), DEFAULT_STATUS).alias("status"),
        F.col("status_folded").alias("status_text"),
        "status_provided",
        F.col("publication_date_provided").alias("publication_provided"),
        F.col("registration_deadline_provided").alias("deadline_provided"),
        F.col("record").alias("raw_payload"),
        *keep,
    )


def batch_keys(raw: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Only the duplicate keys of each record, read from two fields."""
    keep = [*within, "row_number"]
    rows = normalize_fields(raw, ("external_id", "url"), keep)
    return rows.select(
        *keep,
        F.col("external_id_folded").alias("external_key"),
        canonical_url(F.col("url"), F.col("url_folded")).alias("url"),
    )


def flag_batch(
    raw: DataFrame, within: Sequence[str] = (), batches: DataFrame | None = None
) -> DataFrame:
    """Clean records with their duplicate flags.

    The keys are read at once and kept, as they are looked at twice; the records are read once
    more for their rows. With ``batches`` these meet the flags as they are and are cleaned after,
    as the clean fields beside the record would double what is dealt out. That is for whoever
    keeps the rows: a filter on them would be moved below the cleaning, with a copy of it.
    """
    shared_dir(raw.sparkSession)
    keys = batch_keys(raw, within).checkpoint()
    if batches is None:
        return flag_duplicates(clean_records(raw, within), "row_number", within, keys)
    rows = raw.select(*within, "row_number", "record")
    flagged = flag_duplicates(rows, "row_number", within, keys, batches)
    return clean_records(flagged, within, [*BATCH_KEYS, "is_duplicate"])


def tag_rejections(flagged: DataFrame) -> DataFrame:
    """Add ``reasons``, the ordered codes of all broken rules."""
    return flagged.withColumn("reasons", reason_codes(record_rules()))


def valid_notices(tagged: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Rows without a reason, with their content hash."""
    return tagged.where(F.size("reasons") == 0).select(
        *within,
        "row_number",
        "external_id",
        "title",
        "organization",
        "notice_number",
        "publication_date",
        "registration_deadline",
        "url",
        "status",
        content_hash().alias("content_hash"),
        "raw_payload",
    )


def rejected_records(tagged: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    return tagged.where(F.size("reasons") > 0).select(
        *within, "row_number", "external_id", "reasons", "raw_payload"
    )


def batch_metrics(tagged: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Counters of each batch; without ``within`` one row, zeros for an empty batch."""
    rejected = F.size("reasons") > 0
    return tagged.groupBy(*within).agg(
        F.count("*").alias("input_count"),
        F.count_if(~rejected).alias("valid_count"),
        F.count_if(rejected).alias("rejected_count"),
        F.count_if("is_duplicate").alias("duplicate_count"),
    )


def reason_summary(tagged: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """How many rows carry each reason."""
    return (
        tagged.select(*within, F.explode("reasons").alias("code"))
        .groupBy(*within, "code")
        .agg(F.count("*").alias("rows"))
    )

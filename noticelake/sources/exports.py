"""CSV exports of a transformed batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.functions import iso_text, payload_json
from noticelake.operators.rules import reason_texts
from noticelake.schemas import CLEAN_COLUMNS, REJECT_COLUMNS

# Fixed value: what joins several reasons of one row.
REASON_SEPARATOR = " | "

_CSV = {"header": True, "escape": '"', "quote": '"', "emptyValue": "", "encoding": "UTF-8"}


def valid_rows(valid: DataFrame) -> DataFrame:
    """Clean notices as text columns in the fixed export order."""
    texts = {
        "publication_date": iso_text(F.col("publication_date")),
        "registration_deadline": iso_text(F.col("registration_deadline")),
        "raw_payload": payload_json(F.col("raw_payload")),
    }
    return valid.select(*[texts.get(c, F.col(c)).alias(c) for c in CLEAN_COLUMNS])


def rejected_rows(rejected: DataFrame) -> DataFrame:
    """Rejected records with their reasons in one text."""
    texts = {
        "row_number": F.col("row_number").cast("string"),
        "reasons": F.array_join(reason_texts(F.col("reasons")), REASON_SEPARATOR),
        "raw_payload": payload_json(F.col("raw_payload")),
    }
    return rejected.select(*[texts.get(c, F.col(c)).alias(c) for c in REJECT_COLUMNS])


def export_valid(valid: DataFrame, path: str) -> None:
    valid_rows(valid).write.mode("errorifexists").options(**_CSV).csv(path)


def export_rejected(rejected: DataFrame, path: str) -> None:
    rejected_rows(rejected).write.mode("errorifexists").options(**_CSV).csv(path)


def read_export(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """Read an export back, all columns as text."""
    schema = ", ".join(f"{c} string" for c in columns)
    return spark.read.schema(schema).options(**_CSV).csv(path)

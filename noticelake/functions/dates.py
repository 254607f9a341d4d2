"""Dates, durations and stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticelake.schemas import STAMP_FORMAT

# Fixed value: the only accepted date text, year first.
_DATE_TEXT = r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}$"


def parse_iso_date(text: Column) -> Column:
    """Year-month-day text to a date; anything else, or an impossible day, is null."""
    return F.when(text.rlike(_DATE_TEXT), text.try_cast("date"))


def iso_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def deadline_ok(published: Column, deadline: Column) -> Column:
    """False only when both dates are known and the deadline comes first."""
    return F.coalesce(deadline >= published, F.lit(True))


def duration_seconds(started: Column, finished: Column) -> Column:
    """Seconds between two timestamps; null while unfinished."""
    return (F.unix_micros(finished) - F.unix_micros(started)) / F.lit(1e6)


def is_finished(finished: Column) -> Column:
    return finished.isNotNull()


def utc_stamp(moment: Column) -> Column:
    """Compact UTC stamp for file names, whatever the session time zone."""
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), moment.cast("timestamp_ntz"))
    return F.date_format(utc, STAMP_FORMAT)

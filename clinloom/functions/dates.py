"""FHIR dates and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY = r"\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])"
_TIME = r"T([01]\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d+)?)?(Z|[+-]\d\d:\d\d)?"


def fhir_datetime(value: Column) -> Column:
    """struct<date, ts>: the day as written and the time in UTC without a zone. A day alone is its
    midnight; a time without a zone counts as UTC; years and months alone, and impossible days, are null."""
    text, first = F.trim(value), F.substring(F.trim(value), 1, 10)
    # what fits the pattern is read by a plain cast
    day = F.when(text.rlike(f"^{_DAY}({_TIME})?$"), first.try_cast("date"))
    # the session's zone is UTC, so a timestamp's wall clock is UTC
    moment = F.when(text.rlike(f"^{_DAY}{_TIME}$"), F.try_to_timestamp(text)).otherwise(first.try_cast("date").cast("timestamp"))
    return F.when(day.isNotNull() & moment.isNotNull(), F.struct(day.alias("date"), moment.cast("timestamp_ntz").alias("ts")))

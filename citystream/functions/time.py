"""Timestamp normalisation shared by every feed.

Producers send `timestamp` either as epoch milliseconds (a JSON number, which
arrives here as a digit string) or as an ISO-8601 string with or without a
zone suffix. Both become one TIMESTAMP column; anything else becomes NULL so
the validator can route it to the dead-letter branch instead of failing the
job (a plain cast raises under ANSI mode)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# At most 15 digits: every such number is a time, longer ones would overflow.
EPOCH_MS_PATTERN = r"^-?[0-9]{1,15}$"
# A date is asked for: a bare time of day would mean the day the job runs on.
ISO_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ].*)?$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_time(ts: str | Column = "timestamp") -> Column:
    """STRING epoch-ms or ISO-8601 -> TIMESTAMP (NULL when unparseable)."""
    ts = F.trim(_col(ts))
    return (F.when(ts.rlike(EPOCH_MS_PATTERN), F.timestamp_millis(ts.try_cast("bigint")))
             .when(ts.rlike(ISO_PATTERN), ts.try_cast("timestamp")))


def epoch_ms(ts: str | Column) -> Column:
    """TIMESTAMP -> BIGINT epoch milliseconds."""
    return F.unix_millis(_col(ts))


def iso_string(ts: str | Column) -> Column:
    """TIMESTAMP -> ISO-8601 UTC text with milliseconds, as producers write it."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS")


def bound_string(ts: str | Column) -> Column:
    """Window bound as text (`2024-01-01 00:15:00`), the format advisories carry."""
    return F.date_format(_col(ts), "yyyy-MM-dd HH:mm:ss")

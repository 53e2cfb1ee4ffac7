"""Column expressions shared by the operators; all of them run inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskweave.schemas import FLAG_THRESHOLD, SPLIT_SEED

# Text formats of dates and event times.
DATE_FORMAT = "yyyy-MM-dd"
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(c: str | Column) -> Column:
    """Microseconds since the epoch of a timestamp (zone-less ones count as session zone)."""
    return F.unix_micros(_col(c).cast("timestamp"))


def no_nan(c: str | Column) -> Column:
    """NULL in place of NaN."""
    return F.when(~F.isnan(_col(c)), _col(c))


def lenient_number(c: str | Column) -> Column:
    """Text to double; what does not parse becomes NULL."""
    return no_nan(_col(c).try_cast("double"))


def lenient_money(c: str | Column) -> Column:
    """Anything to decimal(12,2); what does not parse or fit becomes NULL."""
    return _col(c).try_cast("decimal(12,2)")


def lenient_date(c: str | Column) -> Column:
    """ISO date text to date; what does not parse becomes NULL."""
    return F.try_to_timestamp(_col(c), F.lit(DATE_FORMAT)).cast("date")


def iso_date(c: str | Column) -> Column:
    return F.date_format(_col(c), DATE_FORMAT)


def event_time_text(c: str | Column) -> Column:
    """ISO-8601 text with offset, as transaction messages carry it."""
    return F.date_format(_col(c).cast("timestamp"), EVENT_TIME_FORMAT)


def flagged(probability: str | Column, threshold: float = FLAG_THRESHOLD) -> Column:
    """1 where the probability reaches the threshold, else 0."""
    return (_col(probability) >= F.lit(threshold)).cast("int")


def split_hash(c: str | Column, seed: int = SPLIT_SEED) -> Column:
    """A reproducible 32-digit hex hash of an id, independent of partitioning; rows without
    an id hash like an empty one."""
    text = F.coalesce(_col(c).cast("string"), F.lit(""))
    return F.md5(F.concat(text, F.lit(str(seed))))

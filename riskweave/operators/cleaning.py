"""Order cleaning: typing, stamps, first arrival, JSON-safe rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.functions.columns import iso_date, lenient_date, lenient_number, no_nan
from riskweave.schemas import ORDER_FLOW_NAME


def coerce_types(df: DataFrame) -> DataFrame:
    """`amount` to double and `order_date` to date, where present; bad values are NULL."""
    typing = {"amount": lenient_number, "order_date": lenient_date}
    return df.withColumns({c: f(c) for c, f in typing.items() if c in df.columns})


def stamp_ingest(df: DataFrame, run_date: str, flow: str = ORDER_FLOW_NAME) -> DataFrame:
    """Adds the run date and the name of the flow that took the rows in."""
    return df.withColumns(
        {"ingestion_date": F.lit(run_date), "pipeline": F.lit(flow)}
    )


def dedupe_first(
    df: DataFrame, key: str = "order_id", arrival: Sequence[str] = ("seq",)
) -> DataFrame:
    """The first arrival of each key; NULL keys count as one key.

    An aggregate rather than a ranking: each task keeps one row per key before the
    shuffle, so a key repeated without end costs no more than any other.
    """
    if key not in df.columns:
        return df
    rest = [c for c in df.columns if c != key and c not in arrival]
    first = F.min(F.struct(*arrival, *rest)).alias("_first")
    return df.groupBy(key).agg(first).select(key, "_first.*").select(*df.columns)


def skip_null_key(df: DataFrame, key: str = "order_id") -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def json_safe(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO date text, NaN as NULL."""
    safe = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            safe[f.name] = iso_date(f.name)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            safe[f.name] = no_nan(f.name)
    return df.withColumns(safe) if safe else df


def json_records(df: DataFrame) -> DataFrame:
    """One JSON record per row, NULL fields kept."""
    return json_safe(df).select(
        F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("record")
    )


def clean_orders(df: DataFrame, run_date: str, flow: str = ORDER_FLOW_NAME) -> DataFrame:
    """The whole cleaning of order messages.

    The first arrival does not depend on types or stamps, so duplicates go before
    anything else is done to them or shuffled with them.
    """
    return json_safe(stamp_ingest(coerce_types(dedupe_first(df)), run_date, flow))

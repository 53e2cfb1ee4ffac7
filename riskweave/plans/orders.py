"""The order load: messages -> cleaned orders -> refreshed order summary -> check."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from riskweave.operators.checks import require_rules, verify_output
from riskweave.operators.cleaning import clean_orders
from riskweave.schemas import ORDER_FLOW_NAME
from riskweave.sinks.inserts import insert_new
from riskweave.sinks.stores import replace_batch
from riskweave.sinks.tables import VersionedTable, full_refresh, order_summary_rows
from riskweave.sources.messages import bounded_drain, read_orders, split_orders


@dataclass(frozen=True)
class OrderLoad:
    taken: int
    loaded: int
    status: str


def load_orders(
    messages: DataFrame,
    target: VersionedTable,
    run_date: str,
    quarantine: str | None = None,
    limit: int | None = None,
    **options,
) -> OrderLoad:
    """Loads queue messages (`seq`, `value`) into the order summary, replacing it.

    The whole backlog is taken. A caller that can continue behind the messages taken may
    bound one run to the oldest `limit`.
    """
    if limit is not None:
        messages = bounded_drain(messages, limit)
    return load_read_orders(read_orders(messages), target, run_date, quarantine, **options)


def load_read_orders(
    read: DataFrame,
    target: VersionedTable,
    run_date: str,
    quarantine: str | None = None,
    flow: str = ORDER_FLOW_NAME,
    skip_if_empty: bool = False,
    keep_versions: int | None = None,
    run_id: int | None = None,
) -> OrderLoad:
    """The load from rows of `read_orders`. Rejected messages go to `quarantine` once the load
    has replaced the table; with `run_id`, in place of those an earlier try of that run left.

    Rows that break the rules of the order summary stop the load before it replaces
    anything.
    """
    # The messages are read and parsed once; the good and the bad part come from the copy.
    read = read.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        good, bad = split_orders(read)
        cleaned = clean_orders(good, run_date, flow)
        rows = order_summary_rows(cleaned, run_date).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            require_rules(rows, "order_summary")
            loaded = full_refresh(target, rows, skip_if_empty, keep_versions)
        finally:
            rows.unpersist()
        if quarantine and run_id is not None:
            replace_batch(bad, quarantine, run_id)
        elif quarantine:
            bad.write.mode("append").parquet(quarantine)
        # Cleaning leaves rows exactly when there were good messages.
        status = verify_output(good, "cleaned_orders", good.sparkSession).first()["status"]
        taken = read.count()
    finally:
        read.unpersist()
    return OrderLoad(taken, loaded, status)


def insert_orders(messages: DataFrame, path: str, run_date: str) -> OrderLoad:
    """Adds the orders of the messages that the summary below `path` does not have yet, and
    leaves those it has as they are; `loaded` is how many were inserted."""
    read = read_orders(messages).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        good, _ = split_orders(read)
        rows = order_summary_rows(clean_orders(good, run_date, ORDER_FLOW_NAME), run_date)
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            require_rules(rows, "order_summary")
            inserted = insert_new(rows, path)
        finally:
            rows.unpersist()
        status = verify_output(good, "cleaned_orders", good.sparkSession).first()["status"]
        taken = read.count()
    finally:
        read.unpersist()
    return OrderLoad(taken, inserted, status)

"""The three stores of scored transactions and what each of them takes."""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from riskweave.operators.rollup import (
    added_partials,
    batch_summary,
    daily_partials,
    metrics_of_partials,
)
from riskweave.schemas import ANALYTICS_COLUMNS, LAKE_COLUMNS, MONEY, OPS_COLUMNS
from riskweave.session import folders_below, has_files, remove
from riskweave.sinks.manifest import CommitLog, Entry, Manifest

BATCH = "batch_id"
log = logging.getLogger(__name__)


def ops_rows(scored: DataFrame) -> DataFrame:
    """Nine columns, money as decimal."""
    return scored.select(*OPS_COLUMNS).withColumn("amount", F.col("amount").cast(MONEY))


def lake_rows(scored: DataFrame) -> DataFrame:
    """Nine columns and the day of the event."""
    return scored.select(*LAKE_COLUMNS, F.to_date("event_time").alias("event_date"))


def analytics_rows(scored: DataFrame) -> DataFrame:
    """Eight columns, money as decimal, and the month of scoring."""
    return scored.select(
        *ANALYTICS_COLUMNS, F.date_format("scored_at", "yyyyMM").alias("scored_month")
    ).withColumn("amount", F.col("amount").cast(MONEY))


def _counts() -> list[Column]:
    flagged_rows = F.sum(F.col("is_flagged").cast("long"))
    return [
        F.count(F.lit(1)).alias("n_scored"),
        F.coalesce(flagged_rows, F.lit(0)).alias("n_flagged"),
    ]


def write_partitioned(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = (),
    clustered: Sequence[str] = (),
    mode: str = "append",
    observed: Observation | None = None,
) -> None:
    """Parquet below `path`, rows of a partition together and files of even size.

    The rebalance splits a partition that holds most of the rows over several
    tasks and merges small ones; `clustered` orders the rows inside each file.
    `observed` takes the counts of the batch from the very tasks that write, whose repeats
    after a loss count once.
    """
    if partitions:
        df = df.hint("rebalance", *partitions)
    if clustered:
        df = df.sortWithinPartitions(*partitions, *clustered)
    if observed is not None:
        df = df.observe(observed, *_counts())
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(path)


def replace_batch(
    df: DataFrame,
    path: str,
    batch_id: int,
    partitions: Sequence[str] = (),
    clustered: Sequence[str] = (),
) -> None:
    """The rows of one batch, in place of all that an earlier try of it left behind.

    A batch has a folder of its own, named so that readers of `path` see `batch_id`.
    """
    folder = f"{path}/{BATCH}={batch_id}"
    remove(df.sparkSession, folder)  # as a whole, with partitions the new rows have not
    write_partitioned(df, folder, partitions, clustered)


def stream_identity(spark: SparkSession) -> str:
    """The id that a stream's checkpoint gives it, inside its `foreachBatch`; else empty."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""


MERGED_AT = 8  # folders of a level are merged when there are this many
GRACE_SECONDS = 3600.0  # what does not count any more stays so long, for readers under way


@dataclass(frozen=True)
class TableStore:
    """A Parquet table that a batch can be written to again without doubling rows.

    The folders that count stand in a commit log. A batch is known by its stream (the id in the
    checkpoint) and its number; written again, it takes the place of its first try. A new
    checkpoint is a new stream, whose batches are counted from 0 beside those of the old one.
    `compact` merges all but each stream's newest batch into files by partition, and
    merged folders with others of their size, so there are few however long the table lives.
    """

    path: str
    rows: Callable[[DataFrame], DataFrame]
    partitions: tuple[str, ...] = ()
    clustered: tuple[str, ...] = ()
    merged: Callable[[DataFrame], DataFrame] | None = None  # how rows of many batches shrink

    def log(self, spark: SparkSession) -> CommitLog:
        return CommitLog(spark, f"{self.path}/log")

    def _folder(self, name: str) -> str:
        return f"{self.path}/data/folder={name}"

    def write(self, scored: DataFrame, batch_id: int, stream: str | None = None) -> None:
        self.write_counted(scored, batch_id, stream)

    def write_counted(
        self, scored: DataFrame, batch_id: int, stream: str | None = None
    ) -> Row | None:
        """Writes the batch and returns its counts, where its rows are written as they are."""
        spark = scored.sparkSession
        stream = stream_identity(spark) if stream is None else stream
        log = self.log(spark)
        if batch_id <= log.latest().closed.get(stream, -1):
            return None  # it was whole before it was closed
        rows = self.rows(scored).withColumn(BATCH, F.lit(batch_id).cast("long"))
        entry = Entry(f"b{uuid.uuid4().hex}", 0, stream, batch_id)
        observed = Observation() if "is_flagged" in rows.columns else None
        folder = self._folder(entry.folder)
        write_partitioned(rows, folder, self.partitions, self.clustered, observed=observed)
        holds = has_files(spark, folder)

        def change(now: Manifest) -> Manifest | None:
            if batch_id <= now.closed.get(stream, -1):
                return None
            old = {e.folder for e in now.entries if (e.level, e.stream, e.batch) == (0, stream, batch_id)}
            return _swapped(now, old, [entry] if holds else [])

        log.commit(change)
        # A plan that Spark found empty has no tasks that could be observed.
        return Row(batch_id=batch_id, **observed.get) if observed and holds else None

    def _read(self, spark: SparkSession, entries: Sequence[Entry]) -> DataFrame:
        folders = [self._folder(e.folder) for e in entries]
        reader = spark.read.option("basePath", f"{self.path}/data")
        return reader.parquet(*folders).drop("folder")

    def read(self, spark: SparkSession) -> DataFrame:
        entries = self.log(spark).latest().entries
        if not entries:
            raise FileNotFoundError(f"no batch has been written to {self.path}")
        return self._read(spark, entries)

    def compact(self, spark: SparkSession, grace_seconds: float = GRACE_SECONDS) -> int:
        """Merges all open batches but each stream's newest, which it may still repeat, and
        returns how many. Only the manifest makes the step count: a run that fails before
        leaves a folder that nothing names, and of two runs at once the second one gives up."""
        log = self.log(spark)
        now = log.latest()
        batches: dict[str, list[Entry]] = {}
        for e in now.entries:
            if e.level == 0:
                batches.setdefault(e.stream, []).append(e)
        closing = [e for own in batches.values() for e in sorted(own, key=lambda e: e.batch)[:-1]]
        if closing:
            merging, level = list(closing), 1
            while len(same := [e for e in now.entries if e.level == level]) >= MERGED_AT - 1:
                merging, level = merging + same, level + 1
            merged = Entry(f"m{uuid.uuid4().hex}", level)
            rows = self._read(spark, merging)
            rows = self.merged(rows) if self.merged else rows
            write_partitioned(rows, self._folder(merged.folder), self.partitions, self.clustered)

            def change(latest: Manifest) -> Manifest | None:
                if not set(merging) <= set(latest.entries):
                    return None
                new = _swapped(latest, {e.folder for e in merging}, [merged])
                for e in closing:
                    new.closed[e.stream] = max(new.closed.get(e.stream, -1), e.batch)
                return new

            if log.commit(change) is None:
                remove(spark, self._folder(merged.folder))
                return 0
        self.clean(spark, grace_seconds)
        return len(closing)

    def clean(self, spark: SparkSession, grace_seconds: float = GRACE_SECONDS) -> int:
        """Removes folders that have not counted for `grace_seconds`, those of failed tries
        included; returns how many."""
        log = self.log(spark)
        now, before = log.latest(), time.time() - grace_seconds
        counting = {e.folder for e in now.entries}
        gone = []
        for name, written_at in folders_below(spark, f"{self.path}/data"):
            folder = name.removeprefix("folder=")
            if folder not in counting and now.dropped.get(folder, written_at) <= before:
                remove(spark, self._folder(folder))
                gone.append(folder)
        if set(gone) & now.dropped.keys():
            log.commit(
                lambda m: replace(m, dropped={f: t for f, t in m.dropped.items() if f not in gone})
            )
        return len(gone)


def _swapped(now: Manifest, old: set[str], new: list[Entry]) -> Manifest:
    """The manifest with `new` in place of the `old` folders."""
    kept = tuple(e for e in now.entries if e.folder not in old)
    dropped = now.dropped | dict.fromkeys(old, time.time())
    return Manifest(now.version, (*kept, *new), dict(now.closed), dropped)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a `TableStore`, or of plain Parquet."""
    store = TableStore(path, lambda df: df)
    if store.log(spark).versions():
        return store.read(spark)
    return spark.read.parquet(path)


@dataclass(frozen=True)
class CatalogStore:
    """A table of the catalog (`create_tables`), partitioned by batch; a batch written
    again replaces its own partitions."""

    table: str
    rows: Callable[[DataFrame], DataFrame]

    def write(self, scored: DataFrame, batch_id: int) -> None:
        spark = scored.sparkSession
        rows = self.rows(scored).withColumn(BATCH, F.lit(batch_id).cast("long"))
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        columns = spark.table(self.table).columns
        rows.select(*columns).write.mode("overwrite").insertInto(self.table)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)


@dataclass(frozen=True)
class JdbcStore:
    """A database table. A batch written again adds only the ids still absent; ids
    are compared within the batch's own span of `time_column`, which the database
    filters by, so no batch reads the whole table back."""

    url: str
    table: str
    rows: Callable[[DataFrame], DataFrame]
    properties: dict = field(default_factory=dict)
    time_column: str = "event_time"
    key: str = "transaction_id"
    batch_rows: int = 10_000
    connections: int = 32

    def write(self, scored: DataFrame, batch_id: int) -> None:
        spark = scored.sparkSession
        rows = self.rows(scored).dropDuplicates([self.key])
        first, last = rows.agg(F.min(self.time_column), F.max(self.time_column)).first()
        # Read back by several connections, each with a part of the batch's time span.
        reader = spark.read.format("jdbc").options(
            **self.properties, url=self.url, dbtable=self.table
        )
        if first is not None and first < last:
            reader = reader.options(
                partitionColumn=self.time_column,
                lowerBound=str(first),
                upperBound=str(last),
                numPartitions=str(self.connections),
            )
        present = (
            reader.load()
            .filter(F.col(self.time_column).between(F.lit(first), F.lit(last)))
            .select(self.key)
        )
        properties = {
            **self.properties,
            "batchsize": str(self.batch_rows),
            "numPartitions": str(self.connections),
        }
        rows.join(present, self.key, "left_anti").select(*rows.columns).write.jdbc(
            self.url, self.table, mode="append", properties=properties
        )


def table_stores(root: str) -> list[TableStore]:
    """Operational, lake and analytics store as tables below `root`."""
    return [
        TableStore(f"{root}/transactions_scored", ops_rows),
        TableStore(f"{root}/transactions_scored_history", lake_rows, ("event_date",)),
        TableStore(
            f"{root}/transactions_scored_analytics",
            analytics_rows,
            ("scored_month",),
            ("scored_at", "account_id"),
        ),
    ]


def rollup_store(path: str) -> TableStore:
    """Daily metrics that are kept up batch by batch: each batch adds its own sums by day, takes
    their place when it is written again, and compaction adds them up. Goes among the
    stores of `fan_out`."""
    return TableStore(path, daily_partials, ("metric_date",), merged=added_partials)


def read_rollup(
    spark: SparkSession, path: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Daily metrics of a `rollup_store`, of the days from `first` to `last` where given; the
    files of other days are not read."""
    partials = rollup_store(path).read(spark)
    if first is not None:
        partials = partials.filter(F.col("metric_date") >= F.lit(first).cast("date"))
    if last is not None:
        partials = partials.filter(F.col("metric_date") <= F.lit(last).cast("date"))
    return metrics_of_partials(partials)


def fan_out(scored: DataFrame, batch_id: int, stores: Sequence) -> Row:
    """One scored batch to every store; returns and logs how many rows were scored and
    how many flagged. The rows are kept meanwhile, so all stores get the same ones and
    the scoring runs once. The counts come from the first write that can tell them; only
    where none can, they are taken by a job of their own."""
    scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
    counts = None
    try:
        for store in stores:
            told = getattr(store, "write_counted", store.write)(scored, batch_id)
            counts = counts or told
        if counts is None:
            counts = scored.agg(F.lit(batch_id).alias(BATCH), *_counts()).first()
    finally:
        scored.unpersist()
    log.info("batch %d: %d scored, %d flagged", *counts)
    return counts


def batch_counts(stored: DataFrame) -> DataFrame:
    """Rows written and flagged per batch of a store."""
    return batch_summary(stored, BATCH)

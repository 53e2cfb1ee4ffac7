"""Tables that are replaced as a whole, and tables that grow by key or by day."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.schemas import TABLES
from riskweave.session import complete_folders, remove
from riskweave.sinks.stores import write_partitioned


class VersionedTable:
    """A table whose readers see either the old or the new rows, never a mixture.

    Every refresh writes its own folder and then one pointer; the newest pointer names
    the current version. Pointers are numbered, so the newest one is found by listing.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def replace(self, df: DataFrame, version: str | None = None) -> str:
        version = version or uuid.uuid4().hex
        path = f"{self.root}/versions/{version}"
        df.write.mode("overwrite").parquet(path)
        self.point_to(path, version)
        return path

    def _pointers(self) -> list[int]:
        """The numbers of the complete pointers, in order."""
        return [int(n) for n in sorted(complete_folders(self.spark, f"{self.root}/pointer"))]

    def _pointer(self, number: int) -> DataFrame:
        return self.spark.read.schema(
            "version string, path string, promoted_at timestamp"
        ).parquet(f"{self.root}/pointer/{number:012d}")

    def point_to(self, path: str, version: str) -> None:
        pointer = self.spark.createDataFrame(
            [(version, path)], "version string, path string"
        ).withColumn("promoted_at", F.current_timestamp())
        number = max(self._pointers(), default=0) + 1
        pointer.coalesce(1).write.parquet(f"{self.root}/pointer/{number:012d}")

    def pointer(self) -> DataFrame | None:
        """The current pointer row, None before the first version."""
        pointers = self._pointers()
        return self._pointer(pointers[-1]) if pointers else None

    def forget(self, keep: int) -> None:
        """Removes all but the `keep` newest pointers, and the folders only they name."""
        pointers = self._pointers()
        named = {n: self._pointer(n).first()["path"] for n in pointers}
        kept = {named[n] for n in pointers[-keep:]}
        for n in pointers[:-keep]:
            if named[n] not in kept:
                remove(self.spark, named[n])
            remove(self.spark, f"{self.root}/pointer/{n:012d}")

    def read(self) -> DataFrame | None:
        now = self.pointer()
        return None if now is None else self.spark.read.parquet(now.first()["path"])


def order_summary_rows(cleaned: DataFrame, load_date: str) -> DataFrame:
    """The columns of the order summary, one row per order that has an id."""
    return cleaned.filter(F.col("order_id").isNotNull()).select(
        F.col("order_id").cast("string").alias("order_id"),
        "customer_id",
        F.col("amount").try_cast("decimal(12,2)").alias("amount"),
        F.lit(load_date).cast("date").alias("load_date"),
    )


def full_refresh(
    table: VersionedTable,
    df: DataFrame,
    skip_if_empty: bool = False,
    keep_versions: int | None = None,
) -> int:
    """Replaces all rows of the table and returns how many it holds now.

    An empty set empties the table unless `skip_if_empty` keeps what is there. Older
    versions stay, for readers under way, or the newest `keep_versions` of them.
    """
    if skip_if_empty and df.isEmpty():
        return 0
    path = table.replace(df)
    if keep_versions:
        table.forget(keep_versions)
    return table.spark.read.parquet(path).count()


def insert_if_absent(new: DataFrame, present: DataFrame, key: str = "order_id") -> DataFrame:
    """The rows of `new`, already one per key, whose key is not present yet."""
    return new.join(present.select(key), key, "left_anti").select(*new.columns)


def append_snapshot(spark: SparkSession, table: str, path: str) -> None:
    """A table's rows as a Parquet snapshot."""
    spark.table(table).write.mode("overwrite").parquet(path)


def write_daily_metrics(metrics: DataFrame, path: str) -> None:
    """Metrics by day; writing a day again replaces it."""
    write_partitioned(metrics, path, ["metric_date"], mode="overwrite")


def write_metrics(metrics: DataFrame, path: str) -> None:
    """The metrics row as a JSON document."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def create_tables(spark: SparkSession, database: str, location: str) -> list[str]:
    """The five tables, below `location`; returns their full names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    for name, (columns, partitions) in TABLES.items():
        by = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet{by}"
        )
    return [f"{database}.{name}" for name in TABLES]

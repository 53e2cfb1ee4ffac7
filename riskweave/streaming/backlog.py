"""How far a stream is behind its source, from its checkpoint or its progress."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.session import files_below

SEEN = "path string, timestamp bigint, batchId bigint"


def _last_committed(spark: SparkSession, checkpoint: str) -> int | None:
    """The newest batch that the stream has finished. One in its offsets alone is under way."""
    names = [f.rsplit("/", 1)[1] for f in files_below(spark, f"{checkpoint}/commits")]
    return max((int(n) for n in names if n.isdigit()), default=None)


def _source_offset(spark: SparkSession, checkpoint: str, batch: int) -> int:
    """Up to which entry of its own log the file source had got with a batch."""
    lines = [r["value"] for r in spark.read.text(f"{checkpoint}/offsets/{batch}").collect()]
    return json.loads(lines[2])["logOffset"]  # version, settings, a line for each source


def seen_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The files (path) whose messages a stream on one file source has finished with."""
    batch = _last_committed(spark, checkpoint)
    if batch is None:
        return spark.createDataFrame([], "path string")
    entries = spark.read.text(f"{checkpoint}/sources/0").select(
        F.from_json("value", SEEN).alias("entry")
    )
    until = _source_offset(spark, checkpoint, batch)
    return entries.select("entry.*").filter(F.col("batchId") <= until).select("path").distinct()


def file_backlog(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """One row, pending_files and pending: what a stopped or running stream of `message_files`
    has still to take, exactly. Messages of a batch under way are pending until it is
    committed. Only files the stream has not finished with are read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    names = F.regexp_replace("path", "^([a-z0-9]+):/*", "$1:/")  # file:/ and file:/// are one
    there = files.load(path).select("path", names.alias("name"))
    taken = seen_files(spark, checkpoint).select(names.alias("name"))
    # As many names as the source lists on the driver whenever it looks for new files.
    left = [r["path"] for r in there.join(taken, "name", "left_anti").select("path").collect()]
    lines = spark.read.text(left) if left else spark.createDataFrame([], "value string")
    return lines.agg(F.lit(len(left)).alias("pending_files"), F.count(F.lit(1)).alias("pending"))


def progress_backlog(progress: dict) -> int:
    """Messages that a stream's sources held beyond what it had taken, by one of its progress
    events (`query.lastProgress`), for sources whose offsets are numbers by topic and partition.
    """
    pending = 0
    for source in progress["sources"]:
        ends, latest = (_offsets(source.get(k)) for k in ("endOffset", "latestOffset"))
        pending += sum(
            max(0, n - ends.get(topic, {}).get(partition, 0))
            for topic, partitions in latest.items()
            for partition, n in partitions.items()
        )
    return pending


def _offsets(given) -> dict:
    got = json.loads(given) if isinstance(given, str) else given
    return got or {}

"""The order load as a stream: bounded micro-batches stage what they read, then one load
replaces the table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.plans.orders import OrderLoad, load_read_orders
from riskweave.session import remove
from riskweave.sinks.stores import BATCH, replace_batch
from riskweave.sinks.tables import VersionedTable
from riskweave.sources.messages import read_orders


def stage_pending(messages: DataFrame, staged: str, checkpoint: str) -> None:
    """Reads what is pending on a stream of (`seq`, `value`) into the table `staged`.

    Each micro-batch, bounded by the source's own limit, has its own place there, so a
    batch that is repeated replaces what its first try left.
    """

    def stage(batch: DataFrame, batch_id: int) -> None:
        replace_batch(read_orders(batch), staged, batch_id)

    (
        messages.writeStream.foreachBatch(stage)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _staged(spark: SparkSession, path: str, messages: DataFrame) -> DataFrame:
    """All staged rows; none if no batch has ever run."""
    schema = read_orders(spark.createDataFrame([], messages.schema)).schema.add(BATCH, "long")
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def load_pending_orders(
    messages: DataFrame,
    target: VersionedTable,
    run_date: str,
    checkpoint: str,
    quarantine: str | None = None,
    **options,
) -> OrderLoad:
    """One run: takes all that is pending on the stream, then replaces the order summary
    with the cleaned orders of all its micro-batches together.

    The staged messages are released only after the table is replaced: a run that fails
    in between leaves them to the next one. With nothing pending the table is emptied, or
    kept with `skip_if_empty`.
    """
    spark = target.spark
    staged = f"{target.root}/staged"
    stage_pending(messages, staged, checkpoint)
    rows = _staged(spark, staged, messages)
    # The same for each try of a run, and another one after the stage is released.
    run_id = rows.agg(F.min(BATCH)).first()[0]
    done = load_read_orders(
        rows.drop(BATCH), target, run_date, quarantine, run_id=run_id, **options
    )
    remove(spark, staged)
    return done

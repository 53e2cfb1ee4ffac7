"""The streaming scorer: messages -> features -> model -> stores, by micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskweave.operators.features import FEATURES, account_features
from riskweave.plans.model import score
from riskweave.schemas import TRIGGER_INTERVAL
from riskweave.session import temporary
from riskweave.sinks.stores import fan_out, replace_batch
from riskweave.sources.messages import good_and_bad, read_transactions
from riskweave.streaming.features import live_features

Model = Callable[[], tuple[str, object]]
TAKEN_AT = "_taken_at"


def score_batch(
    good: DataFrame,
    model,
    scored_at: datetime | None = None,
    by: Sequence[str] = ("account_id",),
) -> DataFrame:
    """Scored rows of one micro-batch. Features look at this batch only, unless the rows
    bring them along.

    The scoring time is that of the batch (TAKEN_AT), which a stream keeps with its
    offsets: a batch that is repeated gets the same one. Elsewhere it is taken once.
    """
    if not set(FEATURES) <= set(good.columns):
        good = account_features(good, by)
    rows = score(good, model)
    if scored_at is None and TAKEN_AT in rows.columns:
        return rows.withColumnRenamed(TAKEN_AT, "scored_at")
    now = scored_at or datetime.now(timezone.utc)
    return rows.drop(TAKEN_AT).withColumn("scored_at", F.lit(now))


def batch_writer(
    model: Model,
    stores: Sequence,
    quarantine: str | None = None,
    scored_at: Callable[[DataFrame], DataFrame] | None = None,
    by: Sequence[str] = ("account_id",),
    taken: dict[int, int] | None = None,
):
    """The function a stream calls with each micro-batch of messages.

    `model` gives (version, model) and is asked anew for each batch, so a promoted
    model takes over with the next one. Bad messages go to the `quarantine` table. `taken`
    is given the number of messages of each batch. Batches of rows that were read already
    (`live_features`) are taken as they are.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # The source is read and parsed once; a lost executor reads its part again.
        read = batch if "reason" in batch.columns else read_transactions(batch)
        read = read.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            with temporary(batch.sparkSession):
                if taken is not None:
                    taken[batch_id] = read.count()
                good, bad = good_and_bad(read)
                if quarantine and not bad.isEmpty():
                    replace_batch(bad.drop(TAKEN_AT, *FEATURES), quarantine, batch_id)
                if good.isEmpty():
                    return
                _, fitted = model()
                rows = score_batch(good, fitted, by=by)
                fan_out(scored_at(rows) if scored_at else rows, batch_id, stores)
        finally:
            read.unpersist()

    return write


def start_scoring(
    messages: DataFrame,
    model: Model,
    stores: Sequence,
    checkpoint: str,
    available_now: bool = False,
    live: bool = False,
    **options,
) -> StreamingQuery:
    """Starts the scorer on a stream with a `value` column.

    Offsets are kept in `checkpoint`: a restart resumes where the stream stopped and
    repeats at most the last batch, which the stores replace: its time of scoring is fixed
    with its offsets, so it goes to the same place again.

    With `live`, features come from state that the checkpoint keeps across micro-batches;
    otherwise they look at each micro-batch alone. One checkpoint serves one of the two.
    """
    messages = messages.withColumn(TAKEN_AT, F.current_timestamp())
    if live:
        messages = live_features(read_transactions(messages), expires=not available_now)
    writer = messages.writeStream.foreachBatch(
        batch_writer(model, stores, **options)
    ).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=TRIGGER_INTERVAL).start()

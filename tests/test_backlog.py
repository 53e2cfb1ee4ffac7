from pyspark.sql import functions as F

from riskweave.operators.rollup import batch_summary
from riskweave.sinks import stores
from riskweave.streaming.backlog import file_backlog, progress_backlog


def _drain(spark, root, fails=False):
    def write(batch, batch_id):
        batch.count()
        if fails:
            raise OSError("the sink is gone")

    query = (
        spark.readStream.text(f"{root}/in")
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    except Exception:
        assert fails


def _pending(spark, root):
    return tuple(file_backlog(spark, f"{root}/in", f"{root}/checkpoint").first())


def test_files_and_messages_before_a_stopped_stream(spark, tmp_path):
    root = str(tmp_path)

    def deliver(rows, files):
        lines = spark.range(rows).select(F.col("id").cast("string").alias("value"))
        lines.repartition(files).write.mode("append").text(f"{root}/in")

    deliver(30, 3)
    assert _pending(spark, root) == (3, 30)
    _drain(spark, root)
    assert _pending(spark, root) == (0, 0)
    deliver(20, 2)
    assert _pending(spark, root) == (2, 20)
    _drain(spark, root, fails=True)  # its offsets are planned, the batch is not committed
    assert _pending(spark, root) == (2, 20)
    for _ in range(12):  # past the point where the source's log is compacted
        _drain(spark, root)
        deliver(5, 1)
    assert _pending(spark, root) == (1, 5)


def test_pending_by_a_progress_event():
    source = {"endOffset": {"t": {"0": 5, "1": 7}}, "latestOffset": '{"t": {"0": 9, "1": 7, "2": 3}}'}
    assert progress_backlog({"sources": [source, {"endOffset": None, "latestOffset": None}]}) == 7


def _scored(spark, n):
    return spark.range(n).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.lit("a").alias("account_id"),
        F.lit(1.0).alias("amount"),
        F.lit("m").alias("merchant_category"),
        F.lit("L").alias("location"),
        F.timestamp_seconds(F.col("id") * 7200).alias("event_time"),
        F.lit(0.5).alias("fraud_probability"),
        (F.col("id") % 4 == 0).cast("int").alias("is_flagged"),
        F.timestamp_seconds(F.col("id") * 7200).alias("scored_at"),
    )


def test_counts_come_from_the_write(spark, tmp_path):
    targets = stores.table_stores(str(tmp_path / "s"))
    rows = _scored(spark, 500)
    for store in targets:
        told = store.write_counted(rows, 3)
        assert told.asDict() == {"batch_id": 3, "n_scored": 500, "n_flagged": 125}
    assert tuple(stores.fan_out(rows, 4, targets)) == (4, 500, 125)
    tracker, group = spark.sparkContext.statusTracker(), "one-store"
    jobs = []
    for chosen in (targets[:1], []):
        spark.sparkContext.setJobGroup(f"{group}{len(jobs)}", "")
        assert tuple(stores.fan_out(rows, 5, chosen)) == (5, 500, 125)
        jobs.append(len(tracker.getJobIdsForGroup(f"{group}{len(jobs)}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == 1  # the write alone
    assert batch_summary(targets[0].read(spark), "batch_id").count() == 3


def test_counts_of_nothing_and_of_closed_batches(spark, tmp_path):
    store = stores.table_stores(str(tmp_path / "s"))[0]
    assert tuple(stores.fan_out(_scored(spark, 0), 0, [store])) == (0, 0, 0)
    for batch_id in (1, 2, 3):
        store.write(_scored(spark, 10), batch_id)
    store.compact(spark)
    assert tuple(stores.fan_out(_scored(spark, 10), 1, [store])) == (1, 10, 3)

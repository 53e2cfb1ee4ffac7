"""The streaming scorer: quarantine, replay, restart, the forest in a stream."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from riskweave.catalog.stream import _deliver, feature_model
from riskweave.plans import model as models
from riskweave.plans.views import scored, txn
from riskweave.session import scratch
from riskweave.sinks.stores import (
    JdbcStore,
    analytics_rows,
    batch_counts,
    fan_out,
    ops_rows,
    table_stores,
)
from riskweave.sources.files import scan_training_input
from riskweave.sources.messages import encode_transactions, message_files
from riskweave.streaming.scorer import TAKEN_AT, batch_writer, start_scoring


def test_stream_with_forest_and_quarantine(spark, sf_dir):
    root = scratch(spark, "forest")
    plan = models.ForestPlan(
        ("amount", *["txns_last_1h_for_account", "hours_since_last_txn"]), True, 3, 3, True, True
    )
    rows = models.training_rows(scored(spark, sf_dir), plan, "is_fraud")
    forest = models.train_forest(rows, plan)
    _deliver(txn(spark, sf_dir), f"{root}/in")
    bad = spark.createDataFrame([("broken",), ("{}",)], "value string")
    bad.write.mode("append").text(f"{root}/in")
    stores = table_stores(f"{root}/stores")
    start_scoring(
        message_files(spark, f"{root}/in"),
        lambda: ("v", forest),
        stores,
        f"{root}/checkpoint",
        available_now=True,
        quarantine=f"{root}/rejected",
    ).awaitTermination()
    assert [s.read(spark).count() for s in stores] == [1000] * 3
    assert spark.read.parquet(f"{root}/rejected").count() == 2
    times = [s.read(spark).select("scored_at").distinct().collect() for s in stores]
    assert len(times[0]) == 1 and times[0] == times[1] == times[2]


def test_continuous_trigger(spark, sf_dir):
    root = scratch(spark, "continuous")
    stores = table_stores(f"{root}/stores")
    rows = txn(spark, sf_dir)
    _deliver(rows.filter(F.col("transaction_id") % 2 == 0), f"{root}/in")
    query = start_scoring(
        message_files(spark, f"{root}/in"),
        lambda: ("v", feature_model()),
        stores,
        f"{root}/checkpoint",
    )
    try:
        query.processAllAvailable()
        assert stores[0].read(spark).count() == 500
        _deliver(rows.filter(F.col("transaction_id") % 2 == 1), f"{root}/in")
        query.processAllAvailable()
    finally:
        query.stop()
    assert stores[0].read(spark).count() == 1000


def test_taken_messages_are_counted_once(spark, sf_dir):
    root = scratch(spark, "taken")
    _deliver(txn(spark, sf_dir), f"{root}/in")
    taken = {}
    start_scoring(
        message_files(spark, f"{root}/in"),
        lambda: ("v", feature_model()),
        table_stores(f"{root}/stores"),
        f"{root}/checkpoint",
        available_now=True,
        taken=taken,
    ).awaitTermination()
    assert taken == {0: 1000}


def test_a_batch_repeated_after_a_month_end_stays_in_its_month(spark, sf_dir):
    root = scratch(spark, "month")
    stores = table_stores(f"{root}/stores")
    write = batch_writer(lambda: ("v", feature_model()), stores)
    # The stream gives a repeated batch the time it had at first, whatever the clock says.
    messages = encode_transactions(txn(spark, sf_dir)).withColumn(
        TAKEN_AT, F.lit("2024-01-31 23:59:59").cast("timestamp")
    )
    for _ in (1, 2):
        write(messages, 0)
    months = stores[2].read(spark).groupBy("scored_month").count().collect()
    assert [(str(r[0]), r[1]) for r in months] == [("202401", 1000)]


def test_compaction_leaves_few_files_and_all_rows(spark, sf_dir):
    store = table_stores(scratch(spark, "compact"))[1]
    rows = scored(spark, sf_dir)
    with pytest.raises(FileNotFoundError):
        store.read(spark)
    for batch_id in range(4):
        store.write(rows.filter(F.col("transaction_id") % 4 == batch_id), batch_id)
    assert store.compact(spark) == 3 and store.compact(spark) == 0
    closed = list(Path(store.path).glob("data/folder=m*/*/*.parquet"))
    assert len(closed) == 30  # one per day
    store.write(rows, 1)  # closed already
    got = store.read(spark)
    assert got.count() == got.select("transaction_id").distinct().count() == 1000
    assert store.clean(spark, grace_seconds=0) == 3
    assert len(list(Path(store.path).glob("data/folder=b*"))) == 1


def test_replayed_batch_replaces_itself(spark, sf_dir):
    root = scratch(spark, "replay")
    stores = table_stores(f"{root}/stores")
    write = batch_writer(lambda: ("v", feature_model()), stores, f"{root}/rejected")
    messages = encode_transactions(txn(spark, sf_dir))
    for batch_id in (0, 1, 1):
        write(messages, batch_id)
    for store in stores:
        got = {r["batch_id"]: r["n_scored"] for r in batch_counts(store.read(spark)).collect()}
        assert got == {0: 1000, 1: 1000}


def test_fan_out_reports_counts(spark, sf_dir):
    rows = scored(spark, sf_dir)
    got = fan_out(rows, 7, table_stores(scratch(spark, "counts")))
    assert tuple(got) == (7, 1000, rows.filter("is_flagged = 1").count())


def test_empty_batch_writes_nothing(spark, sf_dir):
    root = scratch(spark, "empty")
    write = batch_writer(lambda: 1 / 0, table_stores(root), f"{root}/rejected")
    write(encode_transactions(txn(spark, sf_dir)).limit(0), 0)


def test_restart_takes_only_new_messages(spark, sf_dir):
    root = scratch(spark, "restart")
    stores = table_stores(f"{root}/stores")
    for part in (0, 1):
        _deliver(txn(spark, sf_dir).filter(F.col("transaction_id") % 2 == part), f"{root}/in")
        for _ in range(2):
            start_scoring(
                message_files(spark, f"{root}/in", files_per_trigger=100),
                lambda: ("v", feature_model()),
                stores,
                f"{root}/checkpoint",
                available_now=True,
            ).awaitTermination()
    lake = stores[1].read(spark)
    assert lake.count() == lake.select("transaction_id").distinct().count() == 1000
    assert lake.select("batch_id").distinct().count() == 2


def test_partition_pruning_of_the_lake(spark, sf_dir):
    store = table_stores(scratch(spark, "prune"))[1]
    store.write(scored(spark, sf_dir), 0)
    day = store.read(spark).filter("event_date = date '2024-01-15'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\n]*isnotnull\(event_date", plan)
    assert 0 < len(day.inputFiles()) and day.count() > 0


def test_csv_input_with_and_without_schema(spark, sf_dir):
    path = scratch(spark, "csv")
    micro = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    txn(spark, sf_dir).write.option("header", True).option("timestampFormat", micro).csv(path)
    inferred = scan_training_input(spark, path)
    assert dict(inferred.dtypes)["amount"] == "double"
    given = scan_training_input(spark, path, txn(spark, sf_dir).schema)
    assert given.exceptAll(txn(spark, sf_dir)).count() == 0


def test_jdbc_store_leaves_out_present_ids(spark, sf_dir, monkeypatch):
    """No database runs here; reader and writer are replaced to see what is sent."""
    rows = scored(spark, sf_dir)
    present = ops_rows(rows.filter("is_flagged = 1"))
    sent, asked = {}, {}
    from pyspark.sql import DataFrameReader, DataFrameWriter

    monkeypatch.setattr(DataFrameReader, "options", lambda self, **o: asked.update(o) or self)
    monkeypatch.setattr(DataFrameReader, "load", lambda self: present)

    def jdbc(self, url, table, mode, properties):
        sent.update(url=url, table=table, mode=mode, properties=properties, rows=self._df.count())

    monkeypatch.setattr(DataFrameWriter, "jdbc", jdbc)
    JdbcStore("jdbc:any", "transactions_scored", ops_rows, {"user": "u"}).write(
        rows.unionByName(rows), 0
    )
    assert sent["mode"] == "append"
    assert sent["properties"] == {"user": "u", "batchsize": "10000", "numPartitions": "32"}
    assert sent["rows"] == rows.filter("is_flagged = 0").count()
    first, last = rows.agg(F.min("event_time"), F.max("event_time")).first()
    assert asked["partitionColumn"] == "event_time" and asked["numPartitions"] == "32"
    assert (asked["lowerBound"], asked["upperBound"]) == (str(first), str(last))


def test_jdbc_store_sends_nothing_for_a_replayed_analytics_batch(spark, sf_dir, monkeypatch):
    root = scratch(spark, "jdbc")
    store = table_stores(root)[2]
    write = batch_writer(lambda: ("v", feature_model()), [store])
    messages = encode_transactions(txn(spark, sf_dir)).withColumn(
        TAKEN_AT, F.lit("2024-01-31 23:59:59").cast("timestamp")
    )
    write(messages, 0)
    present = store.read(spark)
    sent = []
    from pyspark.sql import DataFrameReader, DataFrameWriter

    monkeypatch.setattr(DataFrameReader, "load", lambda self: present)
    monkeypatch.setattr(
        DataFrameWriter, "jdbc", lambda self, *a, **b: sent.append(self._df.count())
    )
    jdbc = JdbcStore("jdbc:any", "t", analytics_rows, {}, time_column="scored_at")
    batch_writer(lambda: ("v", feature_model()), [jdbc])(messages, 0)
    assert sent == [0]


def test_limits_of_the_stand_in_model_take_six_digits(spark):
    at = [(1.5000003, 2.0), (1.4999996, 1.9999997), (1.5000006, 1.9999994)]
    rows = spark.createDataFrame(
        [(i, 20.0, z, h, 1) for i, (z, h) in enumerate(at)],
        "i int, amount double, amount_zscore_for_account double, hours_since_last_txn double,"
        " txns_last_1h_for_account long",
    )
    found = models.score(rows, feature_model()).orderBy("i").collect()
    assert [round(r["fraud_probability"], 9) for r in found] == [0.1, 0.1, 0.15]

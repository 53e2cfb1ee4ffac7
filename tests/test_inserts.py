from pyspark.sql import functions as F

import pytest

from riskweave.plans.orders import insert_orders
from riskweave.sinks import inserts


@pytest.fixture
def large(spark, tmp_path):
    path = str(tmp_path / "large")
    ids = F.concat(F.lit("O-"), F.col("id").cast("string"))
    spark.range(200_000).select(ids.alias("order_id"), F.lit("kept").alias("origin")).write.parquet(path)
    return path


def _coming(spark, first, last):
    ids = F.concat(F.lit("O-"), F.col("id").cast("string"))
    return spark.range(first, last).select(ids.alias("order_id"), F.lit("new").alias("origin"))


def test_only_absent_keys_go_in_and_are_counted(spark, large):
    coming = _coming(spark, 199_000, 201_000).cache()
    assert inserts.insert_new(coming, large) == 1000
    assert inserts.insert_new(coming, large) == 0
    got = spark.read.parquet(large)
    assert got.count() == got.select("order_id").distinct().count() == 201_000
    assert got.filter("origin = 'new'").agg(F.min(F.substring("order_id", 3, 9).cast("int"))).first()[0] == 200_000


def test_the_filter_keeps_all_that_match_and_few_others(spark, large):
    present = spark.read.parquet(large)
    coming = _coming(spark, 198_000, 202_000)
    perhaps = inserts.perhaps_among(present, coming, "order_id", 4000)
    assert perhaps.join(coming, "order_id", "left_semi").count() == 2000
    assert perhaps.count() < 2000 + 0.02 * 198_000


def test_the_filter_stands_below_the_exchange(spark, large):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = inserts.absent_rows(_coming(spark, 0, 4000), spark.read.parquet(large), "order_id", 4000)
        lines = rows._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = max(i for i, line in enumerate(lines) if "FileScan" in line)
    probe = max(i for i, line in enumerate(lines[:scan]) if "BroadcastHashJoin" in line)
    shuffle = max(i for i, line in enumerate(lines[:probe]) if "Exchange hashpartitioning(order_id" in line)
    assert shuffle < probe < scan


def test_too_many_keys_take_the_plain_join(spark, large, monkeypatch):
    monkeypatch.setattr(inserts, "MOST_WORDS", 10)
    assert inserts.insert_new(_coming(spark, 199_990, 200_100), large) == 100


def test_no_table_no_rows_no_key_other_type(spark, tmp_path, large):
    path = str(tmp_path / "new")
    none = spark.createDataFrame([(None, "new")], "order_id string, origin string")
    assert inserts.insert_new(none, path) == 0
    assert inserts.insert_new(_coming(spark, 0, 5).unionByName(none), path) == 5
    with pytest.raises(TypeError):
        inserts.insert_new(spark.range(3).withColumnRenamed("id", "order_id"), large)


def test_orders_are_added_not_replaced(spark, tmp_path):
    path = str(tmp_path / "summary")

    def messages(amounts):
        rows = [
            (i, '{"order_id": "%s", "customer_id": "c", "amount": "%s", "order_date": "2024-01-01"}' % (k, a))
            for i, (k, a) in enumerate(amounts)
        ]
        return spark.createDataFrame(rows, "seq long, value string")

    assert insert_orders(messages([("a", 1), ("b", 2)]), path, "2024-02-01").loaded == 2
    again = insert_orders(messages([("b", 9), ("c", 3)]), path, "2024-02-02")
    assert (again.taken, again.loaded) == (2, 1)
    got = {r["order_id"]: float(r["amount"]) for r in spark.read.parquet(path).collect()}
    assert got == {"a": 1, "b": 2, "c": 3}

"""What the plans read, shuffle and write."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from riskweave.operators import cleaning, features, rollup, splits
from riskweave.plans.views import order_msgs, scored, txn
from riskweave.session import scratch
from riskweave.sinks.stores import lake_rows, replace_batch, table_stores


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(df) -> set[str]:
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan(df)).group(1)
    return {c.split(":")[0] for c in schema.split(",") if c}


def test_day_filter_reaches_the_scan(spark, sf_dir):
    text = plan(rollup.filter_day(scored(spark, sf_dir), "2024-01-15"))
    assert "GreaterThanOrEqual(ts,2024-01-15" in text
    assert "LessThan(ts,2024-01-16" in text


def test_only_needed_columns_are_read(spark, sf_dir):
    assert read_columns(rollup.daily_fraud_metrics(scored(spark, sf_dir))) == {"ts", "value"}
    stats = features.account_amount_stats(txn(spark, sf_dir))
    assert read_columns(stats) == {"user_id", "value"}
    score = features.account_features(txn(spark, sf_dir)).select("amount_zscore_for_account")
    assert read_columns(score) == {"user_id", "value"}


def test_splits_do_not_shuffle_rows(spark, sf_dir):
    for split in (splits.random_split, splits.stratified_split):
        assert "Exchange" not in plan(split(scored(spark, sf_dir)))


def test_dedupe_combines_before_the_shuffle(spark, sf_dir):
    text = plan(cleaning.dedupe_first(order_msgs(spark, sf_dir)))
    assert text.count("Exchange") == 1
    assert text.index("Exchange") < text.index("partial_min")  # the tree is printed top down


def test_daily_metrics_combine_before_the_shuffle(spark, sf_dir):
    text = plan(rollup.daily_fraud_metrics(scored(spark, sf_dir)))
    assert text.count("Exchange") == 1 and "partial_sum" in text


def test_a_day_with_all_rows_is_written_by_many_tasks(spark, sf_dir):
    path = scratch(spark, "skew")
    rows = (
        scored(spark, sf_dir)
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(40))))
        .withColumn("event_time", F.lit("2024-01-15 12:00:00").cast("timestamp"))
        .repartition(8)
    )
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, "100k")
    try:
        replace_batch(lake_rows(rows), path, 0, ["event_date"])
    finally:
        spark.conf.set(advisory, before)
    files = list(Path(path).glob("batch_id=0/event_date=2024-01-15/*.parquet"))
    assert len(files) > 3
    assert spark.read.parquet(path).count() == 40_000


def test_small_days_share_few_files(spark, sf_dir):
    store = table_stores(scratch(spark, "files"))[1]
    store.write(scored(spark, sf_dir).repartition(8), 0)
    assert len(list(Path(store.path).glob("data/*/*/*.parquet"))) == 30  # one per day


def test_analytics_rows_are_clustered(spark, sf_dir):
    store = table_stores(scratch(spark, "files"))[2]
    store.write(scored(spark, sf_dir).repartition(8), 0)
    (name,) = Path(store.path).glob("data/*/*/*.parquet")
    rows = [(r["scored_at"], r["account_id"]) for r in spark.read.parquet(str(name)).collect()]
    assert rows == sorted(rows)


@pytest.mark.parametrize("column", ["amount", "merchant_category"])
def test_features_shuffle_no_unused_column(spark, sf_dir, column):
    counted = features.account_features(txn(spark, sf_dir)).select("hours_since_last_txn")
    read_as = {"amount": "value", "merchant_category": "event_type"}[column]
    assert read_as not in read_columns(counted)

"""Values the survey of the operators gives for the tables at scale 0.01."""

import pytest
from pyspark.sql import functions as F

from riskweave.operators import features, metrics, splits
from riskweave.plans.views import order_msgs, scored, table, txn

SF = "/root/testdata/sf0.01"


def test_metrics(spark):
    rows = scored(spark, SF)
    got = metrics.precision_recall(rows).first()
    assert got["precision"] == pytest.approx(0.704632, abs=5e-7)
    assert got["recall"] == pytest.approx(0.524294, abs=5e-7)
    got = metrics.ranking_metrics(rows).first()
    assert got["avg_precision"] == pytest.approx(0.496682, abs=5e-7)
    assert got["roc_auc"] == pytest.approx(0.732106, abs=5e-7)


def test_order_messages(spark):
    got = order_msgs(spark, SF).agg(
        F.count("*"), F.count("order_id"), F.count_distinct("order_id")
    )
    assert tuple(got.first()) == (16154, 15596, 14482)


@pytest.mark.parametrize("limit", [10_000, 50])
def test_counts_of_the_last_hour(spark, limit):
    got = features.account_features(txn(spark, SF), max_group_rows=limit)
    counts = {r[0]: r[1] for r in got.groupBy("txns_last_1h_for_account").count().collect()}
    assert counts == {1: 9147, 2: 822, 3: 31}


def test_splits(spark):
    ids = table(spark, SF, "orders").select(F.col("o_orderkey").alias("transaction_id"))
    assert splits.random_split(ids).filter("split = 'train'").count() == 12019
    assert splits.stratified_split(scored(spark, SF)).filter("split = 'train'").count() == 8000


def test_stratified_share_is_exact(spark):
    for n in (5, 35, 55, 115, 1115):
        rows = spark.range(n).selectExpr("cast(id as string) as transaction_id", "0 as is_fraud")
        for share, want in ((0.8, n * 4 // 5), (0.6, n * 3 // 5), (0.7, -(-n * 7 // 10))):
            got = splits.stratified_split(rows, share=share).filter("split = 'train'").count()
            assert got == want

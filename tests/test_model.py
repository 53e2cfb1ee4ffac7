"""Splits, metrics, the forests, the registry and the daily run."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from riskweave.catalog.training import stand_in_model
from riskweave.operators import metrics, splits
from riskweave.plans import model as models
from riskweave.plans.daily import daily_run
from riskweave.plans.views import scored, txn
from riskweave.session import scratch

SMALL = models.ForestPlan(("amount",), True, 5, 4, True, True)


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    kept = scored(spark, sf_dir).cache()
    yield kept
    kept.unpersist()


def test_auc_equals_evaluator(rows):
    raw = rows.withColumn("raw", F.col("fraud_probability"))
    want = BinaryClassificationEvaluator(
        labelCol="is_fraud", rawPredictionCol="raw", numBins=0
    ).evaluate(raw)
    for slice_rows in (10_000, 20):
        got = metrics.ranking_metrics(rows, slice_rows=slice_rows).first()["roc_auc"]
        assert got == pytest.approx(want, abs=1e-9)


def test_average_precision_from_its_definition(rows):
    pairs = [(r["fraud_probability"], r["is_fraud"]) for r in rows.collect()]
    total = sum(y for _, y in pairs)
    want, last = 0.0, 0.0
    for p in sorted({p for p, _ in pairs}, reverse=True):
        above = [y for q, y in pairs if q >= p]
        recall = sum(above) / total
        want += (recall - last) * sum(above) / len(above)
        last = recall
    got = metrics.ranking_metrics(rows).first()["avg_precision"]
    assert got == pytest.approx(want, abs=1e-9)


def test_undefined_metrics(spark):
    none = spark.createDataFrame([], "is_fraud int, is_flagged int, fraud_probability double")
    assert tuple(metrics.precision_recall(none).first()) == (0.0, 0.0, 0.0)
    got = metrics.ranking_metrics(none).first()
    assert (got["roc_auc"], got["avg_precision"]) == (None, 0.0)


def test_category_index_equals_indexer(rows):
    model = StringIndexer(inputCol="location", outputCol="i").fit(rows)
    got = metrics.category_index(rows, "location", slice_rows=2)
    ordered = [r["location"] for r in got.orderBy("category_index").collect()]
    assert ordered == list(model.labels)


def test_stratified_split(rows):
    got = splits.stratified_split(rows)
    for label, n in rows.groupBy("is_fraud").count().collect():
        train = got.filter(f"split = 'train' and is_fraud = {label}").count()
        assert train == -(-n * 8 // 10)
    again = splits.stratified_split(rows.repartition(3))
    assert got.exceptAll(again).count() == 0


def test_stratified_split_keeps_copies_together(spark):
    rows = spark.createDataFrame(
        [(str(i % 10), 0) for i in range(1000)], "transaction_id string, is_fraud int"
    )
    sides = splits.stratified_split(rows).groupBy("transaction_id").agg(
        F.count_distinct("split").alias("n")
    )
    assert sides.filter("n > 1").count() == 0


def test_split_by_more_classes_than_a_plan_holds(spark):
    rows = spark.range(3000).selectExpr(
        "cast(id as string) as transaction_id", "nullif(id % 150, 7) as kind"
    )
    got = splits.stratified_split(rows, "kind")
    sizes = {(r["kind"], r["n"]) for r in got.filter("split = 'train'").groupBy("kind").agg(F.count("*").alias("n")).collect()}
    assert sizes == {(k if k != 7 else None, 16) for k in range(150)}
    assert got.columns == ["transaction_id", "kind", "split"] and got.count() == 3000


def test_shares_of_none_and_all(rows):
    assert splits.random_split(rows, share=1.0).filter("split = 'test'").isEmpty()
    assert splits.random_split(rows, share=0.0).filter("split = 'train'").isEmpty()
    assert splits.stratified_split(rows, share=1.0).filter("split = 'test'").isEmpty()
    assert splits.stratified_split(rows, share=0.0).filter("split = 'train'").isEmpty()


def test_weights_of_any_classes(spark):
    one = spark.createDataFrame([("a",)] * 4, "kind string")
    assert [r["class_weight"] for r in metrics.class_balance_weights(one, "kind").collect()] == [1.0]
    gap = spark.createDataFrame([("a",), ("b",), ("c",), (None,), ("c",)], "kind string")
    got = {r["kind"]: r["class_weight"] for r in metrics.with_class_weights(gap, "kind").collect()}
    assert got == {"a": 4 / 3, "b": 4 / 3, "c": 2 / 3, None: None}


def test_ranking_leaves_out_rows_without_score_or_label(spark, rows):
    gap = rows.select("is_fraud", "fraud_probability").unionByName(
        spark.createDataFrame([(1, None), (None, 0.5)], "is_fraud int, fraud_probability double")
    )
    assert metrics.ranking_metrics(gap).collect() == metrics.ranking_metrics(rows).collect()


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "is_fraud int")
    got = {r["is_fraud"]: r["class_weight"] for r in metrics.with_class_weights(df).collect()}
    assert got == {0: 8 / 12, 1: 2.0}


def test_forest_scores_unseen_categories(spark, rows):
    model = models.train_forest(models.training_rows(rows, SMALL, "is_fraud"), SMALL)
    new = rows.drop("fraud_probability", "is_flagged").withColumn(
        "merchant_category", F.lit("never seen")
    )
    got = models.score(new, model)
    assert got.filter(~F.col("fraud_probability").between(0, 1)).count() == 0
    above = (F.col("fraud_probability") >= 0.5).cast("int")
    assert got.filter(above != F.col("is_flagged")).isEmpty()
    loaded = models.save_and_load(model, spark)
    assert models.score(new, loaded).exceptAll(got).count() == 0


def test_indexed_forest_takes_many_categories(rows):
    wide = rows.withColumn("location", F.concat(F.lit("L"), F.col("transaction_id") % 90))
    plan = models.ForestPlan(("amount",), False, 2, 2, False, False)
    model = models.train_forest(models.training_rows(wide, plan, "is_flagged"), plan, "is_flagged")
    assert model.stages[-1].getMaxBins() > 80
    assert models.score(rows.drop("is_flagged", "fraud_probability"), model).count() == 1000


def test_training_metrics(rows):
    model, measured = models.train_and_evaluate(rows, SMALL)
    got = measured.first()
    assert model is not None
    assert got["roc_auc"] > 0.5
    assert got["n_train"] + got["n_test"] == got["n_samples"] == 1000


def test_no_rows_train_nothing(rows):
    model, measured = models.train_and_evaluate(rows.filter("amount < 0"), SMALL)
    assert model is None
    assert set(measured.first().asDict().values()) == {0}


def test_gate_and_registry(spark, rows):
    registry = models.ModelRegistry(spark, scratch(spark, "registry"))
    with pytest.raises(LookupError):
        registry.current()
    good = spark.createDataFrame([(0.9, 0.9)], "recall double, precision double")
    bad = spark.createDataFrame([(0.9, None)], "recall double, precision double")
    registry.save_candidate(stand_in_model(200.0), "1")
    registry.save_candidate(stand_in_model(100.0), "2")
    assert not registry.promote("1", bad)
    assert registry.promote("1", good)
    version, first = registry.current()
    assert version == "1" and registry.current()[1] is first
    assert not registry.promote("2", bad)
    assert registry.current()[0] == "1"
    assert registry.promote("2", good)
    assert registry.current()[0] == "2"
    assert metrics.quality_gate(bad).first()["reason"] == "precision below limit"


def test_daily_run_twice(spark, rows, sf_dir):
    root = scratch(spark, "daily")
    for _ in range(2):
        done = daily_run(
            spark, rows, rows, root, "2024-01-16", plan=SMALL, min_recall=0.0, min_precision=0.0
        )
        assert done.promoted
    days = spark.read.parquet(f"{root}/fraud_metrics_daily").collect()
    assert [(str(r["metric_date"]), r["total_transactions"]) for r in days] == [
        ("2024-01-15", rows.filter("to_date(scored_at) = '2024-01-15'").count())
    ]
    assert not daily_run(spark, rows, rows, root, "2024-01-17", plan=SMALL, min_recall=2.0).promoted
    assert models.ModelRegistry(spark, f"{root}/model").current()[0] == "2024-01-16"
    assert txn(spark, sf_dir).count() == spark.read.parquet(f"{root}/snapshots/2024-01-17").count()


def test_hashed_forest_with_a_million_locations(spark, tmp_path):
    from dataclasses import replace

    plan = replace(models.HASHED_FOREST, numeric=("amount",), trees=3, hashed=64)
    rows = spark.range(1_000_000).select(
        F.col("id").cast("string").alias("transaction_id"),
        (F.col("id") % 100).cast("double").alias("amount"),
        F.when(F.col("id") % 5 > 0, F.lit("m")).alias("merchant_category"),
        F.concat(F.lit("L"), F.col("id").cast("string")).alias("location"),
        (F.col("id") % 100 >= 90).cast("int").alias("is_fraud"),
        F.when(F.col("id") % 10 > 0, "train").otherwise("test").alias("split"),
    )
    forest = models.train_forest(rows, plan)
    assert forest.stages[-1].numFeatures == 64 + 1
    test = models.score(rows.filter("split = 'test'"), forest)
    assert test.filter("(amount >= 90) = (fraud_probability > 0.5)").count() == 100_000
    forest.save(str(tmp_path / "m"))
    again = models.score(rows.filter("split = 'test'").limit(50), type(forest).load(str(tmp_path / "m")))
    assert again.count() == 50


def test_forest_scores_in_a_session_that_observed_a_write(spark):
    from pyspark.sql import Observation

    seen = Observation()
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 5
    rows = spark.range(100).select(
        (F.col("id") % 10).cast("double").alias("amount"),
        F.lit("m").alias("merchant_category"),
        F.lit("L").alias("location"),
        (F.col("id") % 10 > 5).cast("int").alias("is_flagged"),
        F.lit("train").alias("split"),
    )
    forest = models.train_forest(rows, models.SIMPLE_FOREST)
    assert models.score(rows, forest).filter("fraud_probability > 0.5").count() == 40
    assert forest.transform(rows).count() == 100


def test_forests_read_even_parts_and_keep_places(spark, rows):
    few = rows.coalesce(1)
    sizes = models.dealt_evenly(few).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == models.PARTS_PER_CORE * spark.sparkContext.defaultParallelism
    assert max(r["count"] for r in sizes) <= 2 * min(r["count"] for r in sizes)
    train = models.training_rows(rows, SMALL, "is_fraud")
    assert models.train_forest(train, SMALL, "is_fraud").stages[-1].getCacheNodeIds()

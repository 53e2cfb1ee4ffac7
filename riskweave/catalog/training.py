"""Queries: splits, metrics and the model."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.catalog.registry import query, rounded
from riskweave.operators import metrics, splits
from riskweave.plans import model as models
from riskweave.plans.views import scored, txn
from riskweave.session import scratch, written
from riskweave.sinks.tables import write_metrics as write_metrics_json

SPLIT_SQL = """(
  select *, case when row_number() over (partition by is_fraud order by md5(transaction_id || '42'))
                 <= ceil(0.8 * count(*) over (partition by is_fraud))
            then 'train' else 'test' end as split from scored)"""
PRECISION_SQL = """
  coalesce(round(sum(is_fraud * is_flagged) / cast(nullif(sum(is_flagged), 0) as double), 6), 0.0) as precision,
  coalesce(round(sum(is_fraud * is_flagged) / cast(nullif(sum(is_fraud), 0) as double), 6), 0.0) as recall,
  coalesce(round(2 * sum(is_fraud * is_flagged)
    / cast(nullif(sum(is_flagged) + sum(is_fraud), 0) as double), 6), 0.0) as f1
"""
RANKED = """
  g as (select fraud_probability p, sum(is_fraud) pos, count(*) n from {source} group by 1),
  c as (select p, pos, n, sum(pos) over (order by p desc) tp, sum(n) over (order by p desc) cn,
               sum(pos) over () pt, sum(n) over () nt from g),
  ranked as (
    select round(sum(cast(pos as double) / pt * cast(tp as double) / cn), 6) avg_precision,
           round(sum(cast(pos as double) * (nt - pt - (cn - tp)) + 0.5 * cast(pos as double) * (n - pos))
                 / (max(pt) * cast(max(nt - pt) as double)), 6) roc_auc
    from c)"""
RANKING_SQL = RANKED.format(source="scored")


def stand_in_model(scale: float) -> PipelineModel:
    """A saved-and-loaded model like any other, whose score is one division."""
    return PipelineModel(
        stages=[
            SQLTransformer(
                statement=f"SELECT *, least(amount / {scale}D, 1.0D) AS fraud_probability"
                " FROM __THIS__"
            )
        ]
    )


def scored_once(rows: DataFrame, forest: PipelineModel) -> DataFrame:
    """The test side's labels and scores, written, as several aggregates read them."""
    test = models.score(rows.filter("split = 'test'"), forest)
    return written(test.select("is_fraud", "fraud_probability"), "predictions")


@query(f"select {PRECISION_SQL} from scored")
def precision_recall(spark, sf_dir):
    return rounded(
        metrics.precision_recall(scored(spark, sf_dir)), "precision", "recall", "f1"
    )


@query(f", {RANKING_SQL} select roc_auc from ranked")
def roc_auc(spark, sf_dir):
    return rounded(metrics.ranking_metrics(scored(spark, sf_dir)), "roc_auc").select("roc_auc")


@query(f", {RANKING_SQL} select avg_precision from ranked")
def average_precision(spark, sf_dir):
    # Small slices, so the distributed path is the one compared.
    return rounded(
        metrics.ranking_metrics(scored(spark, sf_dir), slice_rows=1000), "avg_precision"
    ).select("avg_precision")


@query(
    f"""
select count(*) filter (where split = 'train') n_train, count(*) filter (where split = 'test') n_test,
       count(*) n_samples, round(avg(is_fraud) filter (where split = 'test'), 6) fraud_rate_test
from {SPLIT_SQL}
"""
)
def split_counts(spark, sf_dir):
    split = splits.stratified_split(scored(spark, sf_dir))
    return rounded(metrics.split_counts(split), "fraud_rate_test")


@query(
    """
select cast(is_fraud as bigint) is_fraud, count(*) n_class,
       round((select count(*) from scored) / (2.0 * count(*)), 6) class_weight
from scored group by is_fraud
"""
)
def class_balance_weights(spark, sf_dir):
    return rounded(metrics.class_balance_weights(scored(spark, sf_dir)), "class_weight")


@query(
    """
select merchant_category, count(*) n_class,
       round((select count(*) from scored) / ((select count(distinct merchant_category) from scored)
             * cast(count(*) as double)), 6) class_weight
from scored group by merchant_category
"""
)
def class_balance_weights_any_label(spark, sf_dir):
    return rounded(
        metrics.class_balance_weights(scored(spark, sf_dir), "merchant_category"), "class_weight"
    )


@query(
    """
select transaction_id, merchant_category,
       case when row_number() over (partition by merchant_category order by md5(transaction_id || '42'))
                 <= ceil(0.8 * count(*) over (partition by merchant_category))
            then 'train' else 'test' end as split
from scored
"""
)
def stratified_split_any_label(spark, sf_dir):
    return splits.stratified_split(scored(spark, sf_dir), "merchant_category").select(
        "transaction_id", "merchant_category", "split"
    )


@query(
    """
select plan, count(*) n_rows, count(location) n_locations
from (select 'behaviour' as plan, case when cast(transaction_id as bigint) % 3 <> 0 then location end as location
      from scored
      union all
      select 'simple', location from scored where cast(transaction_id as bigint) % 3 <> 0)
group by plan
"""
)
def training_rows_with_gaps(spark, sf_dir):
    k = F.col("transaction_id").cast("long")
    gaps = scored(spark, sf_dir).withColumns(
        {
            "location": F.when(k % 3 != 0, F.col("location")),
            "transaction_id": F.when(k % 5 != 0, F.col("transaction_id")),
        }
    )
    out = None
    for name, plan in (("behaviour", models.BEHAVIOUR_FOREST), ("simple", models.SIMPLE_FOREST)):
        one = models.training_rows(gaps, plan).agg(
            F.lit(name).alias("plan"),
            F.count("*").alias("n_rows"),
            F.count("location").alias("n_locations"),
        )
        out = one if out is None else out.unionByName(one)
    return out


@query(
    """
select merchant_category, count(*) n,
       cast(row_number() over (order by count(*) desc, merchant_category) - 1 as double) category_index
from txn group by merchant_category
"""
)
def category_index(spark, sf_dir):
    return metrics.category_index(txn(spark, sf_dir), "merchant_category")


@query(f"select transaction_id, cast(is_fraud as bigint) is_fraud, split from {SPLIT_SQL}")
def stratified_split(spark, sf_dir):
    return splits.stratified_split(scored(spark, sf_dir)).select(
        "transaction_id", "is_fraud", "split"
    )


@query(
    """
select transaction_id,
       case when substr(md5(transaction_id || '42'), 1, 8) < 'cccccccc' then 'train' else 'test' end split
from scored
"""
)
def random_split(spark, sf_dir):
    return splits.random_split(scored(spark, sf_dir)).select("transaction_id", "split")


@query(
    f""", {RANKING_SQL}
select {PRECISION_SQL}, (select roc_auc from ranked) roc_auc,
       (select avg_precision from ranked) avg_precision, count(*) n_samples
from scored
"""
)
def write_metrics(spark, sf_dir):
    path = scratch(spark, "metrics")
    rows = scored(spark, sf_dir)
    one = models.side_by_side(models.evaluate(rows), rows.agg(F.count("*").alias("n_samples")))
    write_metrics_json(one, path)
    return rounded(
        spark.read.schema(one.schema).json(path),
        "precision",
        "recall",
        "f1",
        "roc_auc",
        "avg_precision",
    )


@query(
    f"""
, m as (select {PRECISION_SQL} from scored),
limits as (select 0.75 min_recall, 0.60 min_precision union all select 0.5, 0.7
           union all select 0.9, 0.9)
select min_recall, min_precision, recall >= min_recall and precision >= min_precision as passed,
       concat_ws(',', case when recall < min_recall then 'recall below limit' end,
                      case when precision < min_precision then 'precision below limit' end) as reason
from (select precision, recall, cast(min_recall as double) min_recall,
             cast(min_precision as double) min_precision from m, limits)
"""
)
def quality_gate(spark, sf_dir):
    measured = metrics.precision_recall(scored(spark, sf_dir))
    out = None
    for recall, precision in [(0.75, 0.60), (0.5, 0.7), (0.9, 0.9)]:
        row = metrics.quality_gate(measured, recall, precision).select(
            F.lit(recall).alias("min_recall"),
            F.lit(precision).alias("min_precision"),
            "passed",
            "reason",
        )
        out = row if out is None else out.unionByName(row)
    return out


@query(
    f"""
select count(*) filter (where split = 'train') n_train, count(*) filter (where split = 'test') n_test,
       200 n_trees, true as within_depth, true as probabilities_valid, true as better_than_chance
from {SPLIT_SQL}
"""
)
def train_forest(spark, sf_dir):
    rows = models.training_rows(scored(spark, sf_dir), models.BEHAVIOUR_FOREST, "is_fraud")
    forest = models.train_forest(rows)
    trees = forest.stages[-1].trees
    test = scored_once(rows, forest)
    return models.side_by_side(
        metrics.split_counts(rows).select("n_train", "n_test"),
        test.agg(
            F.lit(len(trees)).alias("n_trees"),
            F.lit(all(t.depth <= models.BEHAVIOUR_FOREST.depth for t in trees)).alias(
                "within_depth"
            ),
            F.every(F.col("fraud_probability").between(0, 1)).alias("probabilities_valid"),
        ),
        metrics.ranking_metrics(test).select((F.col("roc_auc") > 0.5).alias("better_than_chance")),
    )


@query(
    f"""
select count(*) filter (where split = 'train') n_train, count(*) filter (where split = 'test') n_test,
       200 n_trees, true as within_depth, true as probabilities_valid, true as better_than_chance,
       1024 + 4 as n_features
from {SPLIT_SQL}
"""
)
def train_hashed_forest(spark, sf_dir):
    """A forest whose locations are as many as the events, hashed to a fixed width."""
    rows = scored(spark, sf_dir).withColumn("location", F.concat_ws("-", "location", "transaction_id"))
    plan = models.HASHED_FOREST
    rows = models.training_rows(rows, plan, "is_fraud")
    forest = models.train_forest(rows, plan)
    trees = forest.stages[-1].trees
    test = scored_once(rows, forest)
    return models.side_by_side(
        metrics.split_counts(rows).select("n_train", "n_test"),
        test.agg(
            F.lit(len(trees)).alias("n_trees"),
            F.lit(all(t.depth <= plan.depth for t in trees)).alias("within_depth"),
            F.every(F.col("fraud_probability").between(0, 1)).alias("probabilities_valid"),
            F.lit(forest.stages[-1].numFeatures).alias("n_features"),
        ),
        metrics.ranking_metrics(test).select((F.col("roc_auc") > 0.5).alias("better_than_chance")),
    )


@query(
    f"""
, split as (select * from {SPLIT_SQL}),
tested as (select * from split where split = 'test'), {RANKED.format(source="tested")}
select {PRECISION_SQL}, (select roc_auc from ranked) roc_auc,
       (select avg_precision from ranked) avg_precision, round(avg(is_fraud), 6) fraud_rate_test,
       (select count(*) from split where split = 'train') n_train, count(*) n_test,
       (select count(*) from split) n_samples
from tested
"""
)
def predict_and_evaluate(spark, sf_dir):
    rows = models.training_rows(scored(spark, sf_dir), models.BEHAVIOUR_FOREST, "is_fraud")
    measured = models.predict_and_evaluate(rows, stand_in_model(200.0))
    return rounded(measured, *[c for c in measured.columns if not c.startswith("n_")])


RANDOM_SQL = """(
  select *, case when substr(md5(transaction_id || '42'), 1, 8) < 'cccccccc' then 'train' else 'test' end split
  from scored)"""


@query(
    f"""
select count(*) filter (where split = 'train') n_train, count(*) filter (where split = 'test') n_test,
       count(*) n_samples, 100 n_trees, true as within_depth, true as metrics_valid,
       true as better_than_chance
from {RANDOM_SQL}
"""
)
def train_and_evaluate_simple_forest(spark, sf_dir):
    plan = models.SIMPLE_FOREST
    forest, measured = models.train_and_evaluate(scored(spark, sf_dir), plan)
    trees = forest.stages[-1].trees
    shares = ["precision", "recall", "f1", "roc_auc", "avg_precision"]
    return measured.select(
        "n_train",
        "n_test",
        "n_samples",
        F.lit(len(trees)).alias("n_trees"),
        F.lit(all(t.depth <= plan.depth for t in trees)).alias("within_depth"),
        F.forall(F.array(*shares), lambda m: m.between(0, 1)).alias("metrics_valid"),
        (F.col("roc_auc") > 0.5).alias("better_than_chance"),
    )


@query(
    f"""
, split as (select * from {SPLIT_SQL.replace("is_fraud", "is_flagged")}),
tested as (select * exclude (is_fraud), is_flagged is_fraud from split where split = 'test'),
{RANKED.format(source="tested")}
select {PRECISION_SQL}, (select roc_auc from ranked) roc_auc,
       (select avg_precision from ranked) avg_precision, round(avg(is_fraud), 6) fraud_rate_test,
       (select count(*) from split where split = 'train') n_train, count(*) n_test,
       (select count(*) from split) n_samples
from (select * exclude (is_flagged), case when least(amount / 400.0, 1.0) >= 0.5 then 1 else 0 end is_flagged
      from tested)
"""
)
def evaluate_scored_history(spark, sf_dir):
    # The label is the flag of an earlier model; another one decides anew.
    label = "is_flagged"
    rows = models.training_rows(scored(spark, sf_dir), models.BEHAVIOUR_FOREST, label)
    measured = models.predict_and_evaluate(rows, stand_in_model(400.0), label)
    return rounded(measured, *[c for c in measured.columns if not c.startswith("n_")])


@query("select count(*) n_rows, 0 n_changed from scored")
def model_save_load(spark, sf_dir):
    rows = scored(spark, sf_dir).drop("fraud_probability", "is_flagged")
    plan = replace(models.SIMPLE_FOREST, label="is_fraud")
    fitted = models.train_forest(models.training_rows(rows, plan), plan)
    loaded = models.save_and_load(fitted, spark)
    before = models.score(rows, fitted).withColumnsRenamed(
        {"fraud_probability": "p_before", "is_flagged": "f_before"}
    )
    both = models.score(before, loaded)
    same = F.col("p_before").eqNullSafe(F.col("fraud_probability"))
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(~same).alias("n_changed")
    )


@query(
    f"""
, m as (select {PRECISION_SQL} from scored)
select i as attempt, 'v' || cast(v as varchar) as version, passed, 'v1' as promoted_version,
       (select round(sum(fraud_probability), 4) from scored) as total_score
from (select 1 i, 1 v, recall >= 0.25 and precision >= 0.25 passed from m
      union all select 2, 2, recall >= 0.75 and precision >= 0.6 from m
      union all select 3, 1, recall >= 2 from m)
"""
)
def promote_model(spark, sf_dir):
    registry = models.ModelRegistry(spark, scratch(spark, "registry"))
    rows = scored(spark, sf_dir)
    plain_rows = rows.drop("fraud_probability", "is_flagged")
    out = None
    # The third attempt saves another model as v1 again and misses the gate.
    attempts = [(1, "v1", 200.0, 0.25, 0.25), (2, "v2", 200.0, 0.75, 0.6), (3, "v1", 900.0, 2.0, 0.0)]
    for attempt, version, scale, recall, precision in attempts:
        candidate = stand_in_model(scale)
        registry.save_candidate(candidate, version)
        measured = metrics.precision_recall(models.score(plain_rows, candidate))
        passed = registry.promote(version, measured, recall, precision)
        # A registry that starts now must agree with the one under way.
        promoted, model = models.ModelRegistry(spark, registry.root).current()
        total = models.score(plain_rows, model).agg(
            F.round(F.sum("fraud_probability"), 4).alias("total_score")
        )
        row = total.select(
            F.lit(attempt).alias("attempt"),
            F.lit(version).alias("version"),
            F.lit(passed).alias("passed"),
            F.lit(promoted).alias("promoted_version"),
            "total_score",
        )
        out = row if out is None else out.unionByName(row)
    return out

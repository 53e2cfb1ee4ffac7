"""The daily run over scored history: snapshot, retrain, gate, promote, roll up."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators.checks import check_rules
from riskweave.operators.rollup import daily_fraud_metrics, filter_day
from riskweave.plans.model import (
    BEHAVIOUR_FOREST,
    ForestPlan,
    ModelRegistry,
    stamp_metrics,
    train_and_evaluate,
)
from riskweave.schemas import MIN_PRECISION, MIN_RECALL, NOT_NULL
from riskweave.session import complete_folders, remove, temporary
from riskweave.sinks.tables import write_daily_metrics, write_metrics

KEEP_SNAPSHOTS = 30


@dataclass(frozen=True)
class DailyRun:
    promoted: bool
    version: str
    metrics_path: str


def refresh_rollup(analytics: DataFrame, day: str, path: str) -> None:
    """The metrics of one day into the rollup table; a rerun replaces that day."""
    if "scored_month" in analytics.columns:  # lets the scan leave out other months
        month = day[:4] + day[5:7]
        analytics = analytics.filter(F.col("scored_month").cast("string") == month)
    write_daily_metrics(daily_fraud_metrics(filter_day(analytics, day)), path)


def daily_run(
    spark: SparkSession,
    history: DataFrame,
    analytics: DataFrame,
    root: str,
    run_date: str,
    label: str | None = None,
    plan: ForestPlan = BEHAVIOUR_FOREST,
    min_recall: float = MIN_RECALL,
    min_precision: float = MIN_PRECISION,
    keep_snapshots: int = KEEP_SNAPSHOTS,
) -> DailyRun:
    """One day's work below `root`. A candidate that misses the gate leaves the
    current model and is reported, the rollup of the day before is made anyway.

    Violations of the scored table's rules are written next to the metrics; they do not
    stop the run, for the history cannot be loaded anew. The newest snapshots are kept.
    """
    snapshot = f"{root}/snapshots/{run_date}"
    history.write.mode("overwrite").parquet(snapshot)
    for old in sorted(complete_folders(spark, f"{root}/snapshots"))[:-keep_snapshots]:
        remove(spark, f"{root}/snapshots/{old}")
    present = spark.read.parquet(snapshot)
    if set(NOT_NULL["transactions_scored"]) <= set(present.columns):
        write_metrics(check_rules(present, "transactions_scored"), f"{root}/checks/{run_date}")
    metrics_path = f"{root}/metrics/{run_date}"
    with temporary(spark):
        model, metrics = train_and_evaluate(spark.read.parquet(snapshot), plan, label)
        metrics = stamp_metrics(metrics, run_date)
        write_metrics(metrics, metrics_path)
    registry = ModelRegistry(spark, f"{root}/model")
    promoted = False
    if model is not None:
        registry.save_candidate(model, run_date)
        saved = spark.read.schema(metrics.schema).json(metrics_path)
        promoted = registry.promote(run_date, saved, min_recall, min_precision)
    yesterday = (date.fromisoformat(run_date) - timedelta(days=1)).isoformat()
    refresh_rollup(analytics, yesterday, f"{root}/fraud_metrics_daily")
    return DailyRun(promoted, run_date, metrics_path)

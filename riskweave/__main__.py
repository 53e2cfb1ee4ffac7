"""Jobs for spark-submit: `python -m riskweave <job> --help`."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from riskweave.plans.daily import daily_run
from riskweave.plans.model import (
    BEHAVIOUR_FOREST,
    HISTORY_FOREST,
    SIMPLE_FOREST,
    ModelRegistry,
    stamp_metrics,
    train_and_evaluate,
)
from riskweave.schemas import MIN_PRECISION, MIN_RECALL
from riskweave.session import session, temporary
from riskweave.sinks.stores import (
    JdbcStore,
    analytics_rows,
    ops_rows,
    read_store,
    table_stores,
)
from riskweave.sinks.tables import VersionedTable, write_metrics
from riskweave.sources.files import scan_training_input
from riskweave.sources.messages import order_topic, transaction_topic
from riskweave.streaming.orders import load_pending_orders
from riskweave.streaming.scorer import start_scoring

FORESTS = {"behaviour": BEHAVIOUR_FOREST, "history": HISTORY_FOREST, "simple": SIMPLE_FOREST}


def train(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = scan_training_input(spark, a.input, format=a.format)
    with temporary(spark):
        model, metrics = train_and_evaluate(rows, FORESTS[a.forest], a.label)
        write_metrics(stamp_metrics(metrics, a.model_out), a.metrics_out)
    if model is not None:
        model.write().overwrite().save(a.model_out)


def table_or_path(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by its name, or what a path holds: a store or plain Parquet."""
    if "/" not in name:
        return spark.table(name)
    return read_store(spark, name)


def daily(spark: SparkSession, a: argparse.Namespace) -> None:
    done = daily_run(
        spark,
        table_or_path(spark, a.history),
        table_or_path(spark, a.analytics),
        a.root,
        a.run_date,
        a.label,
        FORESTS[a.forest],
        a.min_recall,
        a.min_precision,
    )
    if not done.promoted:
        raise SystemExit(f"candidate {done.version} missed the gate; see {done.metrics_path}")


def score(spark: SparkSession, a: argparse.Namespace) -> None:
    ops, lake, analytics = table_stores(a.stores)
    if a.ops_jdbc_url:
        ops = JdbcStore(a.ops_jdbc_url, "transactions_scored", ops_rows, _jdbc("OPS"))
    if a.analytics_jdbc_url:
        analytics = JdbcStore(
            a.analytics_jdbc_url,
            "transactions_scored_analytics",
            lambda df: analytics_rows(df).drop("scored_month"),
            _jdbc("ANALYTICS"),
            time_column="scored_at",
        )
    start_scoring(
        transaction_topic(spark, a.servers, a.topic, max_per_trigger=a.max_per_trigger),
        ModelRegistry(spark, a.models).current,
        [ops, lake, analytics],
        a.checkpoint,
        quarantine=f"{a.stores}/rejected",
    ).awaitTermination()


def orders(spark: SparkSession, a: argparse.Namespace) -> None:
    load_pending_orders(
        order_topic(spark, a.servers, a.topic),
        VersionedTable(spark, a.target),
        a.run_date,
        a.checkpoint,
        a.quarantine,
        skip_if_empty=a.skip_if_empty,
        keep_versions=a.keep_versions,
    )


def compact(spark: SparkSession, a: argparse.Namespace) -> None:
    for store in table_stores(a.stores):
        store.compact(spark)


def _jdbc(prefix: str) -> dict[str, str]:
    """Connection properties from e.g. OPS_USER, OPS_PASSWORD and OPS_DRIVER."""
    names = {k: os.environ.get(f"{prefix}_{k.upper()}") for k in ("user", "password", "driver")}
    return {k: v for k, v in names.items() if v}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="riskweave", description=__doc__)
    jobs = p.add_subparsers(required=True)

    def job(run, name: str, required: list[str], forest: bool = False):
        j = jobs.add_parser(name)
        for option in required:
            j.add_argument(f"--{option}", required=True)
        if forest:
            j.add_argument("--forest", choices=FORESTS, default="behaviour")
            j.add_argument("--label")
        j.set_defaults(run=run)
        return j

    j = job(train, "train", ["input", "model-out", "metrics-out"], forest=True)
    j.add_argument("--format", choices=["parquet", "csv"])
    j = job(daily, "daily", ["history", "analytics", "root", "run-date"], forest=True)
    j.add_argument("--min-recall", type=float, default=MIN_RECALL)
    j.add_argument("--min-precision", type=float, default=MIN_PRECISION)
    j = job(score, "score", ["servers", "models", "stores", "checkpoint"])
    j.add_argument("--topic", default="transactions")
    j.add_argument("--max-per-trigger", type=int)
    j.add_argument("--ops-jdbc-url")
    j.add_argument("--analytics-jdbc-url")
    job(compact, "compact", ["stores"])
    j = job(orders, "orders", ["servers", "topic", "target", "checkpoint", "run-date"])
    j.add_argument("--quarantine")
    j.add_argument("--skip-if-empty", action="store_true")
    j.add_argument("--keep-versions", type=int, default=24)
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    a.run(session(f"riskweave-{a.run.__name__}"), a)


if __name__ == "__main__":
    main()

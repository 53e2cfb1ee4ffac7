"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from riskweave.catalog import QUERIES
from riskweave.session import session

HEADLINE = [
    "account_features",
    "account_features_hot_account",
    "daily_fraud_metrics",
    "dedupe_first",
    "clean_orders",
    "quarantine_bad_messages",
    "full_refresh_load",
    "insert_if_absent",
    "table_checks",
    "stratified_split",
    "roc_auc",
    "average_precision",
    "sink_lake_append",
    "fanout_sink",
    "stream_score",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["scan_parquet"](spark, sf_dir).count()  # starts the JVM's threads

    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        # The no-op sink computes every row and column.
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

"""The rollup kept batch by batch against the full recompute."""

import pytest
from pyspark.sql import functions as F

from riskweave.operators.rollup import daily_fraud_metrics
from riskweave.plans.views import scored
from riskweave.session import scratch
from riskweave.sinks.stores import fan_out, read_rollup, rollup_store, table_stores


def rows_of(df):
    rounded = df.withColumn("avg_fraud_probability", F.round("avg_fraud_probability", 9))
    return sorted(map(tuple, rounded.collect()), key=str)


def part(rows, i):
    return rows.filter(F.col("transaction_id").cast("long") % 3 == i)


def test_late_and_replayed_batches(spark, sf_dir):
    root = scratch(spark, "rollup")
    store, rows = rollup_store(root), scored(spark, sf_dir)
    seen = rows.limit(0)
    for i in range(3):
        store.write(rows, i)  # a first try that held other rows
        store.write(part(rows, i), i)
        seen = seen.unionByName(part(rows, i))
        assert rows_of(read_rollup(spark, root)) == rows_of(daily_fraud_metrics(seen))
        store.compact(spark, grace_seconds=0)
        assert rows_of(read_rollup(spark, root)) == rows_of(daily_fraud_metrics(seen))
    store.write(part(rows, 0), 0)  # closed
    assert rows_of(read_rollup(spark, root)) == rows_of(daily_fraud_metrics(rows))
    days = rows.select(F.to_date("scored_at")).distinct().count()
    assert store.read(spark).count() <= days * len(store.log(spark).latest().entries)


def test_other_days_are_not_read(spark, sf_dir):
    root = scratch(spark, "rollup")
    store, rows = rollup_store(root), scored(spark, sf_dir)
    for i in range(3):
        store.write(part(rows, i), i)
    day = read_rollup(spark, root, "2024-01-15", "2024-01-15")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(metric_date" in plan
    own = rows.filter("to_date(scored_at) = date '2024-01-15'")
    assert rows_of(day) == rows_of(daily_fraud_metrics(own))


def test_rollup_among_the_stores(spark, sf_dir):
    root, rows = scratch(spark, "rollup"), scored(spark, sf_dir)
    fan_out(rows, 0, [*table_stores(f"{root}/stores"), rollup_store(f"{root}/daily")])
    assert rows_of(read_rollup(spark, f"{root}/daily")) == rows_of(daily_fraud_metrics(rows))


def test_empty_and_odd_batches(spark, sf_dir):
    root, rows = scratch(spark, "rollup"), scored(spark, sf_dir)
    store = rollup_store(root)
    store.write(rows.limit(0), 0)
    with pytest.raises(FileNotFoundError):
        read_rollup(spark, root)
    odd = rows.limit(20).withColumns(
        {
            "amount": F.when(F.col("transaction_id") % 2 == 0, F.lit(1e30)),
            "fraud_probability": F.lit(None).cast("double"),
            "scored_at": F.when(F.col("transaction_id") % 3 == 0, F.col("scored_at")),
        }
    )
    store.write(odd, 1)
    store.write(rows, 2)
    store.compact(spark)
    both = odd.unionByName(rows)
    assert rows_of(read_rollup(spark, root)) == rows_of(daily_fraud_metrics(both))

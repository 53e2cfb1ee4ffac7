"""Point-in-time features against brute force, on the window and on the sliced path."""

import math
import statistics

import pytest
from pyspark.sql import functions as F
from test_features import EDGES, HOUR, SCHEMA, T0, frame

from riskweave.operators import features
from riskweave.operators.features import FEATURES, account_features, point_in_time_features
from riskweave.operators.moments import merged, moments, none
from riskweave.plans.model import HISTORY_FOREST, training_rows
from riskweave.plans.views import scored, txn

Z = FEATURES[0]


def expected(rows):
    out = {}
    for t, a, x, us in rows:
        before = [v for u, b, v, at in rows if b == a and (at, u) < (us, t) and v is not None]
        z = 0.0
        if x is not None and len(before) > 1:
            z = (x - statistics.mean(before)) / (statistics.stdev(before) or 1)
        out[t] = z
    return out


HISTORIES = EDGES | {
    "long": [(f"{i:03}", "ab"[i % 2], float(i * i % 17), (i * 7919) % (5 * HOUR)) for i in range(60)],
    "near_1e9": [(f"{i:03}", "x", 1e9 + i % 3, i * 10**6) for i in range(40)],
    "falls": [(f"{i:03}", "x", 1e9 if i < 20 else i / 7, i * 10**6) for i in range(40)],
}


@pytest.mark.parametrize("limit", [10**6, 3, 1])
@pytest.mark.parametrize("name", sorted(HISTORIES))
def test_history(spark, name, limit):
    rows = HISTORIES[name]
    df = frame(spark, rows)
    got = point_in_time_features(df, max_group_rows=limit).collect()
    want = expected(rows)
    assert len(got) == len(rows)
    for r in got:
        assert math.isclose(r[Z], want[r["transaction_id"]], rel_tol=1e-6, abs_tol=1e-6)
    both = {r["transaction_id"]: (r[FEATURES[1]], r[FEATURES[2]]) for r in account_features(df).collect()}
    assert {r["transaction_id"]: (r[FEATURES[1]], r[FEATURES[2]]) for r in got} == both


@pytest.mark.parametrize("limit", [10**6, 2])
def test_rows_without_a_time_and_equal_rows(spark, limit):
    rows = [("a", "x", 1.0, T0)] * 3 + [("b", "x", 9.0, None), ("c", None, 2.0, T0), (None, "x", None, T0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("note", F.lit("n"))
    got = point_in_time_features(df, max_group_rows=limit)
    assert got.columns == [*df.columns, *FEATURES]
    assert sorted(r[Z] for r in got.collect()) == [0.0] * 6
    assert point_in_time_features(df.limit(0)).collect() == []


def test_no_row_sees_the_future(spark, sf_dir):
    rows = txn(spark, sf_dir)
    half = rows.agg(F.percentile_approx("event_time", 0.5)).first()[0]
    early = rows.filter(F.col("event_time") <= F.lit(half))
    keep = ["transaction_id", *FEATURES]
    whole = point_in_time_features(rows).filter(F.col("event_time") <= F.lit(half)).select(*keep)
    alone = point_in_time_features(early).select(*keep)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, alone.collect()))


def test_merged_moments(spark):
    values = [1e9, 1e9 + 1, 1e9 + 2, -4.0, 0.5]
    df = spark.createDataFrame([(v, i < 2) for i, v in enumerate(values)], "v double, early boolean")
    parts = df.groupBy("early").agg(moments("v").alias("m"))
    a, b = parts.filter("early").select(F.col("m").alias("a")), parts.filter("not early").select(F.col("m").alias("b"))
    m = a.crossJoin(b).select(merged(F.col("a"), F.col("b")).alias("m"), merged(none(), F.col("b")).alias("b2"), "b").first()
    assert m["m"]["n"] == 5 and m["b2"] == m["b"]
    assert math.isclose(m["m"]["m2"], statistics.pvariance(values) * 5, rel_tol=1e-9)


def test_training_takes_history(spark, sf_dir):
    rows = training_rows(scored(spark, sf_dir), HISTORY_FOREST, "is_fraud")
    want = point_in_time_features(scored(spark, sf_dir)).select("transaction_id", Z).collect()
    assert {r["transaction_id"]: r[Z] for r in rows.collect()} == dict(map(tuple, want))


def test_hot_account_is_cut(spark, sf_dir):
    plan = features.point_in_time_features(txn(spark, sf_dir), max_group_rows=5)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "_slice" in text and "Python" not in text

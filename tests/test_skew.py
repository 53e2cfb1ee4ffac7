"""Running totals over slices, and the search for hot groups."""

import random

from pyspark.sql import functions as F

from riskweave.operators.skew import hot_groups, running_totals


def brute(rows):
    out = []
    for g, o, v in rows:
        before = [r for r in rows if r[0] == g and r[1] < o]
        out.append((g, o, sum(r[2] for r in before) + v, max((r[2] for r in before), default=None)))
    return sorted(out, key=str)


def test_running_totals_over_slices(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot"] * 6 + ["b", "c"]), i, rng.randint(-5, 5)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, o long, v long")
    for slice_rows in (10, 97, 1000):
        got = running_totals(
            df, ["g"], ["o"], 300, {"total": "v"}, {"top": "v"}, slice_rows=slice_rows
        )
        assert got.columns == ["g", "o", "v", "total", "top"]
        out = [(r["g"], r["o"], r["total"], r["top"]) for r in got.collect()]
        assert sorted(out, key=str) == brute(rows)


def test_running_totals_without_groups(spark):
    df = spark.range(1000).withColumn("one", F.lit(1))
    got = running_totals(df, [], ["id"], 1000, {"n": "one"}, slice_rows=50)
    assert got.filter("n <> id + 1").count() == 0
    assert got.count() == 1000


def test_hot_groups(spark):
    df = spark.createDataFrame([("a",)] * 9 + [(None,)] * 5 + [("b",)], "k string")
    hot, rows, small = hot_groups(df, ["k"], 4)
    assert {r["k"] for r in hot.collect()} == {"a", None}
    assert rows == 14
    assert small
    assert not hot_groups(df, ["k"], 4, max_keys=0)[2]
    assert hot_groups(df, ["k"], 9) == (None, 0, True)

"""Account features on hand-written edges, on both the window and the sliced path."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riskweave.operators import features
from riskweave.operators.features import FEATURES, account_features

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = "transaction_id string, account_id string, amount double, event_time timestamp"
Z, HOURS, COUNT = FEATURES


def frame(spark, rows):
    return spark.createDataFrame(
        [(t, a, x, T0 + timedelta(microseconds=us)) for t, a, x, us in rows], SCHEMA
    )


def expected(rows):
    """The definitions, by brute force."""
    out = []
    for t, a, x, us in rows:
        mine = [r for r in rows if r[1] == a]
        amounts = [r[2] for r in mine if r[2] is not None]
        mean = sum(amounts) / len(amounts) if amounts else None
        z = 0.0
        if x is not None and len(amounts) > 1:
            var = sum((v - mean) ** 2 for v in amounts) / (len(amounts) - 1)
            z = (x - mean) / (var**0.5 or 1)
        before = [r[3] for r in mine if (r[3], r[0]) < (us, t)]
        hours = (us - max(before)) / 3.6e9 if before else 24.0
        n = sum(
            1
            for r in mine
            if r[2] is not None and r[3] > us - 3_600_000_000 and (r[3], r[0]) <= (us, t)
        )
        out.append((t, round(z, 6), round(hours, 9), n))
    return sorted(out)


def got(df):
    return sorted(
        (r["transaction_id"], round(r[Z], 6), round(r[HOURS], 9), r[COUNT])
        for r in df.collect()
    )


HOUR = 3_600_000_000
EDGES = {
    "ties": [("a", "x", 1.0, 5), ("b", "x", None, 5), ("c", "x", 3.0, 5)],
    "hour_edge": [
        ("a", "x", 1.0, 0),
        ("b", "x", 2.0, HOUR - 1),
        ("c", "x", 3.0, HOUR),
        ("d", "x", 4.0, 2 * HOUR - 1),
    ],
    "single": [("a", "x", 7.0, 0), ("b", "y", None, 0)],
    "flat": [("a", "x", 5.5, 0), ("b", "x", 5.5, 10), ("c", "x", 5.5, 20)],
    "tied_hours": [(f"t{i:02d}", f"u{i % 2}", float(i % 5), (i % 4) * HOUR) for i in range(24)],
}


@pytest.mark.parametrize("limit", [1_000_000, 1])
@pytest.mark.parametrize("name", EDGES)
def test_edges(spark, name, limit):
    rows = EDGES[name]
    assert got(account_features(frame(spark, rows), max_group_rows=limit)) == expected(rows)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(
            st.sampled_from("xyz"),
            st.one_of(st.none(), st.integers(0, 9)),
            st.integers(0, 12),
        ),
        min_size=1,
        max_size=30,
    )
)
def test_any_rows(spark, drawn):
    rows = [
        (f"t{i:03d}", a, None if x is None else float(x), h * HOUR // 4)
        for i, (a, x, h) in enumerate(drawn)
    ]
    df = frame(spark, rows)
    assert got(account_features(df)) == expected(rows)
    assert got(account_features(df, max_group_rows=3)) == expected(rows)


def test_more_hot_accounts_than_a_broadcast_holds(spark):
    rows = EDGES["tied_hours"]
    df = frame(spark, rows)
    few = account_features(df, max_group_rows=3)
    many = account_features(df, max_group_rows=3, max_hot_keys=1)
    assert got(many) == got(few) == expected(rows)


def test_an_infinite_amount_spoils_no_other_row(spark):
    rows = spark.createDataFrame(
        [("a", "x", 1.0), ("b", "x", float("inf")), ("c", "y", 1.0), ("d", "y", 3.0)],
        "transaction_id string, account_id string, amount double",
    ).withColumn("event_time", F.lit("2024-01-01").cast("timestamp"))
    z = {r["transaction_id"]: r["amount_zscore_for_account"] for r in account_features(rows).collect()}
    assert (z["a"], z["b"]) == (0.0, 0.0) and z["c"] == -z["d"] != 0


def test_missing_account_is_a_group_of_its_own(spark):
    rows = [("a", None, 1.0, 0), ("b", None, 2.0, 10), ("c", "x", 3.0, 20)]
    for limit in (100, 1):
        counts = {
            r["transaction_id"]: r[COUNT]
            for r in account_features(frame(spark, rows), max_group_rows=limit).collect()
        }
        assert counts == {"a": 1, "b": 2, "c": 1}


def test_not_a_number_counts_as_absent(spark):
    rows = [("a", "x", float("nan"), 0), ("b", "x", 2.0, 10)]
    got_rows = account_features(frame(spark, rows)).collect()
    assert {(r["transaction_id"], r[Z], r[COUNT]) for r in got_rows} == {
        ("a", 0.0, 0),
        ("b", 0.0, 1),
    }


@pytest.mark.parametrize("limit", [100, 1])
def test_rows_without_a_time(spark, limit):
    timed = frame(spark, [("c", "x", 3.0, 0), ("d", "x", 4.0, 10)])
    untimed = spark.createDataFrame([("a", "x", 1.0, None), ("b", "x", 2.0, None)], SCHEMA)
    got_rows = account_features(timed.unionByName(untimed), max_group_rows=limit).collect()
    assert {(r["transaction_id"], r[COUNT]) for r in got_rows} == {
        ("a", 0),
        ("b", 0),
        ("c", 1),
        ("d", 2),
    }
    assert [r[HOURS] for r in got_rows if r["transaction_id"] in "abc"] == [24.0] * 3


@pytest.mark.parametrize("block", [1_000_000, 7])
def test_many_copies_of_one_row(spark, block):
    rows = [("a", "x", 1.0, 0)] + [("b", "x", 2.0, 10)] * 50 + [("c", "x", 4.0, HOUR + 5)]
    df = frame(spark, rows)
    cut = features._by_slices(df, ["account_id"], len(rows), 10, copy_block=block)
    assert got(cut) == got(account_features(df))
    assert sorted(r[COUNT] for r in cut.collect()) == sorted([*range(1, 52), 51])


def test_one_shuffle_and_one_sort(spark):
    plan = account_features(frame(spark, EDGES["tied_hours"]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Sort [") == 1


def test_groups_within_batches(spark):
    df = frame(spark, EDGES["ties"]).selectExpr("*", "transaction_id = 'c' as batch")
    got_rows = account_features(df, ["batch", "account_id"]).collect()
    counts = {r["transaction_id"]: r[COUNT] for r in got_rows}
    assert counts == {"a": 1, "b": 1, "c": 1}

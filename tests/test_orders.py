"""Messages and the order load."""

import pytest
from pyspark.errors import AnalysisException

from riskweave.operators.checks import table_checks, verify_output
from riskweave.operators.cleaning import clean_orders, coerce_types, dedupe_first, json_records
from riskweave.plans.orders import load_orders
from riskweave.session import scratch
from riskweave.sinks.tables import VersionedTable, full_refresh, insert_if_absent
from riskweave.sources.messages import (
    bounded_drain,
    good_and_bad,
    read_orders,
    read_transactions,
    split_orders,
)

ORDERS = "seq long, order_id string, customer_id string, amount string, order_date string"


def statuses(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "seq long, value binary")
    return [r["status"] for r in read_orders(df).orderBy("seq").collect()]


def test_bad_read_orders(spark):
    good = [b'{"order_id": "ORD-1", "amount": 12.5}', b'{"amount": "12.5", "other": 1}', b"{}"]
    bad = [
        b"not json",
        b"[1,2]",
        b'[{"order_id": "ORD-1"}]',
        b"5",
        b'"text"',
        b"null",
        b"   ",
        b"",
        None,
        b'{"order_id": "ORD-1"} trailing',
        b'{"order_id": "a"} {"order_id": "b"}',
        b'{"order_id": "a"}, {"order_id": "b"}',
        b'{"order_id": ',
        b'{"order_id": "\xff\xfe"}',
    ]
    got = statuses(spark, [*good, *bad])
    assert got == ["good"] * len(good) + ["bad"] * len(bad)


def test_quoted_and_bare_numbers_survive(spark):
    df = spark.createDataFrame(
        [(1, '{"order_id": 7, "amount": 12.5}'), (2, '{"order_id": "7", "amount": "12.5"}')],
        "seq long, value string",
    )
    good, bad = split_orders(read_orders(df))
    assert bad.count() == 0
    assert {(r["order_id"], r["amount"]) for r in coerce_types(good).collect()} == {("7", 12.5)}


def test_transactions_split(spark):
    ok = (
        '{"transaction_id":"t","account_id":"a","amount":1.5,'
        '"merchant_category":"m","event_time":"%s"}'
    )
    values = [
        ok % "2024-01-01T00:00:00.123456+00:00",
        ok % "2024-01-01T02:00:00+02:00",
        ok % "soon",
        ok.replace("1.5", '"1.5"') % "2024-01-01T00:00:00Z",
        ok.replace("1.5", '"NaN"') % "2024-01-01T00:00:00Z",
        ok.replace('"transaction_id":"t",', "") % "2024-01-01T00:00:00Z",
        "not json",
        None,
    ]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    good, bad = good_and_bad(read_transactions(df))
    assert [str(r["event_time"]) for r in good.collect()] == [
        "2024-01-01 00:00:00.123456",
        "2024-01-01 00:00:00",
    ]
    reasons = [r["reason"] for r in bad.collect()]
    assert reasons[:4] == [
        "missing event_time",
        "missing amount",
        "missing amount",
        "missing transaction_id",
    ]
    assert len(reasons) == 6


@pytest.mark.parametrize("limit", [1, 7, 499, 500, 10_000])
def test_bounded_drain(spark, limit):
    df = spark.range(500).selectExpr("id * id * id + 11 as seq", "id")
    got = sorted(r["id"] for r in bounded_drain(df, limit).collect())
    assert got == list(range(min(limit, 500)))


def test_bounded_drain_of_huge_numbers(spark):
    df = spark.range(300).selectExpr("9007199254740993 + id as seq", "id")
    got = sorted(r["id"] for r in bounded_drain(df, 120).collect())
    assert got == list(range(120))


def test_first_arrival_wins(spark):
    rows = [
        (4, "a", "late", "2", None),
        (1, "a", None, "1", None),
        (3, None, "n2", "1", None),
        (2, None, "n1", "1", None),
    ]
    got = dedupe_first(spark.createDataFrame(rows, ORDERS))
    assert {(r["seq"], r["order_id"], r["customer_id"]) for r in got.collect()} == {
        (1, "a", None),
        (2, None, "n1"),
    }


def test_lenient_types(spark):
    texts = [" 2 ", "1e3", "1,000", "0x10", "", "abc", "nan", None]
    df = spark.createDataFrame([(t,) for t in texts], "amount string")
    assert [r["amount"] for r in coerce_types(df).collect()] == [2.0, 1000.0] + [None] * 6


def test_json_records_keep_absent_fields(spark):
    df = spark.createDataFrame([("a", float("nan"))], "order_id string, amount double")
    assert json_records(df).first()["record"] == '{"order_id":"a","amount":null}'


def test_clean_orders_columns(spark):
    raw = spark.createDataFrame([(1, "a", "c", "x", "2024-01-05")], ORDERS)
    row = clean_orders(raw, "2024-02-01").first()
    assert (row["amount"], row["order_date"], row["ingestion_date"]) == (
        None,
        "2024-01-05",
        "2024-02-01",
    )


def test_load_orders_replaces_and_empties(spark):
    target = VersionedTable(spark, scratch(spark, "t"))
    assert target.read() is None
    messages = spark.createDataFrame(
        [
            (1, '{"order_id":"a","amount":1}'),
            (2, '{"order_id":"a","amount":2}'),
            (3, '{"amount":3}'),
            (4, "broken"),
        ],
        "seq long, value string",
    )
    done = load_orders(messages, target, "2024-02-01", scratch(spark, "q"))
    assert (done.loaded, done.status) == (1, "ok")
    assert float(target.read().first()["amount"]) == 1.0
    none = messages.filter("seq > 9")
    kept = load_orders(none, target, "2024-02-02", skip_if_empty=True)
    assert (kept.loaded, kept.status, target.read().count()) == (0, "empty", 1)
    emptied = load_orders(none, target, "2024-02-02")
    assert (emptied.loaded, target.read().count()) == (0, 0)


def test_insert_if_absent(spark):
    new = spark.createDataFrame([("a", 1), ("b", 2)], "order_id string, v int")
    present = spark.createDataFrame([("a", 9)], "order_id string, v int")
    assert [tuple(r) for r in insert_if_absent(new, present).collect()] == [("b", 2)]


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2)], "k string, v int")
    got = {r["rule"]: r["violations"] for r in table_checks(df, ["v"], "k").collect()}
    assert got == {"not_null_k": 1, "not_null_v": 1, "unique_k": 1}
    assert verify_output(None, "x", spark).first()["status"] == "missing"
    assert verify_output(df.limit(0), "x", spark).first()["status"] == "empty"


def test_full_refresh_returns_count(spark):
    target = VersionedTable(spark, scratch(spark, "t"))
    assert full_refresh(target, spark.range(5).toDF("order_id")) == 5
    assert full_refresh(target, spark.range(3).toDF("order_id")) == 3
    assert target.read().count() == 3


def test_old_versions_are_forgotten(spark):
    target = VersionedTable(spark, scratch(spark, "t"))
    paths = [target.replace(spark.range(i)) for i in range(4)]
    assert full_refresh(target, spark.range(9), keep_versions=2) == 9
    assert target.read().count() == 9
    assert spark.read.parquet(paths[3]).count() == 3
    with pytest.raises(AnalysisException):
        spark.read.parquet(paths[2])


def test_transactions_to_quarantine_are_parsed_once(spark, sf_dir):
    from riskweave.catalog import QUERIES

    found = QUERIES["quarantine_bad_transactions"](spark, sf_dir)
    assert "from_json" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == found.select("transaction_id").distinct().count() == 1000

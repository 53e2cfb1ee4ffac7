"""Features in state: by brute force over arrival order, restarts, expiry, size."""

import math
import statistics
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.catalog.stream import _deliver, feature_model
from riskweave.operators.features import FEATURES
from riskweave.plans.views import txn
from riskweave.schemas import ROLLING_WINDOW_MICROS as HOUR
from riskweave.session import scratch
from riskweave.sinks.stores import table_stores
from riskweave.sources.messages import message_files, read_transactions
from riskweave.streaming.features import AccountState, _account_features, live_features
from riskweave.streaming.scorer import start_scoring


def naive(batches):
    """(score, hours, count) of each event, in arrival order."""
    seen, out = [], []
    for batch in batches:
        for us, x in batch:
            before = [v for _, v in seen if not math.isnan(v)]
            z = 0.0
            if len(before) > 1 and not math.isnan(x):
                z = (x - statistics.mean(before)) / (statistics.stdev(before) or 1)
            last = max((t for t, _ in seen), default=None)
            hours = 24.0 if last is None else max(us - last, 0) / 3.6e9
            seen.append((us, x))
            clock = max(t for t, _ in seen)
            n = sum(1 for t, v in seen if t > clock - HOUR and not math.isnan(v))
            out.append((z, hours, n))
    return out


@pytest.mark.parametrize("seed", range(8))
def test_state_over_batches(seed):
    rng = np.random.default_rng(seed)
    batches = []
    for k in range(5):
        us = np.sort(rng.integers(k * HOUR // 2, (k + 2) * HOUR, rng.integers(1, 30)))
        amounts = 1e9 + rng.integers(0, 9, len(us)).astype(float)
        amounts[rng.random(len(us)) < 0.2] = np.nan
        batches.append(list(zip(us.tolist(), amounts.tolist())))
    account, got = AccountState(), []
    for batch in batches:
        us, amounts = np.array(batch).T
        got += zip(*account.add(us.astype(np.int64), amounts))
    assert np.allclose(np.array(got, float), np.array(naive(batches), float), atol=1e-6)


def test_state_holds_an_hour():
    account = AccountState()
    for k in range(50):
        us = np.arange(1000) * 60_000_000 + k * 1000 * 60_000_000  # one a minute
        account.add(us, np.ones(1000))
    assert len(account.recent) == 8 * 60 and account.n == 50_000


class Timer:
    """The state of an account whose timer has run out."""

    hasTimedOut = exists = True

    def __init__(self, now_ms, value):
        self.now, self.get = now_ms, value

    def getCurrentProcessingTimeMs(self):
        return self.now

    def update(self, value):
        self.get = value


@pytest.mark.parametrize("now, left", [(HOUR // 1000, b""), (HOUR // 1000 - 1, b"12345678")])
def test_a_silent_account_lets_its_times_go(now, left):
    state = Timer(now, (3, 1.0, 2.0, 0, b"12345678"))
    assert list(_account_features([], True)(("a", -1), iter([]), state)) == []
    assert state.get == (3, 1.0, 2.0, 0, left)


def test_bad_rows_pass_and_restarts_repeat_nothing(spark, sf_dir):
    root = scratch(spark, "live")
    stores = table_stores(f"{root}/stores")
    rows = txn(spark, sf_dir)
    for i in range(2):
        _deliver(rows.filter(F.col("transaction_id") % 2 == i), f"{root}/in")
        spark.createDataFrame([("broken",), ("{}",)], "value string").write.mode("append").text(f"{root}/in")
        for _ in (1, 2):  # the second start finds nothing new
            start_scoring(
                message_files(spark, f"{root}/in"),
                lambda: ("v", feature_model()),
                stores,
                f"{root}/checkpoint",
                available_now=True,
                live=True,
                quarantine=f"{root}/rejected",
            ).awaitTermination()
    for store in stores:
        got = store.read(spark)
        assert got.count() == got.select("transaction_id").distinct().count() == rows.count()
    bad = spark.read.parquet(f"{root}/rejected")
    assert bad.count() == 4 and not set(FEATURES) & set(bad.columns)


def test_live_stream_with_expiry(spark, sf_dir):
    root = scratch(spark, "expiring")
    _deliver(txn(spark, sf_dir), f"{root}/in")
    query = (
        live_features(read_transactions(message_files(spark, f"{root}/in")), expires=True)
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/checkpoint")
        .option("path", f"{root}/out")
        .trigger(processingTime="1 second")
        .start()
    )
    try:
        # Timers make empty batches, so all that is available is never processed.
        deadline = time.time() + 60
        while not any(p["stateOperators"] for p in query.recentProgress) and time.time() < deadline:
            time.sleep(0.5)
        accounts = txn(spark, sf_dir).select("account_id").distinct().count()
        sizes = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        assert max(sizes) == accounts
    finally:
        query.stop()
    assert spark.read.parquet(f"{root}/out").count() == 1000


def test_columns_that_pass_through_go_as_one(spark, sf_dir):
    root = scratch(spark, "packed")
    _deliver(txn(spark, sf_dir), f"{root}/in")
    spark.createDataFrame([("broken",)], "value string").write.mode("append").text(f"{root}/in")
    own = {
        "own_n": F.length("value"),
        "own_t": F.lit("2024-01-01 00:00:00.123457").cast("timestamp"),
        "own_b": F.col("value").cast("binary"),
        "own_none": F.lit(None).cast("string"),
    }
    read = read_transactions(message_files(spark, f"{root}/in").withColumns(own))
    live = live_features(read)
    assert [(f.name, f.dataType) for f in live.schema][: len(read.columns)] == [
        (f.name, f.dataType) for f in read.schema
    ]
    plan = live._jdf.queryExecution().analyzed().toString()
    given = next(line for line in plan.splitlines() if "FlatMapGroupsInPandasWithState" in line)
    assert "_packed" in given and "merchant_category" not in given
    (
        live.writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/checkpoint")
        .option("path", f"{root}/out")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    want = read_transactions(spark.read.text(f"{root}/in").withColumns(own))
    got = spark.read.parquet(f"{root}/out").select(*want.columns)
    assert want.count() == got.count() == 1001
    assert got.exceptAll(want).count() == 0

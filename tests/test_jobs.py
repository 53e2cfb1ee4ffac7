"""The command line, as far as it goes without a broker."""

import pytest
from pyspark.ml import PipelineModel

from riskweave.__main__ import main, parser
from riskweave.plans.model import ForestPlan
from riskweave.plans.views import order_msgs, scored
from riskweave.session import scratch
from riskweave.sinks.stores import fan_out, table_stores
from riskweave.sinks.tables import VersionedTable
from riskweave.streaming.orders import load_pending_orders


@pytest.fixture
def small(monkeypatch):
    import riskweave.__main__ as jobs

    monkeypatch.setitem(jobs.FORESTS, "behaviour", ForestPlan(("amount",), True, 3, 3, True, True))


def test_train_job(spark, sf_dir, small):
    root = scratch(spark, "job")
    scored(spark, sf_dir).write.parquet(f"{root}/rows.parquet")
    args = ["--input", f"{root}/rows.parquet", "--model-out", f"{root}/m"]
    main(["train", *args, "--metrics-out", f"{root}/metrics"])
    assert PipelineModel.load(f"{root}/m").stages
    assert spark.read.json(f"{root}/metrics").first()["n_samples"] == 1000


def test_daily_job_reports_a_missed_gate(spark, sf_dir, small):
    root = scratch(spark, "job")
    scored(spark, sf_dir).write.parquet(f"{root}/rows")
    args = ["--history", f"{root}/rows", "--analytics", f"{root}/rows", "--root", f"{root}/out"]
    with pytest.raises(SystemExit, match="missed the gate"):
        main(["daily", *args, "--run-date", "2024-01-16", "--min-recall", "2"])
    assert spark.read.parquet(f"{root}/out/fraud_metrics_daily").count() == 1


def test_arguments():
    a = parser().parse_args(
        "score --servers h:1 --models m --stores s --checkpoint c".split()
    )
    assert (a.topic, a.ops_jdbc_url) == ("transactions", None)
    with pytest.raises(SystemExit):
        parser().parse_args(["orders", "--servers", "h:1"])


def _order_files(spark, sf_dir, path):
    order_msgs(spark, sf_dir).selectExpr(
        "seq", "to_json(struct(order_id, customer_id, amount, order_date)) as value"
    ).repartitionByRange(3, "seq").write.parquet(path)


def _order_stream(spark, path):
    return (
        spark.readStream.schema("seq long, value string")
        .option("maxFilesPerTrigger", 1)
        .parquet(path)
    )


def test_bounded_batches_of_a_run_are_loaded_together(spark, sf_dir):
    root = scratch(spark, "orders")
    _order_files(spark, sf_dir, f"{root}/in")
    target = VersionedTable(spark, f"{root}/t")
    done = load_pending_orders(
        _order_stream(spark, f"{root}/in"), target, "2024-02-01", f"{root}/c", f"{root}/q"
    )
    ids = order_msgs(spark, sf_dir).filter("order_id is not null").select("order_id").distinct()
    assert done.taken == order_msgs(spark, sf_dir).count()
    assert done.loaded == target.read().count() == ids.count()


def test_a_run_without_messages(spark, sf_dir):
    root = scratch(spark, "orders")
    _order_files(spark, sf_dir, f"{root}/in")
    target = VersionedTable(spark, f"{root}/t")
    run = lambda **o: load_pending_orders(
        _order_stream(spark, f"{root}/in"), target, "2024-02-01", f"{root}/c", **o
    )
    loaded = run().loaded
    assert run(skip_if_empty=True).taken == 0
    assert target.read().count() == loaded
    assert run().status == "empty"
    assert target.read().count() == 0


def test_a_run_before_the_first_message(spark):
    root = scratch(spark, "orders")
    spark.createDataFrame([], "seq long, value string").write.parquet(f"{root}/in")
    target = VersionedTable(spark, f"{root}/t")
    done = load_pending_orders(
        _order_stream(spark, f"{root}/in"), target, "2024-02-01", f"{root}/c"
    )
    assert (done.taken, done.loaded, done.status) == (0, 0, "empty")


def test_score_then_daily_on_the_same_folders(spark, sf_dir, small, monkeypatch):
    import riskweave.__main__ as jobs

    monkeypatch.setitem(
        jobs.FORESTS, "simple", ForestPlan(("amount",), False, 3, 3, False, False, "is_flagged", False)
    )
    root = scratch(spark, "chain")
    stores = table_stores(f"{root}/stores")
    for batch_id in (0, 1):
        fan_out(scored(spark, sf_dir).filter(f"transaction_id % 2 = {batch_id}"), batch_id, stores)
    stores[1].compact(spark)
    args = ["--history", stores[1].path, "--analytics", stores[2].path, "--root", f"{root}/out"]
    main(["daily", *args, "--run-date", "2024-01-16", "--forest", "simple", "--min-recall", "0", "--min-precision", "0"])
    metrics = spark.read.json(f"{root}/out/metrics/2024-01-16").first()
    assert metrics["n_samples"] == 1000
    checks = spark.read.json(f"{root}/out/checks/2024-01-16").collect()
    assert len(checks) == 9 and all(c["violations"] == 0 for c in checks)

"""The commit log of the stores: crashes at every step, writers at once, clean-up."""

from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest
from pyspark.sql import functions as F

from riskweave.catalog.outputs import FailsToCommit
from riskweave.plans.views import order_msgs, scored
from riskweave.session import folders_below, scratch
from riskweave.sinks import stores, tables
from riskweave.sinks.manifest import CommitLog, Entry, Manifest
from riskweave.sinks.stores import TableStore, read_store, table_stores
from riskweave.sources.messages import encode_orders
from riskweave.streaming import orders


def lake(spark, name):
    return table_stores(scratch(spark, name))[1]


def part(rows, n, i):
    return rows.filter(F.col("transaction_id").cast("long") % n == i)


def ids(store, spark):
    got = [r[0] for r in store.read(spark).select("transaction_id").collect()]
    assert len(got) == len(set(got))
    return len(got)


def test_manifests_are_numbered_once(spark):
    log = CommitLog(spark, scratch(spark, "log"))
    assert log.latest() == Manifest() and log.versions() == []
    assert log.commit(lambda m: Manifest(0, (Entry("a"),))).version == 1
    assert log.commit(lambda m: None) is None
    taken = Manifest(1, (Entry("b"),))
    assert not log._create(taken)  # the number is gone
    assert log.latest().entries == (Entry("a"),)
    for _ in range(25):
        log.commit(lambda m: m)
    assert len(log.versions()) == 20 and log.latest().version == 26


def test_commits_at_once_lose_none(spark):
    path = scratch(spark, "log")

    def add(i):
        log = CommitLog(spark, path)
        return log.commit(lambda m: Manifest(0, (*m.entries, Entry(str(i)))))

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(add, range(12)))
    now = CommitLog(spark, path).latest()
    assert sorted(int(e.folder) for e in now.entries) == list(range(12)) and now.version == 12


def test_one_of_many_creates_a_number(spark):
    path = scratch(spark, "log")
    logs = [CommitLog(spark, path) for _ in range(6)]
    with ThreadPoolExecutor(6) as pool:
        for n in range(1, 41):
            made = list(pool.map(lambda i: logs[i]._create(Manifest(n, (Entry(str(i)),))), range(6)))
            assert sum(made) == 1 and logs[0].latest().entries == (Entry(str(made.index(True))),)


@pytest.mark.parametrize("step", ["write", "compact"])
def test_a_crash_before_the_manifest_counts_for_nothing(spark, sf_dir, step):
    store = lake(spark, "crash")
    failing = FailsToCommit(store.path, store.rows, store.partitions, store.clustered)
    rows = scored(spark, sf_dir)
    store.write(part(rows, 3, 0), 0)
    store.write(part(rows, 3, 1), 1)
    before = ids(store, spark)
    with pytest.raises(OSError):
        failing.write(part(rows, 3, 2), 2) if step == "write" else failing.compact(spark)
    assert ids(store, spark) == before
    store.write(part(rows, 3, 2), 2)
    assert store.compact(spark, grace_seconds=0) == 2 and ids(store, spark) == 1000
    # The orphan and what was merged are gone, what counts is not.
    assert len(folders_below(spark, f"{store.path}/data")) == 2


def test_a_crash_behind_the_manifest_changes_nothing(spark, sf_dir, monkeypatch):
    store = lake(spark, "behind")
    rows = scored(spark, sf_dir)
    for i in range(3):
        store.write(part(rows, 3, i), i)
    with monkeypatch.context() as m:
        m.setattr(TableStore, "clean", lambda *a, **b: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.compact(spark)
    assert ids(store, spark) == 1000
    for i in range(3):  # the stream repeats what it had not noted
        store.write(part(rows, 3, i), i)
    assert ids(store, spark) == 1000 and store.compact(spark) == 0


def test_two_compactors_and_a_writer(spark, sf_dir):
    store = lake(spark, "two")
    rows = scored(spark, sf_dir)
    for i in range(4):
        store.write(part(rows, 5, i), i)
    with ThreadPoolExecutor(3) as pool:
        done = [
            pool.submit(store.compact, spark),
            pool.submit(store.compact, spark),
            pool.submit(store.write, part(rows, 5, 4), 4),
        ]
        closed = [d.result() for d in done]
    assert sum(n for n in closed if n) in (3, 4) and ids(store, spark) == 1000


def test_compaction_gives_up_when_its_batches_changed(spark, sf_dir, monkeypatch):
    store = lake(spark, "changed")
    rows = scored(spark, sf_dir)
    for i in range(2):
        store.write(part(rows, 2, i), i)
    real = stores.write_partitioned

    def replayed(df, path, *a, **b):
        real(df, path, *a, **b)
        if "folder=m" in path:
            store.write(part(rows, 2, 0), 0)  # the stream repeats the batch meanwhile

    monkeypatch.setattr(stores, "write_partitioned", replayed)
    assert store.compact(spark) == 0 and ids(store, spark) == 1000


def test_a_new_stream_counts_beside_the_old_one(spark, sf_dir):
    store = lake(spark, "streams")
    rows = scored(spark, sf_dir)
    for i in range(3):
        store.write(part(rows, 4, i), i, stream="first")
    store.compact(spark)
    store.write(part(rows, 4, 3), 0, stream="second")
    store.write(part(rows, 4, 0), 0, stream="first")  # closed
    assert ids(store, spark) == 1000


def test_merged_folders_stay_few(spark):
    store = TableStore(scratch(spark, "levels"), lambda df: df)
    for i in range(40):
        store.write(spark.range(i, i + 1).coalesce(1), i)
        store.compact(spark, grace_seconds=0)
    now = store.log(spark).latest()
    assert sorted(r[0] for r in store.read(spark).select("id").collect()) == list(range(40))
    assert len(now.entries) <= 2 * stores.MERGED_AT and max(e.level for e in now.entries) == 2
    assert len(folders_below(spark, f"{store.path}/data")) == len(now.entries)


def test_an_empty_try_takes_the_batch_away(spark, sf_dir):
    store = lake(spark, "emptied")
    rows = scored(spark, sf_dir)
    store.write(rows, 0)
    store.write(rows.limit(0), 0)
    with pytest.raises(FileNotFoundError):
        store.read(spark)
    store.write(rows, 0)
    assert read_store(spark, store.path).count() == 1000


def test_readers_under_way_keep_their_files(spark, sf_dir):
    store = lake(spark, "readers")
    rows = scored(spark, sf_dir)
    for i in range(2):
        store.write(part(rows, 2, i), i)
    reading = store.read(spark)
    store.compact(spark)
    assert reading.count() == 1000


def test_rejected_orders_of_a_retried_load_stand_once(spark, sf_dir, monkeypatch):
    root = scratch(spark, "retried")
    target = tables.VersionedTable(spark, f"{root}/target")
    good = order_msgs(spark, sf_dir).select("order_id", "customer_id", "amount", "order_date")
    messages = encode_orders(good.limit(50)).select(F.col("value").cast("string"))
    bad = spark.createDataFrame([("broken",)] * 5, "value string")

    def load():
        stream = spark.readStream.schema("value string").text(f"{root}/in").withColumn("seq", F.lit(0).cast("long"))
        return orders.load_pending_orders(
            stream, target, str(date(2024, 1, 1)), f"{root}/checkpoint", quarantine=f"{root}/bad"
        )

    messages.unionByName(bad).write.text(f"{root}/in")
    with monkeypatch.context() as m:
        m.setattr(orders, "remove", lambda *a: 1 / 0)  # fails once the table is replaced
        with pytest.raises(ZeroDivisionError):
            load()
    load()
    assert spark.read.parquet(f"{root}/bad").count() == 5
    bad.write.mode("append").text(f"{root}/in")
    load()
    assert spark.read.parquet(f"{root}/bad").count() == 10

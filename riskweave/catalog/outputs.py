"""Queries: stores, snapshots and table definitions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskweave.catalog.features import DAILY_SQL
from riskweave.catalog.registry import query, rounded
from riskweave.operators.rollup import daily_fraud_metrics
from riskweave.plans.views import scored
from riskweave.schemas import ANALYTICS_COLUMNS, LAKE_COLUMNS, OPS_COLUMNS, TABLES
from riskweave.session import scratch
from riskweave.sinks import stores, tables

MONEY_SQL = "cast(cast(amount as decimal(12,2)) as double) amount"
FLAG_SQL = "cast(is_flagged as bigint) is_flagged"
OPS_SQL = f"""
select transaction_id, account_id, {MONEY_SQL}, merchant_category, location, event_time,
       fraud_probability, {FLAG_SQL}, scored_at
from scored
"""
LAKE_SQL = f"""
select transaction_id, account_id, amount, merchant_category, location, event_time,
       fraud_probability, {FLAG_SQL}, scored_at, cast(cast(event_time as date) as varchar) event_date
from scored
"""


@query(OPS_SQL)
def sink_ops_store(spark, sf_dir):
    store = stores.table_stores(scratch(spark, "stores"))[0]
    store.write(scored(spark, sf_dir), 0)
    return store.read(spark).select(*OPS_COLUMNS)


@query(LAKE_SQL)
def sink_lake_append(spark, sf_dir):
    path = scratch(spark, "lake")
    rows = stores.lake_rows(scored(spark, sf_dir))
    half = F.col("transaction_id").cast("long") % 2 == 0
    stores.write_partitioned(rows.filter(half), path, ["event_date"])
    stores.write_partitioned(rows.filter(~half), path, ["event_date"])
    return spark.read.parquet(path).select(*LAKE_COLUMNS, "event_date")


@query(
    f"""
select transaction_id, account_id, {MONEY_SQL}, merchant_category, location, fraud_probability,
       {FLAG_SQL}, scored_at, strftime(scored_at, '%Y%m') scored_month
from scored
"""
)
def sink_analytics_store(spark, sf_dir):
    store = stores.table_stores(scratch(spark, "stores"))[2]
    store.write(scored(spark, sf_dir), 0)
    return store.read(spark).select(
        *ANALYTICS_COLUMNS, F.col("scored_month").cast("string").alias("scored_month")
    )


@query(
    """
, b as (select cast(transaction_id as bigint) % 2 as batch_id, count(*) n_scored,
               cast(sum(is_flagged) as bigint) n_flagged from scored group by 1)
select name, batch_id, n_scored, n_flagged
from b, (values ('transactions_scored'), ('transactions_scored_history'),
                ('transactions_scored_analytics')) as s(name)
"""
)
def fanout_sink(spark, sf_dir):
    targets = stores.table_stores(scratch(spark, "stores"))
    rows = scored(spark, sf_dir)
    for batch_id in (0, 1):
        batch = rows.filter(F.col("transaction_id").cast("long") % 2 == batch_id)
        stores.fan_out(batch, batch_id, targets)
    out = None
    for store in targets:
        counts = stores.batch_counts(store.read(spark)).select(
            F.lit(store.path.rsplit("/", 1)[1]).alias("name"), "*"
        )
        out = counts if out is None else out.unionByName(counts)
    return out


@query(
    """
select transaction_id, cast(is_flagged as bigint) is_flagged, fraud_probability,
       cast(transaction_id as bigint) % 3 as batch_id
from scored
"""
)
def replay_safe_write(spark, sf_dir):
    path = scratch(spark, "replay")
    rows = stores.lake_rows(scored(spark, sf_dir))
    for batch_id in (0, 1, 1, 2, 0):  # batches 0 and 1 are delivered twice
        batch = rows.filter(F.col("transaction_id").cast("long") % 3 == batch_id)
        stores.replace_batch(batch, path, batch_id, ["event_date"])
    return spark.read.parquet(path).select(
        "transaction_id", "is_flagged", "fraud_probability", "batch_id"
    )


@query(
    """
select transaction_id, amount, cast(cast(event_time as date) as varchar) event_date,
       cast(transaction_id as bigint) % 4 as batch_id
from scored
"""
)
def compact_lake(spark, sf_dir):
    store = stores.table_stores(scratch(spark, "compact"))[1]
    rows = scored(spark, sf_dir)

    def deliver(batch_id):
        store.write(rows.filter(F.col("transaction_id").cast("long") % 4 == batch_id), batch_id)

    for batch_id in (0, 1, 1):  # a replay before the compaction
        deliver(batch_id)
    store.compact(spark)  # closes batch 0
    for batch_id in (0, 1, 2):  # replays behind it
        deliver(batch_id)
    store.compact(spark)  # closes batches 1 and 2 but for the newest
    deliver(3)
    return store.read(spark).select("transaction_id", "amount", "event_date", "batch_id")


@query(DAILY_SQL.format(where=""))
def daily_metrics_incremental(spark, sf_dir):
    """The rollup kept batch by batch: batches that touch all days, replays of open and of
    closed ones, compactions in between."""
    root = scratch(spark, "rollup")
    store = stores.rollup_store(root)
    rows = scored(spark, sf_dir)
    for batch_id in (0, 1, 1, 2, 0, 3, 2):
        store.write(rows.filter(F.col("transaction_id").cast("long") % 4 == batch_id), batch_id)
        if batch_id % 2 == 0:
            store.compact(spark)
    return rounded(stores.read_rollup(spark, root), "avg_fraud_probability")


class FailsToCommit(stores.TableStore):
    """Stops after its data is written, before the manifest."""

    def log(self, spark):
        log = super().log(spark)

        def commit(change):
            raise OSError("the driver is gone")

        log.commit = commit
        return log


@query(
    """
select transaction_id, amount, cast(cast(event_time as date) as varchar) event_date,
       cast(transaction_id as bigint) % 6 as batch_id
from scored
"""
)
def commit_crash(spark, sf_dir):
    """Batches and compactions that fail before their manifest, with more batches behind them."""
    store = stores.table_stores(scratch(spark, "crash"))[1]
    failing = FailsToCommit(store.path, store.rows, store.partitions, store.clustered)
    rows = scored(spark, sf_dir)
    for batch_id in range(6):
        some = rows.filter(F.col("transaction_id").cast("long") % 6 == batch_id)
        for step in (
            lambda: failing.write(some, batch_id),
            lambda: store.write(some, batch_id),
            lambda: failing.compact(spark),
        ):
            try:
                step()
            except OSError:
                pass
        if batch_id in (2, 4):
            store.compact(spark)
    return store.read(spark).select("transaction_id", "amount", "event_date", "batch_id")


@query(LAKE_SQL)
def snapshot_history(spark, sf_dir):
    root = scratch(spark, "snapshot")
    name = f"riskweave_{uuid.uuid4().hex}"
    tables.create_tables(spark, name, f"{root}/db")
    history = f"{name}.transactions_scored_history"
    stores.CatalogStore(history, stores.lake_rows).write(scored(spark, sf_dir), 0)
    tables.append_snapshot(spark, history, f"{root}/snapshot.parquet")
    spark.sql(f"DROP DATABASE {name} CASCADE")
    return spark.read.parquet(f"{root}/snapshot.parquet").drop("batch_id")


@query(
    """
select name, case when name = 'fraud_metrics_daily' then n_days when name = 'order_summary' then 0
                  else n_rows end n_rows
from (select count(*) n_rows, count(distinct cast(scored_at as date)) n_days from scored),
     (values ('transactions_scored'), ('transactions_scored_history'),
             ('transactions_scored_analytics'), ('fraud_metrics_daily'), ('order_summary')) as t(name)
"""
)
def create_tables(spark, sf_dir):
    name = f"riskweave_{uuid.uuid4().hex}"
    tables.create_tables(spark, name, f"{scratch(spark, 'tables')}/db")
    rows = scored(spark, sf_dir)
    filled = {
        "transactions_scored": stores.ops_rows,
        "transactions_scored_history": stores.lake_rows,
        "transactions_scored_analytics": stores.analytics_rows,
    }
    for table, columns in filled.items():
        store = stores.CatalogStore(f"{name}.{table}", columns)
        for _ in (1, 2):  # delivered twice
            store.write(rows, 0)
    days = f"{name}.fraud_metrics_daily"
    daily_fraud_metrics(rows).select(*spark.table(days).columns).write.insertInto(days)
    out = None
    for table in TABLES:
        one = spark.table(f"{name}.{table}").select(F.lit(table).alias("name"))
        counted = one.agg(F.lit(table).alias("name"), F.count("*").alias("n_rows"))
        out = counted if out is None else out.unionByName(counted)
    return out

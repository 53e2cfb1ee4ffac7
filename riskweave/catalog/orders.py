"""Queries: the order load."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.catalog.registry import query
from riskweave.operators import checks, cleaning
from riskweave.plans.orders import load_orders
from riskweave.plans.views import order_msgs, scored
from riskweave.schemas import NOT_NULL, ORDER_FLOW_NAME
from riskweave.session import scratch
from riskweave.sinks.inserts import insert_new
from riskweave.sinks.tables import (
    VersionedTable,
    insert_if_absent as absent_rows,
    order_summary_rows,
)
from riskweave.streaming.orders import load_pending_orders

# Fixed value: the day the loads are run for.
RUN_DATE = "2024-02-01"

COERCED = """
  try_cast(amount as double) amount, cast(cast(try_strptime(order_date, '%Y-%m-%d') as date) as varchar) order_date
"""
SUMMARY = f"""
  order_id, customer_id, cast(try_cast(amount as decimal(12,2)) as double) amount, '{RUN_DATE}' load_date
"""


@query("select seq, order_id, customer_id from order_msgs where order_id is not null")
def skip_null_key(spark, sf_dir):
    return cleaning.skip_null_key(order_msgs(spark, sf_dir)).select(
        "seq", "order_id", "customer_id"
    )


@query(
    f"""
select seq, order_id, '{RUN_DATE}' ingestion_date, '{ORDER_FLOW_NAME}' pipeline from order_msgs
"""
)
def stamp_ingest(spark, sf_dir):
    return cleaning.stamp_ingest(order_msgs(spark, sf_dir), RUN_DATE).select(
        "seq", "order_id", "ingestion_date", "pipeline"
    )


@query("select seq, order_id, customer_id, amount, order_date from first_orders")
def dedupe_first(spark, sf_dir):
    return cleaning.dedupe_first(order_msgs(spark, sf_dir))


@query(f"select seq, order_id, customer_id, {COERCED} from order_msgs")
def coerce_types(spark, sf_dir):
    return cleaning.coerce_types(order_msgs(spark, sf_dir))


@query(f"select seq, order_id, customer_id, {COERCED} from order_msgs")
def json_safe_rows(spark, sf_dir):
    typed = cleaning.coerce_types(order_msgs(spark, sf_dir))
    return cleaning.json_records(typed).select(
        F.from_json(
            "record",
            "seq long, order_id string, customer_id string, amount double, order_date string",
        ).alias("r")
    ).select("r.*")


@query(
    f"""
select seq, order_id, customer_id, {COERCED}, '{RUN_DATE}' ingestion_date,
       '{ORDER_FLOW_NAME}' pipeline
from first_orders
"""
)
def clean_orders(spark, sf_dir):
    return cleaning.clean_orders(order_msgs(spark, sf_dir), RUN_DATE)


@query(f"select {SUMMARY} from first_orders where order_id is not null")
def full_refresh_load(spark, sf_dir):
    root = scratch(spark, "orders")
    orders = order_msgs(spark, sf_dir)
    target = VersionedTable(spark, f"{root}/order_summary")
    # Something older must be gone after the load.
    target.replace(order_summary_rows(cleaning.coerce_types(orders), "2024-01-31"))
    messages = orders.select(
        "seq",
        F.to_json(F.struct("order_id", "customer_id", "amount", "order_date")).alias("value"),
    )
    load_orders(messages, target, RUN_DATE, f"{root}/rejected")
    return target.read()


@query(
    f"""
select {SUMMARY}, case when cast(substr(order_id, 5) as bigint) % 2 = 0 then 'kept' else 'inserted' end as origin
from first_orders where order_id is not null
"""
)
def insert_if_absent(spark, sf_dir):
    path = scratch(spark, "order_summary")
    cleaned = cleaning.clean_orders(order_msgs(spark, sf_dir), RUN_DATE)
    rows = order_summary_rows(cleaned, RUN_DATE)
    even = F.substring("order_id", 5, 20).cast("long") % 2 == 0
    rows.filter(even).withColumn("origin", F.lit("kept")).write.parquet(path)
    present = spark.read.parquet(path)
    absent_rows(rows, present).withColumn("origin", F.lit("inserted")).write.mode(
        "append"
    ).parquet(path)
    return spark.read.parquet(path)


@query(
    f"""
, summary as (select {SUMMARY}, cast(substr(order_id, 5) as bigint) k from first_orders
              where order_id is not null)
select order_id, customer_id, amount, load_date,
       (select count(*) from summary where k % 50 = 0) n_inserted, 0 n_repeated
from summary
"""
)
def insert_into_large_table(spark, sf_dir):
    """One row in fifty is new to the table, as many come that it has; then all come again."""
    path = scratch(spark, "large_summary")
    cleaned = cleaning.clean_orders(order_msgs(spark, sf_dir), RUN_DATE)
    rows = order_summary_rows(cleaned, RUN_DATE)
    k = F.substring("order_id", 5, 20).cast("long")
    insert_new(rows.filter(k % 50 != 0), path)
    coming = rows.filter(k % 50 <= 1)
    inserted, repeated = insert_new(coming, path), insert_new(coming, path)
    return spark.read.parquet(path).withColumns(
        {"n_inserted": F.lit(inserted), "n_repeated": F.lit(repeated)}
    )


@query(
    """
, gaps as (select transaction_id, case when k % 11 <> 0 then account_id end account_id,
                  case when k % 13 <> 0 then amount end amount,
                  case when k % 17 <> 0 then merchant_category end merchant_category,
                  case when k % 19 <> 0 then event_time end event_time,
                  case when k % 23 <> 0 then fraud_probability end fraud_probability,
                  case when k % 29 <> 0 then is_flagged end is_flagged,
                  case when k % 31 <> 0 then scored_at end scored_at
           from (select *, cast(transaction_id as bigint) k from scored))
select 'scored' as name, 'not_null_transaction_id' as rule, count(*) - count(transaction_id) as violations from gaps
union all select 'scored', 'not_null_account_id', count(*) - count(account_id) from gaps
union all select 'scored', 'not_null_amount', count(*) - count(amount) from gaps
union all select 'scored', 'not_null_merchant_category', count(*) - count(merchant_category) from gaps
union all select 'scored', 'not_null_event_time', count(*) - count(event_time) from gaps
union all select 'scored', 'not_null_fraud_probability', count(*) - count(fraud_probability) from gaps
union all select 'scored', 'not_null_is_flagged', count(*) - count(is_flagged) from gaps
union all select 'scored', 'not_null_scored_at', count(*) - count(scored_at) from gaps
union all select 'scored', 'unique_transaction_id', count(transaction_id) - count(distinct transaction_id) from gaps
union all select 'order_msgs', 'not_null_order_id', count(*) - count(order_id) from order_msgs
union all select 'order_msgs', 'unique_order_id', count(order_id) - count(distinct order_id) from order_msgs
"""
)
def table_checks(spark, sf_dir):
    k = F.col("transaction_id").cast("long")
    gaps = scored(spark, sf_dir)
    for column, n in zip(NOT_NULL["transactions_scored"], (11, 13, 17, 19, 23, 29, 31)):
        gaps = gaps.withColumn(column, F.when(k % n != 0, F.col(column)))
    a = checks.check_rules(gaps, "transactions_scored")
    b = checks.check_rules(order_msgs(spark, sf_dir), "order_summary")
    return a.select(F.lit("scored").alias("name"), "*").unionByName(
        b.select(F.lit("order_msgs").alias("name"), "*")
    )


@query(
    """
select 'orders' as name, case when count(*) = 0 then 'empty' else 'ok' end status from first_orders
union all
select 'orders_without_customer', case when count(*) = 0 then 'empty' else 'ok' end
from first_orders where customer_id is null
union all select 'never_made', 'missing'
"""
)
def verify_output(spark, sf_dir):
    cleaned = cleaning.clean_orders(order_msgs(spark, sf_dir), RUN_DATE)
    outputs = {
        "orders": cleaned,
        "orders_without_customer": cleaned.filter("customer_id is null"),
        "never_made": None,
    }
    out = None
    for name, df in outputs.items():
        row = checks.verify_output(df, name, spark)
        out = row if out is None else out.unionByName(row)
    return out


@query(f"select {SUMMARY} from first_orders where order_id is not null")
def stream_order_load(spark, sf_dir):
    root = scratch(spark, "order_stream")
    # Four bounded batches; an order and its repeats come in different ones.
    order_msgs(spark, sf_dir).select(
        "seq",
        F.to_json(F.struct("order_id", "customer_id", "amount", "order_date")).alias("value"),
    ).repartitionByRange(4, "seq").write.parquet(f"{root}/in")
    messages = (
        spark.readStream.schema("seq long, value string")
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{root}/in")
    )
    target = VersionedTable(spark, f"{root}/order_summary")
    load_pending_orders(messages, target, RUN_DATE, f"{root}/checkpoint", f"{root}/rejected")
    return target.read()

"""Queries: sources, parsing, projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.catalog.registry import query
from riskweave.functions.columns import flagged
from riskweave.operators.checks import is_empty
from riskweave.operators.metrics import precision_recall
from riskweave.operators.rollup import filter_day
from riskweave.plans.model import empty_metrics
from riskweave.plans.views import order_msgs, scored, table, txn
from riskweave.schemas import TRANSACTION_SCHEMA
from riskweave.session import scratch, written
from riskweave.sources.files import (
    drop_incomplete_rows,
    scan_training_input,
    select_present_columns,
)
from riskweave.sources.messages import (
    bounded_drain,
    encode_orders,
    encode_transactions,
    good_and_bad,
    message_files,
    parse_transactions,
    read_orders,
    read_transactions,
    source_backlog,
)

TXN_SQL = """
select transaction_id, account_id, amount, merchant_category, location, event_time from txn
"""


def _typed(parsed):
    return parsed.withColumn("event_time", F.try_to_timestamp("event_time"))


@query(TXN_SQL)
def src_stream_json(spark, sf_dir):
    root = scratch(spark, "stream")
    encode_transactions(txn(spark, sf_dir)).select(
        F.col("value").cast("string")
    ).write.text(f"{root}/in")
    (
        parse_transactions(message_files(spark, f"{root}/in"))
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/checkpoint")
        .option("path", f"{root}/out")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return _typed(spark.read.parquet(f"{root}/out"))


@query(TXN_SQL)
def parse_txn_json(spark, sf_dir):
    return _typed(parse_transactions(encode_transactions(txn(spark, sf_dir))))


@query(
    """
select seq, case when seq % 19 = 0 then 'bad' else 'good' end status,
       case when seq % 19 <> 0 then order_id end order_id,
       case when seq % 19 <> 0 then amount end amount
from order_msgs
"""
)
def quarantine_bad_messages(spark, sf_dir):
    orders = order_msgs(spark, sf_dir)
    fields = ["order_id", "customer_id", "amount", "order_date"]
    text = F.to_json(F.struct(*fields))
    kind = F.col("seq") % 5
    broken = (
        F.when(kind == 0, F.substring(text, 1, 20))
        .when(kind == 1, F.concat(text, F.lit(" "), text))
        .when(kind == 2, F.concat(F.lit("["), text, F.lit(",1]")))
        .when(kind == 3, F.lit("  "))
        .otherwise(F.lit(None))
    )
    messages = orders.select(
        "seq", F.when(F.col("seq") % 19 == 0, broken).otherwise(text).alias("value")
    )
    return read_orders(messages).select("seq", "status", "order_id", "amount")


@query(
    """
select transaction_id,
       case when cast(transaction_id as bigint) % 7 = 0 or cast(transaction_id as bigint) % 21 in (3, 5)
            then 'bad' else 'good' end status
from txn
"""
)
def quarantine_bad_transactions(spark, sf_dir):
    number = F.col("transaction_id").cast("long")
    dirty = (
        encode_transactions(
            txn(spark, sf_dir).withColumns(
                {
                    "account_id": F.when(number % 21 != 0, F.col("account_id")),
                    "event_time": F.when(number % 21 != 7, F.col("event_time")),
                    "amount": F.when(number % 21 == 3, F.lit(1e11))
                    .when(number % 21 == 5, F.lit(float("inf")))
                    .when(number % 21 != 14, F.col("amount")),
                }
            )
        )
    )
    # Filters on what is read from a message would read it anew for each field they look at.
    good, bad = good_and_bad(written(read_transactions(dirty), "read"))
    bad_id = F.get_json_object(F.col("value").cast("string"), "$.transaction_id")
    return good.select("transaction_id", F.lit("good").alias("status")).unionByName(
        bad.select(bad_id.alias("transaction_id"), F.lit("bad").alias("status"))
    )


@query("select seq, order_id, amount from order_msgs order by seq limit 5000", name="bounded_drain")
def bounded_drain_first(spark, sf_dir):
    return bounded_drain(order_msgs(spark, sf_dir), 5000).select("seq", "order_id", "amount")


@query(
    """
, m as (select o_orderkey k, case when o_orderkey % 7 <> 0 then o_orderkey // 500 end seq from orders)
select k as "offset", seq from m order by seq nulls last, k
limit (select cast(count(*) * 0.95 as bigint) from m)
"""
)
def bounded_drain_ties(spark, sf_dir):
    k = F.col("o_orderkey")
    messages = table(spark, sf_dir, "orders").select(
        k.alias("offset"), F.when(k % 7 != 0, F.floor(k / 500)).alias("seq")
    )
    n = messages.count()
    # Many messages share an arrival time, a seventh have none; the bound lies among those.
    return bounded_drain(messages, round(n * 0.95)).select("offset", "seq")


@query("select count(*) pending from order_msgs", name="source_backlog")
def source_backlog_count(spark, sf_dir):
    return source_backlog(order_msgs(spark, sf_dir))


@query("select event_id, user_id, event_type, value, props, ts from events")
def scan_parquet(spark, sf_dir):
    return scan_training_input(spark, f"{sf_dir}/events.parquet").select(
        "event_id", "user_id", "event_type", "value", "props", "ts"
    )


@query("select event_id, user_id, event_type, value, props, ts from events")
def scan_parquet_folder(spark, sf_dir):
    path = scratch(spark, "snapshot")  # a name without a suffix
    spark.read.parquet(f"{sf_dir}/events.parquet").write.parquet(path)
    return scan_training_input(spark, path, format="parquet")


@query(TXN_SQL)
def scan_csv(spark, sf_dir):
    path = scratch(spark, "csv")
    rows = txn(spark, sf_dir)
    encode = rows.withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    encode.write.option("header", True).csv(path)
    return _typed(scan_training_input(spark, path, TRANSACTION_SCHEMA))


@query("select account_id as message_key, transaction_id, account_id, amount, event_time from txn")
def encode_messages(spark, sf_dir):
    messages = encode_transactions(txn(spark, sf_dir)).withColumn(
        "message_key", F.col("key").cast("string")
    )
    return _typed(parse_transactions(messages)).select(
        "message_key", "transaction_id", "account_id", "amount", "event_time"
    )


@query("select order_id, customer_id, amount, order_date from order_msgs")
def encode_order_messages(spark, sf_dir):
    orders = order_msgs(spark, sf_dir).select(
        "order_id", "customer_id", "amount", "order_date"
    )
    return read_orders(encode_orders(orders)).drop("value", "status")


@query("select transaction_id, amount, merchant_category from txn", name="select_present_columns")
def select_present_columns_query(spark, sf_dir):
    return select_present_columns(
        txn(spark, sf_dir),
        ["transaction_id", "amount", "merchant_category", "device_fingerprint"],
    )


@query(
    """
select transaction_id, amount, merchant_category, location, is_flagged from scored
where cast(transaction_id as bigint) % 11 <> 0 and cast(transaction_id as bigint) % 13 <> 0
""",
    name="drop_incomplete_rows",
)
def drop_incomplete_rows_query(spark, sf_dir):
    number = F.col("transaction_id").cast("long")
    gaps = scored(spark, sf_dir).withColumns(
        {
            "amount": F.when(number % 11 != 0, F.col("amount")),
            "location": F.when(number % 13 != 0, F.col("location")),
        }
    )
    return drop_incomplete_rows(
        gaps,
        ["transaction_id", "amount", "merchant_category", "location", "is_flagged", "absent"],
    )


@query(
    """
select transaction_id, fraud_probability, cast(is_flagged as bigint) is_flagged from scored
"""
)
def flag_threshold(spark, sf_dir):
    return scored(spark, sf_dir).select(
        "transaction_id", "fraud_probability", flagged("fraud_probability").alias("is_flagged")
    )


@query(
    """
select transaction_id, account_id, amount, scored_at from scored
where cast(scored_at as date) = date '2024-01-15'
""",
    name="filter_day",
)
def filter_day_query(spark, sf_dir):
    return filter_day(scored(spark, sf_dir), "2024-01-15").select(
        "transaction_id", "account_id", "amount", "scored_at"
    )


@query(
    """
select 'all' as part, round(sum(is_fraud * is_flagged) / cast(sum(is_flagged) as double), 6) as precision,
       round(sum(is_fraud * is_flagged) / cast(sum(is_fraud) as double), 6) as recall,
       round(2 * sum(is_fraud * is_flagged) / cast(sum(is_flagged) + sum(is_fraud) as double), 6) as f1,
       count(*) as n_samples
from scored
union all select 'none', 0.0, 0.0, 0.0, 0
"""
)
def empty_guard(spark, sf_dir):
    whole = scored(spark, sf_dir)
    parts = {"all": whole, "none": whole.filter("amount < 0")}
    out = None
    for name, part in parts.items():
        if is_empty(part):
            one = empty_metrics(spark).select("precision", "recall", "f1", "n_samples")
        else:
            one = precision_recall(part).select(
                *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")],
                F.lit(part.count()).cast("long").alias("n_samples"),
            )
        one = one.withColumn("part", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out

"""Working views: transactions, scored transactions and order messages derived
from the `events` and `orders` tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.columns import flagged


# Declared, so that the zone-less `ts` reads as a timestamp of the session's zone and
# conditions on it reach the scan.
EVENTS = (
    "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _props_k():
    return F.get_json_object("props", "$.k").cast("int")


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions: the six message fields, event time as a timestamp."""
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("user_id").cast("string").alias("account_id"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("merchant_category"),
        F.concat(F.lit("L"), (_props_k() % 10).cast("string")).alias("location"),
        F.col("ts").alias("event_time"),
    )


def stand_in_score():
    """A score with one division, equal to the last bit in any engine."""
    return F.least(F.col("amount") / F.lit(200.0), F.lit(1.0))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with the stand-in score, its flag and a label."""
    digit = F.substring("location", 2, 1).cast("int")
    return txn(spark, sf_dir).select(
        "*",
        stand_in_score().alias("fraud_probability"),
        flagged(stand_in_score()).alias("is_flagged"),
        F.col("event_time").alias("scored_at"),
        (digit < F.when(F.col("amount") >= 100, 7).otherwise(1))
        .cast("int")
        .alias("is_fraud"),
    )


def order_msgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order messages in arrival order `seq`, dirtied by rule: bad amounts, bad
    dates, missing ids, and repeats that arrive later with another amount."""
    k = F.col("o_orderkey")

    def money(c):
        return c.cast("decimal(12,2)").cast("string")

    order_id = F.when(k % 29 != 0, F.concat(F.lit("ORD-"), k.cast("string")))
    customer = F.concat(F.lit("CUST-"), F.col("o_custkey").cast("string"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    first = F.struct(
        (k * 2).alias("seq"),
        order_id.alias("order_id"),
        customer.alias("customer_id"),
        F.when(k % 17 == 0, "abc").otherwise(money(F.col("o_totalprice"))).alias("amount"),
        F.when(k % 23 == 0, "bad").otherwise(day).alias("order_date"),
    )
    repeat = F.struct(
        (k * 2 + 1000001).alias("seq"),
        order_id.alias("order_id"),
        customer.alias("customer_id"),
        money(F.col("o_totalprice") + 1).alias("amount"),
        day.alias("order_date"),
    )
    both = F.when(k % 13 == 0, F.array(first, repeat)).otherwise(F.array(first))
    return table(spark, sf_dir, "orders").select(F.explode(both).alias("m")).select("m.*")

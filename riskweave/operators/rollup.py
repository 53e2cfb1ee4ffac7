"""Daily metrics and batch counts over scored transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.schemas import MONEY, MONEY_TOTAL


def filter_day(df: DataFrame, day: str, column: str = "scored_at") -> DataFrame:
    """Rows of one day as a half-open range on the bare column, so scans can prune."""
    start = F.lit(day).cast("date")
    return df.filter(
        (F.col(column) >= start.cast("timestamp"))
        & (F.col(column) < F.date_add(start, 1).cast("timestamp"))
    )


def daily_fraud_metrics(df: DataFrame) -> DataFrame:
    """Transactions, flags, flagged money and mean probability of each scoring day."""
    flagged_money = F.when(F.col("is_flagged") == 1, F.col("amount").try_cast(MONEY))
    return df.groupBy(F.to_date("scored_at").alias("metric_date")).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum("is_flagged").cast("long").alias("flagged_transactions"),
        F.coalesce(F.sum(flagged_money), F.lit(0))
        .cast(MONEY_TOTAL)
        .alias("flagged_amount"),
        F.avg("fraud_probability").alias("avg_fraud_probability"),
    )


# What daily metrics are made of: sums that add up over batches.
PARTIAL_SUMS = [
    "total_transactions",
    "flagged_transactions",
    "flagged_amount",
    "probability_sum",
    "probability_count",
]


def daily_partials(df: DataFrame) -> DataFrame:
    """The sums of each scoring day, which add up over batches."""
    flagged_money = F.when(F.col("is_flagged") == 1, F.col("amount").try_cast(MONEY))
    return df.groupBy(F.to_date("scored_at").alias("metric_date")).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum("is_flagged").cast("long").alias("flagged_transactions"),
        F.sum(flagged_money).alias("flagged_amount"),
        F.sum("fraud_probability").alias("probability_sum"),
        F.count("fraud_probability").alias("probability_count"),
    )


def added_partials(partials: DataFrame) -> DataFrame:
    """The partial sums of each day as one row; it names the newest batch in it."""
    kept = dict(partials.dtypes)
    sums = [F.sum(c).cast(kept[c]).alias(c) for c in PARTIAL_SUMS]
    return partials.groupBy("metric_date").agg(*sums, F.max("batch_id").alias("batch_id"))


def metrics_of_partials(partials: DataFrame) -> DataFrame:
    """Daily metrics from partial sums, as `daily_fraud_metrics` has them from the rows."""
    return partials.groupBy("metric_date").agg(
        F.sum("total_transactions").alias("total_transactions"),
        F.sum("flagged_transactions").alias("flagged_transactions"),
        F.coalesce(F.sum("flagged_amount"), F.lit(0)).cast(MONEY_TOTAL).alias("flagged_amount"),
        F.try_divide(F.sum("probability_sum"), F.sum("probability_count")).alias(
            "avg_fraud_probability"
        ),
    )


def batch_summary(df: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Rows written and rows flagged per batch."""
    return df.groupBy(batch).agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.sum("is_flagged").cast("long").alias("n_flagged"),
    )

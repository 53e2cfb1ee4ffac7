"""Queries: account features, rollups and batch counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.catalog.registry import query, rounded
from riskweave.operators import features, rollup
from riskweave.plans.views import scored, txn

Z, HOURS, LAST_HOUR = features.FEATURES


def features_sql(source: str, by: str = "account_id") -> str:
    """All three features of `source` over the groups `by`."""
    return f"""(
  select *,
    coalesce(round((amount - avg(amount) over (partition by {by}))
      / case when stddev_samp(amount) over (partition by {by}) = 0 then 1
             else stddev_samp(amount) over (partition by {by}) end, 6), 0.0) amount_zscore_for_account,
    coalesce(round((us - lag(us) over (partition by {by} order by us, transaction_id)) / 3.6e9, 6),
             24.0) hours_since_last_txn,
    count(amount) over (partition by {by} order by us range between 3599999999 preceding and 1 preceding)
      + count(amount) over (partition by {by}, us order by transaction_id
          rows between unbounded preceding and current row) txns_last_1h_for_account
  from (select *, epoch_us(event_time) us from {source}))"""


@query(f"select transaction_id, account_id, {Z} from {features_sql('txn')}")
def amount_zscore(spark, sf_dir):
    return rounded(
        features.account_features(txn(spark, sf_dir)).select("transaction_id", "account_id", Z),
        Z,
    )


@query(f"select transaction_id, account_id, {HOURS} from {features_sql('txn')}")
def hours_since_last_txn(spark, sf_dir):
    return rounded(
        features.account_features(txn(spark, sf_dir)).select(
            "transaction_id", "account_id", HOURS
        ),
        HOURS,
    )


@query(f"select transaction_id, account_id, {LAST_HOUR} from {features_sql('txn')}")
def txns_last_1h(spark, sf_dir):
    return features.account_features(txn(spark, sf_dir)).select(
        "transaction_id", "account_id", LAST_HOUR
    )


@query(
    f"select transaction_id, account_id, event_time, {Z}, {HOURS}, {LAST_HOUR}"
    f" from {features_sql('txn')}"
)
def account_features(spark, sf_dir):
    return rounded(
        features.account_features(txn(spark, sf_dir)).select(
            "transaction_id", "account_id", "event_time", *features.FEATURES
        ),
        Z,
        HOURS,
    )


# A third of the rows belong to one account, times are cut to whole hours so that
# many are equal, and some amounts are absent.
SKEWED_SQL = """(
  select transaction_id,
         case when cast(transaction_id as bigint) % 3 = 0 then 'hot' else account_id end account_id,
         case when cast(transaction_id as bigint) % 7 <> 0 then amount end amount,
         date_trunc('hour', event_time) event_time
  from txn)"""


def skewed_rows(rows):
    number = F.col("transaction_id").cast("long")
    return rows.select(
        "transaction_id",
        F.when(number % 3 == 0, "hot").otherwise(F.col("account_id")).alias("account_id"),
        F.when(number % 7 != 0, F.col("amount")).alias("amount"),
        F.date_trunc("hour", "event_time").alias("event_time"),
    )


@query(
    f"select transaction_id, account_id, event_time, {Z}, {HOURS}, {LAST_HOUR}"
    f" from {features_sql(SKEWED_SQL)}"
)
def account_features_hot_account(spark, sf_dir):
    rows = txn(spark, sf_dir)
    skewed = skewed_rows(rows)
    # About twenty slices for the hot account, whatever the scale.
    limit = max(rows.count() // 30, 1)
    return rounded(
        features.account_features(skewed, max_group_rows=limit).select(
            "transaction_id", "account_id", "event_time", *features.FEATURES
        ),
        Z,
        HOURS,
    )


def history_sql(source: str, digits: int = 6) -> str:
    """The score against strictly earlier events, next to the other two features."""
    earlier = (
        "over (partition by account_id order by us, transaction_id"
        " rows between unbounded preceding and 1 preceding)"
    )
    return f"""
select transaction_id, account_id, event_time,
       coalesce(round((amount - avg(amount) {earlier})
         / case when stddev_samp(amount) {earlier} = 0 then 1 else stddev_samp(amount) {earlier} end,
         {digits}), 0.0) {Z}, {HOURS}, {LAST_HOUR}
from {features_sql(source)}"""


@query(history_sql("txn"))
def point_in_time_features(spark, sf_dir):
    return rounded(
        features.point_in_time_features(txn(spark, sf_dir)).select(
            "transaction_id", "account_id", "event_time", *features.FEATURES
        ),
        Z,
        HOURS,
    )


LARGE_SQL = SKEWED_SQL.replace("then amount end amount", "then round(amount) + 1e9 end amount")


@query(history_sql(LARGE_SQL, digits=4))
def point_in_time_features_hot_account(spark, sf_dir):
    """A third of the rows in one account, equal times, and whole amounts near 1e9."""
    rows = txn(spark, sf_dir)
    skewed = skewed_rows(rows).withColumn("amount", F.round("amount") + F.lit(1e9))
    limit = max(rows.count() // 30, 1)
    return rounded(
        rounded(
            features.point_in_time_features(skewed, max_group_rows=limit).select(
                "transaction_id", "account_id", "event_time", *features.FEATURES
            ),
            HOURS,
        ),
        Z,
        digits=4,
    )


@query(
    """
select account_id, round(avg(amount), 6) amount_mean, round(stddev_samp(amount), 6) amount_std
from txn group by account_id
"""
)
def account_amount_stats(spark, sf_dir):
    return rounded(
        features.account_amount_stats(txn(spark, sf_dir)), "amount_mean", "amount_std"
    )


@query(
    "select account_id, event_time, transaction_id, amount, merchant_category, location"
    " from txn order by account_id, event_time, transaction_id"
)
def sort_account_time(spark, sf_dir):
    return features.sort_account_time(
        txn(spark, sf_dir).select(
            "account_id",
            "event_time",
            "transaction_id",
            "amount",
            "merchant_category",
            "location",
        )
    )


DAILY_SQL = """
select cast(cast(scored_at as date) as varchar) metric_date, count(*) total_transactions,
       cast(sum(is_flagged) as bigint) flagged_transactions,
       cast(cast(coalesce(sum(case when is_flagged = 1 then cast(amount as decimal(12,2)) end), 0)
            as decimal(14,2)) as double) flagged_amount,
       round(avg(fraud_probability), 6) avg_fraud_probability
from scored {where} group by 1
"""


@query(DAILY_SQL.format(where=""))
def daily_fraud_metrics(spark, sf_dir):
    return rounded(
        rollup.daily_fraud_metrics(scored(spark, sf_dir)), "avg_fraud_probability"
    )


@query(DAILY_SQL.format(where="where cast(scored_at as date) = date '2024-01-15'"))
def daily_fraud_metrics_one_day(spark, sf_dir):
    day = rollup.filter_day(scored(spark, sf_dir), "2024-01-15")
    return rounded(rollup.daily_fraud_metrics(day), "avg_fraud_probability")


@query(
    """
select cast(transaction_id as bigint) // 1000 batch_id, count(*) n_scored,
       cast(sum(is_flagged) as bigint) n_flagged
from scored group by 1
"""
)
def batch_summary(spark, sf_dir):
    batches = scored(spark, sf_dir).withColumn(
        "batch_id", F.floor(F.col("transaction_id").cast("long") / 1000)
    )
    return rollup.batch_summary(batches)

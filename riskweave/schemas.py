"""Record schemas, table layouts and the fixed values of the package."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values.
FLAG_THRESHOLD = 0.5
FIRST_EVENT_HOURS = 24.0
ROLLING_WINDOW_MICROS = 3_600_000_000
SPLIT_SEED = 42
TRAIN_SHARE = 0.8
MIN_RECALL = 0.75
MIN_PRECISION = 0.60
MAX_MESSAGES = 100_000
TRIGGER_INTERVAL = "10 seconds"
ORDER_FLOW_NAME = "Claims_Delay_Early_Warning_Flow"
NUMERIC_FEATURES = [
    "amount",
    "amount_zscore_for_account",
    "txns_last_1h_for_account",
    "hours_since_last_txn",
]
CATEGORY_FEATURES = ["merchant_category", "location"]

MONEY = T.DecimalType(12, 2)
MONEY_TOTAL = T.DecimalType(14, 2)

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("event_time", T.StringType()),
    ]
)
TRANSACTION_REQUIRED = [
    "transaction_id",
    "account_id",
    "amount",
    "merchant_category",
    "event_time",
]

# Every field is text, so a quoted and a bare number both survive until typing.
ORDER_MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("amount", T.StringType()),
        T.StructField("order_date", T.StringType()),
    ]
)

OPS_COLUMNS = [
    "transaction_id",
    "account_id",
    "amount",
    "merchant_category",
    "location",
    "event_time",
    "fraud_probability",
    "is_flagged",
    "scored_at",
]
LAKE_COLUMNS = OPS_COLUMNS
ANALYTICS_COLUMNS = [c for c in OPS_COLUMNS if c != "event_time"]

# name -> (columns, partition columns)
TABLES = {
    "transactions_scored": (
        "transaction_id STRING, account_id STRING, amount DECIMAL(12,2),"
        " merchant_category STRING, location STRING, event_time TIMESTAMP,"
        " fraud_probability DOUBLE, is_flagged INT, scored_at TIMESTAMP, batch_id BIGINT",
        ["batch_id"],
    ),
    "transactions_scored_history": (
        "transaction_id STRING, account_id STRING, amount DOUBLE,"
        " merchant_category STRING, location STRING, event_time TIMESTAMP,"
        " fraud_probability DOUBLE, is_flagged INT, scored_at TIMESTAMP,"
        " event_date DATE, batch_id BIGINT",
        ["event_date", "batch_id"],
    ),
    "transactions_scored_analytics": (
        "transaction_id STRING, account_id STRING, amount DECIMAL(12,2),"
        " merchant_category STRING, location STRING, fraud_probability DOUBLE,"
        " is_flagged INT, scored_at TIMESTAMP, scored_month STRING, batch_id BIGINT",
        ["scored_month", "batch_id"],
    ),
    "fraud_metrics_daily": (
        "total_transactions BIGINT, flagged_transactions BIGINT,"
        " flagged_amount DECIMAL(14,2), avg_fraud_probability DOUBLE,"
        " metric_date DATE",
        ["metric_date"],
    ),
    "order_summary": (
        "order_id STRING, customer_id STRING, amount DECIMAL(12,2), load_date DATE",
        [],
    ),
}
NOT_NULL = {
    "transactions_scored": [
        "account_id",
        "amount",
        "merchant_category",
        "event_time",
        "fraud_probability",
        "is_flagged",
        "scored_at",
    ],
    "order_summary": [],
}
TABLE_KEYS = {"transactions_scored": "transaction_id", "order_summary": "order_id"}

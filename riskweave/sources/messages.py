"""Message inputs and outputs: transactions from a topic, orders from a queue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.functions.columns import event_time_text, no_nan
from riskweave.schemas import (
    MAX_MESSAGES,
    MONEY,
    ORDER_MESSAGE_SCHEMA,
    TRANSACTION_REQUIRED,
    TRANSACTION_SCHEMA,
)


def transaction_topic(
    spark: SparkSession,
    servers: str,
    topic: str = "transactions",
    starting: str = "latest",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """A stream of the topic's `key` and `value` bytes (needs the Kafka connector)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load()


def order_topic(
    spark: SparkSession, servers: str, topic: str, max_per_trigger: int = MAX_MESSAGES
) -> DataFrame:
    """A stream of queued orders, at most `max_per_trigger` at a time (needs the Kafka
    connector). `seq` is the arrival time, partition and offset tell equal times apart."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", max_per_trigger)
        .load()
        .select(F.unix_micros("timestamp").alias("seq"), "partition", "offset", "value")
    )


def message_files(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """A stream of message lines in `value`, from files that arrive below `path`."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def encode_transactions(df: DataFrame) -> DataFrame:
    """Keyed messages: `key` is the account, `value` the JSON of all columns."""
    fields = [
        event_time_text(c).alias(c) if c == "event_time" else F.col(c) for c in df.columns
    ]
    return df.select(
        F.col("account_id").cast("binary").alias("key"),
        F.to_json(F.struct(*fields)).cast("binary").alias("value"),
    )


def encode_orders(df: DataFrame) -> DataFrame:
    """Plain JSON text messages for the order queue."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def publish_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Keyed messages to a topic (needs the Kafka connector)."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def _as_list(value: Column, schema: T.StructType) -> Column:
    """The JSON objects in a message, NULL if it is anything else.

    Reading the text as a list makes trailing text, nested lists and bare scalars
    fail and shows several objects for what they are; bytes that are not UTF-8 are
    NULL before that.
    """
    text = F.try_validate_utf8(value.cast("string"))
    return F.from_json(F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(schema))


def parse_transactions(df: DataFrame) -> DataFrame:
    """The six message fields from `value`; other fields are dropped, a message
    that does not parse gives NULLs."""
    rest = [c for c in df.columns if c not in ("key", "value")]
    return df.select(
        *rest, F.from_json(F.col("value").cast("string"), TRANSACTION_SCHEMA).alias("_t")
    ).select(*rest, "_t.*")


def read_transactions(df: DataFrame) -> DataFrame:
    """Typed transactions from `value`, with `event_time` as a timestamp.

    `reason` names what is missing in a message that does not parse or lacks a
    field no store can do without, or says that its amount is no sum of money; such a
    message keeps its `value`.
    """
    rest = [c for c in df.columns if c not in ("key", "value")]
    typed = {c: F.col(f"_t.{c}") for c in TRANSACTION_SCHEMA.names} | {
        "amount": no_nan("_t.amount"),
        "event_time": F.try_to_timestamp("_t.event_time"),
    }
    fields = df.select(
        *rest,
        "value",
        F.from_json(F.col("value").cast("string"), TRANSACTION_SCHEMA).alias("_t"),
    ).select(*rest, "value", *[c.alias(n) for n, c in typed.items()])
    missing = [F.when(F.col(c).isNull(), F.lit(c)) for c in TRANSACTION_REQUIRED]
    reason = F.when(
        F.concat_ws("", *missing) != "",
        F.concat(F.lit("missing "), F.concat_ws(",", *missing)),
    ).when(
        # Infinite, or more than the stores' money type holds.
        F.col("amount").try_cast(MONEY).isNull(), F.lit("amount out of range")
    )
    return fields.withColumn("reason", reason).withColumn(
        "value", F.when(F.col("reason").isNotNull(), F.col("value"))
    )


def good_and_bad(read: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of `read_transactions` rows; persist those first, so that each
    message is parsed once."""
    good = read.filter("reason is null").drop("value", "reason")
    bad = read.filter("reason is not null").drop(*TRANSACTION_SCHEMA.names)
    return good, bad


def read_orders(df: DataFrame) -> DataFrame:
    """Order fields and a `status` of good or bad for each message in `value`; a bad
    message keeps its `value`."""
    rest = [c for c in df.columns if c != "value"]
    # Separate steps, so that each message is parsed once.
    parsed = df.select(
        *rest, "value", _as_list(F.col("value"), ORDER_MESSAGE_SCHEMA).alias("_l")
    ).select(*rest, "value", F.when(F.size("_l") == 1, F.col("_l")[0]).alias("_o"))
    bad = F.col("_o").isNull()
    return parsed.select(
        *rest,
        F.when(bad, F.col("value")).alias("value"),
        F.when(bad, "bad").otherwise("good").alias("status"),
        "_o.*",
    )


def split_orders(read: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of `read_orders` rows."""
    good = read.filter("status = 'good'").drop("value", "status")
    bad = read.filter("status = 'bad'").drop("status", *ORDER_MESSAGE_SCHEMA.names)
    return good, bad


def _bound(rows: DataFrame, key: str, low: int, high: int, limit: int) -> tuple[int, int, int]:
    """The value of `key` at the place `limit` in ascending order, how many rows lie below
    it and how many have it; found by counting ranges in 1,000 steps."""
    before = 0
    while True:
        step = max((high - low) // 1000, 1)
        cell = F.expr(f"(`{key}` - {low}L) div {step}L")  # exact, unlike a double quotient
        counts = (
            rows.filter(F.col(key).between(low, high))
            .groupBy(cell.alias("cell"))
            .count()
            .orderBy("cell")
            .collect()
        )
        for r in counts:
            if before + r["count"] >= limit:
                break
            before += r["count"]
        low, high = low + r["cell"] * step, min(high, low + (r["cell"] + 1) * step - 1)
        if step == 1:
            return low, before, r["count"]


def bounded_drain(
    df: DataFrame,
    limit: int = MAX_MESSAGES,
    by: str | Sequence[str] = ("seq", "partition", "offset"),
) -> DataFrame:
    """The first `limit` messages in arrival order: by `seq`, equal ones by partition and
    offset where those columns exist. All are integers; NULLs come last.

    A top-k over the whole backlog would hand `limit` rows per task to a single one.
    Instead the value that ends the wanted rows is looked up column by column, and all
    rows below it are taken as they are. Only messages alike in every column are left to a
    limit, for it makes no difference which of them are taken.
    """
    keys = [by] if isinstance(by, str) else [c for c in by if c in df.columns]
    taken, rest, left = F.lit(False), F.lit(True), limit
    for key in keys:
        rows = df.filter(rest)
        low, high, n = rows.agg(F.min(key), F.max(key), F.count(key)).first()
        if n <= left:
            taken = taken | (rest & F.col(key).isNotNull())
            rest, left = rest & F.col(key).isNull(), left - n
            continue
        value, below, same = _bound(rows, key, low, high, left)
        taken = taken | (rest & F.coalesce(F.col(key) < value, F.lit(False)))
        rest, left = rest & F.col(key).eqNullSafe(F.lit(value)), left - below
        if same == left:
            return df.filter(taken | rest)
    first = df.filter(taken)
    return first.unionAll(df.filter(rest).limit(left)) if left else first


def source_backlog(df: DataFrame) -> DataFrame:
    """How many messages are pending."""
    return df.agg(F.count(F.lit(1)).alias("pending"))

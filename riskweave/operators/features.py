"""Behaviour features of an account's transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.columns import micros, no_nan
from riskweave.operators.moments import moments, sample_deviation
from riskweave.operators.skew import (
    COPY_BLOCK,
    GROUP_ROWS,
    each_copy,
    MAX_HOT_KEYS,
    hot_groups,
    running_totals,
    same_keys,
)
from riskweave.schemas import FIRST_EVENT_HOURS, ROLLING_WINDOW_MICROS
from riskweave.session import written

FEATURES = [
    "amount_zscore_for_account",
    "hours_since_last_txn",
    "txns_last_1h_for_account",
]


def zscore(amount: Column, mean: Column, std: Column) -> Column:
    """Standard score; a zero deviation counts as 1, an undefined result (NULL or NaN, as
    from an infinite amount) as 0."""
    spread = F.when(std == 0, F.lit(1.0)).otherwise(std)
    return F.coalesce(no_nan((amount - mean) / spread), F.lit(0.0))


def hours_between(later: Column, earlier: Column) -> Column:
    return F.coalesce((later - earlier) / F.lit(3.6e9), F.lit(FIRST_EVENT_HOURS))


def _if_timed(count: Column) -> Column:
    return F.when(F.col("_us").isNull(), F.lit(0).cast("long")).otherwise(count)


def account_amount_stats(df: DataFrame, by: Sequence[str] = ("account_id",)) -> DataFrame:
    """Mean and sample standard deviation of the amounts of each account."""
    amount = no_nan("amount")
    return df.groupBy(*by).agg(
        F.avg(amount).alias("amount_mean"), F.stddev_samp(amount).alias("amount_std")
    )


def sort_account_time(df: DataFrame) -> DataFrame:
    """Rows in order of account, event time and id. The last key lets the range
    partitioning separate rows that are equal in all three."""
    return df.orderBy("account_id", "event_time", "transaction_id", F.rand(0))


def account_features(
    df: DataFrame,
    by: Sequence[str] = ("account_id",),
    max_group_rows: int = GROUP_ROWS,
    max_hot_keys: int = MAX_HOT_KEYS,
) -> DataFrame:
    """`df` with the three account features.

    The account's mean and deviation run over all of its rows; the previous event
    and the count over (t - 1h, t] follow event time, ties in order of
    transaction_id, so a row sees of its peers only those before it. A row without
    a time counts nothing and is counted by none. `by` may name further group
    columns, e.g. the batch a row came in.

    Accounts of ordinary size share one shuffle on `by`. Those above
    `max_group_rows` are cut into slices of time instead. They are looked for when
    the frame is built, so `df` cannot be a stream, but may be one of its batches.
    """
    by = list(by)
    hot, hot_rows, small = hot_groups(df, by, max_group_rows, max_hot_keys)
    if hot is None:
        return _by_window(df, by)
    cond = same_keys(df, hot, by)
    rest = _by_window(df.join(hot, cond, "left_anti"), by)
    large = _by_slices(
        df.join(hot, cond, "left_semi"), by, hot_rows, max_group_rows, many=not small
    )
    return rest.unionByName(large)


def _by_window(df: DataFrame, by: list[str]) -> DataFrame:
    whole = Window.partitionBy(*by)
    by_time = whole.orderBy("_us")
    in_order = whole.orderBy("_us", "transaction_id")
    start = Window.unboundedPreceding
    # Both count frames only ever grow, so each row is counted once, however
    # many events an hour holds; a sliding frame would recount it for every row.
    upto = in_order.rowsBetween(start, Window.currentRow)
    expired = by_time.rangeBetween(start, -ROLLING_WINDOW_MICROS)
    amount = F.col("_amount")
    # The finest order comes first: the later windows find the rows sorted.
    return (
        df.withColumns({"_us": micros("event_time"), "_amount": no_nan("amount")})
        .withColumns(
            {
                "_previous": F.lag("_us").over(in_order),
                "_upto": F.count(amount).over(upto),
            }
        )
        .withColumn("_expired", F.count(amount).over(expired))
        .withColumns(
            {
                "_mean": F.avg(amount).over(whole),
                "_std": F.stddev_samp(amount).over(whole),
            }
        )
        .select(
            *df.columns,
            zscore(amount, F.col("_mean"), F.col("_std")).alias(FEATURES[0]),
            hours_between(F.col("_us"), F.col("_previous")).alias(FEATURES[1]),
            _if_timed(F.col("_upto") - F.col("_expired")).alias(FEATURES[2]),
        )
    )


def _by_slices(
    df: DataFrame,
    by: list[str],
    rows: int,
    slice_rows: int,
    copy_block: int = COPY_BLOCK,
    many: bool = False,
) -> DataFrame:
    """The same features as a sweep over time: each event enters the count at its
    own time and leaves it one hour later, ahead of the events at that instant.

    Equal rows, which no order could tell apart, are swept as one with a weight.
    """
    stats = account_amount_stats(df, by)  # one row per hot account
    if not many:
        stats = F.broadcast(stats)
    counted = no_nan("amount").isNotNull().cast("long")
    us, copies = micros("event_time"), F.col("_copies")
    row = F.struct(*df.columns)
    entry = F.struct(
        us.alias("_us"),
        F.lit(1).alias("_enters"),
        F.col("transaction_id").alias("_id"),
        F.xxhash64(*df.columns).alias("_tie"),
        (counted * copies).alias("_step"),
        us.alias("_seen"),
        copies.alias("_copies"),
        row.alias("_row"),
    )
    leaving = F.struct(
        (us + F.lit(ROLLING_WINDOW_MICROS)).alias("_us"),
        F.lit(0).alias("_enters"),
        F.col("transaction_id").alias("_id"),
        F.xxhash64(*df.columns).alias("_tie"),
        (-counted * copies).alias("_step"),
        F.lit(None).cast("long").alias("_seen"),
        F.lit(None).cast("long").alias("_copies"),
        F.lit(None).cast(df.schema).alias("_row"),
    )
    sweep = (
        df.groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .select(*by, F.explode(F.array(entry, leaving)).alias("_e"))
        .select(*by, "_e.*")
    )
    swept = running_totals(
        sweep,
        by,
        ["_us", "_enters", "_id", "_tie"],
        rows=2 * rows,
        sums={"_total": "_step"},
        earlier_max={"_previous": "_seen"},
        slice_rows=slice_rows,
    ).filter("_enters = 1")
    events = each_copy(
        swept.select("_row.*", "_us", "_previous", "_total", "_copies"), rows, copy_block
    )
    first = F.col("_copy") == 1
    later = F.col("_copies") - F.col("_copy")
    timed = events.select(
        *df.columns,
        hours_between(
            F.col("_us"), F.when(first, F.col("_previous")).otherwise(F.col("_us"))
        ).alias(FEATURES[1]),
        _if_timed(F.col("_total") - counted * later).alias(FEATURES[2]),
    )
    joined = timed.join(stats, same_keys(timed, stats, by), "left")
    score = zscore(no_nan(timed["amount"]), stats["amount_mean"], stats["amount_std"])
    return joined.select(
        *[timed[c] for c in df.columns],
        score.alias(FEATURES[0]),
        timed[FEATURES[1]],
        timed[FEATURES[2]],
    )


def point_in_time_features(
    df: DataFrame,
    by: Sequence[str] = ("account_id",),
    max_group_rows: int = GROUP_ROWS,
    max_hot_keys: int = MAX_HOT_KEYS,
) -> DataFrame:
    """`df` with the three account features as they were known when each event came.

    As `account_features`, but mean and deviation run over the account's strictly earlier
    events, ties in order of transaction_id, so no row sees what came after it. With fewer
    than two earlier amounts the score is 0. A row without a time has no history and is in
    none. Deviations are kept as such and merged, never taken from sums of squares, so
    large amounts that lie close together keep their digits.

    Accounts above `max_group_rows` are cut into slices of time; each slice starts from
    the moments of the earlier ones.
    """
    by = list(by)
    hot, hot_rows, _ = hot_groups(df, by, max_group_rows, max_hot_keys)
    if hot is None:
        return _history_by_window(df, by)
    cond = same_keys(df, hot, by)
    rest = _history_by_window(df.join(hot, cond, "left_anti"), by)
    large = _history_by_slices(df.join(hot, cond, "left_semi"), by, hot_rows, max_group_rows)
    return rest.unionByName(large)


def _history_score(amount: Column, history: Column, us: Column) -> Column:
    score = zscore(amount, history["mean"], sample_deviation(history))
    return F.when(us.isNull(), F.lit(0.0)).otherwise(score)


def _timed_amount() -> Column:
    return F.when(F.col("event_time").isNotNull(), no_nan("amount"))


def _history_by_window(df: DataFrame, by: list[str]) -> DataFrame:
    rows = df.withColumn("_timed", _timed_amount())
    order = Window.partitionBy(*by).orderBy(micros("event_time"), "transaction_id")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_history", moments("_timed", earlier))
    return _by_window(rows, by).select(
        *df.columns,
        _history_score(no_nan("amount"), F.col("_history"), F.col("event_time")).alias(FEATURES[0]),
        *FEATURES[1:],
    )


def _history_by_slices(
    df: DataFrame, by: list[str], rows: int, slice_rows: int
) -> DataFrame:
    """The sweep of `_by_slices`, with moments. Rows are numbered, so that equal ones can be
    told apart and none needs a weight."""
    numbered = written(
        df.withColumns({"_row": F.monotonically_increasing_id(), "_us": micros("event_time")}),
        "hot-rows",
    )
    counted = _timed_amount().isNotNull().cast("long")
    late = F.col("_us") + F.lit(ROLLING_WINDOW_MICROS)

    def event(at: Column, enters: int, step: Column, **own: Column) -> Column:
        absent = {"_seen": "long", "_amount": "double", "_held": numbered.select(*df.columns).schema}
        return F.struct(
            at.alias("_at"),
            F.lit(enters).alias("_enters"),
            F.col("transaction_id").alias("_id"),
            F.col("_row").alias("_number"),
            step.alias("_step"),
            *[own.get(n, F.lit(None)).cast(t).alias(n) for n, t in absent.items()],
        )

    entry = event(
        F.col("_us"), 1, counted, _seen=F.col("_us"), _amount=_timed_amount(), _held=F.struct(*df.columns)
    )
    leaving = event(late, 0, -counted)
    sweep = numbered.select(*by, F.explode(F.array(entry, leaving)).alias("_e")).select(*by, "_e.*")
    swept = running_totals(
        sweep,
        by,
        ["_at", "_enters", "_id", "_number"],
        rows=2 * rows,
        sums={"_total": "_step"},
        earlier_max={"_previous": "_seen"},
        earlier_moments={"_history": "_amount"},
        slice_rows=slice_rows,
    ).filter("_enters = 1")
    rows_with = swept.select("_held.*", F.col("_at").alias("_us"), "_previous", "_total", "_history")
    return rows_with.select(
        *df.columns,
        _history_score(no_nan("amount"), F.col("_history"), F.col("_us")).alias(FEATURES[0]),
        hours_between(F.col("_us"), F.col("_previous")).alias(FEATURES[1]),
        _if_timed(F.col("_total")).alias(FEATURES[2]),
    )

"""Account features that live across micro-batches, in keyed state.

An account's state is its moments (count, mean, squared deviations), the latest event time it has
seen (its clock) and the times of the events in the hour before that. An event is compared with all
that arrived before it: by micro-batch, and within one by event time, then transaction_id.
Late events do not turn the clock back, so what is older than the clock's hour is let go for good.

Size of the state: three numbers an account, and the times of its last hour, eight bytes each.
A live stream also lets the times go of accounts that have been silent for an hour.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from riskweave.functions.columns import micros
from riskweave.operators.features import FEATURES
from riskweave.schemas import FIRST_EVENT_HOURS, ROLLING_WINDOW_MICROS

STATE = "n bigint, mean double, m2 double, clock bigint, recent binary"
# Rows without a reason are keyed by their account; those to be quarantined have no state
# and are dealt out evenly.
BAD_BUCKETS = 64
GOOD = -1


@dataclass
class AccountState:
    """What is kept of an account between two micro-batches."""

    n: int = 0
    mean: float = 0.0
    m2: float = 0.0
    clock: int | None = None
    recent: bytes = b""  # times of counted events in the hour up to the clock, in order

    def scores(self, amounts: np.ndarray) -> np.ndarray:
        """Standard scores against all earlier amounts, which each amount then joins."""
        out = np.zeros(len(amounts))
        for i, x in enumerate(amounts.tolist()):
            if x != x:  # no amount
                continue
            if self.n > 1:
                deviation = (self.m2 / (self.n - 1)) ** 0.5
                score = (x - self.mean) / (deviation or 1.0)
                out[i] = score if score == score else 0.0
            self.n += 1
            apart = x - self.mean
            self.mean += apart / self.n
            self.m2 += apart * (x - self.mean)
        return out

    def add(self, us: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The three features of events in order of time, which then count as seen."""
        counted = ~np.isnan(amounts)
        before = np.concatenate([[-1 if self.clock is None else self.clock], us[:-1]])
        if self.clock is not None:
            before = np.maximum(before, self.clock)
        hours = np.maximum(us - before, 0) / 3.6e9
        if self.clock is None:
            hours[0] = FIRST_EVENT_HOURS
        clock = us if self.clock is None else np.maximum(us, self.clock)
        edge = clock - ROLLING_WINDOW_MICROS
        held, times = np.frombuffer(self.recent, "<i8"), us[counted]
        upto = np.cumsum(counted)
        left = np.minimum(np.searchsorted(times, edge, side="right"), upto)
        last_hour = len(held) - np.searchsorted(held, edge, side="right") + upto - left
        scores = self.scores(amounts)
        self.clock = int(clock[-1])
        kept = np.concatenate([held, times])
        self.recent = np.sort(kept[kept > edge[-1]]).astype("<i8").tobytes()
        return scores, hours, last_hour


def _account_features(names: list[str], expires: bool):
    def run(key: tuple, chunks: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            kept = AccountState(*state.get)
            if state.getCurrentProcessingTimeMs() * 1000 - kept.clock >= ROLLING_WINDOW_MICROS:
                kept.recent = b""
            state.update(astuple(kept))
            return
        _, bucket = key
        if bucket != GOOD:
            for rows in chunks:
                yield rows.assign(**dict.fromkeys(FEATURES))[names]
            return
        # An account's rows of one micro-batch; the source's limit bounds them.
        rows = list(chunks)
        rows = rows[0] if len(rows) == 1 else pd.concat(rows)
        us, ids = rows["_us"].to_numpy(np.int64), rows["transaction_id"].tolist()
        order = sorted(range(len(us)), key=list(zip(us.tolist(), ids)).__getitem__)
        taken = {n: rows[n].to_numpy().take(order) for n in {*names, "amount"} - {*FEATURES}}
        account = AccountState(*state.get) if state.exists else AccountState()
        found = account.add(us.take(order), taken["amount"].astype(float))
        state.update(astuple(account))
        if expires:
            state.setTimeoutDuration(ROLLING_WINDOW_MICROS // 1000)
        taken |= zip(FEATURES, found)
        yield pd.DataFrame({n: taken[n] for n in names}, copy=False)

    return run


def _packable(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.StringType, T.TimestampType))


def _packed(fields: list[T.StructField]) -> Column:
    """Texts and times as one array of texts."""
    return F.array(
        *[
            (F.unix_micros(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)).cast("string")
            for f in fields
        ]
    )


def _unpacked(fields: list[T.StructField]) -> dict[str, Column]:
    texts = {f.name: F.get("_packed", F.lit(i)) for i, f in enumerate(fields)}
    return texts | {
        f.name: F.timestamp_micros(texts[f.name].cast("long"))
        for f in fields
        if isinstance(f.dataType, T.TimestampType)
    }


def live_features(read: DataFrame, expires: bool = False) -> DataFrame:
    """A stream of `read_transactions` rows with the account features of the good ones; those of
    the others are NULL.

    The score compares an amount with all earlier ones of its account (0 for fewer than two);
    hours run from the account's clock (0 for a late event); the count is that of the events in the
    hour up to the clock, the event itself included. Bad rows pass through. With `expires`,
    accounts silent for an hour by the wall clock, whose events are older than that, let go of
    their times: for streams that keep up with their events, not for those that catch up.
    """
    bad = F.pmod(F.xxhash64("value"), F.lit(BAD_BUCKETS)).cast("int")
    # What only passes through goes as one column: each column of a group, that is of an account in
    # a micro-batch, costs as much as some hundred rows on its way to Python and back.
    texts = [f for f in read.schema if _packable(f)]
    others = [f for f in read.schema if not _packable(f)]
    keyed = read.select(
        _packed(texts).alias("_packed"),
        *[f.name for f in others],
        "transaction_id",
        "account_id",
        micros("event_time").alias("_us"),
        F.when(F.col("reason").isNull(), F.lit(GOOD)).otherwise(bad).alias("_bucket"),
    )
    kinds = (T.DoubleType(), T.DoubleType(), T.LongType())
    packed = T.StructField("_packed", T.ArrayType(T.StringType()))
    schema = T.StructType([packed, *others, *map(T.StructField, FEATURES, kinds)])
    timeout = GroupStateTimeout.ProcessingTimeTimeout if expires else GroupStateTimeout.NoTimeout
    found = keyed.groupBy("account_id", "_bucket").applyInPandasWithState(
        _account_features(schema.names, expires), schema, STATE, "append", timeout
    )
    columns = {f.name: F.col(f.name) for f in others} | _unpacked(texts)
    return found.select(*[columns[n].alias(n) for n in read.columns], *FEATURES)

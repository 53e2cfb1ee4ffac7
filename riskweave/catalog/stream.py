"""Queries: the streaming scorer. Messages arrive in three parts, each taken up by a
restarted stream on the same checkpoint."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from riskweave.catalog.features import HOURS, LAST_HOUR, Z, features_sql
from riskweave.catalog.registry import query, rounded
from riskweave.catalog.training import stand_in_model
from riskweave.operators.features import FEATURES
from riskweave.operators.metrics import precision_recall
from riskweave.plans.model import ModelRegistry
from riskweave.plans.views import scored, txn
from riskweave.session import scratch
from riskweave.sinks.stores import table_stores
from riskweave.sources.messages import (
    encode_transactions,
    message_files,
    parse_transactions,
    read_transactions,
)
from riskweave.streaming.backlog import file_backlog
from riskweave.streaming.features import live_features
from riskweave.streaming.scorer import start_scoring

PARTS = 3


def feature_model() -> PipelineModel:
    """A stand-in model whose score depends on the amount and all three features. Its limits are
    compared with features of six digits: the digits after those depend on the order of sums."""
    return PipelineModel(
        stages=[
            SQLTransformer(
                statement="""
SELECT *, least(amount / 200.0D + 0.05D * (txns_last_1h_for_account - 1)
    + CASE WHEN round(hours_since_last_txn, 6) < 2.0D THEN 0.02D ELSE 0.0D END
    + CASE WHEN round(amount_zscore_for_account, 6) > 1.5D THEN 0.03D ELSE 0.0D END, 1.0D) AS fraud_probability
FROM __THIS__"""
            )
        ]
    )


def _deliver(rows, path: str) -> None:
    encode_transactions(rows).select(F.col("value").cast("string")).write.mode("append").text(
        path
    )


def _part(rows, i: int):
    return rows.filter(F.col("transaction_id").cast("long") % PARTS == i)


def _run(spark, root: str, model, stores, live: bool = False) -> None:
    start_scoring(
        message_files(spark, f"{root}/in"),
        model,
        stores,
        f"{root}/checkpoint",
        available_now=True,
        live=live,
        quarantine=f"{root}/rejected",
        scored_at=lambda df: df.withColumn("scored_at", F.col("event_time")),
    ).awaitTermination()


BATCHES_SQL = f"(select *, cast(transaction_id as bigint) % {PARTS} as batch from txn)"


@query(
    f"""
select transaction_id, batch as batch_id, round(p, 6) fraud_probability,
       cast(case when p >= 0.5 then 1 else 0 end as bigint) is_flagged, scored_at
from (select transaction_id, batch, event_time scored_at,
             least(cast(amount / 200.0 as double)
               + cast(0.05 as double) * (txns_last_1h_for_account - 1)
               + case when hours_since_last_txn < 2 then cast(0.02 as double) else 0 end
               + case when amount_zscore_for_account > 1.5 then cast(0.03 as double) else 0 end, 1.0) p
      from {features_sql(BATCHES_SQL, "batch, account_id")})
"""
)
def stream_score(spark, sf_dir):
    root = scratch(spark, "scorer")
    stores = table_stores(f"{root}/stores")
    model = feature_model()
    rows = txn(spark, sf_dir)
    # Amounts that no store can hold must neither stop the stream nor touch other rows.
    odd = rows.withColumns(
        {
            "transaction_id": F.concat(F.lit("odd-"), "transaction_id"),
            "amount": F.when(F.col("transaction_id").cast("long") % 2 == 0, F.lit(1e11)).otherwise(
                F.lit(float("inf"))
            ),
        }
    )
    for i in range(PARTS):
        some = odd.filter(F.substring("transaction_id", 5, 20).cast("long") % (10 * PARTS) == i)
        _deliver(_part(rows, i).unionByName(some), f"{root}/in")
        _run(spark, root, lambda: ("stand-in", model), stores)
    return (
        stores[1]
        .read(spark)
        .select(
            "transaction_id",
            "batch_id",
            F.round("fraud_probability", 6).alias("fraud_probability"),
            "is_flagged",
            "scored_at",
        )
    )


# What each event sees of its account: all that arrived before it, by batch, time and id. The
# account's clock is the latest time it has seen.
LIVE_SQL = f"""(
  select e.transaction_id, any_value(e.account_id) account_id, any_value(e.batch) batch,
         any_value(e.amount) amount, any_value(e.event_time) event_time, any_value(e.z) {Z},
         any_value(e.h) {HOURS},
         count(o.amount) filter (where (o.batch, o.us, o.transaction_id) <= (e.batch, e.us, e.transaction_id)
                                 and o.us > e.clock - 3600000000) {LAST_HOUR}
  from (select *,
          coalesce(round((amount - avg(amount) over earlier)
            / case when stddev_samp(amount) over earlier = 0 then 1 else stddev_samp(amount) over earlier end, 6),
            0.0) z,
          case when max(us) over earlier is null then 24.0
               else round(greatest(us - max(us) over earlier, 0) / 3.6e9, 6) end h,
          greatest(us, coalesce(max(us) over earlier, us)) clock
        from (select *, epoch_us(event_time) us, cast(transaction_id as bigint) % {PARTS} batch from txn)
        window earlier as (partition by account_id order by batch, us, transaction_id
                           rows between unbounded preceding and 1 preceding)) e
  join (select *, epoch_us(event_time) us, cast(transaction_id as bigint) % {PARTS} batch from txn) o
    on o.account_id = e.account_id
  group by e.transaction_id)"""


@query(f"select transaction_id, account_id, {Z}, {HOURS}, {LAST_HOUR} from {LIVE_SQL}")
def stream_live_features(spark, sf_dir):
    """Features kept in state over three runs on one checkpoint."""
    root = scratch(spark, "live")
    rows = txn(spark, sf_dir)
    for i in range(PARTS):
        _deliver(_part(rows, i), f"{root}/in")
        (
            live_features(read_transactions(message_files(spark, f"{root}/in")))
            .writeStream.format("parquet")
            .option("checkpointLocation", f"{root}/checkpoint")
            .option("path", f"{root}/out")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    return rounded(
        spark.read.parquet(f"{root}/out").select(
            "transaction_id", "account_id", *FEATURES
        ),
        Z,
        HOURS,
    )


@query(
    f"""
select transaction_id, batch as batch_id, round(p, 6) fraud_probability,
       cast(case when p >= 0.5 then 1 else 0 end as bigint) is_flagged
from (select transaction_id, batch,
             least(cast(amount / 200.0 as double)
               + cast(0.05 as double) * ({LAST_HOUR} - 1)
               + case when {HOURS} < 2 then cast(0.02 as double) else 0 end
               + case when {Z} > 1.5 then cast(0.03 as double) else 0 end, 1.0) p
      from {LIVE_SQL})
"""
)
def stream_score_live(spark, sf_dir):
    """The scorer with features that live across its micro-batches."""
    root = scratch(spark, "live-scorer")
    stores = table_stores(f"{root}/stores")
    model = feature_model()
    rows = txn(spark, sf_dir)
    for i in range(PARTS):
        _deliver(_part(rows, i), f"{root}/in")
        _run(spark, root, lambda: ("stand-in", model), stores, live=True)
    return (
        stores[0]
        .read(spark)
        .select(
            "transaction_id",
            "batch_id",
            F.round("fraud_probability", 6).alias("fraud_probability"),
            "is_flagged",
        )
    )


@query("select transaction_id, account_id, amount from txn")
def stream_trigger_checkpoint(spark, sf_dir):
    root = scratch(spark, "restart")
    rows = txn(spark, sf_dir)
    for i in range(PARTS):
        _deliver(_part(rows, i), f"{root}/in")
        (
            parse_transactions(message_files(spark, f"{root}/in"))
            .writeStream.format("parquet")
            .option("checkpointLocation", f"{root}/checkpoint")
            .option("path", f"{root}/out")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    return spark.read.parquet(f"{root}/out").select("transaction_id", "account_id", "amount")


@query(
    f"""
select transaction_id,
       least(amount / case when cast(transaction_id as bigint) % {PARTS} = 0 then 200.0 else 400.0 end, 1.0)
         as fraud_probability
from txn
"""
)
def model_hot_swap(spark, sf_dir):
    root = scratch(spark, "swap")
    stores = table_stores(f"{root}/stores")
    registry = ModelRegistry(spark, f"{root}/model")
    rows = txn(spark, sf_dir)
    measured = precision_recall(scored(spark, sf_dir))
    for i, scale in [(0, 200.0), (1, 400.0), (2, 400.0)]:
        if i < 2:
            registry.save_candidate(stand_in_model(scale), f"v{i}")
            registry.promote(f"v{i}", measured, 0.25, 0.25)
        _deliver(_part(rows, i), f"{root}/in")
        _run(spark, root, registry.current, stores)
    return stores[1].read(spark).select("transaction_id", "fraud_probability")


@dataclass(frozen=True)
class FailsOnce:
    """A store whose first write fails after the stores before it have taken the batch."""

    store: object
    failed: list

    def write(self, scored, batch_id):
        if not self.failed:
            self.failed.append(batch_id)
            raise OSError("the store is down")
        self.store.write(scored, batch_id)


@query(
    """
select s.name, count(*) n_rows, count(distinct transaction_id) n_ids, cast(1 as bigint) n_times
from txn, (values ('transactions_scored'), ('transactions_scored_history'),
                  ('transactions_scored_analytics')) as s(name)
group by s.name
"""
)
def replay_scoring_time(spark, sf_dir):
    root = scratch(spark, "replayed")
    stores = table_stores(f"{root}/stores")
    targets = [*stores[:2], FailsOnce(stores[2], [])]
    _deliver(txn(spark, sf_dir), f"{root}/in")
    model = feature_model()
    for _ in (1, 2):  # the batch is tried again by the restarted stream
        try:
            start_scoring(
                message_files(spark, f"{root}/in"),
                lambda: ("stand-in", model),
                targets,
                f"{root}/checkpoint",
                available_now=True,
            ).awaitTermination()
        except StreamingQueryException:
            pass
    out = None
    for store in stores:
        one = store.read(spark).agg(
            F.count("*").alias("n_rows"),
            F.count_distinct("transaction_id").alias("n_ids"),
            F.count_distinct("scored_at").alias("n_times"),
        ).select(F.lit(store.path.rsplit("/", 1)[1]).alias("name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    f"select transaction_id, cast(transaction_id as bigint) % {PARTS} % 2 as batch_id from txn",
)
def stream_new_checkpoint(spark, sf_dir):
    """A scorer that starts anew on another checkpoint counts its batches from 0 again; none
    takes the place of an earlier stream's, closed or open."""
    root = scratch(spark, "anew")
    store = table_stores(f"{root}/stores")[0]
    model = feature_model()
    rows = txn(spark, sf_dir)
    for i in range(PARTS):  # two runs on the first checkpoint, one on the second
        run = f"{root}/{i // 2}"
        _deliver(_part(rows, i), f"{run}/in")
        _run(spark, run, lambda: ("stand-in", model), [store])
        store.compact(spark)
    return store.read(spark).select("transaction_id", "batch_id")


@query(
    f"""
select part as after_part, (select count(*) from txn where cast(transaction_id as bigint) % {PARTS} <= part)
       - coalesce((select count(*) from txn where cast(transaction_id as bigint) % {PARTS} < part and part > 1), 0) pending,
       0 left_behind
from range({PARTS}) t(part)
"""
)
def stream_backlog(spark, sf_dir):
    """What a stopped stream has before it, from its checkpoint: two parts before its first
    run, one part before each run after it; and after the runs."""
    root = scratch(spark, "backlog")
    rows = txn(spark, sf_dir)
    store = table_stores(f"{root}/stores")[:1]
    model = feature_model()
    out = None
    for i in range(PARTS):
        _deliver(_part(rows, i), f"{root}/in")
        before = file_backlog(spark, f"{root}/in", f"{root}/checkpoint").first()["pending"]
        if i:
            _run(spark, root, lambda: ("stand-in", model), store)
        after = file_backlog(spark, f"{root}/in", f"{root}/checkpoint").first()["pending"]
        left = after if i else 0
        one = spark.range(1).select(
            F.lit(i).alias("after_part"), F.lit(before).alias("pending"), F.lit(left).alias("left_behind")
        )
        out = one if out is None else out.unionByName(one)
    return out

"""The register of queries and the views their SQL starts from."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

VIEWS = """
with txn as (
  select cast(event_id as varchar) transaction_id, cast(user_id as varchar) account_id,
         value amount, event_type merchant_category,
         'L' || cast(cast(json_extract_string(props, '$.k') as integer) % 10 as varchar) as location,
         ts event_time
  from events),
scored as (
  select *, least(amount / 200.0, 1.0) fraud_probability,
         case when least(amount / 200.0, 1.0) >= 0.5 then 1 else 0 end is_flagged,
         event_time scored_at,
         case when cast(substr(location, 2, 1) as integer)
                   < case when amount >= 100 then 7 else 1 end then 1 else 0 end is_fraud
  from txn),
order_rows as (
  select o_orderkey k, concat('ORD-', cast(o_orderkey as varchar)) oid,
         concat('CUST-', cast(o_custkey as varchar)) cid, o_totalprice amt,
         substr(cast(o_orderdate as varchar), 1, 10) od
  from orders),
order_msgs as (
  select k * 2 seq, case when k % 29 = 0 then null else oid end order_id, cid customer_id,
         case when k % 17 = 0 then 'abc'
              else cast(cast(amt as decimal(12,2)) as varchar) end amount,
         case when k % 23 = 0 then 'bad' else od end order_date
  from order_rows
  union all
  select k * 2 + 1000001, case when k % 29 = 0 then null else oid end, cid,
         cast(cast(amt + 1 as decimal(12,2)) as varchar), od
  from order_rows where k % 13 = 0),
first_orders as (
  select * from (select *, row_number() over (partition by order_id order by seq) rn
                 from order_msgs) where rn = 1)
"""


def plain(df: DataFrame) -> DataFrame:
    """Types that compare alike in any engine: wide integers, doubles for decimals,
    text for dates, zone-less timestamps."""
    changed = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            changed[f.name] = F.col(f.name).cast("long")
        elif isinstance(f.dataType, T.DecimalType):
            changed[f.name] = F.col(f.name).cast("double")
        elif isinstance(f.dataType, T.DateType):
            changed[f.name] = F.col(f.name).cast("string")
        elif isinstance(f.dataType, T.TimestampType):
            changed[f.name] = F.col(f.name).cast("timestamp_ntz")
    return df.withColumns(changed) if changed else df


def query(sql: str | None = None, name: str | None = None):
    """Registers a query under its function's name or `name`, with its SQL (after VIEWS)."""

    def register(f):
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return plain(f(spark, sf_dir))

        key = name or f.__name__
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = f"{VIEWS}{sql}"
        return run

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})

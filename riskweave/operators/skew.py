"""Running aggregates and group sizes that stay balanced when one group is huge."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.operators.moments import merged, moments as moments_of, none, of_earlier_parts
from riskweave.session import written

# One task sorts at most about this many rows of one group.
GROUP_ROWS = 5_000_000
# So many hot keys at most are broadcast.
MAX_HOT_KEYS = 100_000
# Carried totals are broadcast, one row per slice at most; beyond this number of
# slices the slices grow instead.
MAX_SLICES = 20_000
# A row repeated more often than this is handed out to several tasks.
COPY_BLOCK = 1_000_000


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality on `keys` under which NULL equals NULL."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def hot_groups(
    df: DataFrame,
    keys: Sequence[str],
    limit: int = GROUP_ROWS,
    max_keys: int = MAX_HOT_KEYS,
) -> tuple[DataFrame | None, int, bool]:
    """The groups with more than `limit` rows (None if there are none), their row total,
    and whether they are few enough for a broadcast.

    One aggregate over the key columns alone, combined before the shuffle. Up to
    `max_keys` hot groups are broadcast; more are kept as a table for an ordinary join.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    hot = written(sizes.filter(F.col("_rows") > limit), "hot-groups")
    n, total = hot.agg(F.count(F.lit(1)), F.sum("_rows")).first()
    if not n:
        return None, 0, True
    small = n <= max_keys
    found = hot.select(*keys)
    return F.broadcast(found) if small else found, total, small


def running_totals(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    rows: int,
    sums: Mapping[str, str] | None = None,
    earlier_max: Mapping[str, str] | None = None,
    slice_rows: int = GROUP_ROWS,
    earlier_moments: Mapping[str, str] | None = None,
) -> DataFrame:
    """Running aggregates of every row within its group, in ascending `order`.

    `sums` maps a new column to the column whose running sum (own row included)
    it holds, `earlier_max` to the column whose maximum over strictly earlier
    rows it holds, `earlier_moments` to that whose moments over strictly earlier rows it
    holds (`moments.TYPE`). `rows` is the row count of `df`, which the caller knows.

    Beyond `slice_rows` the sorted sequence is cut by range partitioning into
    slices, whatever group they belong to, and each slice starts from the totals
    of the earlier slices of its group. A slice opens with at most one group
    begun before it, so the carried totals have fewer rows than there are slices
    and can be broadcast. `order` should tell rows apart: rows alike in all of it
    cannot be separated by sorting.
    """
    sums, earlier_max = dict(sums or {}), dict(earlier_max or {})
    earlier_moments = dict(earlier_moments or {})
    slices = min(math.ceil(rows / slice_rows), MAX_SLICES)
    if slices <= 1:
        upto, before = _frames(groups, order)
        return df.select(
            "*",
            *[F.sum(c).over(upto).alias(n) for n, c in sums.items()],
            *[F.max(c).over(before).alias(n) for n, c in earlier_max.items()],
            *[moments_of(c, before).alias(n) for n, c in earlier_moments.items()],
        )

    # The slice number must never change once taken, hence the written table.
    sliced = written(
        df.repartitionByRange(slices, *groups, *order).withColumn(
            "_slice", F.spark_partition_id()
        ),
        "slices",
    )
    own = sliced.groupBy(*groups, "_slice").agg(
        *[F.sum(c).alias(n) for n, c in sums.items()],
        *[F.max(c).alias(n) for n, c in earlier_max.items()],
        *[moments_of(c).alias(n) for n, c in earlier_moments.items()],
    )
    if earlier_moments:
        own = written(own, "slice-totals")
    _, previous = _frames(groups, ["_slice"])
    carried = (
        own.select(
            *groups,
            "_slice",
            F.count(F.lit(1)).over(previous).alias("_behind"),
            *[F.sum(n).over(previous).alias(f"_{n}") for n in sums],
            *[F.max(n).over(previous).alias(f"_{n}") for n in earlier_max],
        )
        .filter("_behind > 0")
        .drop("_behind")
    )
    keys = ["_slice", *groups]
    if earlier_moments:
        folded = of_earlier_parts(own, groups, "_slice", list(earlier_moments))
        folded = folded.withColumnsRenamed({n: f"_{n}" for n in earlier_moments})
        carried = carried.join(folded, same_keys(carried, folded, keys)).select(
            *[carried[c] for c in carried.columns], *[folded[f"_{n}"] for n in earlier_moments]
        )
    upto, before = _frames(keys, order)
    inside = sliced.select(
        "*",
        *[F.sum(c).over(upto).alias(n) for n, c in sums.items()],
        *[F.max(c).over(before).alias(n) for n, c in earlier_max.items()],
        *[moments_of(c, before).alias(n) for n, c in earlier_moments.items()],
    )
    joined = inside.join(F.broadcast(carried), same_keys(inside, carried, keys), "left")
    return joined.select(
        *[inside[c] for c in df.columns],
        *[
            (inside[n] + F.coalesce(carried[f"_{n}"], F.lit(0))).alias(n)
            for n in sums
        ],
        *[F.greatest(inside[n], carried[f"_{n}"]).alias(n) for n in earlier_max],
        *[
            merged(F.coalesce(carried[f"_{n}"], none()), inside[n]).alias(n)
            for n in earlier_moments
        ],
    )


def each_copy(df: DataFrame, rows: int, block: int = COPY_BLOCK) -> DataFrame:
    """One row per copy, numbered from 1 in `_copy`, of rows that stand for `_copies`
    equal ones; `rows` bounds the total."""
    copies = F.col("_copies")
    few = df.filter(copies <= block).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("long"), copies))
    )
    if rows <= block:
        return few
    first = F.lit(1).cast("long")
    last = F.least(F.col("_from") + F.lit(block - 1), copies)
    many = (
        df.filter(copies > block)
        .withColumn("_from", F.explode(F.sequence(first, copies, F.lit(block).cast("long"))))
        .repartition(min(math.ceil(rows / block), MAX_SLICES))
        .withColumn("_copy", F.explode(F.sequence(F.col("_from"), last)))
        .drop("_from")
    )
    return few.unionByName(many)


def _frames(groups: Sequence[str], order: Sequence[str]):
    w = Window.partitionBy(*(groups or [F.lit(0)])).orderBy(*order)
    start = Window.unboundedPreceding
    return w.rowsBetween(start, Window.currentRow), w.rowsBetween(start, -1)

"""Moments (count, mean, sum of squared deviations) that can be merged.

Sums of squares lose all digits where amounts are large and close together; deviations from
the mean of their own part do not, and two parts merge without going back to the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

TYPE = "struct<n: bigint, mean: double, m2: double>"


def _moments(n: Column, mean: Column, m2: Column) -> Column:
    zero = F.lit(0.0)
    return F.struct(
        F.coalesce(n, F.lit(0).cast("long")).alias("n"),
        F.coalesce(mean, zero).alias("mean"),
        F.coalesce(m2, zero).alias("m2"),
    )


def none() -> Column:
    return _moments(*[F.lit(None).cast(t) for t in ("long", "double", "double")])


def moments(value: str, over: WindowSpec | None = None) -> Column:
    """Of the values in a group, or in a frame of a window."""

    def of(c: Column) -> Column:
        return c if over is None else c.over(over)

    return _moments(
        of(F.count(value)), of(F.avg(value)), of(F.var_pop(value)) * of(F.count(value))
    )


def merged(a: Column, b: Column) -> Column:
    """Of both parts together."""
    n = a["n"] + b["n"]
    apart = b["mean"] - a["mean"]
    both = F.struct(
        n.alias("n"),
        (a["mean"] + apart * (b["n"] / n)).alias("mean"),
        (a["m2"] + b["m2"] + apart * apart * (a["n"] * (b["n"] / n))).alias("m2"),
    )
    return F.when(b["n"] == 0, a).when(a["n"] == 0, b).otherwise(both)


def sample_deviation(of: Column) -> Column:
    """NULL for fewer than two values."""
    return F.when(of["n"] > 1, F.sqrt(of["m2"] / (of["n"] - 1)))


def of_earlier_parts(parts: DataFrame, groups: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """For each part of a group the moments of all earlier parts of it, in the same columns.

    `parts` has one row per group and part. They are few, as those that ask for this bound
    them; a group's parts are folded in one row.
    """
    held = F.array_sort(F.collect_list(F.struct(order, *columns)))

    def step(done: Column, part: Column) -> Column:
        last = F.element_at(done, -1)
        return F.concat(
            done, F.array(F.struct(*[merged(last[c], part[c]).alias(c) for c in columns]))
        )

    start = F.array(F.struct(*[none().alias(c) for c in columns]))
    before = F.aggregate("_parts", start, step)
    placed = F.arrays_zip(F.col("_parts").alias("part"), before.alias("before"))
    return (
        parts.groupBy(*groups)
        .agg(held.alias("_parts"))
        .select(*groups, F.explode(placed).alias("_z"))
        .filter("_z.part is not null")  # behind the last part there is none
        .select(
            *groups,
            F.col("_z.part")[order].alias(order),
            *[F.col("_z.before")[c].alias(c) for c in columns],
        )
    )

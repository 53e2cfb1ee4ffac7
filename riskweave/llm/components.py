"""Connected components, and groups of rows cut into blocks that are compared in pairs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.session import written


def local_labels(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For nodes 0 to n - 1 the smallest node each is connected with by the given links."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def block_pairs(rows: DataFrame, group: str, member: str, block_rows: int) -> DataFrame:
    """Rows of groups with two members at least, once for each pair of blocks they belong to.

    A group of up to `block_rows` rows is one block. A larger one is cut by a hash of
    `member`, and a row goes to every pair of blocks that has its own: all pairs of rows
    meet, in tasks of at most about two blocks. Adds _i and _j, the blocks (i <= j), and
    _own, the block of the row.
    """
    sizes = (
        rows.groupBy(group)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .select(group, F.ceil(F.col("_n") / F.lit(block_rows)).cast("int").alias("_blocks"))
    )
    own = F.pmod(F.xxhash64(F.lit(7), member), F.col("_blocks")).cast("int")
    return (
        rows.join(sizes, group)
        .withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("_i", F.least("_own", "_other"))
        .withColumn("_j", F.greatest("_own", "_other"))
        .drop("_blocks", "_other")
    )


def components(edges: DataFrame) -> DataFrame:
    """node and component, the smallest node reachable, for every node of `edges` (a, b).

    Large-star and small-star turns: each node hands its larger neighbours, then its
    smaller ones, to the smallest it knows, until every component is a star. Each turn is
    written to the shared folder; nothing but counts reaches the driver.
    """
    edges = written(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    seen = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.filter("b > a")
            .join(least, "a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        small_least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            down.join(small_least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a <> b")
            .unionAll(small_least.select("a", F.col("m").alias("b")))
            .distinct()
        )
        edges = written(small, "edges")
        state = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if state == seen:
            break
        seen = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )

"""Uniform shuffle into shards of exact size, by a drawn communication matrix.

1. Rows lie in blocks by a hash of their key, and each block's rows are counted.
2. How many rows each block sends to each shard is drawn from the multivariate
   hypergeometric law: the matrix a uniformly random permutation of all rows would give.
   Its column sums are the shard sizes, which differ by one at most.
3. Within its block a row's place is that of a seeded hash (the local permutation).
   The matrix cuts this order into runs, one for each shard; the cuts are found as hash
   values on the key column alone, so texts are not moved for it.
4. Rows go to their shard, in pieces by the leading bits of a second hash, and are
   permuted again by it; with the counts of the pieces, slots are gapless.

Defined results: texts that are NULL have size 1 and checksum 0. Rows that repeat a
doc_id (or have none) get a row number first, written to the shared folder, so that no
two rows share a hash order.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import parallelism
from riskweave.session import written

BLOCK_ROWS = 1_000_000  # rows of a block; the matrix has a row for each block
MAX_BLOCKS = 4096  # beyond it blocks grow, so that the matrix stays small


def communication_matrix(block_rows: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows each block sends to each shard, as a uniform permutation would have it."""
    rng = np.random.default_rng(seed)
    total = sum(block_rows)
    left = np.array([total // shards + (s < total % shards) for s in range(shards)], np.int64)
    out = np.zeros((len(block_rows), shards), np.int64)
    for b, n in enumerate(block_rows):
        out[b] = rng.multivariate_hypergeometric(left, n, method="marginals")
        left -= out[b]
    return out


def shuffle_into_shards(docs: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """All columns of `docs`, shard (0 to shards - 1) and slot (gapless from 0 in its shard).

    Partitions hold whole pieces of shards in slot order. Columns of `docs` named shard or
    slot are replaced.
    """
    docs = docs.drop("shard", "slot")
    spark = docs.sparkSession
    rows = docs.count()
    blocks = int(min(MAX_BLOCKS, max(16, rows // BLOCK_ROWS)))
    repeated = docs.groupBy("doc_id").count().filter((F.col("count") > 1) | F.col("doc_id").isNull())
    if repeated.isEmpty():
        keyed = docs.withColumn("_key", F.xxhash64(F.lit(seed), F.col("doc_id")))
    else:
        numbered = written(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
        keyed = numbered.withColumn("_key", F.xxhash64(F.lit(seed), F.col("_row"))).drop("_row")
    # xxhash64 of one long maps different longs to different hashes.
    keyed = keyed.withColumn("_block", F.pmod(F.xxhash64(F.lit(1), "_key"), F.lit(blocks)).cast("int"))
    keys = keyed.select("_block", "_key")

    counts = {r["_block"]: r["count"] for r in keys.groupBy("_block").count().collect()}
    matrix = communication_matrix([counts.get(b, 0) for b in range(blocks)], shards, seed)
    ends = np.cumsum(matrix, axis=1)
    places = sorted({(b, int(e)) for b in range(blocks) for e in ends[b] if e})
    place = F.row_number().over(Window.partitionBy("_block").orderBy("_key"))
    last = (  # the hash at the end of each run
        keys.withColumn("_place", place)
        .join(
            F.broadcast(spark.createDataFrame(places or [(0, 0)], "_block int, _place int")),
            ["_block", "_place"],
        )
        .collect()
    )
    value = {(r["_block"], r["_place"]): r["_key"] for r in last}
    cuts = [
        # A shard's run ends at the hash; a shard without rows ends where the one before does.
        (b, [value.get((b, int(e)), -(2**63)) for e in ends[b][:-1]])
        for b in range(blocks)
    ]
    cut = F.broadcast(spark.createDataFrame(cuts, "_block int, _cuts array<bigint>"))
    key = F.col("_key")
    placed = (
        keyed.join(cut, "_block")
        .withColumn("shard", F.size(F.filter("_cuts", lambda c: c < key)))
        .withColumn("_order", F.xxhash64(F.lit(2), "_key"))
        .drop("_cuts", "_block")
    )
    pieces = max(1, -(-4 * parallelism(spark) // shards))
    placed = placed.withColumn(
        "_piece", F.pmod(F.shiftright("_order", 32), F.lit(pieces)).cast("int")
    )
    sizes = placed.select("shard", "_piece").groupBy("shard", "_piece").count()
    before = Window.partitionBy("shard").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "shard", "_piece", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before")
    ).collect()  # shards x pieces rows
    offset = spark.createDataFrame(offsets, "shard int, _piece int, _before bigint")
    within = Window.partitionBy("shard", "_piece").orderBy("_order", "_key")
    return (
        placed.withColumn("_place", F.row_number().over(within) - 1)
        .join(F.broadcast(offset), ["shard", "_piece"])
        .withColumn("slot", F.col("_before") + F.col("_place"))
        .select(*docs.columns, "shard", "slot")
    )


def sharded(docs: DataFrame, shards: int = 8, seed: int = 0) -> DataFrame:
    """doc_id, text, size (UTF-8 bytes and one), shard and slot of every row of `docs`."""
    rows = docs.select(
        "doc_id",
        "text",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
    )
    return shuffle_into_shards(rows, shards, seed)

"""Reproducible train/test splits by hash of the row id."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.columns import split_hash
from riskweave.schemas import SPLIT_SEED, TRAIN_SHARE

MAX_CLASSES = 100  # up to which class ends are written into the plan


def random_split(
    df: DataFrame,
    id_column: str = "transaction_id",
    share: float = TRAIN_SHARE,
    seed: int = SPLIT_SEED,
) -> DataFrame:
    """`df` with `split`: train below the share's place in the hash range. No shuffle."""
    place = F.conv(F.substring(split_hash(id_column, seed), 1, 8), 16, 10).cast("long")
    train = place < F.lit(int(Decimal(str(share)) * 16**8))
    return df.withColumn("split", F.when(train, "train").otherwise("test"))


def stratified_split(
    df: DataFrame,
    label: str = "is_fraud",
    id_column: str = "transaction_id",
    share: float = TRAIN_SHARE,
    seed: int = SPLIT_SEED,
) -> DataFrame:
    """`df` with `split`: within each class the ceil(share * n) lowest hashes train.

    Instead of ranking the rows, which would sort every class in one task, the
    hash that ends the training side is looked up: rows are counted by the first
    four hex digits, and only the cell the end falls into is resolved further.
    Rows with one id share a hash and stay on one side.
    """
    hashed = df.select(F.col(label).alias("_y"), split_hash(id_column, seed).alias("_h"))
    cell = F.substring("_h", 1, 4)
    part = F.lit(Decimal(str(share)))  # as a double, 0.8 * n may end above a whole number
    # At most 65,536 cells per class, whatever the number of rows.
    cells = hashed.groupBy("_y", cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
    per_class = Window.partitionBy("_y")
    behind = per_class.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    end = (
        cells.withColumns(
            {
                "_before": F.coalesce(F.sum("_n").over(behind), F.lit(0)),
                "_want": F.ceil(part * F.sum("_n").over(per_class)).cast("long"),
            }
        )
        .filter("_before < _want and _before + _n >= _want")
        .select("_y", "_cell", (F.col("_want") - F.col("_before")).alias("_left"))
    )
    # One row per class.
    h, e = hashed.withColumn("_cell", cell).alias("h"), F.broadcast(end).alias("e")
    inside = (
        h.join(
            e,
            F.col("h._y").eqNullSafe(F.col("e._y")) & (F.col("h._cell") == F.col("e._cell")),
        )
        .groupBy("h._y", "_h", "_left")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    earlier = per_class.orderBy("_h").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        inside.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .filter("_before < _left")
        .groupBy("_y")
        .agg(F.max("_h").alias("_last"))
    )
    # One row per class. A few classes become a plain expression, more a join.
    few = last.limit(MAX_CLASSES + 1).collect()
    if len(few) > MAX_CLASSES:
        last = last.select(F.col("_y").alias("_class"), "_last")
        rows = df.join(last, df[label].eqNullSafe(last["_class"]), "left")
        train = split_hash(id_column, seed) <= F.coalesce("_last", F.lit(""))
        split = F.when(train, "train").otherwise("test")
        return rows.select(*[df[c] for c in df.columns], split.alias("split"))
    train = F.lit(False)
    for r in few:
        train = train | (
            F.col(label).eqNullSafe(F.lit(r["_y"]))
            & (split_hash(id_column, seed) <= F.lit(r["_last"]))
        )
    return df.withColumn("split", F.when(train, "train").otherwise("test"))

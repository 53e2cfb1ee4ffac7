"""Classification metrics, class weights, category index and the quality gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.operators.skew import GROUP_ROWS, running_totals
from riskweave.schemas import MIN_PRECISION, MIN_RECALL
from riskweave.session import written


def _ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def precision_recall(
    df: DataFrame, label: str = "is_fraud", decision: str = "is_flagged"
) -> DataFrame:
    """Precision, recall and F1 of a 0/1 decision, in one pass; 0 where undefined."""
    counts = df.agg(
        F.sum(F.col(label) * F.col(decision)).alias("tp"),
        F.sum(decision).alias("flagged"),
        F.sum(label).alias("positives"),
    )
    return counts.select(
        _ratio(F.col("tp"), F.col("flagged")).alias("precision"),
        _ratio(F.col("tp"), F.col("positives")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("flagged") + F.col("positives")).alias("f1"),
    )


def ranking_metrics(
    df: DataFrame,
    label: str = "is_fraud",
    score: str = "fraud_probability",
    slice_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Exact `roc_auc` (ties count half) and step-wise `avg_precision`, one row.

    Rows are combined per distinct score first, so a score shared by many costs
    nothing; the running counts over the scores are cut into slices. Rows without a score
    or a label do not count.
    """
    by_score = written(
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy((-F.col(score)).alias("_worst")).agg(
            F.sum(F.col(label).cast("long")).alias("_pos"),
            F.count(F.lit(1)).alias("_n"),
        ),
        "scores",
    )
    counted = running_totals(
        by_score,
        [],
        ["_worst"],
        rows=by_score.count(),
        sums={"_tp": "_pos", "_seen": "_n"},
        slice_rows=slice_rows,
    )
    pos, n = F.col("_pos").cast("double"), F.col("_n").cast("double")
    tp, seen = F.col("_tp").cast("double"), F.col("_seen").cast("double")
    # A negative ranked above a positive costs a pair, one at the same score half.
    lost = F.sum(pos * (seen - tp - F.lit(0.5) * (n - pos)))
    positives, negatives = F.sum(pos), F.sum(n - pos)
    return counted.agg(
        F.try_subtract(
            F.lit(1.0), F.try_divide(lost, positives * negatives)
        ).alias("roc_auc"),
        F.coalesce(F.try_divide(F.sum(pos * tp / seen), positives), F.lit(0.0)).alias(
            "avg_precision"
        ),
    )


def split_counts(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Rows per side of the split and the positive rate of the test side."""
    test = F.col("split") == "test"
    return df.agg(
        F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(test).alias("n_test"),
        F.count(F.lit(1)).alias("n_samples"),
        F.coalesce(F.avg(F.when(test, F.col(label))), F.lit(0.0)).alias("fraud_rate_test"),
    )


def class_balance_weights(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Weight of each class: rows / (classes * rows of the class). Rows without a label
    are no class."""
    sizes = df.filter(F.col(label).isNotNull()).groupBy(label).agg(
        F.count(F.lit(1)).alias("n_class")
    )
    rows, classes = sizes.agg(F.sum("n_class"), F.count(F.lit(1))).first()
    weight = F.lit(float(rows or 0)) / (F.lit(float(classes)) * F.col("n_class"))
    return sizes.select(label, "n_class", weight.alias("class_weight"))


def with_class_weights(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """`df` with `class_weight`."""
    weights = class_balance_weights(df, label).select(
        F.col(label).alias("_class"), "class_weight"
    )
    return df.join(weights, df[label] == weights["_class"], "left").drop("_class")


def category_index(
    df: DataFrame, category: str, slice_rows: int = GROUP_ROWS
) -> DataFrame:
    """Index of each category by descending frequency, ties in alphabetical order."""
    counts = written(
        df.filter(F.col(category).isNotNull())
        .groupBy(category)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumns({"_rarest": -F.col("n"), "_one": F.lit(1)}),
        "categories",
    )
    ranked = running_totals(
        counts,
        [],
        ["_rarest", category],
        rows=counts.count(),
        sums={"_rank": "_one"},
        slice_rows=slice_rows,
    )
    return ranked.select(
        category, "n", (F.col("_rank") - 1).cast("double").alias("category_index")
    )


def quality_gate(
    metrics: DataFrame,
    min_recall: float = MIN_RECALL,
    min_precision: float = MIN_PRECISION,
) -> DataFrame:
    """Whether metrics rows reach both limits, and which limit they miss."""
    low_recall = ~F.coalesce(F.col("recall") >= min_recall, F.lit(False))
    low_precision = ~F.coalesce(F.col("precision") >= min_precision, F.lit(False))
    return metrics.select(
        "*",
        (~low_recall & ~low_precision).alias("passed"),
        F.concat_ws(
            ",",
            F.when(low_recall, F.lit("recall below limit")),
            F.when(low_precision, F.lit("precision below limit")),
        ).alias("reason"),
    )

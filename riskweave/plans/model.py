"""Training, evaluation and promotion of the model."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import (
    HashingTF,
    OneHotEncoder,
    SQLTransformer,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.columns import flagged
from riskweave.operators.features import account_features, point_in_time_features
from riskweave.operators.metrics import (
    precision_recall,
    quality_gate,
    ranking_metrics,
    split_counts,
    with_class_weights,
)
from riskweave.operators.splits import random_split, stratified_split
from riskweave.plans.forest import fit_forest
from riskweave.schemas import (
    CATEGORY_FEATURES,
    MIN_PRECISION,
    MIN_RECALL,
    NUMERIC_FEATURES,
    SPLIT_SEED,
)
from riskweave.session import scratch, written
from riskweave.sinks.tables import VersionedTable


@dataclass(frozen=True)
class ForestPlan:
    """What a forest is trained on and how."""

    numeric: tuple[str, ...]
    one_hot: bool
    trees: int
    depth: int
    balanced: bool
    stratified: bool
    label: str = "is_fraud"
    keeps_gaps: bool = True  # rows without a category stay, as an unknown one
    point_in_time: bool = False  # features see an account's earlier events only
    hashed: int | None = None  # categories as this many columns by hash, without a vocabulary


# The two forests.
BEHAVIOUR_FOREST = ForestPlan(
    tuple(NUMERIC_FEATURES), one_hot=True, trees=200, depth=8, balanced=True, stratified=True
)
# The first of them without a look ahead.
HISTORY_FOREST = replace(BEHAVIOUR_FOREST, point_in_time=True)
# The first of them with no vocabulary: any number of categories, every one kept.
HASHED_FOREST = replace(BEHAVIOUR_FOREST, hashed=1024)
SIMPLE_FOREST = ForestPlan(
    ("amount",),
    one_hot=False,
    trees=100,
    depth=10,
    balanced=False,
    stratified=False,
    label="is_flagged",
    keeps_gaps=False,
)


def category_indexer() -> StringIndexer:
    """Indexes both categories; one unseen in training gets an index of its own."""
    return StringIndexer(
        inputCols=CATEGORY_FEATURES,
        outputCols=[f"{c}_index" for c in CATEGORY_FEATURES],
        handleInvalid="keep",
    )


def forest_stages(
    plan: ForestPlan, indexer: StringIndexerModel | None, label: str, seed: int = SPLIT_SEED
) -> Pipeline:
    """Indexing, encoding and the forest as one estimator.

    One-hot, the index of unseen categories is the one left out, so they encode as
    zeros. Indexed, a tree needs as many bins as there are categories. Hashed, a category
    sets the column its hash names, whether training saw it or not; a missing one sets
    none, and categories that share a column are told apart by nothing. Neither the driver
    nor the bins grow with the categories then.
    """
    columns = indexer.getOutputCols() if indexer else []
    stages = [indexer] if indexer else []
    bins = RandomForestClassifier().getMaxBins()
    if plan.hashed:
        encoded = ["categories_hashed"]
        named = ", ".join(f"concat('{c}=', `{c}`)" for c in CATEGORY_FEATURES)
        stages += [
            SQLTransformer(
                statement=f"SELECT *, array_compact(array({named})) AS categories FROM __THIS__"
            ),
            HashingTF(
                inputCol="categories", outputCol=encoded[0], numFeatures=plan.hashed, binary=True
            ),
        ]
    elif plan.one_hot:
        encoded = [f"{c}_onehot" for c in CATEGORY_FEATURES]
        stages.append(OneHotEncoder(inputCols=columns, outputCols=encoded))
    else:
        encoded = columns
        bins = max(bins, *[len(labels) + 1 for labels in indexer.labelsArray])
    forest = RandomForestClassifier(
        labelCol=label,
        featuresCol="features",
        numTrees=plan.trees,
        maxDepth=plan.depth,
        maxBins=bins,
        seed=seed,
        # Where the library grows the trees, a row's place in each is kept, not looked for from the
        # root at each level.
        cacheNodeIds=not plan.hashed,
    )
    if plan.balanced:
        forest = forest.setWeightCol("class_weight")
    assembler = VectorAssembler(inputCols=[*encoded, *plan.numeric], outputCol="features")
    return Pipeline(stages=[*stages, assembler, forest])


PARTS_PER_CORE = 4


def dealt_evenly(df: DataFrame) -> DataFrame:
    """`df` in equal parts, some for each core: a forest reads its rows once a level, which takes
    as long as the largest part, and keeps them in memory by the part."""
    return df.repartition(PARTS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism)


def training_rows(df: DataFrame, plan: ForestPlan, label: str | None = None) -> DataFrame:
    """Rows with the features the plan asks for, and their split.

    A row needs its label and its numbers, and its categories unless the plan keeps gaps.
    The id is no feature; rows without one stay.
    """
    label = label or plan.label
    if set(plan.numeric) - {"amount"}:
        df = point_in_time_features(df) if plan.point_in_time else account_features(df)
    wanted = ["transaction_id", *plan.numeric, *CATEGORY_FEATURES, label]
    needed = [*plan.numeric, label, *([] if plan.keeps_gaps else CATEGORY_FEATURES)]
    df = df.select(*wanted).dropna(how="any", subset=needed)
    # Read again by the split, the vocabularies, the trees and the evaluation.
    df = written(dealt_evenly(df), "training")
    return stratified_split(df, label) if plan.stratified else random_split(df)


def train_forest(
    rows: DataFrame, plan: ForestPlan = BEHAVIOUR_FOREST, label: str | None = None
) -> PipelineModel:
    """A fitted model from the training side of `training_rows`; the vocabularies are
    learnt from that side only. Forests over 0/1 columns are grown by `fit_forest`, those over
    indexed categories by the library."""
    label = label or plan.label
    train = rows.filter("split = 'train'")
    if plan.balanced:
        train = with_class_weights(train, label)
    indexer = None if plan.hashed else category_indexer().fit(train)
    stages = forest_stages(plan, indexer, label)
    if plan.hashed or plan.one_hot:
        *before, forest = stages.getStages()
        features = Pipeline(stages=before).fit(train)
        weight = "class_weight" if plan.balanced else None
        fitted = fit_forest(
            features.transform(train), forest, plan.numeric, len(CATEGORY_FEATURES), weight
        )
        return PipelineModel([*features.stages, fitted])
    # A copy has no training summary. That one holds the session, which no task can be sent once
    # it has observed a write.
    return stages.fit(train).copy()


def score(df: DataFrame, model: Transformer) -> DataFrame:
    """`df` with `fraud_probability` and `is_flagged`."""
    out = model.transform(df)
    if "fraud_probability" not in out.columns:
        out = out.withColumn(
            "fraud_probability", vector_to_array("probability")[1].cast("double")
        )
    kept = [c for c in df.columns if c != "fraud_probability"]
    return out.select(*kept, "fraud_probability").withColumn(
        "is_flagged", flagged("fraud_probability")
    )


def side_by_side(*rows: DataFrame) -> DataFrame:
    """One row from several one-row frames with different columns."""
    both = rows[0]
    for r in rows[1:]:
        both = both.unionByName(r, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def evaluate(scored: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Metrics of a scored test side, one row."""
    return side_by_side(precision_recall(scored, label), ranking_metrics(scored, label))


METRIC_COLUMNS = [
    "precision",
    "recall",
    "f1",
    "roc_auc",
    "avg_precision",
    "fraud_rate_test",
    "n_train",
    "n_test",
    "n_samples",
]


def empty_metrics(spark: SparkSession) -> DataFrame:
    """The metrics of no rows: all zero."""
    return spark.range(1).select(
        *[
            F.lit(0).cast("long" if c.startswith("n_") else "double").alias(c)
            for c in METRIC_COLUMNS
        ]
    )


def predict_and_evaluate(
    rows: DataFrame, model: Transformer, label: str = "is_fraud"
) -> DataFrame:
    """Metrics of the model on the test side of `training_rows`, with the row counts."""
    # The label may be named like the decision, so it is set apart first.
    test = rows.filter("split = 'test'").withColumn("_label", F.col(label))
    scored = written(
        score(test, model).select("_label", "fraud_probability", "is_flagged"), "predictions"
    )
    return side_by_side(evaluate(scored, "_label"), split_counts(rows, label)).select(
        *METRIC_COLUMNS
    )


def stamp_metrics(metrics: DataFrame, version: str) -> DataFrame:
    """Metrics with the version they belong to and the time of training."""
    return metrics.withColumns(
        {
            "model_version": F.lit(version),
            "trained_at": F.lit(datetime.now(timezone.utc)),
        }
    )


def train_and_evaluate(
    df: DataFrame, plan: ForestPlan = BEHAVIOUR_FOREST, label: str | None = None
) -> tuple[PipelineModel | None, DataFrame]:
    """(model, metrics row); no model and zero metrics if no usable row is left."""
    label = label or plan.label
    rows = training_rows(df, plan, label)
    if rows.isEmpty():
        return None, empty_metrics(df.sparkSession)
    model = train_forest(rows, plan, label)
    return model, predict_and_evaluate(rows, model, label)


class ModelRegistry:
    """Models by version; the promoted one is named by a pointer written last.

    Every candidate has a folder of its own, so trying a version again never touches a
    model that is in use.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.table = VersionedTable(spark, root)
        self._loaded: tuple[str, PipelineModel] | None = None
        self._saved: dict[str, str] = {}

    def save_candidate(self, model: PipelineModel, version: str) -> str:
        path = f"{self.root}/versions/{version}-{uuid.uuid4().hex}"
        model.write().save(path)
        self._saved[version] = path
        return path

    def promote(
        self,
        version: str,
        metrics: DataFrame,
        min_recall: float = MIN_RECALL,
        min_precision: float = MIN_PRECISION,
        path: str | None = None,
    ) -> bool:
        """Makes a saved candidate current if its metrics pass the gate; otherwise
        the current model stays. `path` is where it was saved, if not by this object."""
        gate = quality_gate(metrics, min_recall, min_precision).first()
        if gate is not None and gate["passed"]:
            self.table.point_to(path or self._saved[version], version)
            return True
        return False

    def current(self) -> tuple[str, PipelineModel]:
        """(version, model) now promoted; loads again only when another was promoted."""
        pointer = self.table.pointer()
        if pointer is None:
            raise LookupError(f"no model has been promoted in {self.root}")
        row = pointer.first()
        if self._loaded is None or self._loaded[0] != row["path"]:
            self._loaded = (row["path"], PipelineModel.load(row["path"]))
        return row["version"], self._loaded[1]


def save_and_load(model: PipelineModel, spark: SparkSession) -> PipelineModel:
    path = scratch(spark, "model")
    model.write().overwrite().save(path)
    return PipelineModel.load(path)

"""The trainer of the forests against the library's trees."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskweave.plans import forest as forests
from riskweave.plans import model as models


@pytest.fixture(scope="module")
def rows(spark):
    """Six 0/1 columns and two numbers of few values; dense and sparse vectors, some rows twice."""
    k = F.col("id")
    bit = [((F.xxhash64(k, F.lit(j)) % 5) == 0).cast("double") for j in range(6)]
    # At most two of them are set, in different halves.
    some = [bit[j] * F.greatest(F.lit(0.0), 1 - sum(bit[a] for a in range(j // 3 * 3, j))) if j % 3 else bit[j] for j in range(6)]
    made = spark.range(0, 4000, 1, 3).withColumn("id", k % 3500).select(
        array_to_vector(F.array(*some)).alias("set"),
        (F.abs(F.xxhash64(k, F.lit(7))) % 20).cast("double").alias("a"),
        (F.abs(F.xxhash64(k, F.lit(8))) % 3).cast("double").alias("b"),
        (F.abs(F.xxhash64(k, F.lit(9))) % 10).alias("noise"),
    )
    y = ((F.col("a") + 6 * vector_to_array("set")[0] - 5 * vector_to_array("set")[4] + F.col("noise") / 4) > 14).cast("int")
    made = made.withColumn("y", y).withColumn("weight", F.when(F.col("y") == 1, 2.5).otherwise(0.75))
    return VectorAssembler(inputCols=["set", "a", "b"], outputCol="features").transform(made).cache()


def said(model) -> list[str]:
    lines = [x.strip() for x in model.toDebugString.splitlines()]
    return [x for x in lines if x.startswith(("If", "Else", "Predict"))]


def test_one_tree_is_the_library_s(rows):
    settings = {"labelCol": "y", "weightCol": "weight", "maxDepth": 4}
    want = DecisionTreeClassifier(**settings).fit(rows)
    one = RandomForestClassifier(**settings, numTrees=1)
    got = forests.fit_forest(rows, one, ("a", "b"), 2, "weight")
    assert len(said(want)) > 8 and said(got) == said(want)
    p = [m.transform(rows).select(vector_to_array("probability")[1].alias("p")) for m in (want, got)]
    a, b = ([r["p"] for r in x.collect()] for x in p)
    assert a == pytest.approx(b, abs=1e-9)


def test_forest_scores_as_the_library_s(rows, tmp_path):
    settings = RandomForestClassifier(labelCol="y", weightCol="weight", numTrees=40, maxDepth=5, seed=3)
    want, got = settings.fit(rows).copy(), forests.fit_forest(rows, settings, ("a", "b"), 2, "weight")
    assert (got.getNumTrees, got.numFeatures, got.numClasses, got.getMaxDepth()) == (40, 8, 2, 5)
    assert len({t.toDebugString.split("\n", 1)[1] for t in got.trees}) > 30
    assert max(abs(want.featureImportances.toArray() - got.featureImportances.toArray())) < 0.08
    both = rows
    for name, m in (("p", want), ("q", got)):
        both = m.transform(both).withColumn(name, vector_to_array("probability")[1])
        both = both.drop("probability", "rawPrediction", "prediction")
    assert both.agg(F.avg(F.abs(F.col("p") - F.col("q")))).first()[0] < 0.06
    got.save(str(tmp_path / "m"))
    again = type(got).load(str(tmp_path / "m"))
    assert again.toDebugString == got.toDebugString


def test_rows_of_a_hashed_forest_take_a_few_bytes(spark):
    """A row was an integer for each of 1,024 columns and for each of 200 trees."""
    plan = models.HASHED_FOREST
    train = spark.range(0, 20_000, 1, 4).select(
        *[(F.abs(F.hash("id", F.lit(c))) % 1000).cast("double").alias(c) for c in plan.numeric],
        F.concat(F.lit("m"), F.col("id") % 5).alias("merchant_category"),
        F.concat(F.lit("L"), F.col("id")).alias("location"),
        (F.col("id") % 7 == 0).cast("int").alias("is_fraud"),
    )
    *before, forest = models.forest_stages(plan, None, "is_fraud").getStages()
    assert forest.getNumTrees() == 200
    wide = Pipeline(stages=before).fit(train).transform(train)
    ends = forests.all_cuts(train, plan.numeric, 32)
    assert [len(e) for e in ends] == [31] * 4
    held = forests.portions(wide, "is_fraud", ends, 1024, 2).collect()
    assert sum(r["n"] for r in held) == 20_000
    assert sum(len(r[c]) for r in held for c in ("bins", "held", "classes")) <= 16 * 20_000
    for r in held:  # every row's two columns, both its own or one for both
        columns = np.frombuffer(r["held"], np.uint16).reshape(-1, 2)
        assert (columns[:, 0] < 1024).all() and (columns <= 1024).all()


def test_draws_are_poisson_and_repeat():
    rows, times = forests.drawn(200_000, 42, 3, 1)
    assert (np.diff(rows) > 0).all() and rows[-1] < 200_000
    counts = np.bincount(times.astype(int), minlength=5) / 200_000
    want = [math.exp(-1) / math.factorial(k) for k in range(1, 5)]
    assert counts[1:5] == pytest.approx(want, abs=0.004)
    again = forests.drawn(200_000, 42, 3, 1)
    assert (rows == again[0]).all() and (times == again[1]).all()
    assert len(forests.drawn(1, 42, 3, 2)[0]) <= 1


def test_searched_columns_are_those_of_the_table(monkeypatch):
    rng = np.random.default_rng(5)
    n, encoded, nodes = 3000, 40, 4
    cells = [rng.integers(0, 32, n) * 2 for _ in range(2)]
    labels = rng.integers(0, 2, n)
    words = [np.ascontiguousarray(np.stack([*(c // 2 for c in cells), *[np.zeros(n)] * 2], 1).astype(np.uint8)).view(np.uint32).ravel()]
    held = [rng.integers(0, 41, n).astype(np.uint8) for _ in range(2)]
    drew = np.array([rng.choice(42, 7, replace=False) for _ in range(nodes)])
    layout = forests.Layout(drew, encoded, 32, 2)
    tree = 0, (1,), [np.full(8, 0x0A0A0A0A, np.uint32)], np.full(8, 3, np.uint8), np.array([-1] * 4 + [0, 1, 2, 3])
    portion = 9, words, [c + labels for c in cells], held, labels
    want = forests.count_level(portion, tree, 2, layout, 2, encoded)
    monkeypatch.setattr(forests, "LARGEST_TABLE", 0)
    assert (forests.count_level(portion, tree, 2, layout, 2, encoded) == want).all()
    assert want[layout.nodes_at :].sum() == forests.drawn(n, 1, 0, 9)[1].sum()


def test_a_forest_of_no_rows_or_weights_within_a_class_is_refused(rows):
    forest = RandomForestClassifier(labelCol="y", numTrees=2, maxDepth=2)
    with pytest.raises(ValueError):
        forests.fit_forest(rows.filter("a < 0"), forest, ("a", "b"), 2)
    with pytest.raises(ValueError):
        forests.fit_forest(rows.withColumn("weight", F.col("a")), forest, ("a", "b"), 2, "weight")


def test_counts_of_many_tasks_are_added_up_in_steps(rows, monkeypatch):
    forest = RandomForestClassifier(labelCol="y", weightCol="weight", numTrees=3, maxDepth=3, seed=3)
    want = forests.fit_forest(rows, forest, ("a", "b"), 2, "weight")
    monkeypatch.setattr(forests, "MOST_AT_ONCE", 0)
    monkeypatch.setattr(forests.math, "isqrt", lambda n: 2)
    assert said(forests.fit_forest(rows, forest, ("a", "b"), 2, "weight")) == said(want)

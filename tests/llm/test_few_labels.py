"""Corpora without labels, with rare ones, and texts of marks alone."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskweave.llm import language, quality, toxicity


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def test_no_labels_reject_nothing(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(toxicity.labelled(documents, labels, "toxic"))
    kept = toxicity.without_toxic(documents, model)
    assert kept.columns == documents.columns and kept.exceptAll(documents).count() == 0
    assert kept.count() == quality.keep_good(kept, labels).count() == documents.count()


def test_the_pipeline_without_labels(spark, tmp_path):
    folder = str(tmp_path)
    source = "/root/testdata/sf0.001"
    spark.read.parquet(f"{source}/documents.parquet").write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{source}/labels.parquet").limit(0).write.parquet(f"{folder}/labels.parquet")
    packed = corpus_pipeline.run(spark, folder).select("doc_id").distinct().count()
    groups = spark.read.parquet(f"{folder}/documents.parquet").select("text").distinct().count()
    assert 0 < packed <= groups and packed > groups // 2


def test_rare_bad_labels_are_learned(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_ROWS", 200)
    rows = spark.range(4_008).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 8, F.repeat(F.lit("1$ # 77 @@ "), 30))
        .otherwise(F.concat(F.repeat(F.lit("The river was calm and wide. "), 12), F.md5(F.col("id").cast("string"))))
        .alias("text"),
        F.lit("en").alias("lang"),
        F.when(F.col("id") < 8, "junk").otherwise("books").alias("source"),
        F.lit(300).cast("long").alias("n_chars"),
    )
    labels = rows.select("doc_id", (F.col("doc_id") >= 8).cast("int").alias("quality"))
    for seed in range(3):
        got = quality.score(rows, labels, seed=seed).filter("not keep").select("doc_id").collect()
        assert sorted(r[0] for r in got) == list(range(8))


def test_marks_alone_are_no_letters(spark, documents):
    model = language.fit(documents)
    odd = spark.createDataFrame([(1, "́́"), (2, "12 ̈"), (3, "la ét")], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(odd, model, 0.0).collect()}
    assert got[1] == got[2] == ("und", 0.0) and got[3][0] != "und"


def test_estimates_equal_naive_kneser_ney(spark):
    texts = [("a", "abab abc cab"), ("a", "bab a"), ("b", "xyx yxy xx"), ("b", "zx a")]
    rows = spark.createDataFrame(texts, "lang string, text string")
    p, w = language.kneser_ney(language.gram_counts(rows))
    got = {(r["lang"], r["gram"]): r["p"] for r in p.collect()}
    weights = {(r["lang"], r["context"]): r["weight"] for r in w.collect()}
    for lang in "ab":
        top = Counter()
        for g, t in texts:
            if g == lang:
                t = "   " + t + " "
                top.update(t[i : i + 4] for i in range(len(t) - 3))
        levels = [top]
        for _ in range(3):
            levels.append(Counter(g[1:] for g in levels[-1]))
        levels = levels[::-1]
        symbols = len(levels[0]) + 1
        for k, level in enumerate(levels):
            once, twice = (sum(v == n for v in level.values()) for n in (1, 2))
            d = once / (once + 2 * twice) if once + twice else 0.5
            d = min(max(d, 0.1), 0.95)
            total, kinds = defaultdict(int), defaultdict(int)
            for g, n in level.items():
                total[g[:-1]] += n
                kinds[g[:-1]] += 1
            for g, n in level.items():
                low = got[lang, g[1:]] if k else 1 / symbols
                want = (n - d) / total[g[:-1]] + d * kinds[g[:-1]] / total[g[:-1]] * low
                assert math.isclose(got[lang, g], want, rel_tol=1e-12)
            for c in total:
                want = d * kinds[c] / total[c] / (1 if k else symbols)
                assert math.isclose(weights[lang, c], want, rel_tol=1e-12)
    model = language.fit(rows)
    entropy, size = model.entropies(["abc"])
    assert np.isfinite(entropy).all() and size[0] == 4

"""Toxicity of texts by a linear classifier on character n-grams.

Texts are lower-cased and white space is made one kind of blank; n-grams of 3 to 5
characters are hashed into a table. In the labelled rows each bucket counts the toxic and
the other documents that hold it. The log ratio of the two smoothed rates (naive Bayes)
scales the bucket's presence, and a logistic regression on the scaled features of the most
telling buckets weighs them. A Platt curve on rows kept aside makes the score a probability.
Rows are drawn for each label apart, so that a rare one keeps its rows, and weighted back to
the labels' true shares.

Whole texts are scored. Defined results: NULL and empty texts get the score of a text
without any telling n-gram. Without labels of both classes every score is the toxic share.
Rows that repeat a doc_id take each label given to it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import filter_rows, map_rows, runs, small_batches
from riskweave.llm.linear import calibrate, fit_logistic, sigmoid
from riskweave.session import written

SIZES = (3, 4, 5)
TABLE_BITS = 18
TELLING = 2048  # buckets that get a weight
LEAST_DOCUMENTS = 4  # in which a bucket stands, to get one
LABELLED_ROWS = 20_000  # about how many labelled rows are fitted on, half of each label if it has them
SMOOTHING = 0.5
PORTION = 250_000  # characters whose n-grams are held at a time
PENALTY = 1e-5


def gram_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Document number and bucket of every n-gram of the texts."""
    joined = "".join(" " + " ".join(t.lower().split()) + " \0" for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    end = codes == 0
    document = np.cumsum(end) - end
    ends = np.flatnonzero(end)
    room = ends[np.minimum(document, len(texts) - 1)] - np.arange(len(codes))
    owners, buckets = [], []
    h = np.zeros(len(codes), np.uint32)
    for k in range(max(SIZES)):
        h = h[: len(codes) - k] if k else h
        h = (h ^ codes[k:]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        if k + 1 in SIZES:
            fits = room[: len(h)] > k
            spread = (h[fits] + np.uint32(k)) * np.uint32(0x85EBCA6B)
            owners.append(document[: len(h)][fits])
            buckets.append((spread >> np.uint32(32 - TABLE_BITS)).astype(np.int64))
    return np.concatenate(owners), np.concatenate(buckets)


def _present(texts: list[str], keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of document number and bucket, of buckets that `keep` marks."""
    owner, bucket = gram_buckets(texts)
    if keep is not None:
        held = keep[bucket]
        owner, bucket = owner[held], bucket[held]
    both = np.unique((owner << TABLE_BITS) | bucket)
    return both >> TABLE_BITS, both & ((1 << TABLE_BITS) - 1)


def bucket_counts(rows: DataFrame) -> np.ndarray:
    """Of the rows (text, label): documents that hold each bucket, by label (2 x table)."""

    def run(batches):
        counts = np.zeros((2, 1 << TABLE_BITS), np.int64)
        for batch in batches:
            labels = batch.column("label").to_pylist()
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in runs([len(t) for t in texts], PORTION):
                owner, bucket = _present(texts[a:b])
                mark = np.array(labels[a:b])[owner]
                for label in (0, 1):
                    counts[label] += np.bincount(bucket[mark == label], minlength=1 << TABLE_BITS)
        some = np.flatnonzero(counts.sum(axis=0))
        for a in range(0, len(some), 65536):
            part = some[a : a + 65536]
            yield pa.RecordBatch.from_pydict(
                {"bucket": part, "n0": counts[0, part], "n1": counts[1, part]}
            )

    small_batches(rows.sparkSession)
    found = (
        rows.select("text", F.col("label").cast("int").alias("label"))
        .mapInArrow(run, "bucket bigint, n0 bigint, n1 bigint")
        .groupBy("bucket")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .filter(F.col("n0") + F.col("n1") >= LEAST_DOCUMENTS)
        .toArrow()
    )  # a row for each bucket of the table at most
    out = np.zeros((2, 1 << TABLE_BITS))
    at = found.column("bucket").to_numpy()
    out[0, at], out[1, at] = found.column("n0").to_numpy(), found.column("n1").to_numpy()
    return out


def log_count_ratios(counts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The most telling buckets and their log ratios, given how many rows have each label."""
    some = np.flatnonzero(counts.sum(axis=0))
    held = counts[:, some] + SMOOTHING
    rate = held / (rows[:, None] + 2 * SMOOTHING)
    ratio = np.log(rate[1]) - np.log(rate[0])
    surprise = np.abs(ratio) / np.sqrt(1 / held[0] + 1 / held[1])
    best = np.sort(np.argsort(-surprise, kind="stable")[:TELLING])
    return some[best], ratio[best]


class Presence:
    """Rows of ones at the given places: their products, taken in portions of rows."""

    def __init__(self, places: np.ndarray, sizes: np.ndarray, width: int, portion: int = 512):
        self.places, self.sizes, self.width = places, sizes, width
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        self.portions = [(a, min(a + portion, len(sizes))) for a in range(0, len(sizes), portion)]

    def times(self, w: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.sizes))
        for a, b in self.portions:
            bounds = self.bounds[a : b + 1]
            sums = np.concatenate([[0.0], np.cumsum(w[self.places[bounds[0] : bounds[-1]]])])
            out[a:b] = np.diff(sums[bounds - bounds[0]])
        return out

    def back(self, e: np.ndarray) -> np.ndarray:
        out = np.zeros(self.width)
        for a, b in self.portions:
            places = self.places[self.bounds[a] : self.bounds[b]]
            out += np.bincount(places, np.repeat(e[a:b], self.sizes[a:b]), self.width)
        return out


class Model:
    """A weight for each bucket (the log ratio times the fitted one) and the score's curve."""

    def __init__(self, weights: np.ndarray, constant: float, slope: float, shift: float):
        self.weights = weights.astype(np.float32)
        self.constant, self.slope, self.shift = constant, slope, shift

    def score(self, texts: list[str]) -> np.ndarray:
        z, marked = np.zeros(len(texts)), self.weights != 0
        for a, b in runs([len(t) for t in texts], PORTION):
            owner, bucket = _present(texts[a:b], marked)
            z[a:b] = np.bincount(owner, self.weights[bucket].astype(np.float64), b - a)
        return sigmoid(self.slope * (z + self.constant) + self.shift)


def _draw() -> Column:
    """What rows are drawn by: the text counts too, so that those of one doc_id are drawn apart."""
    return F.xxhash64("doc_id", "text")


def _sizes(rows: DataFrame, *keys: str) -> dict:
    """How many rows stand for each label, or for each label and further keys."""
    return {tuple(r)[:-1]: r["count"] for r in rows.groupBy("label", *keys).count().collect()}


def fit(rows: DataFrame, seed: int = 10) -> Model:
    """A model of the labelled rows (doc_id, text, label)."""
    sizes = {label: n for (label,), n in _sizes(rows).items()}
    least = min(sizes.get(0, 0), sizes.get(1, 0), LABELLED_ROWS // 2)
    wanted = {k: LABELLED_ROWS - least if n > least else least for k, n in sizes.items()}
    if least:
        if "_draw" not in rows.columns:
            rows = rows.withColumn("_draw", _draw())
        chance = F.pmod(F.xxhash64(F.lit(seed), "_draw"), F.lit(1_000_000)) / F.lit(1e6)
        share = F.when(F.col("label") == 1, wanted[1] / sizes[1]).otherwise(wanted[0] / sizes[0])
        fold = F.pmod(F.xxhash64(F.lit(seed + 1), "_draw"), F.lit(5))
        rows = rows.filter(chance < share)
        # Drawn on narrow rows; the semi join goes below the one with the labels, so that only
        # the texts of drawn rows move.
        keys = F.broadcast(rows.select("_draw").distinct())
        rows = written(rows.join(keys, "_draw", "left_semi"), "labelled").withColumn("_aside", fold == 0)
        drawn = _sizes(rows, "_aside")
    if not least or not all(any(drawn.get((k, a)) for a in (False, True)) for k in (0, 1)):
        share = (sizes.get(1, 0) + SMOOTHING) / (sum(sizes.values()) + 2 * SMOOTHING)
        return Model(np.zeros(1 << TABLE_BITS), 0.0, 1.0, float(np.log(share / (1 - share))))
    if not drawn.get((0, False)) or not drawn.get((1, False)):
        rows = rows.withColumn("_aside", F.lit(False))  # too few to keep some aside
        drawn = _sizes(rows, "_aside")
    n = {k: drawn[k, False] for k in (0, 1)}
    back = np.array([sizes[k] / (n[k] + drawn.get((k, True), 0)) for k in (0, 1)])
    train = rows.filter(~F.col("_aside"))
    chosen, ratio = log_count_ratios(
        bucket_counts(train), np.array([n[0], n[1]], float)
    )
    marked = np.zeros(1 << TABLE_BITS, bool)
    marked[chosen] = True

    def make():
        def work(c):
            owner, bucket = _present(c["text"], marked)
            held = np.split(bucket, np.searchsorted(owner, np.arange(1, len(c["text"]))))
            place = [np.searchsorted(chosen, h).astype(np.uint16).tobytes() for h in held]
            return {"label": c["label"], "_aside": c["_aside"], "held": place}

        return work

    sample = map_rows(
        rows.select("text", "label", "_aside"), make, "label int, _aside boolean, held binary"
    ).toArrow()  # at most TELLING 16-bit numbers for each sampled row
    y = sample.column("label").to_numpy().astype(float)
    aside = sample.column("_aside").to_numpy()
    held = sample.column("held").to_pylist()
    rows = Presence(
        np.frombuffer(b"".join(held), np.uint16), np.array([len(h) // 2 for h in held]), len(chosen)
    )
    w = fit_logistic(
        lambda w: rows.times(ratio * w),
        lambda e: ratio * rows.back(e),
        len(chosen),
        y,
        (~aside) * back[y.astype(int)],
        PENALTY,
    )
    z = rows.times(ratio * w[:-1]) + w[-1]
    use = aside if len(set(y[aside])) == 2 else ~aside
    slope, shift = calibrate(z[use], y[use], back[y[use].astype(int)])
    weights = np.zeros(1 << TABLE_BITS)
    weights[chosen] = ratio * w[:-1]
    return Model(weights, float(w[-1]), slope, shift)


def with_scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row of `docs`."""
    parts = (model.weights, model.constant, model.slope, model.shift)  # 1 MB
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    def make():
        own = Model(*shared.value)

        def work(c):
            return {"doc_id": c["doc_id"], "score": own.score(c["text"])}

        return work

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_rows(rows, make, "doc_id bigint, score double")


def without_toxic(docs: DataFrame, model: Model, reject_from: float = 0.5) -> DataFrame:
    """The rows of `docs` whose score is below `reject_from`; all of them where nothing was
    learned, as then all have the same score."""
    if not model.weights.any():
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.weights, model.constant, model.slope, model.shift)
    )

    def make():
        own = Model(*shared.value)

        def work(c):
            return own.score(c["text"]) < reject_from

        return work

    return filter_rows(docs, make)


def labelled(docs: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """doc_id, text, label and `_draw` of the rows of `docs` that have a 0 or 1 in that column."""
    marks = (
        labels.select(F.col("doc_id").alias("_id"), F.col(column).cast("int").alias("label"))
        .filter("label in (0, 1)")
        .distinct()
    )
    rows = docs.select("doc_id", "text", _draw().alias("_draw"))
    return rows.join(marks, F.col("doc_id") == F.col("_id")).drop("_id")

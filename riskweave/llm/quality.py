"""Document quality by co-training two classifiers that look at different things.

The text view sees the words: shares of kinds of characters and words, and repetition. The
metadata view sees what is known of a page without reading it: source, language, length
and line layout. Each starts from the labelled rows. In every round each view scores all
unlabelled documents, and those it is sure of become labelled rows for the other view;
where both are sure and disagree, neither counts. What a view must score to be sure is
read off rows kept aside, so a view that tells nothing hands nothing over. In the end both
views are calibrated on those rows and combined, and every document is scored.

Fits use at most SAMPLE_ROWS labelled rows, and as many of the rows that the other view
labelled, chosen by a hash of doc_id and text; thresholds and scores cover all documents.

Defined results: NULL and empty texts have the features of a text without words. Without
labels of both classes every document gets the share of good labels and is kept.
"""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import filter_rows, map_rows
from riskweave.llm.linear import calibrate, fit_dense, sigmoid
from riskweave.session import written

ROUNDS = 2
SAMPLE_ROWS = 20_000
SURE = 0.98  # precision, on rows kept aside, of what a view hands over
LEAST_SURE = 20  # rows kept aside that this precision is read off, at least
PSEUDO_WEIGHT = 0.5
SOURCES, LANGUAGES = 32, 8  # hashed places of the metadata view
LIMIT = 20.0  # of a view's calibrated logit
REJECT = 0.5  # documents below this chance of being good are rejected

_MARKS = re.compile(r"[^\w\s]+")


def text_features(text: str) -> list[float]:
    """Shares of kinds of characters and words, and measures of repetition."""
    words = text.split()
    n, size = max(len(words), 1), max(len(text), 1)
    low = [w.lower() for w in words]
    counts = Counter(low)
    marks = _MARKS.findall(text)
    marked = sum(map(len, marks))
    stops = text.count(".") + text.count(",")
    letters = sum(map(len, low)) - marked
    digits = sum(map(text.count, "0123456789"))
    upper = sum(1 for w in words if w.isupper() and len(w) > 1)
    pairs = len(set(zip(low, low[1:])))
    again = sum(a == b for a, b in zip(low, low[1:]))
    common = counts.most_common(1)[0][1] if counts else 0
    odd = sum(1 for m in marks if len(m) > 1)
    lengths = [len(w) for w in counts]
    return [
        np.log1p(n),
        letters / size,
        digits / size,
        marked / size,
        (marked - stops) / size,
        stops / n,
        len(marks) / n,
        odd / n,
        upper / n,
        sum(1 for w in words if w[:1].isupper()) / n,
        len(counts) / n,
        len(counts) / n**0.5,
        pairs / max(n - 1, 1),
        again / n,
        common / n,
        sum(lengths) / max(len(lengths), 1),
        max(lengths, default=0) / 50.0,
        sum(1 for w in low if len(w) <= 3) / n,
        text.count("|") / n,
        text.count("http") / n,
    ]


def page_features(source: str | None, lang: str | None, text: str, n_chars: int | None) -> list[float]:
    """Source, language, length and line layout."""
    lines = text.split("\n")
    filled = [x for x in lines if x.strip()]
    sizes = np.array([len(x) for x in filled] or [0], float)
    size = len(text) if n_chars is None else n_chars
    ends = sum(1 for x in filled if x.rstrip()[-1] in ".!?:\"'")
    places = [0.0] * (SOURCES + LANGUAGES)
    if source is not None:
        places[crc32(source.encode()) % SOURCES] = 1.0
    if lang is not None:
        places[SOURCES + crc32(lang.encode()) % LANGUAGES] = 1.0
    return [
        np.log1p(max(size, 0)),
        np.log1p(len(filled)),
        np.log1p(sizes.mean()),
        np.log1p(sizes.max()),
        sizes.std() / (1.0 + sizes.mean()),
        len(set(filled)) / max(len(filled), 1),
        ends / max(len(filled), 1),
        (len(lines) - len(filled)) / len(lines),
        *places,
    ]


def features(docs: DataFrame) -> DataFrame:
    """doc_id, text_view and page_view (arrays) of every row of `docs`, and a hash of its text."""

    def make():
        def work(c):
            return {
                "doc_id": c["doc_id"],
                "_digest": c["_digest"],
                "text_view": [np.array(text_features(t), np.float32) for t in c["text"]],
                "page_view": [
                    np.array(page_features(s, g, t, n), np.float32)
                    for s, g, t, n in zip(c["source"], c["lang"], c["text"], c["n_chars"])
                ],
            }

        return work

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "text",
        "source",
        "lang",
        F.col("n_chars").cast("bigint"),
        F.xxhash64("text").alias("_digest"),
    )
    return map_rows(
        rows, make, "doc_id bigint, _digest bigint, text_view array<float>, page_view array<float>"
    )


class View:
    """A logistic regression on one view, standardised, with its calibrated curve."""

    def __init__(self, column: str, x: np.ndarray, y: np.ndarray, weight: np.ndarray):
        self.column = column
        self.mean, scale = x.mean(axis=0), x.std(axis=0)
        self.scale = np.where(scale > 1e-9, scale, 1.0)
        self.w = fit_dense((x - self.mean) / self.scale, y, weight)
        self.slope, self.shift = 1.0, 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.w[:-1] + self.w[-1]

    def settle(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        self.slope, self.shift = calibrate(self.raw(x), y, weight)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.slope * self.raw(x) + self.shift

    def expression(self) -> Column:
        """The calibrated logit as a column over the features."""
        factors = self.slope * self.w[:-1] / self.scale
        start = self.shift + self.slope * (self.w[-1] - float(self.w[:-1] @ (self.mean / self.scale)))
        products = F.zip_with(
            F.col(self.column).cast("array<double>"),
            F.array(*[F.lit(float(f)) for f in factors]),
            lambda a, b: a * b,
        )
        return F.aggregate(products, F.lit(float(start)), lambda total, p: total + p)


def sure_above(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float | None:
    """The lowest score from which on the share of y = 1 is at least SURE (None: there is none)."""
    order = np.argsort(-z, kind="stable")
    right = np.cumsum((weight * y)[order]) / np.cumsum(weight[order])
    enough = np.flatnonzero(right >= SURE)
    enough = enough[enough + 1 >= LEAST_SURE]
    return float(z[order[enough[-1]]]) if len(enough) else None


def _fetch(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """label, _aside and both views of a bounded sample."""
    found: pa.Table = rows.select("label", "_aside", "text_view", "page_view").toArrow()
    views = [
        found.column(n).combine_chunks().flatten().to_numpy().astype(float).reshape(found.num_rows, -1)
        for n in ("text_view", "page_view")
    ]
    return (
        found.column("label").to_numpy().astype(float),
        found.column("_aside").to_numpy().astype(bool),
        *views,
    )


def _bounded(rows: DataFrame, n: int, seed: int, wanted: int | None = None) -> DataFrame:
    """About `wanted` (SAMPLE_ROWS) of n rows, by a hash of doc_id and text: those of one id are drawn apart."""
    chance = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "_digest"), F.lit(1_000_000)) / F.lit(1e6)
    wanted = SAMPLE_ROWS if wanted is None else wanted
    return rows.filter(chance < min(1.0, wanted / max(n, 1)))


class Model:
    """The views and how they are combined; without views, the share of good labels."""

    def __init__(self, views: list[View], weights: np.ndarray, share: float):
        self.views, self.weights, self.share = views, weights, share

    def chance(self, text: np.ndarray, page: np.ndarray) -> np.ndarray:
        if not self.views:
            return np.full(len(text), max(self.share, REJECT))
        z = [np.clip(v.logit(x), -LIMIT, LIMIT) for v, x in zip(self.views, (text, page))]
        return sigmoid(z[0] * self.weights[0] + z[1] * self.weights[1] + self.weights[2])

    def columns(self) -> list[Column]:
        """text_score, page_score and score over the features."""
        if not self.views:
            none = F.lit(None).cast("double")
            return [
                none.alias("text_score"), none.alias("page_score"), F.lit(self.share).alias("score")
            ]
        z = [F.least(F.greatest(v.expression(), F.lit(-LIMIT)), F.lit(LIMIT)) for v in self.views]
        w = [float(x) for x in self.weights]
        logits = {"text_score": z[0], "page_score": z[1], "score": z[0] * w[0] + z[1] * w[1] + w[2]}
        return [(1.0 / (1.0 + F.exp(-x))).alias(n) for n, x in logits.items()]


def with_labels(docs: DataFrame, labels: DataFrame, seed: int) -> DataFrame:
    """The features of every row, its label (NULL: none) and whether it is kept aside."""
    marks = (
        labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("label"))
        .filter("label in (0, 1)")
        .groupBy("_id")
        .agg(F.min("label").alias("label"))
    )
    table = features(docs).join(marks, F.col("doc_id") == F.col("_id"), "left").drop("_id")
    fold = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "_digest"), F.lit(4))
    return written(table.withColumn("_aside", fold == 0), "views")


def fit(table: DataFrame, seed: int) -> Model:
    """Co-trains the views on the rows of `with_labels`."""
    known, unknown = table.filter("label is not null"), table.filter("label is null")
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    total = sum(sizes.values())
    if not sizes.get(0) or not sizes.get(1):
        return Model([], np.empty(0), sizes.get(1, 0) / total if total else 1.0)
    # Each label has half of the sample, or all of its rows and what that leaves to the other;
    # rows weigh as much as those they stand for.
    least = min(sizes[0], sizes[1], SAMPLE_ROWS // 2)
    wanted = {k: SAMPLE_ROWS - least if n > least else least for k, n in sizes.items()}
    drawn = [
        _bounded(known.filter(F.col("label") == k), sizes[k], seed + 1, wanted[k]) for k in (0, 1)
    ]
    y, aside, text, page = _fetch(drawn[0].unionAll(drawn[1]))
    if len(set(y)) < 2:
        return Model([], np.empty(0), sizes[1] / total)
    back = np.array([sizes[k] / (y == k).sum() for k in (0, 1)])
    weigh = back[y.astype(int)] * len(y) / total
    if len(set(y[aside])) < 2 or len(set(y[~aside])) < 2:
        aside = np.zeros(len(y), bool)
    test = aside if aside.any() else ~aside
    own = [text, page]
    more: list[list[tuple[np.ndarray, np.ndarray]]] = [[], []]  # rows that the other view labelled

    def fitted(k: int) -> View:
        x = np.concatenate([own[k][~aside], *(m[0] for m in more[k])])
        t = np.concatenate([y[~aside], *(m[1] for m in more[k])])
        weight = np.full(len(t), PSEUDO_WEIGHT)
        weight[: (~aside).sum()] = weigh[~aside]
        view = View(("text_view", "page_view")[k], x, t, weight)
        view.settle(own[k][test], y[test], weigh[test])
        return view

    views = [fitted(0), fitted(1)]
    for turn in range(ROUNDS):
        vote = []
        for k, view in enumerate(views):
            z = view.logit(own[k][test])
            good, bad = sure_above(z, y[test], weigh[test]), sure_above(-z, 1 - y[test], weigh[test])
            logit = view.expression()
            says_good = logit >= good if good is not None else F.lit(False)
            says_bad = logit <= -bad if bad is not None else F.lit(False)
            vote.append(F.when(says_good & ~says_bad, 1).when(says_bad & ~says_good, 0))
        voted = unknown.select(
            "doc_id", "_digest", "_aside", "text_view", "page_view", vote[0].alias("_0"), vote[1].alias("_1")
        ).filter("coalesce(_0, _1) is not null and coalesce(_0 = _1, true)")
        groups = voted.groupBy("_0", "_1").count().collect()
        for k in (0, 1):
            for value in (0, 1):
                n = sum(r["count"] for r in groups if r[f"_{k}"] == value)
                if not n:
                    continue
                part = voted.filter(F.col(f"_{k}") == value).withColumn("label", F.lit(value))
                t, _, *x = _fetch(_bounded(part, 2 * n, seed + 2 + turn))
                more[1 - k].append((x[1 - k], t))
        views = [fitted(0), fitted(1)]
        if turn + 1 < ROUNDS:
            more = [[], []]  # votes are taken anew by the better views
    # The views' calibrated logits are combined by a regression on the rows kept aside.
    z = np.stack([view.logit(own[k][test]) for k, view in enumerate(views)], axis=1)
    return Model(views, fit_dense(np.clip(z, -LIMIT, LIMIT), y[test], weigh[test]), total and sizes[1] / total)


def score(docs: DataFrame, labels: DataFrame, seed: int = 1) -> DataFrame:
    """doc_id, text_score, page_score, score (chance of being good) and keep of every row.

    `labels` has doc_id and quality (1 good, 0 bad); other values do not count.
    """
    table = with_labels(docs, labels, seed)
    model = fit(table, seed)
    keep = F.col("score") >= REJECT if model.views else F.lit(True)
    return table.select("doc_id", *model.columns()).withColumn("keep", keep)


def keep_good(docs: DataFrame, labels: DataFrame, seed: int = 1) -> DataFrame:
    """The rows of `docs`, unchanged, that `score` keeps."""
    model = fit(with_labels(docs, labels, seed), seed)

    def make():
        def work(c):
            text = np.array([text_features(t) for t in c["text"]], np.float32)
            page = [page_features(*x) for x in zip(c["source"], c["lang"], c["text"], c["n_chars"])]
            return model.chance(text, np.array(page, np.float32)) >= REJECT

        return work

    return filter_rows(docs, make, "source", "lang", "n_chars")

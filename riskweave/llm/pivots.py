"""Near-duplicate vectors by a permutation index over pivots.

Pivots are taken from a bounded sample of the vectors so that no two are alike. A vector is
described by its nearest pivots in order; equal vectors are one. Every pivot has the list
of the vectors that name it. Within a list, pairs that share enough pivots are verified by
cosine in double precision. A pair that shares several pivots is counted in the list of
the smallest only. Lists too long for a task are cut into blocks and compared block by
block, so none is cut short; a task returns counts and component labels, never pairs.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite numbers link
with nothing. Rows with equal vectors link with each other; rows that repeat a vec_id
count as different vectors. Vectors of different length do not link.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.components import block_pairs, components, local_labels
from riskweave.session import written

SAMPLE = 4096  # vectors the pivots are chosen among
PIVOTS_MIN, PIVOTS_MAX = 64, 1024  # a pivot for every VECTORS_PER_PIVOT vectors in between
VECTORS_PER_PIVOT = 64
PIVOT_COSINE = 0.7  # pivots are less alike than this
NAMED = 8  # pivots that describe a vector
SHARED = 2  # pivots a pair must share to be verified
BLOCK_ROWS = 1024


def unit(vectors) -> np.ndarray:
    """Vectors of unit length; scaled first, so that squares neither overflow nor vanish."""
    m = np.stack([np.asarray(v, np.float64) for v in vectors])
    m /= np.abs(m).max(axis=1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """The first n vectors of the sample (of unit length) that are not like an earlier one."""
    chosen: list[int] = []
    near = np.full(len(sample), -1.0)
    for i in range(len(sample)):
        if near[i] < PIVOT_COSINE:
            chosen.append(i)
            if len(chosen) == n:
                break
            near = np.maximum(near, sample @ sample[i])
    return sample[chosen]


def describe(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Adds named: the numbers of the nearest pivots, nearest first."""
    k = min(NAMED, len(pivots))
    shared = vectors.sparkSession.sparkContext.broadcast(pivots.astype(np.float32))

    def run(frames):
        p = shared.value
        for frame in frames:
            for a in range(0, len(frame), 2048):
                part = frame.iloc[a : a + 2048].copy()
                cosine = unit(part["embedding"]).astype(np.float32) @ p.T
                near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
                order = np.argsort(-np.take_along_axis(cosine, near, 1), axis=1, kind="stable")
                part["named"] = list(np.take_along_axis(near, order, 1).astype(np.int32))
                yield part

    fields = ", ".join(f"{n} {t}" for n, t in vectors.dtypes)
    return vectors.mapInPandas(run, f"{fields}, named array<int>")


def link_lists(described: DataFrame, threshold: float) -> DataFrame:
    """For each vector and list: vec_id, links (weighted by copies) and label, the smallest
    vector it is connected with in that list."""

    def compare(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        pivot, i, j = key
        frame = frame.sort_values("vec_id", ignore_index=True)
        own = frame["_own"].to_numpy()
        rows, columns = np.flatnonzero(own == i), np.flatnonzero(own == j)
        named = np.stack(frame["named"].to_numpy())
        vectors = unit(frame["embedding"])
        used, place = np.unique(named, return_inverse=True)
        holds = np.zeros((len(frame), len(used)), np.float32)
        np.put_along_axis(holds, place.reshape(named.shape), 1, axis=1)
        shared = holds[rows] @ holds[columns].T
        need = min(SHARED, named.shape[1])
        a, b = np.nonzero(shared >= need)
        a, b = rows[a], columns[b]
        if i == j:
            a, b = a[a < b], b[a < b]
        hits = [np.empty(0, np.int64)] * 2, [np.empty(0, np.int64)] * 2
        for s in range(0, len(a), 65536):
            x, y = a[s : s + 65536], b[s : s + 65536]
            near = np.einsum("ij,ij->i", vectors[x], vectors[y]) >= threshold
            x, y = x[near], y[near]
            both = named[x][:, :, None] == named[y][:, None, :]
            least = np.where(both.any(axis=2), named[x], np.iinfo(np.int32).max).min(axis=1)
            hits[0].append(x[least == pivot])
            hits[1].append(y[least == pivot])
        x, y = np.concatenate(hits[0]), np.concatenate(hits[1])
        copies = frame["copies"].to_numpy()
        links = np.bincount(x, copies[y], len(frame)) + np.bincount(y, copies[x], len(frame))
        label = local_labels(len(frame), x, y)
        some = links > 0
        ids = frame["vec_id"].to_numpy()
        return pd.DataFrame(
            {"vec_id": ids[some], "links": links[some].astype(np.int64), "label": ids[label[some]]}
        )

    lists = described.withColumn("_pivot", F.explode("named"))
    return (
        block_pairs(lists, "_pivot", "vec_id", BLOCK_ROWS)
        .groupBy("_pivot", "_i", "_j")
        .applyInPandas(compare, "vec_id bigint, links bigint, label bigint")
    )


def near_duplicates(rows: DataFrame, threshold: float = 0.95, seed: int = 0) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of `rows` (vec_id, embedding)."""
    spark = rows.sparkSession
    rows = rows.select(
        F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    low = F.lit(-(2**63)).cast("bigint")
    keyed = rows.withColumns({"_id": F.coalesce("vec_id", low), "_usable": usable})
    # Equal vectors are compared once; the smallest id stands for them.
    classes = written(
        keyed.filter("_usable")
        .groupBy("embedding")
        .agg(F.min("_id").alias("first"), F.count(F.lit(1)).alias("copies")),
        "vectors",
    )
    widths = [r[0] for r in classes.select(F.size("embedding")).distinct().collect()]
    found = []
    # A repeated vec_id may stand for several vectors, so classes get numbers of their own.
    numbered = written(
        classes.withColumn("vec_id", F.monotonically_increasing_id()), "numbered"
    )
    for width in sorted(widths):
        part = numbered.filter(F.size("embedding") == width)
        n = part.count()
        sample = part.select("embedding").orderBy(F.xxhash64(F.lit(seed), "vec_id")).limit(SAMPLE)
        pivots = choose_pivots(
            unit([r[0] for r in sample.collect()]),
            min(PIVOTS_MAX, max(PIVOTS_MIN, n // VECTORS_PER_PIVOT)),
        )
        described = describe(part.select("vec_id", "copies", "embedding"), pivots)
        found.append(link_lists(described, threshold))
    schema = "vec_id bigint, links bigint, label bigint"
    links = spark.createDataFrame([], schema)
    for part in found:
        links = links.unionAll(part)
    links = written(links, "links")
    total = links.groupBy("vec_id").agg(F.sum("links").alias("links"))
    reach = components(links.select(F.col("vec_id").alias("a"), F.col("label").alias("b")))
    known = (
        numbered.join(total, "vec_id", "left")
        .join(reach.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        .select(
            "embedding",
            "first",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "vec_id").alias("_component"),
        )
    )
    smallest = known.groupBy("_component").agg(F.min("first").alias("component_id"))
    known = known.join(smallest, "_component").select(
        F.col("embedding").alias("_same"), "n_links", "component_id"
    )
    out = keyed.join(known, F.col("_usable") & (F.col("embedding") == F.col("_same")), "left")
    component = F.nullif(F.coalesce("component_id", "_id"), low)
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("_id").eqNullSafe(F.coalesce("component_id", "_id")).alias("kept"),
    )

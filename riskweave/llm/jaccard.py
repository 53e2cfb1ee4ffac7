"""Documents whose sets of five-word shingles are alike, with Bayesian pruning.

1. Each text becomes the set of hashes of its windows of five words (lower case, between
   blanks; a shorter text is one window). Equal sets are one class.
2. MinHash values of a class, four at a time, name 32 buckets. Classes in one bucket are
   candidates; two sets with similarity 0.8 miss every bucket with probability 5e-8. For
   lower thresholds two values or one name 64 or 128 buckets, so that this bound holds for
   sets at the threshold (from 0.49 and 0.13 on); still lower ones raise.
3. Within a bucket MinHash values are compared 16 at a time. Given m of n equal ones, the
   posterior of the similarity is Beta(m + 1, n - m + 1); a pair for which the chance of
   reaching the threshold falls below the tolerance is dropped. A pair that meets in
   several buckets is handled in the first.
4. Survivors are verified on their whole shingle sets.

Large buckets are cut into blocks and compared block by block, so none is cut short. A task
returns each class's number of links and its component label, never pairs.

Defined results: texts without a word (NULL, empty) link with nothing. Rows that repeat
a doc_id are told apart by their text; of rows that repeat both, one is kept.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import map_rows, mix64, parallelism, span_hashes
from riskweave.llm.components import block_pairs, components, local_labels
from riskweave.session import written

WORDS = 5
BANDS, VALUES = 32, 4  # 128 MinHash values
MISSED = 5e-8  # chance that a pair at the threshold meets in no bucket, at most
STEP = 16  # values compared at a time
TOLERANCE = 1e-6
BLOCK_ROWS = 512
PAIRS = 1 << 17  # looked at together
_RNG = np.random.default_rng(5)
FACTORS = _RNG.integers(0, 2**63, BANDS * VALUES, np.uint64) * np.uint64(2) + np.uint64(1)
TERMS = _RNG.integers(0, 2**63, BANDS * VALUES, np.uint64)


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its windows of five words."""
    words = [t.lower().split() for t in texts]
    counts = np.array([len(w) for w in words if w], np.int64)
    if not len(counts):
        return [np.empty(0, np.uint64) for _ in texts]
    raw = np.frombuffer("".join(" ".join(w) + "\n" for w in words if w).encode(), np.uint8)
    ends = np.flatnonzero((raw == 32) | (raw == 10))
    starts = np.concatenate([[0], ends[:-1] + 1])
    windows = np.maximum(counts - WORDS + 1, 1)
    first = np.repeat(np.cumsum(counts) - counts, windows)
    before = np.repeat(np.cumsum(windows) - windows, windows)
    at = first + np.arange(len(first)) - before
    last = at + np.repeat(np.minimum(counts, WORDS), windows) - 1
    hashes = span_hashes(raw, starts[at], ends[last])
    sets = iter(np.split(hashes, np.cumsum(windows)[:-1]))
    return [np.unique(next(sets)) if w else np.empty(0, np.uint64) for w in words]


def minhash(shingles: np.ndarray) -> np.ndarray:
    """128 values of 32 bits: the least of each hash function over the set."""
    out = np.full(BANDS * VALUES, np.iinfo(np.uint32).max, np.uint64)
    for a in range(0, len(shingles), 2048):
        part = FACTORS[:, None] * shingles[None, a : a + 2048] + TERMS[:, None]
        np.minimum(out, (part >> np.uint64(32)).min(axis=1), out=out)
    return out.astype(np.uint32)


def band_values(threshold: float) -> int:
    """How many values name a bucket, so that pairs at the threshold are missed by MISSED at most."""
    for width in (VALUES, 2, 1):
        if (1 - min(threshold, 1.0) ** width) ** (BANDS * VALUES // width) <= MISSED:
            return width
    raise ValueError(f"{BANDS * VALUES} MinHash values do not find pairs with similarity {threshold}")


def bucket_names(values: np.ndarray, width: int = VALUES) -> np.ndarray:
    """For rows of MinHash values the names of their buckets, of `width` values each."""
    bands = BANDS * VALUES // width
    whole = np.ascontiguousarray(values)
    whole = whole.astype(np.uint64) if width == 1 else whole.view(np.uint64)
    pairs = whole.reshape(len(values), bands, max(width // 2, 1))
    name = np.broadcast_to(mix64(np.arange(1, bands + 1, dtype=np.uint64)), pairs.shape[:2])
    for k in range(pairs.shape[2]):
        name = mix64(name + pairs[:, :, k])
    return name.view(np.int64)


def least_matches(threshold: float, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For n compared values the fewest equal ones that keep a pair.

    With a uniform prior the chance that the similarity reaches t, given m of n equal, is
    that of at most m successes in n + 1 trials of probability t.
    """
    out = {}
    for n in range(STEP, BANDS * VALUES + 1, STEP):
        chance, m = 0.0, -1
        while chance < tolerance:
            m += 1
            chance += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def sketches(docs: DataFrame, width: int = VALUES) -> DataFrame:
    """_id, _text (a digest of the text), set (a digest of the shingle set; NULL without
    words), minhash and buckets of every row of `docs`."""

    def make():
        from hashlib import blake2b

        def work(c):
            sets = shingle_sets(c["text"])
            values = np.stack([minhash(s) for s in sets])
            names = bucket_names(values, width)
            some = [len(s) > 0 for s in sets]
            return {
                "_id": c["_id"],
                "_text": c["_text"],
                "set": [blake2b(s.tobytes(), digest_size=16).digest() if k else None for s, k in zip(sets, some)],
                "minhash": [v.tobytes() if k else None for v, k in zip(values, some)],
                "buckets": [n.tolist() if k else None for n, k in zip(names, some)],
            }

        return work

    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63)).cast("bigint")).alias("_id"),
        F.md5(F.coalesce("text", F.lit(""))).alias("_text"),
        "text",
    )
    return map_rows(
        rows, make, "_id bigint, _text string, set binary, minhash binary, buckets array<bigint>"
    )


def shingles_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """set and shingles, one row for each row of `wanted` (set, _id, _text)."""

    def make():
        def work(c):
            return {
                "set": c["set"],
                "shingles": [s.tobytes() for s in shingle_sets(c["text"])],
            }

        return work

    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63)).cast("bigint")).alias("_id"),
        "text",
    )
    # A repeated id brings a text more than once or a wrong one; only its own counts.
    own = F.md5(F.coalesce("text", F.lit(""))) == F.col("_text")
    found = rows.join(wanted, "_id").filter(own).select("set", "text")
    return map_rows(found, make, "set binary, shingles binary")


def _pruned(values: np.ndarray, x: np.ndarray, y: np.ndarray, least: dict[int, int]):
    """The pairs of rows of MinHash values whose similarity may reach the threshold."""
    equal = np.zeros(len(x), np.int64)
    for n, need in least.items():
        equal += (values[x, n - STEP : n] == values[y, n - STEP : n]).sum(axis=1)
        stay = equal >= need
        x, y, equal = x[stay], y[stay], equal[stay]
    return x, y


def _pairs(starts: np.ndarray, sizes: np.ndarray):
    """All pairs of rows within groups of consecutive rows, in portions of bounded size."""
    for n in np.unique(sizes[sizes > 1]):
        first = starts[sizes == n]
        for i in range(0, n - 1, step := max(1, PAIRS // n)):
            rows, columns = np.meshgrid(np.arange(i, min(i + step, n - 1)), np.arange(n), indexing="ij")
            upper = columns > rows
            rows, columns = rows[upper], columns[upper]
            for g in range(0, len(first), groups := max(1, PAIRS // len(rows))):
                base = first[g : g + groups, None]
                yield (base + rows).ravel(), (base + columns).ravel()


def _candidates(
    frame: pd.DataFrame, starts: np.ndarray, sizes: np.ndarray, least: dict[int, int], width: int = VALUES
):
    """Pairs of row numbers of one group that first meet in its bucket and survive.

    `frame` holds groups (bucket, _i, _j) of consecutive rows. Of a group that stands for
    two blocks only pairs across them count.
    """
    own, i, j = (frame[n].to_numpy() for n in ("_own", "_i", "_j"))
    band = frame["band"].to_numpy()
    values = np.frombuffer(b"".join(frame["minhash"]), np.uint32).reshape(len(frame), -1)
    names = bucket_names(values, width)
    kept = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for x, y in _pairs(starts, sizes):
        meet = (i[x] == j[x]) | (own[x] != own[y])
        x, y = x[meet], y[meet]
        # The first of the buckets that both are in; this one is among them.
        first = (names[x] == names[y]).argmax(axis=1) == band[x]
        x, y = _pruned(values, x[first], y[first], least)
        kept[0].append(x)
        kept[1].append(y)
    return np.concatenate(kept[0]), np.concatenate(kept[1])


def _groups(frame: pd.DataFrame) -> np.ndarray:
    """Where runs of rows with the same bucket and blocks begin, and the end."""
    keys = frame[["bucket", "_i", "_j"]].to_numpy()
    change = (keys[1:] != keys[:-1]).any(axis=1)
    return np.concatenate([[0], np.flatnonzero(change) + 1, [len(frame)]])


def _common(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sets."""
    if len(x) < 4 * len(sets):
        return np.array(
            [len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(x, y)], np.int64
        )
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(times > 1) - 1  # hashes of one set only meet nothing
    owner, place = owner[times[place] > 1], shared[place[times[place] > 1]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for a in range(0, int(place[-1]) + 1 if len(place) else 0, 4096):
        lo, hi = np.searchsorted(place, [a, a + 4096])
        holds = np.zeros((len(sets), 4096), np.float32)
        holds[owner[lo:hi], place[lo:hi] - a] = 1
        both += holds @ holds.T
    return both[x, y].astype(np.int64)


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One row for each row of `docs`: doc_id, text_md5, class_id, n_links, component_id, kept.

    class_id is the smallest doc_id with the same shingles, n_links the number of other
    documents with a similarity of at least `threshold`, component_id the smallest doc_id
    reachable by links; one document of each component is kept.
    """
    least, width = least_matches(threshold), band_values(threshold)
    rows = written(sketches(docs, width), "sketches")
    classes = written(
        rows.filter("set is not null")
        .groupBy("set")
        .agg(
            F.min(F.struct("_id", "_text")).alias("first"),
            F.count(F.lit(1)).alias("copies"),
            F.any_value("minhash").alias("minhash"),
            F.any_value("buckets").alias("buckets"),
        ),
        "classes",
    )
    members = classes.select("set", F.posexplode("buckets").alias("band", "bucket"))
    group = ["bucket", "_i", "_j"]

    def survivors(frames):
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            bounds = _groups(frame)
            rest = frame.iloc[bounds[-2] :].reset_index(drop=True)  # may go on in the next batch
            yield surviving(frame.iloc[: bounds[-2]], bounds[:-1])
        if rest is not None and len(rest):
            yield surviving(rest, _groups(rest))

    def surviving(frame: pd.DataFrame, bounds: np.ndarray) -> pd.DataFrame:
        if not len(frame):
            return frame[["set", "band", *group, "_own"]]
        x, y = _candidates(frame, bounds[:-1], np.diff(bounds), least, width)
        return frame.iloc[np.union1d(x, y)][["set", "band", *group, "_own"]]

    facts = classes.select("set", "minhash")
    met = written(
        block_pairs(members, "bucket", "set", BLOCK_ROWS)
        .join(facts, "set")
        .select("set", "band", *group, "_own", "minhash")
        .repartition(parallelism(docs.sparkSession), *group)
        .sortWithinPartitions(*group)
        .mapInPandas(survivors, "set binary, band int, bucket bigint, _i int, _j int, _own int"),
        "met",
    )
    wanted = classes.join(met.select("set").distinct(), "set").select("set", "first._id", "first._text")

    def verify(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("set", ignore_index=True)
        x, y = _candidates(frame, np.array([0]), np.array([len(frame)]), least, width)
        sets = [np.frombuffer(s, np.uint64) for s in frame["shingles"]]
        sizes = np.array([len(s) for s in sets])
        common = _common(sets, x, y)
        linked = common / (sizes[x] + sizes[y] - common) >= threshold
        x, y = x[linked], y[linked]
        copies = frame["copies"].to_numpy()
        links = np.bincount(x, copies[y], len(frame)) + np.bincount(y, copies[x], len(frame))
        label, some = local_labels(len(frame), x, y), links > 0
        names = frame["set"].to_numpy()
        return pd.DataFrame(
            {"set": names[some], "links": links[some].astype(np.int64), "label": names[label[some]]}
        )

    links = written(
        met.join(classes.select("set", "minhash", "copies"), "set")
        .join(shingles_of(docs, wanted).dropDuplicates(["set"]), "set")
        .groupBy(*group)
        .applyInPandas(verify, "set binary, links bigint, label binary"),
        "links",
    )
    total = links.groupBy("set").agg(F.sum("links").alias("links"))
    reach = components(links.select(F.col("set").alias("a"), F.col("label").alias("b")))
    linked = total.join(reach.withColumnRenamed("node", "set"), "set")
    known = classes.select("set", "first", "copies").join(linked, "set", "left")
    known = known.withColumn("component", F.coalesce("component", "set"))
    known = known.join(
        known.groupBy("component").agg(F.min("first").alias("smallest")), "component"
    ).select(
        "set",
        F.col("first._id").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        "smallest",
    )
    this = F.struct("_id", "_text")
    out = rows.select("_id", "_text", "set").join(known, "set", "left")
    repeats = F.row_number().over(Window.partitionBy("_id", "_text").orderBy(F.lit(0)))
    first = F.col("set").isNull() | ((F.col("smallest") == this) & (repeats == 1))
    low = F.lit(-(2**63)).cast("bigint")
    return out.select(
        F.nullif("_id", low).alias("doc_id"),
        F.col("_text").alias("text_md5"),
        F.nullif(F.coalesce("class_id", "_id"), low).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.nullif(F.coalesce("smallest._id", "_id"), low).alias("component_id"),
        first.alias("kept"),
    )


def keep_one(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The rows of `docs` without near-duplicates: one document of each component stays."""
    verdict = written(near_duplicates(docs, threshold), "verdict")
    keys = verdict.groupBy("doc_id", "text_md5").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum(F.col("kept").cast("int")).alias("_kept")
    )
    marked = docs.withColumn("_md5", F.md5(F.coalesce("text", F.lit(""))))

    def joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        right = right.select(F.col("doc_id").alias("_key"), "text_md5")
        same = left["doc_id"].eqNullSafe(right["_key"]) & (left["_md5"] == right["text_md5"])
        return left.join(right, same, how)

    out = joined(marked, keys.filter("_kept = 0"), "left_anti")
    again = keys.filter("_kept > 0 and _rows > _kept")  # rows that repeat id and text
    if not again.isEmpty():
        once = joined(out, again, "left_semi").dropDuplicates(["doc_id", "_md5"])
        out = joined(out, again, "left_anti").unionByName(once)
    return out.select(*docs.columns)

"""Random forests of gini trees over numbers and 0/1 columns of categories.

The result is a model of Spark ML. Its own trainer keeps each row as an integer a column and one a
tree, which is kilobytes where categories are hashed or one-hot, and looks at every column that a
node draws. Here a row is a byte for each number (its bin) and the names of the few columns that
are set; the rows of a node for which a column is not set are those of the node less those for
which it is.

Growth. All trees grow by a level at a time, in one job: each task walks its rows down the trees so
far and counts them by what splits may look at, the counts of a tree are added up, and each node
takes the split that gains most among a share of the columns drawn for it (the square root of their
number). Counts are whole numbers, so the order in which they are added up does not matter; the
weights of the classes come in afterwards.

Every tree sees each row as often as a Poisson draw of mean 1 says (from 16 bits each). Draws follow from
the seed, the tree and the portion that the row is written in, so that a level sees those of the
level before. Bins end at quantiles of all rows, as the library sets them on a sample.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.session import scratch, written

PORTION_ROWS = 65_536
GRID = 4_096  # quantiles that bins are made from
LARGEST_TABLE = 1 << 22  # entries of the places of columns by node, else they are searched
MOST_AT_ONCE = 64  # tasks whose counts of a tree are added up in one step
NEVER = 255  # no bin is above
_UNIFORM = (np.arange(1 << 16) + 0.5) / (1 << 16)
_TAKEN = 1 - math.exp(-1)  # share of rows that are drawn at all
# Steps from one of them to the next, and how often one is drawn, each by a uniform number.
_STEPS = np.ceil(np.log1p(-_UNIFORM) / math.log1p(-_TAKEN)).astype(np.uint8)
_TIMES = 1 + np.searchsorted(
    np.cumsum([math.exp(-1) / math.factorial(k) / _TAKEN for k in range(1, 12)]), _UNIFORM
).astype(np.uint8)


def drawn(n: int, *seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of n rows are taken, with replacement, and how often."""
    source = np.random.PCG64(seed)
    most = int(n * _TAKEN + 4 * math.sqrt(n)) + 16
    rows = np.array([], np.int64)
    while not len(rows) or rows[-1] < n:
        raw = source.random_raw(-(-most // 4)).view(np.uint16)
        rows = np.concatenate([rows, np.cumsum(_STEPS.take(raw), dtype=np.int64) + (rows[-1] if len(rows) else -1)])
    rows = rows[: np.searchsorted(rows, n)]
    raw = source.random_raw(-(-len(rows) // 4)).view(np.uint16)
    return rows, _TIMES.take(raw[: len(rows)]).astype(float)


# --- bins --------------------------------------------------------------------------------


def cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Where bins of about as many of the values end: between values that differ."""
    distinct, n = np.unique(values, return_counts=True)
    between = distinct[:-1] / 2 + distinct[1:] / 2
    between = np.where((between >= distinct[:-1]) & (between < distinct[1:]), between, distinct[:-1])
    if len(distinct) <= bins:
        return between
    share = len(values) / bins
    held, want, out = np.cumsum(n), share, []
    for i in range(1, len(distinct)):
        if abs(held[i - 1] - want) < abs(held[i] - want):
            out.append(between[i - 1])
            want += share
    return np.array(out[: bins - 1])


def all_cuts(rows: DataFrame, numeric: tuple[str, ...], bins: int) -> list[np.ndarray]:
    """Of each number, from quantiles of all rows."""
    if not numeric:
        return []
    grid = [i / GRID for i in range(GRID + 1)]
    numbers = rows.select(*[F.col(c).cast("double").alias(c) for c in numeric])
    return [cuts(np.array(q), bins) for q in numbers.approxQuantile(list(numeric), grid, 0.5 / GRID)]


# --- portions ----------------------------------------------------------------------------


def _entries(vectors: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and value of what dense and sparse vectors hold."""
    kind, _, indices, values = vectors.flatten()
    sizes = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    columns = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    sparse = np.repeat(kind.to_numpy(zero_copy_only=False) == 0, sizes)
    columns[sparse] = indices.flatten().to_numpy(zero_copy_only=False)
    return rows, columns, values.flatten().to_numpy(zero_copy_only=False)


def coded(vectors: pa.StructArray, ends: list[np.ndarray], encoded: int, places: int):
    """Bins of the numbers, filled up to whole words, and the columns that are set, each row's in front."""
    n, numbers = len(vectors), len(ends)
    rows, columns, values = _entries(vectors)
    bins = np.zeros((n, -(-numbers // 4) * 4), np.uint8)
    for j, cut in enumerate(ends):
        found, at = np.zeros(n), columns == encoded + j
        found[rows[at]] = values[at]
        bins[:, j] = np.searchsorted(cut, found)
    at = (columns < encoded) & (values != 0)
    rows, columns = rows[at], columns[at]
    sizes = np.bincount(rows, minlength=n)
    held = np.full((n, places), encoded, np.min_scalar_type(encoded + 1))
    held[rows, np.arange(len(rows)) - (np.cumsum(sizes) - sizes)[rows]] = columns
    return bins, held


def portions(rows: DataFrame, label: str, ends, encoded: int, places: int) -> DataFrame:
    """Rows of `features` and a class, behind each other in arrays: portion, n, bins, held, classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, n, nth = [], 0, TaskContext.get().partitionId() << 32
        for batch in _and_end(batches):
            if batch is not None and batch.num_rows:
                bins, held = coded(batch.column("features"), ends, encoded, places)
                kept.append((bins, held, batch.column("class").to_numpy().astype(np.int32)))
                n += batch.num_rows
            if n >= PORTION_ROWS or (batch is None and n):
                parts = [[np.concatenate(x).tobytes()] for x in zip(*kept)]
                arrays = [[nth], [n], *parts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, t) for a, t in zip(arrays, [pa.int64(), pa.int64(), *[pa.binary()] * 3])],
                    ["portion", "n", "bins", "held", "classes"],
                )
                kept, n, nth = [], 0, nth + 1

    wanted = rows.select("features", F.col(label).cast("int").alias("class"))
    return wanted.mapInArrow(run, "portion bigint, n bigint, bins binary, held binary, classes binary")


def _and_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


# --- a level -----------------------------------------------------------------------------


class Layout:
    """Where the counts of one tree stand: bins by class of each number that a node drew, set rows by
    class of each column that it drew, and all rows by class."""

    def __init__(self, drew: np.ndarray, encoded: int, bins: int, classes: int):
        number = drew >= encoded
        self.numbers, self.columns = np.argwhere(number), np.argwhere(~number)  # node, nth drawn
        self.number = drew[number] - encoded
        self.column = drew[~number]
        self.cell = bins * classes
        self.columns_at = len(self.numbers) * self.cell
        self.nodes_at = self.columns_at + len(self.columns) * classes
        self.size = self.nodes_at + len(drew) * classes


def count_level(portion: tuple, tree: tuple, level: int, layout: Layout, classes: int, encoded: int) -> np.ndarray:
    """The counts of one portion for one tree. `tree`: its number, seeds, bins and columns that split
    nodes by number, and the place of each node among those that grow (-1 where it doesn't)."""
    nth, words, cells, held, labels = portion
    number, seed, above, column, grows = tree
    if seed:
        rows, weight = drawn(len(labels), *seed, number, nth)
    else:
        rows, weight = np.arange(len(labels)), np.ones(len(labels))
    held = [h.take(rows) for h in held]
    node = np.ones(len(rows), np.intp)
    if level:
        words = [w.take(rows) for w in words]
    for _ in range(level):
        wanted = column.take(node)
        right = np.zeros(len(rows), bool)
        for h in held:
            right |= h == wanted
        for w, limits in zip(words, above):
            over = w.view(np.uint8) > limits.take(node).view(np.uint8)
            right |= over.view(np.uint32) != 0
        node <<= 1
        node += right
    place = grows.take(node)
    if place.min(initial=0) < 0:
        kept = np.flatnonzero(place >= 0)
        rows, place, weight, held = rows[kept], place[kept], weight[kept], [h[kept] for h in held]
    y = labels.take(rows)
    out = np.bincount(place * classes + (y + layout.nodes_at), weight, layout.size + layout.cell)
    n_nodes = (layout.size - layout.nodes_at) // classes

    def add(at: np.ndarray, more: Callable[[np.ndarray], np.ndarray], many: bool) -> None:
        """Counts what stands at `at`, by `more`; what no node drew ends behind the layout."""
        nonlocal out
        if many:
            key, n = at + more(slice(None)), weight
        else:
            some = np.flatnonzero(at < layout.size)
            key, n = at[some] + more(some), weight[some]
        out += np.bincount(key, n, len(out))

    for j in np.unique(layout.number):
        mine = np.flatnonzero(layout.number == j)
        begins = np.full(n_nodes, layout.size, np.int64)
        begins[layout.numbers[mine, 0]] = mine * layout.cell
        add(begins.take(place), lambda some: cells[j].take(rows[some]), 8 * len(mine) > n_nodes)
    if len(layout.column):
        pairs = layout.columns[:, 0] * (encoded + 1) + layout.column
        begins = layout.columns_at + np.arange(len(pairs)) * classes
        width = n_nodes * (encoded + 1)
        place *= encoded + 1
        if width <= LARGEST_TABLE:
            table = np.full(width, layout.size, np.int32)
            table[pairs] = begins
        else:
            order = np.argsort(pairs)
            pairs, begins = pairs[order], begins[order]
        for h in held:
            key = place + h
            if width <= LARGEST_TABLE:
                at = table.take(key)
            else:
                near = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
                at = np.where(pairs[near] == key, begins[near], layout.size)
            add(at, y.__getitem__, 8 * len(pairs) > width)
    return out[: layout.size]


def gini(counts: np.ndarray) -> np.ndarray:
    """Of the weights of the classes on the last axis."""
    total = np.maximum(counts.sum(-1, keepdims=True), 1e-300)
    return 1 - np.square(counts / total).sum(-1)


def best_splits(counts: np.ndarray, layout: Layout, drew: np.ndarray, class_weights: np.ndarray):
    """Of each node: rows by class, which of the drawn columns gains most, its last bin on the left, the
    gain (0 where none does), and the rows on the left."""
    classes = len(class_weights)
    total = counts[layout.nodes_at :].reshape(-1, classes)

    def gains(left, nodes):
        all_of = total[nodes].reshape(len(nodes), *[1] * (left.ndim - 2), classes)
        right = all_of - left
        a, b, t = left * class_weights, right * class_weights, all_of * class_weights
        share = a.sum(-1) / np.maximum(t.sum(-1), 1e-300)
        found = gini(t) - share * gini(a) - (1 - share) * gini(b)
        return np.where((left.sum(-1) >= 1) & (right.sum(-1) >= 1), found, 0.0)

    gain = np.zeros(drew.shape)
    last = np.zeros(drew.shape, np.int64)
    left = np.zeros((*drew.shape, classes))
    if len(layout.numbers):
        nodes, nth = layout.numbers.T
        cells = counts[: layout.columns_at].reshape(len(nodes), -1, classes)
        below = np.cumsum(cells, 1)[:, :-1]
        found = gains(below, nodes)
        best, every = found.argmax(1), np.arange(len(nodes))
        gain[nodes, nth], last[nodes, nth], left[nodes, nth] = found[every, best], best, below[every, best]
    if len(layout.columns):
        nodes, nth = layout.columns.T
        unset = total[nodes] - counts[layout.columns_at : layout.nodes_at].reshape(-1, classes)
        gain[nodes, nth], left[nodes, nth] = gains(unset, nodes), unset
    best, every = gain.argmax(1), np.arange(len(drew))
    return total, best, last[every, best], gain[every, best], left[every, best]


# --- a forest ----------------------------------------------------------------------------


class Trees:
    """All trees as arrays by number and node; node i has the children 2 i and 2 i + 1, the root is 1."""

    def __init__(self, trees: int, depth: int, classes: int):
        shape = trees, 2 << depth
        self.feature = np.full(shape, -1, np.int64)  # -1: a leaf, or no node at all
        self.last = np.zeros(shape, np.int64)
        self.gain = np.full(shape, -1.0)
        self.rows = np.zeros((*shape, classes))


def _drawn_columns(columns: int, per_node: int, nodes: int, *seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return np.array([rng.choice(columns, per_node, replace=False) for _ in range(nodes)])


def grow(
    chunks: DataFrame,
    trees: int,
    depth: int,
    numbers: int,
    encoded: int,
    bins: int,
    class_weights: np.ndarray,
    per_node: int,
    seed: int,
    bagged: bool,
) -> Trees:
    """The trees, a level a job. What the driver gets of a level is one row a node."""
    out = Trees(trees, depth, len(class_weights))
    classes, columns = len(class_weights), encoded + numbers
    growing = {t: np.array([1]) for t in range(trees)}
    for level in range(max(depth, 1)):
        drew = {
            t: _drawn_columns(columns, per_node, len(nodes), t, level, seed)
            for t, nodes in growing.items()
        }
        for t, row in _level(chunks, out, growing, drew, level, numbers, encoded, bins, class_weights, (seed,) if bagged else ()):
            nodes = growing[t]
            total, best, last, gain, left = row
            out.rows[t, nodes] = total
            some = np.flatnonzero(gain > 0) if level < depth else np.array([], np.int64)
            parents = nodes[some]
            out.feature[t, parents] = drew[t][some, best[some]]
            out.last[t, parents], out.gain[t, parents] = last[some], gain[some]
            out.rows[t, 2 * parents] = left[some]
            out.rows[t, 2 * parents + 1] = total[some] - left[some]
            children = np.sort(np.concatenate([2 * parents, 2 * parents + 1]))
            mixed = gini(out.rows[t, children] * class_weights) > np.finfo(float).eps
            growing[t] = children[mixed]
        growing = {t: nodes for t, nodes in growing.items() if len(nodes)}
        if not growing:
            break
    return out


def _level(chunks, trees: Trees, growing, drew, level, numbers, encoded, bins, class_weights, seed):
    """Tree and `best_splits` of each tree that grows."""
    classes, n_nodes = len(class_weights), 2 << level
    words = -(-numbers // 4)
    kind = np.min_scalar_type(encoded + 1)

    def limits(t):
        """Bins by word and node that go to the right beyond, and the column that does where it is set."""
        nodes = np.flatnonzero(trees.feature[t, :n_nodes] >= 0)
        feature = trees.feature[t, nodes]
        above = np.full((n_nodes, words * 4), NEVER, np.uint8)
        of_number = feature >= encoded
        above[nodes[of_number], feature[of_number] - encoded] = trees.last[t, nodes[of_number]]
        column = np.full(n_nodes, encoded + 1, kind)
        column[nodes[~of_number]] = feature[~of_number]
        grows = np.full(n_nodes, -1, np.int64)
        grows[growing[t]] = np.arange(len(growing[t]))
        return list(np.ascontiguousarray(above.view(np.uint32).T)), column, grows

    shared = chunks.sparkSession.sparkContext.broadcast([(t, *limits(t), drew[t]) for t in growing])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(*tree, Layout(tree[-1], encoded, bins, classes)) for tree in shared.value]
        sums, part = None, TaskContext.get().partitionId() % groups
        for batch in batches:
            for row in batch.to_pylist():
                n = row["n"]
                of_bins = np.frombuffer(row["bins"], np.uint8).reshape(n, words * 4)
                set_columns = np.frombuffer(row["held"], kind).reshape(n, -1)
                labels = np.frombuffer(row["classes"], np.int32).astype(np.int64)
                portion = (
                    row["portion"],
                    list(np.ascontiguousarray(of_bins.view(np.uint32).T)) if words else [],
                    [of_bins[:, j] * np.int64(classes) + labels for j in range(numbers)],
                    list(np.ascontiguousarray(set_columns.T)),
                    labels,
                )
                sums = sums or [0] * len(held)
                for i, (t, above, column, grows, _, layout) in enumerate(held):
                    tree = t, seed, above, column, grows
                    sums[i] = sums[i] + count_level(portion, tree, level, layout, classes, encoded)
        for (t, *_), found in zip(held, sums or []):
            yield pa.RecordBatch.from_arrays(
                [pa.array([t], pa.int32()), pa.array([part], pa.int32()), pa.array([found.tobytes()])],
                ["tree", "part", "counts"],
            )

    def added(table: pa.Table) -> np.ndarray:
        return np.sum([np.frombuffer(b) for b in table.column("counts").to_pylist()], axis=0)

    def add(table: pa.Table) -> pa.Table:
        return table.slice(0, 1).set_column(2, "counts", pa.array([added(table).tobytes()]))

    def split(key: tuple, table: pa.Table) -> pa.Table:
        t = key[0].as_py()
        chosen = next(x[-1] for x in shared.value if x[0] == t)
        found = best_splits(added(table), Layout(chosen, encoded, bins, classes), chosen, class_weights)
        return pa.table([pa.array([t], pa.int32()), *[[np.ravel(x).astype(float).tobytes()] for x in found]], names)

    tasks = chunks.rdd.getNumPartitions()
    groups = math.isqrt(tasks) if tasks > MOST_AT_ONCE else 1
    columns = "tree int, part int, counts binary"
    names = ["tree", "total", "best", "last", "gain", "left"]
    schema = "tree int, " + ", ".join(f"{n} binary" for n in names[1:])
    counted = chunks.mapInArrow(count, columns)
    if groups > 1:
        counted = counted.groupBy("tree", "part").applyInArrow(add, columns)
    rows = counted.groupBy("tree").applyInArrow(split, schema).collect()
    shared.unpersist()
    for r in rows:
        total, best, last, gain, left = (np.frombuffer(r[n]) for n in names[1:])
        yield r["tree"], (
            total.reshape(-1, classes), best.astype(np.int64), last.astype(np.int64), gain, left.reshape(-1, classes),
        )


def _nodes(trees: Trees, t: int, class_weights: np.ndarray, ends: list[np.ndarray], encoded: int) -> list[dict]:
    """Nodes of a tree as the library writes them, a node in front of its children. Leaves of one parent
    that decide alike are one, as there."""
    feature = trees.feature[t].copy()
    stats = trees.rows[t] * class_weights
    decides = stats.argmax(1)
    for i in np.flatnonzero(feature >= 0)[::-1]:
        if feature[2 * i] < 0 and feature[2 * i + 1] < 0 and decides[2 * i] == decides[2 * i + 1]:
            feature[i] = -1
    impurity = gini(stats)
    out = []

    def add(i: int) -> int:
        f, place = int(feature[i]), len(out)
        out.append(
            {
                "id": place,
                "prediction": float(decides[i]),
                "impurity": float(impurity[i]),
                "impurityStats": stats[i].tolist(),
                "rawCount": int(trees.rows[t, i].sum()),
                "gain": -1.0,
                "leftChild": -1,
                "rightChild": -1,
                "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1},
            }
        )
        if f >= 0:
            end = 0.5 if f < encoded else float(ends[f - encoded][trees.last[t, i]])
            out[place]["split"] = {"featureIndex": f, "leftCategoriesOrThreshold": [end], "numCategories": -1}
            out[place] |= {"gain": float(trees.gain[t, i]), "leftChild": add(2 * i), "rightChild": add(2 * i + 1)}
        return place

    add(1)
    return out


_NODE = pa.struct(
    [
        ("id", pa.int32()),
        ("prediction", pa.float64()),
        ("impurity", pa.float64()),
        ("impurityStats", pa.list_(pa.float64())),
        ("rawCount", pa.int64()),
        ("gain", pa.float64()),
        ("leftChild", pa.int32()),
        ("rightChild", pa.int32()),
        (
            "split",
            pa.struct(
                [
                    ("featureIndex", pa.int32()),
                    ("leftCategoriesOrThreshold", pa.list_(pa.float64())),
                    ("numCategories", pa.int32()),
                ]
            ),
        ),
    ]
)
_OF_FORESTS_ONLY = {"bootstrap", "featureSubsetStrategy", "leafCol", "numTrees", "subsamplingRate"}


def as_model(
    spark, trees: Trees, forest: RandomForestClassifier, class_weights, ends, encoded: int
) -> RandomForestClassificationModel:
    """A model with the settings of `forest`, by way of the form that the library saves models in."""
    path = scratch(spark, "forest")
    forest.write().save(f"{path}/settings")
    said = json.loads(spark.read.text(f"{path}/settings/metadata").first()[0])
    package = "org.apache.spark.ml.classification"
    n_trees, classes, columns = len(trees.feature), len(class_weights), encoded + len(ends)
    whole = said | {
        "class": f"{package}.RandomForestClassificationModel",
        "numFeatures": columns,
        "numClasses": classes,
        "numTrees": n_trees,
    }
    one = said | {"class": f"{package}.DecisionTreeClassificationModel"}
    for params in ("paramMap", "defaultParamMap"):
        one[params] = {k: v for k, v in said[params].items() if k not in _OF_FORESTS_ONLY}
    each = [(t, json.dumps(one | {"uid": f"{said['uid']}_{t}"}), 1.0) for t in range(n_trees)]
    held = [(t, node) for t in range(n_trees) for node in _nodes(trees, t, class_weights, ends, encoded)]
    numbers, nodes = zip(*held)
    data = pa.table({"treeID": pa.array(numbers, pa.int32()), "nodeData": pa.array(nodes, _NODE)})
    spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/model/metadata")
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").write.parquet(f"{path}/model/treesMetadata")
    spark.createDataFrame(data).write.parquet(f"{path}/model/data")
    return RandomForestClassificationModel.load(f"{path}/model")


def columns_per_node(forest: RandomForestClassifier, columns: int) -> int:
    """As the library draws them where it is left to choose: all for a single tree."""
    return columns if forest.getNumTrees() == 1 else math.ceil(math.sqrt(columns))


def fit_forest(
    rows: DataFrame,
    forest: RandomForestClassifier,
    numeric: tuple[str, ...],
    places: int,
    weight: str | None = None,
) -> RandomForestClassificationModel:
    """The forest of rows whose `features` are 0/1 columns, at most `places` of them set, and behind
    them the `numeric` ones. Rows of a class have one weight."""
    label = forest.getLabelCol()
    of_class = F.col(weight) if weight else F.lit(1.0)
    sizes = rows.groupBy(F.col(label).cast("double").alias("y")).agg(
        F.min(of_class).alias("low"), F.max(of_class).alias("high")
    ).collect()
    if not sizes:
        raise ValueError("a forest needs training rows")
    if any(r["y"] is None or r["y"] < 0 or r["y"] != int(r["y"]) or r["low"] != r["high"] for r in sizes):
        raise ValueError(f"{label} must be a class from 0 on, and rows of a class must weigh the same")
    class_weights = np.zeros(max(int(r["y"]) for r in sizes) + 1)
    for r in sizes:
        class_weights[int(r["y"])] = r["low"]
    encoded = rows.select("features").first()[0].size - len(numeric)
    bins = forest.getMaxBins()
    ends = all_cuts(rows, numeric, bins)
    chunks = written(portions(rows, label, ends, encoded, places), "forest-rows")
    trees = grow(
        chunks,
        forest.getNumTrees(),
        forest.getMaxDepth(),
        len(numeric),
        encoded,
        bins,
        class_weights,
        columns_per_node(forest, encoded + len(numeric)),
        forest.getSeed() % (1 << 63),
        forest.getBootstrap() and forest.getNumTrees() > 1,
    )
    return as_model(rows.sparkSession, trees, forest, class_weights, ends, encoded)

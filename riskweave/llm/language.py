"""Language identification by interpolated Kneser-Ney models of characters.

Texts are reduced to lower-case letters with single blanks between words. For every
language, n-grams of four characters are counted on its training texts; counts of shorter
ones are continuation counts, the number of different characters seen in front. Each
order's discounted estimate is interpolated with that of the order below, down to a uniform
one. The finished probabilities and back-off weights of all languages stand in arrays sorted
by hash. A text belongs to the language with the lowest cross-entropy a character; how far
ahead it is gives a score, calibrated on training texts kept aside, below which a
prediction can be rejected.

All training texts are counted, whole. What is broadcast is bounded: of each order at most
KEPT_GRAMS n-grams of all languages keep an estimate of their own, the most frequent of each
language; the others get that of the order below by the back-off weight, so that probabilities
still sum to one. The curve of the score is fitted with models that leave out a tenth of the
texts, on about CALIBRATION_ROWS of that tenth; the models that score count it as well.
Whole texts are scored.

Defined results: `und` with score 0 if the text is NULL or has no letter, or if nothing
was learned. Ties go to the language that comes first by name.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import map_rows, mix64, portions, runs, small_batches
from riskweave.llm.linear import calibrate, sigmoid
from riskweave.session import written

ORDER = 4
KEPT_GRAMS = 1_000_000  # of an order, over all languages
TALLIED = 250_000  # n-grams that a task counts before it hands them on
CALIBRATION_ROWS = 5_000
UNDETERMINED = "und"
_BASE = 0x9E3779B97F4A7C15


def _letters(codes: np.ndarray) -> np.ndarray:
    """The code points with a blank for everything but letters and marks."""
    used = np.flatnonzero(np.bincount(codes))
    kept = [c for c in used.tolist() if unicodedata.category(chr(c))[0] in "LM"]
    table = np.full(used[-1] + 1 if len(used) else 1, 32, np.uint32)
    table[kept] = kept
    return table[codes]


def reduced(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the reduced texts in a row, and for each the number of its text.

    Each text begins with ORDER - 1 blanks and ends with one.
    """
    parts = [t.lower() for t in texts]
    codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _letters(codes)
    owner = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
    # A blank stays only behind a letter of the same text.
    keep = codes != 32
    keep[1:] |= (codes[:-1] != 32) & (owner[1:] == owner[:-1])
    codes, owner = codes[keep], owner[keep]
    ends = np.searchsorted(owner, np.arange(len(texts)), side="right")
    starts = np.searchsorted(owner, np.arange(len(texts)))
    open_end = (ends > starts) & (codes[np.maximum(ends, 1) - 1] != 32) if len(codes) else ends > starts
    place = np.concatenate([np.repeat(starts, ORDER - 1), ends[open_end]])
    whose = np.concatenate([np.repeat(np.arange(len(texts)), ORDER - 1), np.flatnonzero(open_end)])
    order = np.lexsort((np.r_[np.zeros(len(texts) * (ORDER - 1)), np.ones(open_end.sum())], whose, place))
    # Blanks in front of a text and behind the one before it share a place; by owner they sort.
    place, whose = place[order], whose[order]
    return np.insert(codes, place, np.uint32(32)), np.insert(owner, place, whose)


def gram_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """For each position the hash of the `size` characters that end there."""
    h = np.zeros(len(codes), np.uint64)
    for back in range(size):
        factor = np.uint64(pow(_BASE, back, 1 << 64))
        h[back:] += (codes[: len(codes) - back].astype(np.uint64) + np.uint64(1)) * factor
    return mix64(h + np.uint64(size))


def _grams(codes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Positions at which ORDER characters of one text end, the last of them one that counts."""
    at = np.arange(ORDER - 1, len(codes))
    return at[owner[at] == owner[at - ORDER + 1]]


class _Tally:
    """Counts of n-grams, sorted by hash, with their code points."""

    def __init__(self):
        self.keys, self.n = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.codes = np.empty((0, ORDER), np.uint32)

    def add(self, texts: list[str]) -> None:
        codes, owner = reduced(texts)
        at = _grams(codes, owner)
        keys, first, n = np.unique(gram_hashes(codes, ORDER)[at], return_index=True, return_counts=True)
        grams = codes[at[first][:, None] + np.arange(1 - ORDER, 1)]
        n = np.concatenate([self.n, n])
        self.keys, first, place = np.unique(
            np.concatenate([self.keys, keys]), return_index=True, return_inverse=True
        )
        self.codes = np.concatenate([self.codes, grams])[first]
        self.n = np.bincount(place, n, len(first)).astype(np.int64)

    def grams(self) -> list[str]:
        text = self.codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        return [text[i : i + ORDER] for i in range(0, len(text), ORDER)]


def gram_counts(rows: DataFrame) -> DataFrame:
    """lang, gram and n: how often each n-gram of ORDER characters stands in the texts.

    Rows with a column `aside` are counted apart by it.
    """
    keys = ["lang", *(c for c in ("aside",) if c in rows.columns)]
    types = {"lang": pa.string(), "aside": pa.bool_()}

    def handed_on(tallies):
        for key, tally in tallies.items():
            same = {c: pa.array([v] * len(tally.n), types[c]) for c, v in zip(keys, key)}
            yield pa.RecordBatch.from_pydict({**same, "gram": tally.grams(), "n": tally.n})

    def run(batches):
        tallies: dict[tuple, _Tally] = {}
        for batch in batches:
            for part in portions(batch):
                texts: dict[tuple, list[str]] = {}
                columns = [part.column(c).to_pylist() for c in (*keys, "text")]
                for *key, text in zip(*columns):
                    texts.setdefault(tuple(key), []).append(text or "")
                for key, mine in texts.items():
                    for a, b in runs([len(t) for t in mine]):
                        tallies.setdefault(key, _Tally()).add(mine[a:b])
                if sum(len(t.n) for t in tallies.values()) > TALLIED:
                    yield from handed_on(tallies)
                    tallies = {}
        yield from handed_on(tallies)

    small_batches(rows.sparkSession)
    return (
        rows.select(*keys, "text")
        .mapInArrow(run, f"{'lang string, aside boolean' if keys[1:] else 'lang string'}, gram string, n bigint")
        .groupBy(*keys, "gram")
        .agg(F.sum("n").alias("n"))
    )


def _rank(n: Column) -> Column:
    """Grows with a count, in steps of an eighth of a doubling."""
    return F.floor(8 * F.log2(n)).cast("int")


def _rank_counts(levels: list[DataFrame]) -> list[dict[str, dict[int, int]]]:
    """By order and language, how many n-grams have each rank: at most 512 an order and language."""
    found: list[dict[str, dict[int, int]]] = [{} for _ in levels]
    ranks = [
        level.groupBy("lang", _rank(F.col("n")).alias("rank")).count().withColumn("order", F.lit(k))
        for k, level in enumerate(levels)
    ]
    for r in reduce(DataFrame.unionAll, ranks).collect():
        found[r["order"]].setdefault(r["lang"], {})[r["rank"]] = r["count"]
    return found


def _least_ranks(langs: dict[str, dict[int, int]]) -> dict[str, int]:
    """By language the lowest rank whose n-grams are kept, KEPT_GRAMS of an order at most.

    Languages have equal shares; what one leaves of its own is shared out among the others.
    """
    room, least = KEPT_GRAMS, {}
    by_size = sorted(langs, key=lambda g: (sum(langs[g].values()), g))
    for done, lang in enumerate(by_size):
        share, held = room // (len(langs) - done), 0
        least[lang] = max(langs[lang]) + 1
        for rank, n in sorted(langs[lang].items(), reverse=True):
            if held + n > share:
                break
            held, least[lang] = held + n, rank
        room -= held
    return least


def _of_lang(values: dict[str, float]) -> Column:
    """A number by language: a literal, not a join."""
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[F.col("lang")]


def _discount(ranks: dict[int, int]) -> float:
    """From how many n-grams stand once (rank 0) and twice (rank 8)."""
    once, twice = ranks.get(0, 0), ranks.get(8, 0)
    return min(max(once / (once + 2 * twice) if once else (0.0 if twice else 0.5), 0.1), 0.95)


def kneser_ney(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Probabilities (lang, gram, p) and back-off weights (lang, context, weight), all orders,
    of the n-grams that are kept; the discount of any other is its whole count."""
    levels = [counts]
    for _ in range(ORDER - 1):
        shorter = levels[-1].groupBy("lang", F.expr("substring(gram, 2)").alias("gram"))
        levels.append(written(shorter.agg(F.count(F.lit(1)).alias("n")), "shorter-grams"))
    levels = levels[::-1]  # from single characters upwards
    ranks = _rank_counts(levels)
    symbols = _of_lang({g: float(sum(r.values()) + 1) for g, r in ranks[0].items()})
    below = None
    found, weights = [], []
    for level, langs in zip(levels, ranks):
        discount = _of_lang({g: _discount(r) for g, r in langs.items()})
        rows = level.withColumns(
            {
                "context": F.expr("substring(gram, 1, length(gram) - 1)"),
                "kept": _rank(F.col("n")) >= _of_lang(_least_ranks(langs)),
                "_d": discount,
            }
        )
        mass = F.max("_d") * F.count_if("kept") + F.sum(F.when(F.col("kept"), 0).otherwise(F.col("n")))
        whole = rows.groupBy("lang", "context").agg(
            F.sum("n").alias("_total"),
            (mass / F.sum("n")).alias("weight"),
            F.bool_or("kept").alias("_some"),
        )
        whole = written(whole, "contexts")
        rows = rows.join(whole, ["lang", "context"])
        if below is None:
            rows = rows.withColumn("_low", 1.0 / symbols)
        else:
            low = below.select("lang", F.col("gram").alias("_tail"), F.col("p").alias("_low"))
            rows = rows.withColumn("_tail", F.expr("substring(gram, 2)")).join(low, ["lang", "_tail"])
        own = F.when(F.col("kept"), F.col("n") - F.col("_d")).otherwise(0.0) / F.col("_total")
        below = written(
            rows.select("lang", "gram", (own + F.col("weight") * F.col("_low")).alias("p"), "kept"),
            "grams",
        )
        found.append(below.filter("kept").drop("kept"))
        # A context without kept n-grams leaves all to the order below: its weight is 1.
        weights.append((whole.filter("_some") if weights else whole).select("lang", "context", "weight"))
    first = weights[0].select(
        "lang", "context", (F.col("weight") / symbols).alias("weight")
    )  # what an unknown character gets
    p, w = found[0], first
    for a, b in zip(found[1:], weights[1:]):
        p, w = p.unionAll(a), w.unionAll(b)
    return p, w


def _sorted_arrays(rows: pa.Table, name: str, value: str, langs: list[str], missing: float):
    """By length of the gram: its hashes in order, and a row of logarithms by language."""
    out = {}
    sizes = pc.utf8_length(rows.column(name)).to_numpy()
    logs = np.log(rows.column(value).to_numpy())
    which = pc.index_in(rows.column("lang"), pa.array(langs)).to_numpy()
    for size in np.unique(sizes):
        mine = np.flatnonzero(sizes == size)
        own = pa.concat_arrays(rows.column(name).take(pa.array(mine)).cast(pa.large_string()).chunks)
        text = own.buffers()[2].to_pybytes()[: pc.sum(pc.binary_length(own)).as_py()].decode("utf-8") if size else ""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        hashes = gram_hashes(codes, size)[size - 1 :: size] if size else np.zeros(len(mine), np.uint64)
        keys, place = np.unique(hashes, return_inverse=True)
        table = np.full((len(keys), len(langs)), missing, np.float32)
        table[place, which[mine]] = logs[mine]
        out[int(size)] = keys, table
    return out


class Model:
    def __init__(self, langs: list[str], grams: dict, weights: dict, slope: float, shift: float):
        self.langs, self.grams, self.weights = langs, grams, weights
        self.slope, self.shift = slope, shift

    @staticmethod
    def _rows(arrays: tuple[np.ndarray, np.ndarray], hashes: np.ndarray, missing: float) -> np.ndarray:
        keys, table = arrays
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        out = table[at]
        out[keys[at] != hashes] = missing
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each text its cross-entropy by language (nats a character), and its characters."""
        codes, owner = reduced(texts)
        at = _grams(codes, owner)
        _, first, place = np.unique(
            gram_hashes(codes, ORDER)[at], return_index=True, return_inverse=True
        )
        end = at[first]
        # From the shortest order up: what a language has seen replaces the estimate from
        # below, anything else costs the context's back-off weight.
        logs = np.broadcast_to(self.weights[0][1], (len(end), len(self.langs))).copy()
        for size in range(1, ORDER + 1):
            if size - 1 in self.weights and size > 1:
                context = gram_hashes(codes, size - 1)[end - 1]
                logs += self._rows(self.weights[size - 1], context, 0.0)
            if size in self.grams:
                seen = self._rows(self.grams[size], gram_hashes(codes, size)[end], np.nan)
                logs = np.where(np.isnan(seen), logs, seen)
        size = np.bincount(owner[at], minlength=len(texts))
        total = np.stack(
            [np.bincount(owner[at], logs[place, k], len(texts)) for k in range(len(self.langs))], axis=1
        )
        return -total / np.maximum(size, 1)[:, None], size

    def ahead(self, entropy: np.ndarray, size: np.ndarray) -> np.ndarray:
        """How far the best language is ahead of the next, growing with the text's length."""
        if entropy.shape[1] < 2:
            return np.full(len(entropy), 1.0)
        two = np.partition(entropy, 1, axis=1)
        return (two[:, 1] - two[:, 0]) * np.sqrt(size)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.langs:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        entropy, size = self.entropies(texts)
        score = sigmoid(self.slope * self.ahead(entropy, size) + self.shift)
        best = np.argmin(entropy, axis=1)
        # Marks belong to words, but alone they are no letters.
        letters = np.array([any(map(str.isalpha, t)) for t in texts], bool)
        found = [self.langs[b] if n else UNDETERMINED for b, n in zip(best, letters)]
        return found, np.where(letters, score, 0.0)


def _estimated(counts: DataFrame) -> Model:
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not langs:
        return Model([], {}, {}, 1.0, 0.0)
    p, weight = kneser_ney(counts)
    return Model(
        langs,
        _sorted_arrays(p.toArrow(), "gram", "p", langs, np.nan),
        _sorted_arrays(weight.toArrow(), "context", "weight", langs, 0.0),
        1.0,
        0.0,
    )


def fit(rows: DataFrame, seed: int = 9) -> Model:
    """A model of the rows (text, lang); rows without a language do not count."""
    # Folds go by the text, so that rows that share a doc_id or have none are drawn apart.
    fold = F.pmod(F.xxhash64(F.lit(seed + 1), "text"), F.lit(10))
    rows = (
        rows.filter("lang is not null and text is not null")
        .select("text", "lang")
        .withColumn("aside", fold == 0)
    )
    counts = written(gram_counts(rows), "gram-counts")
    model = _estimated(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    if model.langs:
        trial = _estimated(counts.filter("not aside").drop("aside"))
        model.slope, model.shift = _curve(rows.filter("aside").drop("aside"), trial, seed)
    return model


def _curve(aside: DataFrame, model: Model, seed: int) -> tuple[float, float]:
    """Slope and shift of the score, by texts that the model has not counted."""
    if not model.langs:
        return 1.0, 0.0
    spark = aside.sparkSession
    aside = aside.filter(F.col("lang").isin(model.langs))
    chance = F.pmod(F.xxhash64(F.lit(seed), "text"), F.lit(1_000_000)) / F.lit(1e6)
    # Equal texts are drawn together, so they count once.
    aside = aside.filter(chance < CALIBRATION_ROWS / max(aside.count(), 1)).distinct()
    shared = _share(spark, model)

    def make():
        own = Model(*shared.value)

        def work(c):
            entropy, size = own.entropies(c["text"])
            best = [own.langs[b] for b in np.argmin(entropy, axis=1)]
            return {
                "right": [float(a == b) for a, b in zip(best, c["lang"])],
                "ahead": own.ahead(entropy, size),
                "size": size,
            }

        return work

    tried = (
        map_rows(aside.select("text", "lang"), make, "right double, ahead double, size bigint")
        .filter("size > 0")
        .toArrow()
    )
    shared.unpersist()
    if tried.num_rows:
        slope, shift = calibrate(tried.column("ahead").to_numpy(), tried.column("right").to_numpy())
        if slope > 0:
            return slope, shift
    return 1.0, 0.0


def _share(spark, model: Model):
    return spark.sparkContext.broadcast(
        (model.langs, model.grams, model.weights, model.slope, model.shift)
    )


def identify(docs: DataFrame, model: Model, reject_below: float = 0.5) -> DataFrame:
    """doc_id, lang_pred and score of every row of `docs`; `und` where the score is too low."""
    shared = _share(docs.sparkSession, model)

    def make():
        own = Model(*shared.value)

        def work(c):
            found, score = own.predict(c["text"])
            kept = [g if s >= reject_below else UNDETERMINED for g, s in zip(found, score)]
            return {"doc_id": c["doc_id"], "lang_pred": kept, "score": score}

        return work

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_rows(rows, make, "doc_id bigint, lang_pred string, score double")

"""Mining of phrases by top-order marginalisation.

Texts are cut into pieces and words. Every word begins one window of LONGEST words, padded
where its piece ends. Only windows are counted; one shuffle brings those that share
their first words together. ROLLUP sums them over ever shorter prefixes: what is left of a window
without its last words is a shorter phrase, so all orders come from the counts of the top one.
A candidate is scored at its weakest cut, and dropped when a longer candidate explains at least
half of it.

Words that are rarer in a language than a candidate may be cannot be part of one; they end a window
like the end of a piece does, which changes no count that is asked for. The others become
numbers by a broadcast list, the most frequent first. The list has at most LISTED words. Where that
is not all of them, the words beyond it go by 62-bit hashes instead, which are
looked up by a join in the end; the hash is salted until no frequent word shares its own.

Defined results. NULL text is empty, NULL lang is `und`. Ties of cuts go to the shorter first
part; ranks have none, as phrases of a language differ. Repeated rows count as often as they
stand. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import parallelism, portions, small_batches
from riskweave.session import written

LONGEST = 3
LEAST = 10
EXPLAINED = 50  # percent of a candidate inside a longer one
LISTED = 1_000_000
TOP = 2_000
TALLIED = 1_000_000  # words or windows a task holds before it hands them on
SPREAD = 64  # tasks that look for the top phrases of a language
_BREAK = b"\xff"  # no byte of UTF-8
_CLEAN = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", _BREAK * 10 + b" ")


def words_of(text: str) -> list[bytes]:
    """The words of a text, with _BREAK between pieces. A-Z become lower case."""
    raw = text.encode("utf-8", "surrogatepass").lower().translate(_CLEAN)
    return raw.replace(_BREAK, b" \xff ").split(b" ")


def _by_language(batch: pa.RecordBatch) -> dict[str, list[str]]:
    """The texts of a batch by language."""
    out: dict[str, list[str]] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
        out.setdefault(lang, []).append(text or "")
    return out


def _texts(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    return docs.select(lang.alias("lang"), F.col("text").cast("string").alias("text"))


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word and n, counted in the tasks before the shuffle."""

    def run(batches):
        counts: dict[str, Counter] = {}

        def handed_on():
            for lang, c in counts.items():
                c.pop(_BREAK, None)
                c.pop(b"", None)
                words = pa.array(list(c), pa.binary()).cast(pa.string())
                langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(c), np.int64)))
                n = pa.array(list(c.values()), pa.int64())
                yield pa.RecordBatch.from_arrays([langs, words, n], ["lang", "word", "n"])

        for batch in batches:
            for part in portions(batch):
                for lang, texts in _by_language(part).items():
                    count = counts.setdefault(lang, Counter())
                    for text in texts:
                        count.update(words_of(text))
            if sum(map(len, counts.values())) > TALLIED:
                yield from handed_on()
                counts = {}
        yield from handed_on()

    found = _texts(docs).mapInArrow(run, "lang string, word string, n bigint")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n"))


PADDING, RARE, FIRST = 0, 1, 2  # numbers of no word; those of words begin at FIRST


class Numbers:
    """Words as numbers: from FIRST on by the list; any other word is RARE if the list is
    `whole`, else a negative hash."""

    def __init__(self, words: list[str], whole: bool, salt: bytes):
        self.of = {w.encode("utf-8", "surrogatepass"): i for i, w in enumerate(words, FIRST)}
        self.of[_BREAK] = PADDING
        self.of[b""] = -1  # what stands between two blanks
        self.whole, self.salt = whole, salt

    def __call__(self, words: list[bytes]) -> np.ndarray:
        get = self.of.get
        ids = np.fromiter((get(w, RARE) for w in words), np.int64, len(words))
        if not self.whole:
            for i in np.flatnonzero(ids == RARE).tolist():
                ids[i] = hashed(words[i], self.salt)
        return ids[ids != -1]


def hashed(word: bytes, salt: bytes) -> int:
    """As the column of that name: at most -2."""
    return -(xxhash.xxh64_intdigest(salt + word, seed=42) >> 2) - 2


def _hashed(word: Column, salt: bytes) -> Column:
    bits = F.xxhash64(F.concat(F.lit(salt.decode()), word))
    return -F.shiftrightunsigned(bits, 2) - F.lit(2)


def windows_of(ids: np.ndarray) -> np.ndarray:
    """For each word a row of LONGEST numbers: its own and those behind it, PADDING from the first
    that is no word on. All of the row is PADDING if the word itself is RARE."""
    columns = [np.where(ids == RARE, PADDING, ids)]
    for k in range(1, LONGEST):
        behind = np.concatenate([columns[0][k:], np.zeros(min(k, len(ids)), np.int64)])
        columns.append(np.where(columns[-1] == PADDING, PADDING, behind))
    return np.stack(columns, axis=1)[ids != PADDING]


def _counted(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and how often each stands."""
    known, place = np.unique(windows, return_inverse=True)
    bits = np.int64(max(1, int(len(known)).bit_length()))
    if bits * LONGEST > 62:
        return np.unique(windows, axis=0, return_counts=True)
    place = place.reshape(windows.shape)
    key = np.zeros(len(windows), np.int64)
    for k in range(LONGEST):
        key = (key << bits) | place[:, k]
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    return windows[first], n


def window_counts(docs: DataFrame, words: list[str], whole: bool, salt: bytes) -> DataFrame:
    """lang, w1, w2, w3 and n: windows counted by each task, not yet summed over tasks."""
    shared = docs.sparkSession.sparkContext.broadcast(words)
    names = ["lang", *(f"w{k + 1}" for k in range(LONGEST)), "n"]

    def run(batches):
        numbers = None
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def handed_on():
            for lang, parts in held.items():
                rows, n = _counted(np.concatenate(parts))
                langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(n), np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [langs, *(pa.array(rows[:, k]) for k in range(LONGEST)), pa.array(n)], names
                )

        for batch in batches:
            numbers = numbers or Numbers(shared.value, whole, salt)
            for part in portions(batch):
                for lang, texts in _by_language(part).items():
                    # A text ends its last piece.
                    found = [w for t in texts for w in (*words_of(t), _BREAK)]
                    held.setdefault(lang, []).append(windows_of(numbers(found)))
                    size += len(held[lang][-1])
            if size > TALLIED:
                yield from handed_on()
                held, size = {}, 0
        yield from handed_on()

    columns = ", ".join(f"{c} {'string' if c == 'lang' else 'bigint'}" for c in names)
    return _texts(docs).mapInArrow(run, columns)


def phrase_counts(windows: DataFrame, least: int) -> DataFrame:
    """lang, w1, w2, w3, n and size: how often each phrase of up to three words stands. Those of
    two or three words only from `least` on; size 0 is the language as a whole.

    One shuffle brings windows with the same first two words together; what is too rare to be
    asked for becomes padding there, before ROLLUP.
    """
    n = parallelism(windows.sparkSession)
    rows = (
        windows.repartition(n, "lang", "w1", "w2")
        .groupBy("lang", "w1", "w2", "w3")
        .agg(F.sum("n").alias("n"))
    )
    pair = F.sum("n").over(Window.partitionBy("lang", "w1", "w2"))
    kept = rows.withColumn("_pair", pair).select(
        "lang",
        "w1",
        F.when(F.col("_pair") >= least, F.col("w2")).otherwise(PADDING).alias("w2"),
        F.when(F.col("n") >= least, F.col("w3")).otherwise(PADDING).alias("w3"),
        "n",
    )
    sums = kept.rollup("lang", "w1", "w2", "w3").agg(
        F.sum("n").alias("n"), F.grouping_id().alias("_without")
    )
    size = sum(
        F.when(F.col("_without") < (1 << k), 1).otherwise(0) for k in range(LONGEST)
    )
    last = F.coalesce("w3", "w2", "w1")
    return (
        sums.withColumn("size", size)
        .filter(F.col("lang").isNotNull() & ((F.col("size") == 0) | (last != PADDING)))
        .drop("_without")
    )


def _score(l: str, r: str) -> Column:
    def exact(c: str) -> str:
        return f"cast({c} as decimal(15,0))"

    return F.expr(
        f"cast(1000000 as decimal(7,0)) * {exact('a')} * {exact('a')} div ({exact(l)} * {exact(r)})"
    )


def _weakest(rows: DataFrame, cuts: list[tuple[str, str]]) -> DataFrame:
    """l, r and score of the cut that scores lowest; ties go to the first of them."""
    found = [
        F.struct(_score(l, r).alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r"))
        for k, (l, r) in enumerate(cuts)
    ]
    best = found[0] if len(found) == 1 else F.least(*found)
    return rows.withColumn("_cut", best).select(
        "lang", "w1", "w2", "w3", "a", "_cut.l", "_cut.r", "_cut.score"
    )


def candidates(phrases: DataFrame, explained: int) -> DataFrame:
    """lang, w1, w2, w3 (PADDING for phrases of two), a, l, r, score; without those that a longer
    one explains to `explained` percent."""

    def counts(size: int, columns: dict[str, str], name: str) -> DataFrame:
        return phrases.filter(F.col("size") == size).select(
            "lang", *[F.col(w).alias(as_) for w, as_ in columns.items()], F.col("n").alias(name)
        )

    def ones(word: str, name: str) -> DataFrame:
        return counts(1, {"w1": word}, name)

    def twos(first: str, second: str, name: str) -> DataFrame:
        return counts(2, {"w1": first, "w2": second}, name)

    three = counts(3, {"w1": "w1", "w2": "w2", "w3": "w3"}, "a")
    longer = three.select("lang", "w1", "w2", "a").unionAll(three.select("lang", "w2", "w3", "a"))
    longer = longer.groupBy("lang", "w1", "w2").agg(F.max("a").alias("_longer"))
    keys = ["lang", "w1", "w2"]
    two = twos("w1", "w2", "a").join(longer, keys, "left")
    own = F.coalesce(100 * F.col("_longer") >= explained * F.col("a"), F.lit(False))
    two = (
        two.filter(~own)
        .withColumn("w3", F.lit(PADDING).cast("bigint"))
        .join(ones("w1", "_x"), ["lang", "w1"])
        .join(ones("w2", "_y"), ["lang", "w2"])
    )
    three = (
        three.join(ones("w1", "_x"), ["lang", "w1"])
        .join(twos("w2", "w3", "_yz"), ["lang", "w2", "w3"])
        .join(twos("w1", "w2", "_xy"), ["lang", "w1", "w2"])
        .join(ones("w3", "_z"), ["lang", "w3"])
    )
    return _weakest(two, [("_x", "_y")]).unionByName(
        _weakest(three, [("_x", "_yz"), ("_xy", "_z")])
    )


def _free_salt(rest: DataFrame, least: int) -> bytes:
    """A salt under which no frequent word of a language shares its hash with another word."""
    for salt in (b"", b"\n1", b"\n2", b"\n3"):
        shared = rest.groupBy("lang", _hashed(F.col("word"), salt)).agg(
            F.count(F.lit(1)).alias("_words"), F.max("n").alias("_most")
        )
        if shared.filter((F.col("_words") > 1) & (F.col("_most") >= least)).isEmpty():
            return salt
    raise ValueError("words share hashes under every salt")


def phrases(
    docs: DataFrame,
    least: int = LEAST,
    explained: int = EXPLAINED,
    top: int | None = TOP,
    listed: int = LISTED,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` phrases of each language (None: all), by
    score, then count a, then the phrase itself."""
    spark = docs.sparkSession
    counts = written(word_counts(docs), "words")
    frequent = counts.filter(F.col("n") >= least).groupBy("word").agg(F.sum("n").alias("n"))
    whole = frequent.count() <= listed
    chosen = frequent if whole else frequent.orderBy(F.desc("n"), "word").limit(listed)
    words = [r["word"] for r in chosen.select("word").toLocalIterator()]  # at most `listed`
    numbered = spark.createDataFrame(
        pa.table({"number": pa.array(range(FIRST, FIRST + len(words)), pa.int64()), "word": pa.array(words, pa.string())})
    )
    salt = b""
    if not whole:
        rest = written(counts.join(numbered, "word", "left_anti"), "unlisted-words")
        salt = _free_salt(rest, least)
        others = rest.filter(F.col("n") >= least).select(
            _hashed(F.col("word"), salt).alias("number"), "word"
        )
        numbered = numbered.unionByName(others.distinct())
    numbered = written(numbered, "numbers")
    found = written(phrase_counts(window_counts(docs, words, whole, salt), least), "phrases")
    rows = candidates(found, explained)
    for k in range(1, LONGEST + 1):
        name = numbered.select(F.col("number").alias(f"w{k}"), F.col("word").alias(f"_{k}"))
        rows = rows.join(name, f"w{k}", "left" if k > 2 else "inner")
    rows = rows.select(
        "lang", F.concat_ws(" ", "_1", "_2", "_3").alias("phrase"), "a", "l", "r", "score"
    )
    best = [F.desc("score"), F.desc("a"), "phrase"]
    if top is not None:
        # The best of each share first, so that no task sorts all phrases of a language.
        share = F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))
        place = F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*best))
        rows = rows.withColumn("_share", share).withColumn("_place", place)
        rows = rows.filter(F.col("_place") <= top).drop("_share", "_place")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best))
    rows = rows.withColumn("rank", rank.cast("bigint"))
    if top is not None:
        rows = rows.filter(F.col("rank") <= top)
    total = found.filter("size = 0").select("lang", F.col("n"))
    return rows.join(F.broadcast(total), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )

"""Packing of tokenised documents into windows, planned by non-negative least squares.

Documents longer than the window are cut at multiples of it; what is left of each is one
piece. Others are cut only to fill a window that nothing else fits in. The plan needs only how many pieces there are of each length:

1. Lengths are put in bins, and every way to fill the window exactly with up to three bins
   is listed. Repeat counts that reproduce the histogram best come from non-negative least
   squares; they are rounded down.
2. What the rounded counts leave over is packed greedily, on exact lengths: the longest
   piece, then again and again the longest that still fits, and in the end a cut one,
   repeated as often as the histogram allows.

A plan row says: pieces of this length with ranks in this range go to these sequences at
this offset. Ranks come from counts by length and hash, in as many buckets as the length has
pieces for, so no length is sorted in one task.

Defined results: NULL and empty texts consist of the end id alone. Repeated rows and ids are
packed each for itself; equal lengths are told apart by a hash, in no order that means
anything. Columns other than doc_id and text are not read, so their names cannot clash. The plan has at most
about a hundred thousand rows whatever the input, as the window bounds the lengths.
"""

from __future__ import annotations

import os
import string
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import map_rows
from riskweave.session import written

BIN = 16
RUN_CHARS = 2_000_000  # texts handled at a time; the more, the more of their words are the same
KNOWN_WORDS = 250_000  # Latin words a task remembers; then it starts anew
CRUMB = 64  # no cut leaves a part shorter than this
RANK_ROWS = 100_000  # pieces of one length that are ranked in one task, about


class WordTokenizer:
    """Ids by a tokenizer whose pre-tokens never span blanks or line ends.

    Such a tokenizer gives a text the ids of its words in a row, so each distinct word of a
    batch is encoded once. Latin words, with marks behind them, are lower-cased here and sent
    through the model alone, without the slow normaliser and patterns; a run of marks is a
    pre-token of its own. Apostrophes may begin an ending and "<" a special token, so those
    are no marks. Latin words are remembered, up to a bound, without their capitals and marks.
    """

    LATIN = r"\A[A-Za-zÀ-ÖØ-öø-ÿ]+"
    MARKS = string.punctuation.replace("'", "").replace("<", "")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        self.whole = self.full.normalizer, self.full.pre_tokenizer
        self.plain = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        size = self.full.get_vocab_size()
        self.ends_word = np.array(
            [(self.full.id_to_token(i) or "").endswith("</w>") for i in range(size)]
        )
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.ends = np.empty(0, np.uint32), np.empty(0, np.int64)

    def _learn(self, words: list[str]) -> None:
        """Latin words in lower case: their numbers, their ids in a row and where each one's end."""
        missing = [w for w in words if w not in self.known]
        if len(self.known) + len(missing) > KNOWN_WORDS:
            self._forget()
            missing = words
        if not missing:
            return
        self.full.normalizer, self.full.pre_tokenizer = None, self.plain
        [got] = self.full.encode_batch_fast([" ".join(missing)], add_special_tokens=False)
        self.full.normalizer, self.full.pre_tokenizer = self.whole
        ids = np.array(got.ids, np.uint32)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(missing):
            raise ValueError("the vocabulary has no word ends; words cannot be told apart")
        self.known.update(zip(missing, range(len(self.known), len(self.known) + len(missing))))
        self.ends = np.concatenate([self.ends, len(self.ids) + ends])
        self.ids = np.concatenate([self.ids, ids])

    def _units(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The two units of each word, the ids of all units in a row and where each unit's end.

        Units are Latin words, then other words and runs of marks, the empty one among them.
        """
        cores = pc.utf8_rtrim(words, characters=self.MARKS)
        plain = pc.match_substring_regex(cores, f"{self.LATIN}\\z")
        latin = pc.utf8_lower(cores.filter(plain)).dictionary_encode()
        lower = latin.dictionary.to_pylist()
        self._learn(lower)
        numbers = np.fromiter(map(self.known.__getitem__, lower), np.int64, len(lower))
        marked = pc.and_(plain, pc.not_equal(words, cores))
        marks = pc.replace_substring_regex(words.filter(marked), self.LATIN, "").dictionary_encode()
        rest = ["", *marks.dictionary.to_pylist(), *words.filter(pc.invert(plain)).to_pylist()]

        known = len(self.ends)
        units = np.full((len(words), 2), known, np.int64)
        plain, marked = (m.to_numpy(zero_copy_only=False) for m in (plain, marked))
        units[plain, 0] = numbers[latin.indices.to_numpy()]
        units[marked, 1] = known + 1 + marks.indices.to_numpy()
        units[~plain, 0] = known + 1 + len(marks.dictionary) + np.arange((~plain).sum())
        more = [self.full.encode(w, add_special_tokens=False).ids for w in rest]
        behind = len(self.ids) + np.cumsum([len(m) for m in more])
        flat = np.fromiter((i for m in more for i in m), np.uint32)
        return units, np.concatenate([self.ids, flat]), np.concatenate([self.ends, behind])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """For each text its ids."""
        blanks = pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " ")
        split = pc.split_pattern(blanks, " ")
        words = split.flatten().dictionary_encode()
        of_word, ids, ends = self._units(words.dictionary)
        begins = np.concatenate([[0], ends[:-1]])
        units = of_word[words.indices.to_numpy()].ravel()
        sizes = (ends - begins)[units]
        stops = np.concatenate([[0], np.cumsum(sizes)])
        # Each unit's ids, moved to where the unit stands in the texts.
        row = ids[np.repeat(begins[units] - stops[:-1], sizes) + np.arange(stops[-1])]
        pa.default_memory_pool().release_unused()  # workers of other stages stay beside this one
        return np.split(row, stops[2 * split.offsets.to_numpy()[1:-1]]) if texts else []


def tokenise(docs: DataFrame, tokenizer_file: str, end_id: int, window: int) -> DataFrame:
    """Pieces of the tokenised documents: row, doc_id, doc_tokens, start, length, ids.

    `row` numbers the documents; `ids` are 16-bit if the vocabulary allows, else 32-bit.
    """

    def make():
        tokenizer = WordTokenizer(tokenizer_file)
        narrow = max(tokenizer.full.get_vocab_size(), end_id + 1) <= 1 << 16
        last = np.uint32(end_id)

        def work(c):
            out = {n: [] for n in ("row", "doc_id", "doc_tokens", "start", "length", "ids")}
            for row, doc_id, ids in zip(c["row"], c["doc_id"], tokenizer.encode(c["text"])):
                ids = np.append(ids, last)
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    out["row"].append(row)
                    out["doc_id"].append(doc_id)
                    out["doc_tokens"].append(len(ids))
                    out["start"].append(start)
                    out["length"].append(len(piece))
                    out["ids"].append(piece.astype("<u2" if narrow else "<u4").tobytes())
            return out

        return work

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint"), "text"
    )
    return map_rows(
        rows,
        make,
        "row bigint, doc_id bigint, doc_tokens bigint, start bigint, length int, ids binary",
        RUN_CHARS,
    )


def combinations(bins: int) -> np.ndarray:
    """All ways to write `bins` as a sum of one to three bins, as count columns."""
    found = [(bins,)]
    found += [(a, bins - a) for a in range(1, bins // 2 + 1)]
    found += [
        (a, b, bins - a - b)
        for a in range(1, bins // 3 + 1)
        for b in range(a, (bins - a) // 2 + 1)
    ]
    out = np.zeros((bins, len(found)))
    for k, parts in enumerate(found):
        for p in parts:
            out[p - 1, k] += 1
    return out


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int) -> np.ndarray:
    """min |ax - b| with x >= 0: columns enter by steepest descent and leave at zero.

    Ends where no column would still gain a thousandth, as counts are rounded anyway.
    """
    x = np.zeros(a.shape[1])
    active: list[int] = []
    gain = 1e-3 + 1e-6 * float(np.abs(b).max())
    for _ in range(rounds):
        slope = a.T @ (b - a[:, active] @ x[active])
        slope[active] = -np.inf
        enter = int(np.argmax(slope))
        if slope[enter] <= gain:
            break
        active.append(enter)
        while True:
            part = a[:, active]
            square = part.T @ part + 1e-9 * np.eye(len(active))
            s = np.linalg.solve(square, part.T @ b)
            if (s > 0).all():
                x[:] = 0
                x[active] = s
                break
            now, low = x[active], s <= 0
            step = min((v / (v - t) for v, t, bad in zip(now, s, low) if bad), default=0.0)
            moved = np.maximum(now + step * (s - now), 0)
            drop = low & (moved <= gain * 1e-3)
            drop[np.argmin(np.where(low, moved, np.inf))] = True
            x[:] = 0
            active = [k for k, gone in zip(active, drop) if not gone]
            x[active] = moved[~drop]
            if enter not in active:  # rounding; nothing is gained by it any more
                return x
    return x


class _Plan:
    """Hands out the pieces of each length and notes where they go.

    Pieces alike are held as runs: [length of the piece, first rank, how many, start of the
    part], the part being what is left of the pieces after cuts.
    """

    def __init__(self, histogram: dict[int, int]):
        self.runs = {n: [[n, 0, c, 0]] for n, c in histogram.items() if c}
        self.sequences = 0
        self.rows: list[tuple[int, int, int, int, int, int, int]] = []

    def left(self, n: int) -> int:
        return sum(r[2] for r in self.runs.get(n, ()))

    def lengths(self) -> list[int]:
        return sorted(n for n, runs in self.runs.items() if runs)

    def _take(self, n: int, times: int, used: int, offset: int) -> None:
        """`times` parts of length n go, from their start to `used`, to the next sequences."""
        run = self.runs[n][0]
        whole, first, count, start = run
        self.rows.append((whole, first, first + times, start, used, self.sequences, offset))
        if used < n:
            self.runs.setdefault(n - used, []).append([whole, first, times, start + used])
        run[1], run[2] = first + times, count - times
        if not run[2]:
            self.runs[n].pop(0)

    def repeat(self, lengths: list[int], limit: int | None = None, cut: tuple[int, int] | None = None) -> int:
        """Sequences of these lengths, and of the first cut[1] ids of a part of length cut[0],
        as often as the runs at the front allow; returns how often."""
        uses = Counter([*lengths, *([cut[0]] if cut else [])])
        times = min(max(1, self.runs[n][0][2] // k) for n, k in uses.items())
        times = times if limit is None else min(times, limit)
        offset = 0
        for n in lengths:
            self._take(n, times, n, offset)
            offset += n
        if cut:
            self._take(cut[0], times, cut[1], offset)
        self.sequences += times
        return times


def plan(histogram: dict[int, int], window: int) -> tuple[list[tuple], int]:
    """Rows (length, first rank, rank behind the last, start and length of the part, first
    sequence, offset), and how many sequences they fill. No length is above the window."""
    p = _Plan(histogram)
    while p.left(window):
        p.repeat([window])
    bins = window // BIN
    by_bin: dict[int, list[int]] = {}  # longest first, so that little of a bin is lost
    for n in reversed(p.lengths()):
        by_bin.setdefault(-(-n // BIN), []).append(n)
    counts = np.array([sum(map(p.left, by_bin.get(b + 1, []))) for b in range(bins)], float)
    if counts.any():
        ways = combinations(bins)
        repeats = np.floor(nonnegative_least_squares(ways, counts, 3 * bins)).astype(np.int64)
        for k in np.argsort(-repeats, kind="stable"):
            if repeats[k] <= 0:
                break
            parts = [b + 1 for b in range(bins) for _ in range(int(ways[b, k]))]
            todo = int(repeats[k])
            while todo:
                taken: Counter[int] = Counter()
                for b in parts:
                    n = next((n for n in by_bin.get(b, []) if p.left(n) > taken[n]), None)
                    if n is None:
                        break
                    taken[n] += 1
                if taken.total() < len(parts):
                    break
                todo -= p.repeat(sorted(taken.elements(), reverse=True), todo)
    while lengths := p.lengths():
        taken, room = Counter(), window
        at = len(lengths) - 1
        while at >= 0:
            n = lengths[at]
            fit = min(p.left(n) - taken[n], room // n)
            taken[n] += fit
            room -= fit * n
            at = min(at - 1, bisect_right(lengths, room) - 1)
        # Nothing left fits whole: fill the room by a cut, unless it made a crumb.
        longest = next((n for n in reversed(lengths) if p.left(n) > taken[n]), 0)
        part = min(room, longest - CRUMB)
        cut = (longest, part) if part >= CRUMB else None
        p.repeat(sorted((+taken).elements(), reverse=True), cut=cut)
    return p.rows, p.sequences


def with_rank(pieces: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """Adds rank: a gapless number from 0 among the pieces of the same length, of which the
    histogram tells how many there are."""
    buckets = pieces.sparkSession.createDataFrame(  # a row for each length, a window at most
        [(n, -(-c // RANK_ROWS)) for n, c in histogram.items()], "length int, _buckets bigint"
    )
    bucket = F.pmod(F.xxhash64("row", "start"), F.col("_buckets"))
    rows = pieces.join(F.broadcast(buckets), "length").withColumn("_bucket", bucket).drop("_buckets")
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("length", "_bucket")
        .count()
        .select("length", "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy("length", "_bucket").orderBy("row", "start")
    return (
        rows.withColumn("_place", F.row_number().over(within) - 1)
        .join(offsets, ["length", "_bucket"])
        .withColumn("rank", F.col("_before") + F.col("_place"))
        .drop("_bucket", "_place", "_before")
    )


def pack(
    docs: DataFrame, tokenizer_file: str, end_id: int, window: int = 4096
) -> DataFrame:
    """One row a piece: doc_id, doc_tokens, start, length, ids, sequence_id, offset.

    `ids` are little-endian unsigned 32-bit numbers. Sequences are padded to the window.
    """
    if window % BIN:
        raise ValueError(f"the window must be a multiple of {BIN}")
    spark = docs.sparkSession
    pieces = written(tokenise(docs, tokenizer_file, end_id, window), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    rows, _ = plan(histogram, window)
    plan_rows = spark.createDataFrame(
        rows,
        "length int, _first bigint, _behind bigint, _part int, _ids int, _sequence bigint, offset bigint",
    )
    rank = F.col("rank")
    part = F.struct(
        "_part", "_ids", (F.col("_sequence") + rank - F.col("_first")).alias("sequence_id"), "offset"
    )
    placed = (
        with_rank(pieces.select("row", "start", "length"), histogram)
        .join(F.broadcast(plan_rows), "length")
        .filter((rank >= F.col("_first")) & (rank < F.col("_behind")))
        .groupBy("row", "start")
        .agg(F.collect_list(part).alias("_parts"))  # the parts of one piece, a window at most
    )

    def cut(batches):
        for batch in batches:
            out = {f.name: [] for f in arrow}
            for doc_id, tokens, start, n, data, parts in zip(*[c.to_pylist() for c in batch.columns]):
                ids = np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4").astype("<u4")
                for p in parts:
                    out["doc_id"].append(doc_id)
                    out["doc_tokens"].append(tokens)
                    out["start"].append(start + p["_part"])
                    out["length"].append(p["_ids"])
                    out["ids"].append(ids[p["_part"] : p["_part"] + p["_ids"]].tobytes())
                    out["sequence_id"].append(p["sequence_id"])
                    out["offset"].append(p["offset"])
            yield pa.RecordBatch.from_pydict(out, schema=arrow)

    number = pa.int64()
    arrow = pa.schema(
        [("doc_id", number), ("doc_tokens", number), ("start", number), ("length", number)]
        + [("ids", pa.binary()), ("sequence_id", number), ("offset", number)]
    )
    return (
        pieces.join(placed, ["row", "start"])
        .select("doc_id", "doc_tokens", "start", "length", "ids", "_parts")
        .mapInArrow(
            cut,
            "doc_id bigint, doc_tokens bigint, start bigint, length bigint, ids binary, "
            "sequence_id bigint, offset bigint",
        )
    )

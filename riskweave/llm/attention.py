"""Language-model scoring by causal self-attention, trained in numpy on subword ids.

A text is the row of its words, lower-cased in A-Z and cut at ASCII white space, and an end. Each
word, with a blank in front, becomes subword ids of a given byte-level tokenizer. The SYMBOLS - 2
most frequent ids of the training corpus have a symbol of their own; the others share one,
and within it go by their corpus frequency. A symbol is predicted as a class and a member of the
class. The network has one layer: token and place embeddings, masked attention, and a hidden layer,
both added to the embedding of the last token. As nothing comes in front of the attention,
queries, keys and values are sums of two table rows, so an overlap between windows costs a lookup.

Windows. Each scores STRIDE tokens and sees CONTEXT tokens in front of them, those of the window
before it, so that every token is scored once with at least that much context (or all there is).

Training. Word counts of all training texts, and so the counts of all ids, choose the symbols,
the shares of rare ones and the first biases. The weights are fitted on all training texts as well, cut
into shards of about SHARD_TOKENS; in each of ROUNDS rounds every shard fits a part of its pieces,
starting from the common weights (Adam), and their mean, summed up by Spark, starts the next round. Every
piece is used in one round, or in more where all texts together have fewer than LEAST_TOKENS.

Beside the model's score each text has that of smoothed word counts. The LISTED most frequent words
are broadcast with their counts and ids; the counts of the others come from a join. How often
such a word stands anywhere is bounded by their being rare.

Defined results. NULL and empty texts consist of the end alone. Words of more than LONG_WORD
characters become ids in portions of that many. If there are no training texts, nothing is known
and all symbols are alike. Repeated rows each count and each have a row in the result; rows alike in doc_id and
text teach in the same shard and round. Other columns are ignored.
"""

from __future__ import annotations

import base64
import ctypes
import math
from collections import Counter
from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import frequent, map_rows, portions, small_batches
from riskweave.session import written

LISTED = 200_000
LONG_WORD = 512
CLASSES = MEMBERS = 32
SYMBOLS = CLASSES * MEMBERS
END, RARE = 0, 1
WIDTH, HIDDEN = 32, 32
CONTEXT, STRIDE = 16, 32
SPAN = CONTEXT + STRIDE
LEAST_TOKENS = 2_000_000
SHARD_TOKENS = 4_000_000
ROUNDS = 3
PIECE = 32 * STRIDE  # tokens of a text that stay together in a shard
BATCH, LARGEST_BATCH = 32, 128  # windows of a step
STEPS = 325  # of a pass, before its steps take more than BATCH windows
KNOWN_WORDS = 200_000  # whose symbols a task remembers
RATE = 1e-2
ATTENDED_AT_ONCE, SCORED_AT_ONCE = 64, 256  # windows


def words_of(text: str) -> list[bytes]:
    """What stands between ASCII white space, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


class Subwords:
    """Ids of words by a byte-level tokenizer given as a file of ranks."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(t): int(n) for t, n in map(bytes.split, lines)}
        self.size = max(ranks.values()) + 1
        self.blank = np.zeros(self.size, bool)  # those that begin with a blank
        self.blank[[n for t, n in ranks.items() if t.startswith(b" ")]] = True
        self.of = tiktoken.Encoding(
            "subwords", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary

    def __call__(self, word: bytes) -> list[int]:
        text = " " + word.decode("utf-8", "replace")
        if len(text) <= LONG_WORD:
            return self.of(text)
        parts = (text[i : i + LONG_WORD] for i in range(0, len(text), LONG_WORD))
        return [i for part in parts for i in self.of(part)]

    def rows(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words as one array and where those of each begin in it. Words without blanks of
        any kind are encoded as one text, as no id reaches from one into the next."""
        texts = [w.decode("utf-8", "replace") for w in words]
        joined = "".join([" " + t for t in texts])
        if len(joined.split()) == len(words) and max(map(len, texts), default=0) < LONG_WORD:
            ids = np.array(self.of(joined), np.int32)
            begins = np.flatnonzero(self.blank[ids])
            if len(begins) == len(words):
                return ids, np.append(begins, len(ids))
        if len(words) <= 8:
            return _rows_of([self(w) for w in words])
        (a, at), (b, then) = self.rows(words[: len(words) // 2]), self.rows(words[len(words) // 2 :])
        return np.concatenate([a, b]), np.concatenate([at, then[1:] + len(a)])


def _rows_of(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists as one array and where each of them begins in it."""
    begins = np.cumsum([0, *map(len, lists)])
    flat = np.fromiter((i for one in lists for i in one), np.int32, int(begins[-1]))
    return flat, begins


# --- the network -------------------------------------------------------------------------


def new_weights(symbol_counts: np.ndarray, seed: int) -> dict[str, np.ndarray]:
    """Small random weights; the biases are the logarithms of the corpus frequencies."""
    rng = np.random.default_rng(seed)
    shapes = {
        "token": (SYMBOLS, WIDTH),
        "place": (SPAN, WIDTH),
        "query": (WIDTH, WIDTH),
        "key": (WIDTH, WIDTH),
        "value": (WIDTH, WIDTH),
        "up": (WIDTH, HIDDEN),
        "down": (HIDDEN, WIDTH),
        "class": (WIDTH, CLASSES),
        "member": (CLASSES, WIDTH, MEMBERS),
    }
    out = {n: rng.normal(0, 1 / math.sqrt(WIDTH), s).astype(np.float32) for n, s in shapes.items()}
    out["down"] *= 0.5
    out["class"] *= 0.3
    out["member"] *= 0.3
    out["up_bias"] = np.zeros(HIDDEN, np.float32)
    share = np.maximum(symbol_counts, 0.5).reshape(CLASSES, MEMBERS)
    out["class_bias"] = np.log(share.sum(1) / share.sum()).astype(np.float32)
    out["member_bias"] = np.log(share / share.sum(1, keepdims=True)).astype(np.float32)
    return out


_CAUSAL = np.where(
    np.arange(SPAN)[None, :] <= CONTEXT + np.arange(STRIDE)[:, None], 0.0, -1e9
).astype(np.float32)


def _exp(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials and their sums over the last axis; only where 32 bits do not
    hold them the largest is taken off first."""
    ones = np.ones(x.shape[-1], x.dtype)
    with np.errstate(over="ignore"):
        e = np.exp(x)
        total = e @ ones
    if not (np.isfinite(total).all() and total.all()):
        e = np.exp(x - x.max(-1, keepdims=True))
        total = e @ ones
    return e, total


class Tables:
    """What symbols and places give: query and embedding of an own place, key and value of any."""

    def __init__(self, w: dict[str, np.ndarray]):
        self.w = w
        scaled = w["query"] * w["query"].dtype.type(1 / math.sqrt(WIDTH))
        of = w["token"], w["place"][CONTEXT:]
        self.own = [np.hstack([x @ scaled, x]) for x in of]
        self.past = [np.hstack([x @ w["key"], x @ w["value"]]) for x in (w["token"], w["place"])]


def attended(t: Tables, inputs: np.ndarray, absent: np.ndarray) -> dict[str, np.ndarray]:
    """What the windows (symbols, and which places hold none) give for their last STRIDE places."""
    own = t.own[0].take(inputs[:, CONTEXT:], 0)
    own += t.own[1]
    past = t.past[0].take(inputs, 0)
    past += t.past[1]
    query, key, value = own[..., :WIDTH], past[..., :WIDTH], past[..., WIDTH:]
    scores = query @ key.transpose(0, 2, 1)
    scores += _CAUSAL
    begun = np.flatnonzero(absent[:, 0])  # what is absent stands in front
    if len(begun):
        scores[begun] += np.where(absent[begun], np.float32(-1e9), np.float32(0))[:, None, :]
    weights, total = _exp(scores)
    given = (weights @ value).reshape(-1, WIDTH)
    given /= total.reshape(-1, 1)
    base = own[..., WIDTH:].reshape(-1, WIDTH) + given
    up = base @ t.w["up"]
    up += t.w["up_bias"]
    np.maximum(up, 0, out=up)
    out = up @ t.w["down"]
    out += base
    return {
        "query": query, "key": key, "value": value, "weights": weights, "total": total,
        "given": given, "base": base, "up": up, "out": out,
    }


def _choices(w: dict[str, np.ndarray], out: np.ndarray, targets: np.ndarray) -> dict:
    """Exponentials of the classes and of the members of each target's class, with their sums.

    Places are in the order of their targets' classes, so that each class (c, a, b) is a slice.
    """
    kind = targets // MEMBERS
    order = np.argsort(kind.astype(np.int16), kind="stable")
    ends = np.cumsum(np.bincount(kind, minlength=CLASSES))
    slices = [(c, a, b) for c, (a, b) in enumerate(zip([0, *ends[:-1]], ends)) if b > a]
    rows = out.take(order, 0)
    logits = np.empty((2, len(rows), MEMBERS), out.dtype)
    np.matmul(rows, w["class"], out=logits[0])
    logits[0] += w["class_bias"]
    for c, a, b in slices:
        np.matmul(rows[a:b], w["member"][c], out=logits[1, a:b])
        logits[1, a:b] += w["member_bias"][c]
    e, total = _exp(logits)
    at = np.stack([kind, targets % MEMBERS])[:, order]
    chosen = np.take_along_axis(e, at[..., None], 2)[..., 0]
    logs = np.log(np.maximum(chosen, 1e-38) / total).sum(0)
    return {"order": order, "slices": slices, "rows": rows, "e": e, "total": total, "at": at, "logs": logs}


def log_probabilities(t: Tables, inputs, absent, targets) -> np.ndarray:
    """Natural logarithms, windows by STRIDE."""
    out = np.empty((targets.size, WIDTH), t.w["token"].dtype)
    for i in range(0, len(inputs), ATTENDED_AT_ONCE):
        some = slice(i, i + ATTENDED_AT_ONCE)
        out[i * STRIDE : (i + ATTENDED_AT_ONCE) * STRIDE] = attended(t, inputs[some], absent[some])["out"]
    found = _choices(t.w, out, targets.reshape(-1))
    logs = np.empty_like(found["logs"])
    logs[found["order"]] = found["logs"]
    return logs.reshape(targets.shape)


def _by_symbol(symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of the rows of each symbol."""
    order = np.argsort(symbols.astype(np.int16), kind="stable")
    held = symbols[order]
    first = np.flatnonzero(np.diff(held, prepend=-1))
    out = np.zeros((SYMBOLS, rows.shape[1]), rows.dtype)
    pairs = rows.take(order, 0).view(np.result_type(rows, np.complex64))  # two numbers at a time
    out[held[first]] = np.add.reduceat(pairs, first).view(rows.dtype)
    return out


def gradients(w: dict, inputs, absent, targets, counts) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss (nats a token) over the places that count, and its gradients.

    Queries, keys and values are linear in what tokens and places give, so their gradients are
    summed up by symbol and by place before they go through the weights.
    """
    t = Tables(w)
    f = attended(t, inputs, absent)
    g = {}
    weight = counts.reshape(-1).astype(w["token"].dtype)
    weight /= max(weight.sum(), 1)
    found = _choices(w, f["out"], targets.reshape(-1))
    order, slices, rows, p = (found[n] for n in ("order", "slices", "rows", "e"))
    weight = weight[order]
    loss = -(weight * found["logs"]).sum()
    p *= (weight / found["total"])[..., None]
    p[np.arange(2)[:, None], np.arange(len(rows)), found["at"]] -= weight
    g["class"], g["class_bias"] = rows.T @ p[0], p[0].sum(0)
    g["member"], g["member_bias"] = np.zeros_like(w["member"]), np.zeros_like(w["member_bias"])
    d = np.empty_like(rows)
    for c, a, b in slices:
        np.matmul(rows[a:b].T, p[1, a:b], out=g["member"][c])
        np.matmul(p[1, a:b], w["member"][c].T, out=d[a:b])
    g["member_bias"][[c for c, _, _ in slices]] = np.add.reduceat(p[1], [a for _, a, _ in slices])
    d += p[0] @ w["class"].T
    d_base = np.empty_like(d)
    d_base[order] = d
    g["down"] = f["up"].T @ d_base
    d_up = d_base @ w["down"].T
    d_up *= f["up"] > 0
    g["up"], g["up_bias"] = f["base"].T @ d_up, d_up.sum(0)
    d_base += d_up @ w["up"].T
    # The weights of the attention are left as they are, undivided by their sums.
    d_own = np.empty((len(inputs), STRIDE, 2 * WIDTH), d.dtype)
    d_past = np.empty((len(inputs), SPAN, 2 * WIDTH), d.dtype)
    d_own[..., WIDTH:] = d_base.reshape(-1, STRIDE, WIDTH)
    total = f["total"].reshape(-1, 1)
    d_given = d_base / total
    common = np.einsum("ij,ij->i", d_given, f["given"]).reshape(-1, STRIDE, 1)
    d_given = d_given.reshape(-1, STRIDE, WIDTH)
    np.matmul(f["weights"].transpose(0, 2, 1), d_given, out=d_past[..., WIDTH:])
    d_scores = d_given @ f["value"].transpose(0, 2, 1)
    d_scores -= common
    d_scores *= f["weights"]
    np.matmul(d_scores, f["key"], out=d_own[..., :WIDTH])
    np.matmul(d_scores.transpose(0, 2, 1), f["query"], out=d_past[..., :WIDTH])
    scale = w["query"].dtype.type(1 / math.sqrt(WIDTH))  # keys get it through the queries
    token, place = w["token"], w["place"]
    past = _by_symbol(inputs.reshape(-1), d_past.reshape(-1, 2 * WIDTH)), d_past.sum(0)
    own = _by_symbol(inputs[:, CONTEXT:].reshape(-1), d_own.reshape(-1, 2 * WIDTH)), d_own.sum(0)
    both = token.T @ past[0] + place.T @ past[1]
    g["key"], g["value"] = both[:, :WIDTH], both[:, WIDTH:]
    g["query"] = (token.T @ own[0][:, :WIDTH] + place[CONTEXT:].T @ own[1][:, :WIDTH]) * scale
    to_past = np.hstack([w["key"], w["value"]]).T
    to_own = np.vstack([w["query"].T * scale, np.eye(WIDTH, dtype=d.dtype)])
    g["token"] = past[0] @ to_past + own[0] @ to_own
    g["place"] = past[1] @ to_past
    g["place"][CONTEXT:] += own[1] @ to_own
    return float(loss), g


def _packed(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[n].ravel() for n in sorted(w)])


def _views(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for n in sorted(like):
        out[n] = flat[at : at + like[n].size].reshape(like[n].shape)
        at += like[n].size
    return out


def keep_freed_memory() -> None:
    """Arrays of a step take the room of the step before instead of asking the system for it anew,
    which takes longer than the arithmetic. At most 64 MB are kept."""
    mallopt = getattr(ctypes.CDLL(None), "mallopt", None)
    if mallopt:  # GNU C library: M_MMAP_THRESHOLD, M_TRIM_THRESHOLD
        mallopt(-3, 8 << 20)
        mallopt(-1, 64 << 20)


def fit_windows(w: dict, windows: tuple, seed: int, rate: float = RATE) -> dict:
    """Weights after one pass of Adam over the windows, in random order."""
    inputs, absent, targets, counts = windows
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(inputs))
    flat = _packed(w)
    w = _views(flat, w)
    first, second, grown = (np.zeros_like(flat) for _ in range(3))
    size = min(max(BATCH, len(order) // STEPS), LARGEST_BATCH)
    steps = [order[i : i + size] for i in range(0, len(order), size)]
    for step, at in enumerate(steps, 1):
        _, g = gradients(w, inputs[at], absent[at], targets[at], counts[at])
        now = rate * min(1, step / 20) * (1 - 0.9 * step / (len(steps) + 1))
        g = _packed(g)
        first += 0.1 * (g - first)
        g *= g
        g -= second
        g *= 0.01
        second += g
        np.divide(second, 1 - 0.99**step, out=grown)
        np.sqrt(grown, out=grown)
        grown += 1e-8
        np.divide(first, grown, out=grown)
        grown *= now / (1 - 0.9**step)
        flat -= grown
    return w


def windows_of(symbols: np.ndarray, begins: np.ndarray, skip: np.ndarray):
    """Windows over rows of symbols that stand one behind the other, row i from begins[i] to
    begins[i + 1]. The symbol in front of the first is END; the first skip[i] are context.

    Returns inputs, which places of them are absent, targets, which of them count, and the row
    of each window.
    """
    sizes = np.diff(begins) - skip
    per = -(-sizes // STRIDE)
    row = np.repeat(np.arange(len(sizes)), per)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
    start = begins[row] + skip[row] + nth * STRIDE  # the first target
    # Rows set apart by ENDs, so that each window is one stretch.
    gap = SPAN + 1
    apart = np.full(len(symbols) + gap * (len(begins) + 1), END, symbols.dtype)
    shift = gap * np.arange(1, len(begins))
    apart[np.arange(begins[0], begins[-1]) + np.repeat(shift, np.diff(begins))] = symbols[begins[0] : begins[-1]]
    stretches = np.lib.stride_tricks.sliding_window_view(apart, SPAN + 1)
    known = stretches[start + shift[row] - CONTEXT - 1]
    inputs, targets = known[:, :-1], known[:, 1 + CONTEXT :]
    # The place just in front of a row holds END.
    absent = np.arange(SPAN) < (begins[row] + CONTEXT - start)[:, None]
    counts = np.arange(STRIDE) < (begins[row + 1] - start)[:, None]
    return inputs, absent, targets, counts, row


# --- counting ----------------------------------------------------------------------------


def word_counts(docs: DataFrame, learns: Column) -> DataFrame:
    """word, n (in texts that teach) and n_all, counted in the tasks before the shuffle."""

    def run(batches):
        counts = Counter(), Counter()

        def handed_on():
            for i, c in enumerate(counts):
                words = pa.array(list(c), pa.binary()).cast(pa.string())
                n = pa.array(list(c.values()), pa.int64())
                zero = pa.array(np.zeros(len(c), np.int64))
                yield pa.RecordBatch.from_arrays([words, n if i else zero, n], ["word", "n", "n_all"])

        for batch in batches:
            for part in portions(batch):
                for teaches, text in zip(*[c.to_pylist() for c in part.columns]):
                    counts[bool(teaches)].update(words_of(text or ""))
            if sum(map(len, counts)) > 1_000_000:
                yield from handed_on()
                counts = Counter(), Counter()
        yield from handed_on()

    small_batches(docs.sparkSession)
    rows = docs.select(learns.alias("teaches"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(run, "word string, n bigint, n_all bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_all").alias("n_all"))


def id_counts(counts: DataFrame, subwords: Callable[[], Subwords]) -> np.ndarray:
    """How often each subword id stands in the training texts."""

    def run(batches):
        ids_of = None
        for batch in batches:
            ids_of = ids_of or subwords()
            words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            flat, begins = ids_of.rows([w.encode() for w in words])
            sums = np.bincount(flat, np.repeat(n, np.diff(begins)), ids_of.size)
            used = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), pa.array(sums[used].astype(np.int64))], ["id", "n"]
            )

    taught = counts.filter("n > 0").select("word", "n")
    found = taught.mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    rows = found.toArrow()  # at most one row an id
    out = np.zeros(subwords().size, np.int64)
    out[rows.column("id").to_numpy()] = rows.column("n").to_numpy()
    return out


class Symbols:
    """The symbol of each id, and the logarithm of an id's share in its symbol."""

    def __init__(self, counts: np.ndarray, texts: int):
        order = np.lexsort((np.arange(len(counts)), -counts))
        own, rest = order[: SYMBOLS - 2], order[SYMBOLS - 2 :]
        self.of = np.full(len(counts), RARE, np.int32)
        self.of[own] = np.arange(2, SYMBOLS)
        share = counts[rest] + 0.5
        self.log_share = np.zeros(len(counts), np.float32)
        self.log_share[rest] = np.log(share / share.sum())
        self.counts = np.concatenate([[texts, share.sum()], counts[own]])

    def of_words(self, flat: np.ndarray, begins: np.ndarray) -> list[bytes]:
        """The symbols of each word, as 16-bit numbers, from the ids of all."""
        held, at = self.of[flat].astype("<i2").tobytes(), (2 * begins).tolist()
        return [held[a:b] for a, b in zip(at, at[1:])]


# --- training ----------------------------------------------------------------------------


def _pieces(
    docs: DataFrame, symbols: Symbols, subwords, shards: int, uses: int, seed: int
) -> DataFrame:
    """Pieces of all texts, each for `uses` rounds: shard, round, symbols, and how many of them are
    context."""

    def make():
        ids_of, known = subwords(), {}
        end = np.array([END], "<i2").tobytes()

        def work(c):
            if len(known) > KNOWN_WORDS:
                known.clear()
            split = [words_of(t) for t in c["text"]]
            new = list({w for words in split for w in words} - known.keys())
            known.update(zip(new, symbols.of_words(*ids_of.rows(new))))
            out = {n: [] for n in ("shard", "round", "symbols", "skip")}
            for words, drawn in zip(split, c["drawn"]):
                all_of = b"".join(map(known.__getitem__, words)) + end
                place = np.random.default_rng([seed, drawn % (1 << 62)])
                for start in range(0, len(all_of) // 2, PIECE):
                    front = min(start, CONTEXT + 1)
                    shard, first = int(place.integers(shards)), int(place.integers(ROUNDS))
                    for use in range(uses):
                        out["shard"].append(shard)
                        out["round"].append((first + use) % ROUNDS)
                        out["symbols"].append(all_of[2 * (start - front) : 2 * (start + PIECE)])
                        out["skip"].append(front)
            return out

        return work

    drawn = F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), "text")
    rows = docs.select(F.col("text").cast("string").alias("text"), drawn.alias("drawn"))
    return map_rows(rows, make, "shard int, round int, symbols binary, skip int")


def _mean_of_shards(pieces: DataFrame, w: dict, round_no: int, shards: int, seed: int) -> dict:
    """The mean of the weights that the shards reach, by the tokens they have."""
    shared = pieces.sparkSession.sparkContext.broadcast(w)
    columns = "part int, tokens bigint, weights binary"

    def row(part: int, tokens: int, flat: np.ndarray) -> pa.Table:
        held = {"part": [part], "tokens": [tokens], "weights": [flat.astype("<f8").tobytes()]}
        return pa.table(held, pa.schema([("part", pa.int32()), ("tokens", pa.int64()), ("weights", pa.binary())]))

    groups = max(1, math.isqrt(shards))

    def fit(table: pa.Table) -> pa.Table:
        keep_freed_memory()
        # In a fixed order, so that a repeated task finds the same weights.
        held = sorted(zip(table.column("symbols").to_pylist(), table.column("skip").to_pylist()))
        rows = [np.frombuffer(b, "<i2").astype(np.int32) for b, _ in held]
        begins = np.cumsum([0, *map(len, rows)])
        skip = np.array([n for _, n in held])
        *windows, _ = windows_of(np.concatenate(rows), begins, skip)
        shard = table.column("shard")[0].as_py()
        tokens = int(windows[3].sum())
        done = fit_windows(shared.value, windows, seed + 1000 * round_no + shard)
        return row(shard % groups, tokens, _packed(done).astype(np.float64) * tokens)

    def added(table: pa.Table) -> pa.Table:
        flat = np.sum([np.frombuffer(b, "<f8") for b in sorted(table.column("weights").to_pylist())], axis=0)
        return row(0, sum(table.column("tokens").to_pylist()), flat)

    # By range, as shards of one size would meet in some tasks by hash.
    dealt = pieces.filter(F.col("round") == round_no).repartitionByRange(shards, "shard")
    fitted = dealt.groupBy("shard").applyInArrow(fit, columns)
    sums = fitted.groupBy("part").applyInArrow(added, columns).collect()  # a root of the shards
    shared.unpersist()
    if not sums:
        return w
    tokens = sum(r["tokens"] for r in sums)
    flat = np.sum([np.frombuffer(r["weights"], "<f8") for r in sorted(sums, key=lambda r: bytes(r["weights"]))], axis=0)
    return _views((flat / max(tokens, 1)).astype(np.float32), w)


class Model:
    """What scoring needs: the counts of all words as a table, the rest in memory."""

    def __init__(self, counts, words, totals, symbols, weights, subwords):
        self.counts, self.words, self.totals = counts, words, totals
        self.symbols, self.weights, self.subwords = symbols, weights, subwords


def _listed(rows: pa.Table, ids_of: Subwords) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Words behind each other, their counts, their ids, and where those of each begin."""
    words = [w.encode() for w in rows.column("word").to_pylist()]
    return b" ".join(words), rows.column("n").to_numpy(), *ids_of.rows(words)


def fit(docs: DataFrame, learns: Column, subwords: Callable[[], Subwords], seed: int = 13) -> Model:
    """Counts of all words of `docs` and a network fitted on texts for which `learns` holds."""
    texts = docs.filter(learns).count()
    counts = written(word_counts(docs, learns), "word-counts")
    n, distinct = counts.agg(F.sum("n"), F.count_if(F.col("n") > 0)).first()
    totals = (n or 0) + texts, distinct + bool(texts), texts
    listed = _listed(frequent(counts, "n_all", LISTED).select("word", "n").toArrow(), subwords())
    by_id = id_counts(counts, subwords)
    symbols = Symbols(by_id, texts)
    weights = new_weights(symbols.counts, seed)
    tokens = int(by_id.sum()) + texts
    if tokens:
        shards = max(1, round(tokens / SHARD_TOKENS))
        uses = min(ROUNDS, max(1, round(LEAST_TOKENS / tokens)))
        pieces = written(
            _pieces(docs.filter(learns), symbols, subwords, shards, uses, seed), "lm-pieces"
        )
        for round_no in range(ROUNDS):
            weights = _mean_of_shards(pieces, weights, round_no, shards, seed)
    return Model(counts, listed, totals, symbols, weights, subwords)


# --- scoring -----------------------------------------------------------------------------


class Scorer:
    """Scores texts in one task, from what is broadcast."""

    def __init__(self, words: tuple, totals, symbols: Symbols, weights, subwords):
        self.ids_of, self.symbols = subwords(), symbols
        self.tables = Tables(weights)
        listed, self.n, flat, begins = words
        self.number = dict(zip(listed.split(), range(len(self.n))))
        self.held, self.share = self._of_words(flat, begins)
        self.total, self.distinct, self.texts = totals

    def _of_words(self, flat: np.ndarray, begins: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """The symbols of words and the logarithms of their ids' shares in them."""
        whose = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
        share = np.bincount(whose, self.symbols.log_share[flat], len(begins) - 1)
        return self.symbols.of_words(flat, begins), share.astype(float)

    def log_base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + 0.5) / (self.total + 0.5 * (self.distinct + 1)))

    def __call__(self, texts: list[str]) -> dict[str, list]:
        split = [words_of(t) for t in texts]
        sizes = np.array([len(w) for w in split], np.int64)
        words = [w for one in split for w in one]
        number = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        owner = np.repeat(np.arange(len(texts)), sizes)
        listed = number >= 0
        n = self.n[number[listed]]
        at = owner[listed]
        known = np.bincount(at, n > 0, len(texts)) + (self.texts > 0)
        base = np.bincount(at, self.log_base(n), len(texts)) + self.log_base(np.array(self.texts))
        other = np.flatnonzero(~listed)
        new = {w: i for i, w in enumerate(dict.fromkeys(words[i] for i in other))}
        held, share = self._of_words(*self.ids_of.rows(list(new)))
        number[other] = [len(self.n) + new[words[i]] for i in other]
        rare: list[list[str]] = [[] for _ in texts]
        for i in other.tolist():
            rare[owner[i]].append(words[i].decode("utf-8", "replace"))
        return {
            "n_tokens": sizes + 1,
            "known": known.astype(np.int64),
            "base": base,
            "score": self._scores(number, sizes, self.held + held, np.concatenate([self.share, share])),
            "rare": rare,
        }

    def _scores(self, number, sizes, held, share) -> np.ndarray:
        """log10 probabilities of texts of so many words, that have these numbers, symbols and shares."""
        n_texts = len(sizes)
        parts = [held[i] for i in number.tolist()]
        end, ends = np.array([END], "<i2").tobytes(), np.cumsum(sizes)
        rows = [b"".join(parts[b - n : b]) + end for b, n in zip(ends.tolist(), sizes.tolist())]
        row_begins = np.cumsum([0, *map(len, rows)]) // 2
        symbols = np.frombuffer(b"".join(rows), "<i2").astype(np.int32)
        # Of nothing, bincount gives integers.
        owner = np.repeat(np.arange(n_texts), sizes)
        total = np.bincount(owner, share[number], n_texts).astype(float)
        for a in range(0, n_texts, 64):  # texts at a time, so that windows take little room
            b = min(a + 64, n_texts)
            total[a:b] += self._windows(symbols, row_begins[a : b + 1])
        return total / math.log(10)

    def _windows(self, symbols, begins) -> np.ndarray:
        n = len(begins) - 1
        out = np.zeros(n)
        low, high = begins[0], begins[-1]
        for a in range(low, high, 1 << 18):  # a long text goes in portions, with their context
            b = min(a + (1 << 18), high)
            inside = np.clip(begins, a, b)
            rows = np.flatnonzero(np.diff(inside))
            front = np.where(begins[rows] < a, CONTEXT + 1, 0)
            cut = np.concatenate([symbols[inside[r] - f : inside[r + 1]] for r, f in zip(rows, front)])
            at = np.cumsum([0, *(inside[rows + 1] - inside[rows] + front)])
            inputs, absent, targets, counts, row = windows_of(cut, at, front)
            for i in range(0, len(inputs), SCORED_AT_ONCE):
                j = slice(i, i + SCORED_AT_ONCE)
                logs = log_probabilities(self.tables, inputs[j], absent[j], targets[j])
                out += np.bincount(rows[row[j]], (logs * counts[j]).sum(1), n)
        return out


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    parts = (model.words, model.totals, model.symbols, model.weights, model.subwords)
    shared = spark.sparkContext.broadcast(parts)

    def make():
        keep_freed_memory()
        scorer = Scorer(*shared.value)

        def work(c):
            return {"row": c["row"], "doc_id": c["doc_id"]} | scorer(c["text"])

        return work

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string").alias("text")
    )
    key = docs.schema["doc_id"].dataType.simpleString()
    scored = written(
        map_rows(
            rows,
            make,
            f"row bigint, doc_id {key}, n_tokens bigint, known bigint, base double, score double, rare array<string>",
        ),
        "scored-texts",
    )
    total, distinct, _ = model.totals
    per_word = F.log10((F.col("n") + 0.5) / F.lit(total + 0.5 * (distinct + 1)))
    rest = (
        scored.select("row", F.explode("rare").alias("word"))
        .join(model.counts.select("word", "n"), "word")
        .groupBy("row")
        .agg(F.sum(per_word).alias("_base"), F.count_if(F.col("n") > 0).alias("_known"))
    )
    return scored.drop("rare").join(rest, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", F.lit(0.0))).alias("base_score"),
        "score",
    )

"""Conversation repair, phrase mining and language-model scoring against brute force and SQL."""

import hashlib
import math
import re
from collections import Counter
from functools import partial
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from riskweave.llm import attention, collocations, conversations
from riskweave.llm.common import mod_crc
from riskweave.llm.queries import QUERIES

CLASH = ["_id", "_said", "_hash", "_front", "slice", "chunk", "row", "n", "word", "w1", "_share"]


# --- conversations -----------------------------------------------------------------------


def every_repair(rows):
    """All (cost, audit, lines) of edits with at most two inserts at a place."""
    seen, kinds = set(), []
    for role, text in rows:
        said = text.rstrip(" \t\n\x0b\x0c\r")
        gone = not said or (role, text) in seen
        seen.add((role, text))
        kinds.append((role, text, gone, bool(said) and said[-1] not in ".!?" and not gone))
    inserts = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    choices = []
    for role, text, gone, cut in kinds:
        own = [(2, "D", [])]
        if not gone:
            extra = 5 if cut else 0
            own.append((extra, "K", [(role, text)]))
            own += [(1 + extra, "R", [(r, text)]) for r in ("user", "assistant")]
        choices.append(own)
    for places in product(inserts, repeat=len(rows) + 1):
        if sum(map(len, places)) > 3:
            continue
        for picked in product(*choices):
            cost, audit, out = 0, "", []
            for place, edit in zip(places, [*picked, (0, "", [])]):
                cost += 5 * len(place) + edit[0]
                audit += "I" * len(place) + edit[1]
                out += [(r, "") for r in place] + edit[2]
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in out)):
                yield cost, audit, [f"{r}:{t}" for r, t in out]


CONVERSATIONS = {
    1: [("user", "Hi."), ("assistant", "Yes.")],
    2: [("assistant", "a."), ("user", "b"), ("user", "b")],
    3: [("system", "s."), ("assistant", "x."), ("user", "u.")],
    4: [("system", "s.")],
    5: [("user", "  "), ("tool", "t."), ("user", "q!")],
    6: [("", "e."), ("user", "u?"), ("system", "s.")],
    7: [("user", "a."), ("user", "b."), ("assistant", "c"), ("assistant", "d.")],
    8: [("user", "no stop"), ("assistant", "none either")],
}


def expected_repairs():
    out = {}
    for key, rows in CONVERSATIONS.items():
        cost, audit, lines = min(every_repair(rows))
        out[key] = (cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversation_rows(spark):
    rows = [
        (key, turn, role, text, 1, "x")
        for key, turns in CONVERSATIONS.items()
        for turn, (role, text) in enumerate(turns)
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, _id int, slice string")
    return df.withColumns({c: F.lit(7) for c in CLASH if c not in df.columns})


@pytest.mark.parametrize("part_rows", [1000, 2, 1])
def test_repairs_are_the_least_of_all(spark, part_rows):
    found = conversations.report(conversation_rows(spark), part_rows=part_rows).collect()
    got = {r["conv_id"]: (r["cost"], r["audit"], r["repaired_sha256"]) for r in found}
    assert got == expected_repairs()


def test_parts_change_nothing(spark, sf_dir):
    rows = conversations.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    # One conversation of them all as well, some rows repeated, some without a turn.
    merged = rows.withColumns(
        {"conv_id": F.lit(None).cast("long"), "turn": F.when(F.length("text") % 3 > 0, F.col("turn"))}
    )
    rows = rows.unionByName(merged).unionByName(merged)
    whole = conversations.report(rows).collect()
    cut = conversations.report(rows, part_rows=3).collect()
    assert len(whole) == rows.select("conv_id").distinct().count()
    assert sorted(map(tuple, whole), key=str) == sorted(map(tuple, cut), key=str)


def test_repaired_turns_alternate(spark, sf_dir):
    rows = conversations.repair(conversations.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    for r in rows.collect():
        assert re.fullmatch("(s?(ua)+)?", "".join(t["role"][0] for t in r["turns"]))
        kept = sum(r["audit"].count(c) for c in "KRI")
        assert kept == len(r["turns"]) and r["audit"].count("D") >= r["blank"] + r["duplicate"]


def test_odd_conversations(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert conversations.report(conversations.damaged(spark.createDataFrame([], schema))).collect() == []
    long = "word " * 60_000 + "."
    rows = [(None, None, None, None), (1, None, "user", long), (1, 1, "assistant", "."), (1, 1, "assistant", ".")]
    found = {r["conv_id"]: r for r in conversations.report(spark.createDataFrame(rows, schema)).collect()}
    assert (found[None]["blank"], found[None]["audit"], found[None]["gaps"]) == (1, "D", 0)
    assert (found[1]["duplicate"], found[1]["audit"], found[1]["gaps"]) == (1, "KKD", 0)
    dropped = spark.createDataFrame(rows[1:2], schema).withColumn("dropped", F.lit(True))
    [r] = conversations.report(dropped).collect()
    assert (r["cost"], r["audit"], r["repaired_sha256"]) == (0, "", hashlib.sha256(b"").hexdigest())


# --- phrases -----------------------------------------------------------------------------


def naive_phrases(rows, least, top):
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    counts: dict[str, Counter] = {}
    for lang, text in rows:
        c = counts.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(lower)):
            words = re.findall("[^ \t]+", piece)
            for k in (1, 2, 3):
                c.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, c in counts.items():
        found = []
        n = sum(v for g, v in c.items() if len(g) == 1)
        for g, a in c.items():
            if len(g) < 2 or a < least:
                continue
            longer = [v for h, v in c.items() if len(h) == 3 > len(g) and v >= least and g in (h[:2], h[1:])]
            if any(100 * v >= 50 * a for v in longer):
                continue
            score, _, l, r = min(
                (10**6 * a * a // (c[g[:k]] * c[g[k:]]), k, c[g[:k]], c[g[k:]]) for k in range(1, len(g))
            )
            found.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


@pytest.mark.parametrize("listed", [1_000_000, 3, 0])
def test_phrases_against_brute_force(spark, listed):
    rng = np.random.default_rng(12)
    words = ["A", "b", "ç", "D.", "e", "\t", "f,g", "ö\n", "\x85", "x"]
    rows = [(None if i % 3 else "de", " ".join(rng.choice(words, 30))) for i in range(60)]
    rows += [("fr", None), ("fr", ""), ("es", "one two three " * 5_000), (None, "b e b e")]
    df = spark.createDataFrame(rows, "lang string, text string").withColumns({c: F.lit(1) for c in CLASH})
    got = collocations.phrases(df, least=4, top=25, listed=listed).collect()
    assert sorted(map(tuple, got)) == naive_phrases(rows, 4, 25)


def test_no_phrases(spark):
    schema = "lang string, text string"
    assert collocations.phrases(spark.createDataFrame([], schema)).collect() == []
    assert collocations.phrases(spark.createDataFrame([("en", "a b"), (None, None)], schema)).collect() == []


# --- scores ------------------------------------------------------------------------------

SUBWORDS = partial(
    attention.Subwords, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
)


def test_gradients():
    rng = np.random.default_rng(1)
    w = {n: v.astype(np.float64) for n, v in attention.new_weights(np.ones(attention.SYMBOLS), 1).items()}
    rows = rng.integers(0, attention.SYMBOLS, 120)
    *windows, _ = attention.windows_of(rows, np.array([0, 70, 71, 120]), np.array([0, 0, 17]))
    _, g = attention.gradients(w, *windows)
    for name in w:
        at = tuple(rng.integers(0, s) for s in w[name].shape)
        if name == "token":
            at = (windows[0][0, -1], at[1])
        w[name][at] += 1e-5
        up, _ = attention.gradients(w, *windows)
        w[name][at] -= 2e-5
        down, _ = attention.gradients(w, *windows)
        w[name][at] += 1e-5
        assert math.isclose((up - down) / 2e-5, g[name][at], rel_tol=1e-3, abs_tol=1e-6), name


def naive_log10(w, symbols):
    """Token by token, with the context its window gives it."""
    total = 0.0
    for t in range(len(symbols)):
        window = t // attention.STRIDE * attention.STRIDE
        places = [i for i in range(window - attention.CONTEXT, t + 1) if i >= 0]
        given = [symbols[i - 1] if i else attention.END for i in places]
        x = [w["token"][s] + w["place"][i - window + attention.CONTEXT] for s, i in zip(given, places)]
        q = x[-1] @ w["query"] / math.sqrt(attention.WIDTH)
        a = np.exp([q @ (v @ w["key"]) for v in x])
        h = x[-1] + sum(p * (v @ w["value"]) for p, v in zip(a / a.sum(), x))
        h = h + np.maximum(h @ w["up"] + w["up_bias"], 0) @ w["down"]
        c, m = divmod(symbols[t], attention.MEMBERS)
        for logits, k in ((h @ w["class"] + w["class_bias"], c), (h @ w["member"][c] + w["member_bias"][c], m)):
            total += logits[k] - np.log(np.exp(logits).sum())
    return total / math.log(10)


def test_scores_against_naive_counts_and_attention(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    odd = [(10**6, None), (10**6 + 1, ""), (None, "x"), (10**6 + 2, "never\x0bseen here " * 30), (10**6 + 3, "q" * 5_000)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    docs = docs.withColumns({c: F.lit(3) for c in CLASH + ["known", "base", "score", "rare"]})
    learns = mod_crc("doc_id", 5) != 1
    attention_listed, attention.LISTED = attention.LISTED, 300
    try:
        model = attention.fit(docs, learns, SUBWORDS)
    finally:
        attention.LISTED = attention_listed
    found = attention.score(docs, model).collect()
    rows = docs.select("doc_id", "text", learns.alias("learns")).collect()
    assert len(found) == len(rows)
    counts, taught = Counter(), 0
    for r in rows:
        if r["learns"]:
            counts.update(attention.words_of(r["text"] or ""))
            taught += 1
    total, distinct = counts.total() + taught, len(counts) + 1
    by_id = {r["doc_id"]: r for r in found}
    ids_of = SUBWORDS()
    w = {n: v.astype(np.float64) for n, v in model.weights.items()}
    for k, r in enumerate(rows):
        got = by_id[r["doc_id"]]
        c = [counts[x] for x in attention.words_of(r["text"] or "")] + [taught]
        base = sum(math.log10((n + 0.5) / (total + 0.5 * (distinct + 1))) for n in c)
        assert (got["n_tokens"], got["n_known"], got["train_tokens"]) == (len(c), sum(n > 0 for n in c), total)
        assert math.isclose(got["base_score"], base, rel_tol=1e-9)
        if k % 40 and k < len(rows) - len(odd):
            continue
        ids = [i for x in attention.words_of(r["text"] or "") for i in ids_of(x)]
        want = naive_log10(w, [*model.symbols.of[ids].tolist(), attention.END])
        want += model.symbols.log_share[ids].sum() / math.log(10)
        assert math.isclose(got["score"], want, rel_tol=1e-4), r["doc_id"]


def test_symbols_share_all_probability():
    counts = np.arange(5_000)
    s = attention.Symbols(counts, 3)
    assert math.isclose(np.exp(s.log_share[s.of == attention.RARE]).sum(), 1, rel_tol=1e-5)
    t = attention.Tables(attention.new_weights(s.counts, 2))
    every = np.arange(attention.SYMBOLS)
    inputs = np.tile(np.arange(attention.SPAN), (attention.SYMBOLS, 1))
    targets = np.tile(every[:, None], (1, attention.STRIDE))
    logs = attention.log_probabilities(t, inputs, np.zeros(inputs.shape, bool), targets)
    assert np.allclose(np.exp(logs).sum(0), 1, atol=1e-4)


def test_model_beats_word_counts(spark):
    out = QUERIES["op13_attention"](spark, "/root/testdata/sf0.01").filter("held_out")
    r = out.agg(F.sum("score").alias("model"), F.sum("base_score").alias("base")).first()
    assert r["model"] > r["base"]


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = attention.fit(docs, F.lit(False), SUBWORDS)
    found = attention.score(docs, model).orderBy("doc_id").collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in found] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)
    empty = docs.limit(0)
    assert attention.score(empty, attention.fit(empty, F.lit(True), SUBWORDS)).collect() == []


def test_words_are_encoded_together_as_alone():
    ids_of = SUBWORDS()
    words = attention.words_of("The 12345 don't !!! \x85 a\u3000b c\x1cd \ud800z 'S \u2028 z\xdcrich. " + "x" * 1500)
    flat, begins = ids_of.rows(words * 3)
    assert [flat[a:b].tolist() for a, b in zip(begins, begins[1:])] == [ids_of(w) for w in words * 3]
    flat, begins = ids_of.rows([])
    assert (len(flat), begins.tolist()) == (0, [0])


def test_weights_are_fitted_on_every_training_text(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(attention, "LEAST_TOKENS", 1_000)
    monkeypatch.setattr(attention, "SHARD_TOKENS", 20_000)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    learns = mod_crc("doc_id", 5) != 1
    taken = []

    def seen(pieces, w, *rest):
        taken.append(pieces)
        return w

    monkeypatch.setattr(attention, "_mean_of_shards", seen)
    attention.fit(docs, learns, SUBWORDS)
    ids_of = SUBWORDS()
    texts = [r["text"] or "" for r in docs.filter(learns).collect()]
    tokens = sum(len(ids_of(w)) for t in texts for w in attention.words_of(t)) + len(texts)
    found = taken[0].agg(F.sum(F.length("symbols") / 2 - F.col("skip")), F.count_distinct("round")).first()
    assert tuple(found) == (tokens, attention.ROUNDS)

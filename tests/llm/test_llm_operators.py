"""The corpus operators against brute force, and on odd rows."""

import gzip
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm import (
    components,
    fingerprints,
    jaccard,
    language,
    linear,
    packing,
    pieces,
    pivots,
    quality,
    sharding,
    toxicity,
    warc,
)

tokenizers = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " ", "\n\n", "a", "é漢🙂", "a b c", "x" * 50_000, "the same words here again " * 40]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, repeated rows, an id without text, a text without id, clashing columns."""
    rows = [(i, t, None, None, None) for i, t in enumerate(ODD)]
    rows += [(3, "other text of a repeated id", "en", "s", 27), rows[6], rows[6], rows[0]]
    rows += [(None, "no id", "en", "s", 5), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({c: F.lit(1) for c in ("shard", "score", "label", "ids", "bucket", "kept")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


# Fingerprints


def test_chunks_depend_on_nothing_around_them():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abc d\né漢") for _ in range(rng.randint(0, 900))) for _ in range(40)]
    together = fingerprints.chunk_sets(texts)
    for text, found in zip(texts, together):
        [alone] = fingerprints.chunk_sets([text])
        assert alone.tolist() == found.tolist()
        assert fingerprints.from_text(fingerprints.as_text(alone)).tolist() == alone.tolist()
        assert (alone["length"].sum() > 0) == bool(text)


def test_an_insertion_changes_few_chunks():
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh ") for _ in range(5000))
    a, b = fingerprints.chunk_sets([text, text[:2500] + "inserted" + text[2500:]])
    assert fingerprints.containment(a, b) > 0.95
    assert fingerprints.containment(a, a) == 1.0
    other = "".join(rng.choice("ijklmnop ") for _ in range(5000))
    assert fingerprints.containment(a, fingerprints.chunk_sets([other])[0]) == 0.0


def edited(rows):
    """doc_id -> edited text, by the order of ids and texts."""
    rows = sorted((r["doc_id"] if r["doc_id"] is not None else -(2**63), r["text"] or "") for r in rows)
    out = []
    for (key, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        n = len(text) // 4
        out.append((key if key != -(2**63) else None, text[: len(text) - n] + following[:n]))
    return out


@pytest.mark.parametrize("name", ["docs", "odd"])
def test_edited_texts(request, name):
    df = request.getfixturevalue(name)
    got = fingerprints.edited_likeness(df).collect()
    assert Counter((r["doc_id"], r["edited"]) for r in got) == Counter(edited(df.collect()))
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))
    assert all((r["fingerprint"] == "") == (r["n_chars"] == 0) for r in got)


def test_fingerprints_of_nothing_and_of_one(spark, empty):
    assert fingerprints.edited_likeness(empty).collect() == []
    one = spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string")
    [r] = fingerprints.edited_likeness(one).collect()
    assert (r["edited"], r["near_next"]) == ("abcdefab", 1.0)


# Jaccard join


def shingles(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def jaccard_brute(rows):
    sets = [shingles(r["text"]) for r in rows]
    links, label = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) / len(a | sets[j]) >= 0.8:
                links[i] += 1
                links[j] += 1
                label[find(i)] = find(j)
    low = -(2**63)
    ids = [r["doc_id"] if r["doc_id"] is not None else low for r in rows]
    smallest = defaultdict(lambda: math.inf)
    for i in range(len(rows)):
        smallest[find(i)] = min(smallest[find(i)], ids[i])
    return links, [smallest[find(i)] if smallest[find(i)] != low else None for i in range(len(rows))]


def near_copies(spark, n):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(400)]
    base = [rng.choice(words) for _ in range(120)]
    rows = []
    for i in range(n):
        text = list(base)
        for _ in range(rng.randint(0, 6)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, " ".join(text)))
    rows += [(n + i, " ".join(rng.choice(words) for _ in range(80))) for i in range(20)]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("block", [512, 16])
def test_near_copies_lose_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block)
    df = near_copies(spark, 90)
    rows = df.collect()
    links, component = jaccard_brute(rows)
    got = {r["doc_id"]: r for r in jaccard.near_duplicates(df).collect()}
    for r, n, c in zip(rows, links, component):
        found = got[r["doc_id"]]
        assert (found["n_links"], found["component_id"]) == (n, c)
        assert found["kept"] == (r["doc_id"] == c)


def test_jaccard_on_documents(docs):
    rows = docs.collect()
    links, component = jaccard_brute(rows)
    got = {r["doc_id"]: r for r in jaccard.near_duplicates(docs).collect()}
    assert {r["doc_id"]: (n, c) for r, n, c in zip(rows, links, component)} == {
        k: (r["n_links"], r["component_id"]) for k, r in got.items()
    }


def test_jaccard_on_odd_rows(odd, empty):
    assert jaccard.near_duplicates(empty).collect() == []
    rows = odd.collect()
    links, component = jaccard_brute(rows)
    got = jaccard.near_duplicates(odd).collect()
    assert Counter((r["doc_id"], r["n_links"], r["component_id"]) for r in got) == Counter(
        (r["doc_id"], n, c) for r, n, c in zip(rows, links, component)
    )
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns
    texts = Counter(shingles(r["text"]) for r in kept.collect())
    assert all(n == 1 for s, n in texts.items() if s)
    assert texts[frozenset()] == sum(not shingles(r["text"]) for r in rows)


def test_low_thresholds_lose_no_link(spark):
    # pairs of texts with 40 common shingles of 78: a similarity of 0.51
    rows = [
        (2 * k + side, " ".join([f"c{k}x{i}" for i in range(44)] + [f"s{k}x{side}x{i}" for i in range(19)]))
        for k in range(150)
        for side in (0, 1)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.near_duplicates(df, 0.5).collect()
    assert len(got) == 300 and all(r["n_links"] == 1 for r in got)
    assert jaccard.band_values(0.8) == jaccard.VALUES
    with pytest.raises(ValueError):
        jaccard.near_duplicates(df, 0.05)


def test_pruning_keeps_what_may_reach_the_threshold():
    least = jaccard.least_matches(0.8)
    assert list(least) == list(range(16, 129, 16))
    assert all(m / n < 0.8 for n, m in least.items())
    assert least[128] / 128 > 0.5


# Components


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 40)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(70)]
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in components.components(df).collect()}
    assert got == {k: v for k, v in label.items() if k in got}
    assert {x for a, b in edges if a != b for x in (a, b)} == set(got)
    left, right = np.array(edges).T
    assert components.local_labels(200, left, right)[left].tolist() == [label[a] for a, _ in edges]


# Sharding


def test_matrix_has_exact_sums():
    rows = [5, 0, 17, 100, 1]
    m = sharding.communication_matrix(rows, 8, 1)
    assert m.sum(axis=1).tolist() == rows
    assert sorted(m.sum(axis=0).tolist()) == [15] * 5 + [16] * 3


@pytest.mark.parametrize("name", ["docs", "odd", "empty"])
def test_shards(request, name):
    df = request.getfixturevalue(name)
    got = sharding.sharded(df, 8, 3).collect()
    rows = df.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((r["doc_id"], r["text"]) for r in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["size"] == len((r["text"] or "").encode()) + 1
    sizes = [len(slots.get(s, [])) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    again = sharding.sharded(df.repartition(3), 8, 3).collect()
    if name == "docs":
        assert {(r["doc_id"], r["shard"], r["slot"]) for r in got} == {
            (r["doc_id"], r["shard"], r["slot"]) for r in again
        }


# Packing


@pytest.fixture(scope="module")
def words_file():
    return tokenizers.path("word_bpe_49k.json")


def test_word_tokenizer_equals_the_library(words_file):
    from tokenizers import Tokenizer

    full, own = Tokenizer.from_file(words_file), packing.WordTokenizer(words_file)
    rng = random.Random(5)
    alphabet = "  abÉß\n🙂é漢.,t'sS1²½́ \t\x1cΣς<|endoftext|>İ"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    texts += ["<|endoftext|>", "it's we'll ÀÉ, x.,. a.b", "Hend, hend hend."]
    for text, ids in zip(texts, own.encode(texts)):
        want = full.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want, text


def test_word_tokenizer_with_marks_and_a_full_memory(words_file, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "KNOWN_WORDS", 50)
    full, own = Tokenizer.from_file(words_file), packing.WordTokenizer(words_file)
    rng = random.Random(8)
    alphabet = "abYZÉß'.,!<|>$#*-_\"12 \n\u0301ªħ가"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    texts += ["a<|endoftext|>", "foo|> x'|>", "A'S! it's...'s", "ÀB***'ll", "a\r b", "", "word***\n***"]
    for k in range(0, len(texts), 100):
        for text, ids in zip(texts[k : k + 100], own.encode(texts[k : k + 100])):
            assert ids.tolist() == full.encode(text, add_special_tokens=False).ids, text
    assert own.encode([]) == []


def test_ranks_of_a_length_with_a_third_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 40)
    length = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 90 + 2).cast("int")
    pieces = spark.range(3000).select(F.col("id").alias("row"), F.lit(0).alias("start"), length.alias("length"))
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    ranks = defaultdict(list)
    for r in packing.with_rank(pieces, histogram).collect():
        ranks[r["length"]].append(r["rank"])
    assert {n: sorted(got) for n, got in ranks.items()} == {n: list(range(c)) for n, c in histogram.items()}


@pytest.mark.parametrize(
    "histogram",
    [{}, {1: 1}, {4096: 3, 7: 2}, {3000: 100, 1: 5}, {2049: 77, 2048: 1}, {4000: 50, 97: 3}, "drawn"],
)
def test_plan_covers_each_piece_once(histogram):
    if histogram == "drawn":
        drawn = np.random.default_rng(6).lognormal(6.4, 1, 800).astype(int) % 4096 + 1
        histogram = dict(Counter(drawn.tolist()))
    rows, n = packing.plan(histogram, 4096)
    parts, filled = defaultdict(list), defaultdict(list)
    for length, first, behind, start, used, sequence, offset in rows:
        for k in range(behind - first):
            parts[length, first + k].append((start, used))
            filled[sequence + k].append((offset, used))
    assert set(parts) == {(length, r) for length, c in histogram.items() for r in range(c)}
    for (length, _), got in parts.items():
        got.sort()
        assert got[0][0] == 0 and sum(got[-1]) == length
        assert all(sum(a) == b[0] for a, b in zip(got, got[1:]))
    assert set(filled) == set(range(n))
    for got in filled.values():
        got.sort()
        assert got[0][0] == 0 and sum(got[-1]) <= 4096
        assert all(sum(a) == b[0] for a, b in zip(got, got[1:]))
    tokens = sum(k * v for k, v in histogram.items())
    if tokens > 40 * 4096:
        assert 1 - tokens / (n * 4096) < 0.02


def test_least_squares_is_not_negative_and_good():
    rng = np.random.default_rng(7)
    a = packing.combinations(12)
    x = packing.nonnegative_least_squares(a, b := a @ rng.integers(0, 50, a.shape[1]).astype(float), 100)
    assert (x >= 0).all()
    assert np.abs(a @ x - b).max() < 1


@pytest.mark.parametrize("name", ["docs", "odd", "empty"])
def test_packed_ids(request, name, words_file):
    from tokenizers import Tokenizer

    full, df = Tokenizer.from_file(words_file), request.getfixturevalue(name)
    got = packing.pack(df, words_file, 2).collect()
    filled = defaultdict(list)
    for r in got:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
        assert len(r["ids"]) == 4 * r["length"]
    for v in filled.values():
        v.sort()
        assert v[0][0] == 0 and all(sum(a) == b[0] for a, b in zip(v, v[1:])) and sum(v[-1]) <= 4096
    want = [
        (r["doc_id"], np.array([*full.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4"))
        for r in df.collect()
    ]
    assert sum(r["length"] for r in got) == sum(len(ids) for _, ids in want)
    if name == "docs":
        parts = defaultdict(list)
        for r in got:
            parts[r["doc_id"]].append((r["start"], bytes(r["ids"])))
        for doc_id, ids in want:
            assert b"".join(p for _, p in sorted(parts[doc_id])) == ids.tobytes()


# WARC


def test_record_round_trip():
    for refers in (None, 9):
        data = warc.record(7, "http://a b\r\nX: y", b"<p>\r\n\r\n\x00\xff", "ab12", refers)
        got = warc.parse(gzip.decompress(gzip.compress(data)))
        assert got["page_id"] == 7 and got["refers_to"] == refers and got["payload_bytes"] == 9
        assert got["url"] == "http://a%20b%0D%0AX:%20y"
        assert got["payload"] == (b"" if refers else b"<p>\r\n\r\n\x00\xff")


def test_archives(spark):
    long, other = "x" * 1200, "é" * 600
    rows = [(1, "u1", long), (2, "u2", long), (5, "u5", long), (3, None, "short"), (4, "u4", "short")]
    rows += [(6, "u6", None), (None, "u", other), (8, "u8", other), (8, "u8", other), (9, "u9", "y" * 300_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    got = warc.archive_round_trip(df).collect()
    first = {hashlib.sha1(long.encode()).hexdigest(): 5, hashlib.sha1(other.encode()).hexdigest(): 8}
    want = Counter()
    for page_id, _, html in rows:
        payload = (html or "").encode()
        digest = hashlib.sha1(payload).hexdigest()
        refers = first.get(digest) if first.get(digest) != page_id else None
        want[page_id, len(payload), digest, "revisit" if refers else "response", refers, b"" if refers else payload] += 1
    assert want == Counter(
        (r["page_id"], r["payload_bytes"], r["digest"], r["record_type"], r["refers_to"], bytes(r["payload"]))
        for r in got
    )
    assert warc.archive_round_trip(df.limit(0)).collect() == []


def test_wrong_payloads_are_not_read_as_right(spark):
    from riskweave.session import scratch

    right = b"<p>what was fetched</p>"
    data = warc.record(1, "u", right, hashlib.sha1(right).hexdigest(), None)
    assert warc.verified(warc.parse(data))["payload_bytes"] == len(right)
    folder = scratch(spark, "warc")
    fs, base = warc._filesystem(folder)
    fs.create_dir(base, recursive=True)
    wrong = data.replace(b"fetched", b"changed"), data.replace(b" fetched</p>", b"")
    for k, record in enumerate(wrong):
        member = gzip.compress(record)
        with fs.open_output_stream(f"{base}/{k}.gz", compression=None) as out:
            out.write(member)
        index = spark.createDataFrame([(f"{k}.gz", 0, len(member))], "file string, offset long, length long")
        with pytest.raises(Exception, match="its header says"):
            warc.read_records(index, folder).collect()


def test_selected_records_by_small_reads(spark, monkeypatch):
    from riskweave.session import scratch

    folder = scratch(spark, "warc")
    df = spark.createDataFrame([(i, "u", f"page {i} " * i) for i in range(200)], "page_id long, url string, html string")
    index = warc.write_archives(df, folder)
    chosen = index.filter("page_id % 7 = 3")
    monkeypatch.setattr(warc, "GAP_BYTES", 100)
    monkeypatch.setattr(warc, "READ_BYTES", 400)
    got = {r["page_id"]: bytes(r["payload"]).decode() for r in warc.read_records(chosen, folder).collect()}
    assert got == {i: f"page {i} " * i for i in range(200) if i % 7 == 3}


# SentencePiece


@pytest.fixture(scope="module")
def model_file():
    return tokenizers.path("piece_bpe_32k.model")


def test_pieces_equal_the_library(model_file):
    import sentencepiece

    library, own = sentencepiece.SentencePieceProcessor(model_file=model_file), pieces.Encoder(model_file)
    rng = random.Random(8)
    texts = ["", " ", "  lead", "trail  ", "\n\n x", "▁", "a▁b", "▁▁ x", "é́ 漢字 🙂🙂x", "\x00a", "a\tb  c"]
    texts += ["".join(rng.choice(" ▁ab\n🙂é漢.t") for _ in range(rng.randint(0, 12))) for _ in range(1500)]
    for text, (ids, begin, end) in zip(texts, own.encode(texts)):
        proto = library.encode(text, return_type="proto").pieces
        assert ids.tolist() == [p.id for p in proto], text
        data = text.encode()
        whole = [(p.begin, p.end) for p in proto if p.end > p.begin and not p.piece.startswith("<0x")]
        mine = [(b, e) for b, e, p in zip(begin, end, proto) if p.end > p.begin and not p.piece.startswith("<0x")]
        assert mine == whole, text
        for b, e, p in zip(begin, end, proto):  # a byte piece stands for its own byte
            if p.piece.startswith("<0x"):
                assert data[b:e] == bytes([int(p.piece[3:5], 16)]), text


def test_character_map_takes_the_longest_key():
    # A trie with the keys 'a' and 'ab', laid out by hand: unit = offset << 10 | leaf << 8 | label.
    units = np.zeros(512, np.uint32)
    units[0] = 1 << 10  # root: children at 0 ^ 1 ^ label
    a = 1 ^ ord("a")
    units[a] = (256 << 10) | (1 << 8) | ord("a")
    node = a ^ 256
    units[node] = 0x80000000 | 0
    units[node ^ ord("b")] = (2 << 10) | (1 << 8) | ord("b")
    units[node ^ ord("b") ^ 2] = 0x80000000 | 2
    blob = len(units.tobytes()).to_bytes(4, "little") + units.tobytes() + b"X\0YY\0"
    m = pieces.CharacterMap(blob)
    assert m.longest(b"ab", 0) == (2, "YY") and m.longest(b"ac", 0) == (1, "X")
    assert m.longest(b"ba", 0) is None and pieces.CharacterMap(b"").longest(b"a", 0) is None


@pytest.mark.parametrize("name", ["docs", "odd", "empty"])
def test_encoded_and_decoded_texts(request, name, model_file):
    import sentencepiece

    library, df = sentencepiece.SentencePieceProcessor(model_file=model_file), request.getfixturevalue(name)
    coded = pieces.encode(df, model_file)
    want = Counter()
    for r in df.collect():
        ids = [*library.encode(r["text"] or ""), library.eos_id()]
        want[r["doc_id"], tuple(ids), library.decode(ids)] += 1
    got = pieces.decode(coded, model_file).collect()
    assert Counter((r["doc_id"], tuple(r["ids"]), r["text"]) for r in got) == want
    for r in coded.collect():
        assert len(r["ids"]) == len(r["begins"]) == len(r["ends"])
        assert all(a <= b for a, b in zip(r["begins"], r["ends"]))


# Vectors


def vectors_brute(rows):
    good = {}
    for k, (_, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            a = np.array(v, float)
            a = a / np.abs(a).max()
            good[k] = a / np.linalg.norm(a)
    links, label = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in good:
        for j in good:
            if j < i and len(good[i]) == len(good[j]) and good[i] @ good[j] >= 0.95:
                links[i] += 1
                links[j] += 1
                label[find(i)] = find(j)
    low = -(2**63)
    ids = [low if i is None else i for i, _ in rows]
    smallest = defaultdict(lambda: math.inf)
    for i in range(len(rows)):
        smallest[find(i)] = min(smallest[find(i)], ids[i])
    return [
        (rows[i][0], links[i], None if smallest[find(i)] == low else smallest[find(i)]) for i in range(len(rows))
    ]


@pytest.mark.parametrize("block", [1024, 8])
def test_vectors_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(pivots, "BLOCK_ROWS", block)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(30, 16))
    rows = [(i, (centres[i % 30] + rng.normal(size=16) * 0.12).tolist()) for i in range(300)]
    rows += [(300 + i, (centres[0] * (i + 1)).tolist()) for i in range(40)]  # a large group
    rows += [(900, rows[0][1]), (901, rows[0][1]), (5, rows[7][1]), (None, rows[3][1])]
    rows += [(910, None), (911, []), (912, [0.0] * 16), (913, [1.0, None]), (914, [float("nan")] * 16)]
    rows += [(915, [1e300] * 16), (916, [1e-300] * 16), (917, [float("inf")] * 16), (918, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("copies", F.lit(3))
    got = Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in pivots.near_duplicates(df).collect())
    want = Counter(vectors_brute(rows))
    missing = sum((want - got).values())
    assert missing <= 0.02 * len(rows)
    assert sum(n for (_, n, _), k in got.items() for _ in range(k)) <= sum(n for (_, n, _), k in want.items() for _ in range(k))


def test_vectors_of_the_table(spark, sf_dir):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in pivots.near_duplicates(df).collect())
    assert got == Counter(vectors_brute(rows))
    assert pivots.near_duplicates(df.limit(0)).collect() == []


# Language


def test_probabilities_sum_to_one(spark):
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(["abra cadabra", "banana bandana abba"])], "doc_id long, text string, lang string")
    p, weight = language.kneser_ney(language.gram_counts(rows))
    by = defaultdict(dict)
    for r in p.collect():
        by[len(r["gram"])][r["gram"]] = r["p"]
    back = {r["context"]: r["weight"] for r in weight.filter("context <> ''").collect()}
    symbols = list(by[1])
    rest = next(r["weight"] for r in weight.filter("context = ''").collect())
    assert sum(by[1].values()) + rest == pytest.approx(1)

    def chance(context, symbol):
        if not context:
            return by[1][symbol]
        gram = context + symbol
        return by[len(gram)].get(gram, back.get(context, 1.0) * chance(context[1:], symbol))

    for context in [g[:3] for g in by[4]]:
        assert sum(chance(context, s) for s in symbols) + back[context] * back[context[1:]] * back[context[2:]] * rest == pytest.approx(1)


def test_held_out_languages(docs):
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = language.fit(docs.filter(fold != 0))
    got = language.identify(docs.filter(fold == 0), model, 0.0).join(docs, "doc_id")
    assert got.filter("lang = lang_pred").count() / got.count() > 0.9
    assert got.filter("score < 0 or score > 1").isEmpty()


def test_all_training_texts_are_counted(spark):
    # 20 million characters, a word of its own in each text
    word = F.translate(F.lpad(F.col("id").cast("string"), 4, "0"), "0123456789", "bcdfghjklm")
    rows = spark.range(200).select(
        F.col("id").alias("doc_id"),
        F.concat(F.repeat(F.lit("some more words "), 6250), word).alias("text"),
        F.lit("en").alias("lang"),
    )
    keys, _ = language.fit(rows).grams[4]
    words = ["".join("bcdfghjklm"[int(d)] for d in f"{i:04}") for i in range(200)]
    codes = np.array([[ord(c) for c in w] for w in words], np.uint32)
    hashes = [language.gram_hashes(c, 4)[3] for c in codes]
    assert np.isin(hashes, keys).all()


def test_no_language_is_lost(spark):
    rows = [(None if i % 2 else i, f"text number {chr(97 + i % 26)} of its language", f"l{i:02}") for i in range(40)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == [f"l{i:02}" for i in range(40)]


def test_probabilities_of_kept_grams_sum_to_one(spark, monkeypatch):
    texts = ["abra cadabra", "banana bandana abba", "abra banana"]
    rows = spark.createDataFrame([(t, g) for t in texts for g in ("x", "y")] + [("ab", "z")], "text string, lang string")
    full = language.kneser_ney(language.gram_counts(rows))[0].filter("length(gram) = 4").count()
    monkeypatch.setattr(language, "KEPT_GRAMS", 36)
    p, weight = language.kneser_ney(language.gram_counts(rows))
    sizes = Counter((len(r["gram"]), r["lang"]) for r in p.collect())
    assert full > 36 and all(sum(sizes[k, g] for g in "xyz") <= 36 for k in (1, 2, 3, 4))
    assert sizes[4, "z"] == 3 and sizes[4, "x"] > 0
    chance = {r["gram"]: r["p"] for r in p.filter("lang = 'x'").collect()}
    back = {r["context"]: r["weight"] for r in weight.filter("lang = 'x'").collect()}
    symbols = [g for g in chance if len(g) == 1]

    def of(context, symbol):
        if context + symbol in chance:
            return chance[context + symbol]
        return back.get(context, 1.0) * of(context[1:], symbol)

    rest = back[""]
    for context in {g[:3] for g in chance if len(g) == 4} | {"bra", "ana", " ba"}:
        unknown = rest * math.prod(back.get(context[i:], 1.0) for i in range(3))
        assert sum(of(context, s) for s in symbols) + unknown == pytest.approx(1)


def test_languages_of_odd_rows(odd, empty, docs):
    model = language.fit(docs)
    got = language.identify(odd, model, 0.0).collect()
    assert len(got) == odd.count()
    for r in got:
        if r["doc_id"] in (1, 2):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert {r["lang_pred"] for r in language.identify(odd, model, 2.0).collect()} == {"und"}
    assert language.identify(empty, model).collect() == []
    none = language.fit(empty)
    assert {r["lang_pred"] for r in language.identify(odd, none).collect()} == {"und"}


# Toxicity, quality


def test_held_out_toxicity(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    model = toxicity.fit(toxicity.labelled(docs.filter(fold != 1), marks, "toxic"))
    got = toxicity.with_scores(docs.filter(fold == 1), model).join(marks, "doc_id").collect()
    toxic = [r["score"] for r in got if r["toxic"] == 1]
    clean = [r["score"] for r in got if r["toxic"] == 0]
    ahead = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert ahead > 0.9
    assert sum(s >= 0.7 for s in clean) <= 0.02 * len(clean)


def test_a_rare_label_keeps_its_rows(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "LABELLED_ROWS", 200)
    words = ["table", "river", "garden", "paper", "window", "summer", "market"]
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(words, k=12)), 0) for i in range(2000)]
    rows += [(2000 + i, " ".join(rng.choices(words, k=11)) + " zqxjk", 1) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    scored = toxicity.with_scores(df, toxicity.fit(df)).join(df.drop("text"), "doc_id").collect()
    toxic = [r["score"] for r in scored if r["label"] == 1]
    clean = [r["score"] for r in scored if r["label"] == 0]
    assert min(toxic) > 0.5 > max(clean)


def test_calibration_by_weights():
    z, y = np.random.default_rng(1).normal(size=4000), np.arange(4000) % 2
    for weight, share in ((None, 0.5), (np.where(y == 1, 0.02, 1.98), 0.01)):
        slope, shift = linear.calibrate(z, y, weight)
        assert linear.sigmoid(slope * z + shift).mean() == pytest.approx(share, rel=0.1)


@pytest.mark.parametrize("doc_id", [None, 5])
def test_rows_of_one_id_are_drawn_apart(spark, monkeypatch, doc_id):
    monkeypatch.setattr(toxicity, "LABELLED_ROWS", 200)
    monkeypatch.setattr(quality, "SAMPLE_ROWS", 200)
    rows = [(doc_id, f"text number {i}", i % 2) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    sizes = []

    def noted(rows, name):
        sizes.append(rows.count())
        return rows

    monkeypatch.setattr(toxicity, "written", noted)
    toxicity.fit(df)
    docs = df.select("doc_id", "text", F.lit("s").alias("source"), F.lit("en").alias("lang"), F.lit(9).alias("n_chars"))
    sizes += [quality._bounded(quality.features(docs), 2000, seed).count() for seed in (1, 2)]
    table = quality.with_labels(docs, df.limit(0).select("doc_id", F.col("label").alias("quality")), 1)
    assert 300 < table.filter("_aside").count() < 700
    assert len(sizes) == 3 and all(100 < n < 300 for n in sizes)


def test_grams_stay_within_texts():
    owner, bucket = toxicity.gram_buckets(["abc", "", "a b  C"])
    alone = [toxicity.gram_buckets([t])[1].tolist() for t in ("abc", "", "a b  C")]
    assert [sorted(bucket[owner == i].tolist()) for i in range(3)] == [sorted(a) for a in alone]
    assert toxicity.gram_buckets(["A b\nc"])[1].tolist() == toxicity.gram_buckets([" a  b c "])[1].tolist()


def test_toxicity_of_odd_rows(odd, empty, docs, labels):
    model = toxicity.fit(toxicity.labelled(docs, labels, "toxic"))
    got = toxicity.with_scores(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.without_toxic(odd, model, 2.0).columns == odd.columns
    assert toxicity.without_toxic(odd, model, 2.0).exceptAll(odd).isEmpty()
    assert toxicity.with_scores(empty, model).collect() == []
    untaught = toxicity.fit(toxicity.labelled(docs, labels.limit(0), "toxic"))
    assert {r["score"] for r in toxicity.with_scores(odd, untaught).collect()} == {0.5}


def test_quality_of_labelled_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    known = marks.filter(fold != 1)
    got = quality.score(docs, known).join(marks.filter(fold == 1), "doc_id")
    assert got.filter("keep = (quality = 1)").count() >= 0.97 * got.count()
    assert got.filter("quality = 1 and not keep").count() <= 0.02 * got.count()
    kept = quality.keep_good(docs, known)
    assert kept.columns == docs.columns
    assert {r[0] for r in kept.select("doc_id").collect()} == {
        r[0] for r in quality.score(docs, known).filter("keep").select("doc_id").collect()
    }


def test_quality_of_odd_rows(odd, empty, docs, labels):
    got = quality.score(odd.unionByName(docs, allowMissingColumns=True), labels)
    assert got.count() == odd.count() + docs.count()
    assert got.filter("score is null or score < 0 or score > 1").isEmpty()
    assert quality.score(empty, labels).collect() == []
    assert quality.score(odd, labels.limit(0)).filter("not keep").isEmpty()
    assert quality.keep_good(odd, labels.limit(0)).count() == odd.count()


def test_logistic_regression_separates():
    rng = np.random.default_rng(10)
    x = rng.normal(size=(500, 3))
    y = (x @ [1.0, -2.0, 0.5] + 0.3 > 0).astype(float)
    w = linear.fit_dense(x, y)
    assert (((x @ w[:-1] + w[-1]) > 0) == y).mean() > 0.98
    slope, shift = linear.calibrate(x[:, 0], np.ones(500))
    assert (slope, shift) == (1.0, 0.0)
    assert zlib.crc32(b"") == 0

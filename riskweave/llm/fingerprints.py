"""Document fingerprints from content-defined chunks.

A gear hash rolls over the UTF-8 bytes of a text; where its leading bits are zero,
the text is cut. The test is normalised: strict before a chunk has the usual length,
loose after it, so that lengths gather around it. A cut depends only on the 32 bytes
before it, so an insertion moves chunks but does not change them. The fingerprint is
the sorted set of chunk digests with their lengths; likeness is the share of one
text's chunk bytes that the other has as well (containment).

Defined results: NULL and empty texts have the fingerprint '' and are alike (1.0);
an empty and a non-empty text are not (0.0). Rows that repeat a doc_id are ordered by
text; rows without doc_id come first.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import RUN_CHARS, map_rows, parallelism, small_batches, span_hashes

MIN_BYTES, USUAL_BYTES, MAX_BYTES = 12, 32, 128
STRICT_BITS, LOOSE_BITS = 6, 4
WINDOW = 32
GEAR = np.array(
    [int.from_bytes(hashlib.sha256(bytes([b])).digest()[:4], "little") for b in range(256)],
    np.uint32,
)
MASK48 = np.uint64((1 << 48) - 1)
RECORD = np.dtype([("digest", ">u8"), ("length", ">u2")])


def _cuts(strict: list[int], loose: list[int], start: int, end: int) -> list[int]:
    """Ends of the chunks of the bytes [start, end), given where the hash allows a cut."""
    out = []
    while end - start > MIN_BYTES:
        usual, last = min(start + USUAL_BYTES, end), min(start + MAX_BYTES, end)
        i = bisect_left(strict, start + MIN_BYTES)
        if i < len(strict) and strict[i] < usual:
            start = strict[i]
        else:
            i = bisect_left(loose, usual)
            start = loose[i] if i < len(loose) and loose[i] < last else last
        out.append(start)
    if start < end:
        out.append(end)
    return out


def chunk_sets(texts: list[str]) -> list[np.ndarray]:
    """For each text its distinct chunks, sorted by digest, as RECORD arrays."""
    data = [t.encode() for t in texts]
    gap = bytes(WINDOW)
    raw = np.frombuffer(gap + b"".join(d + gap for d in data), np.uint8)
    sizes = np.array([len(d) for d in data], np.int64)
    starts = WINDOW + np.concatenate([[0], np.cumsum(sizes + WINDOW)[:-1]]).astype(np.int64)
    gear = GEAR[raw]
    for s in [0, *(starts + sizes).tolist()]:
        gear[s : s + WINDOW] = 0  # what stands before a text has no part in its hash
    width = 1
    while width < WINDOW:
        shifted = gear.copy()
        shifted[width:] += gear[:-width] << np.uint32(width)
        gear, width = shifted, width * 2
    loose = np.flatnonzero(gear >> np.uint32(32 - LOOSE_BITS) == 0)
    strict = loose[gear[loose] >> np.uint32(32 - STRICT_BITS) == 0]
    loose, strict = loose + 1, (strict + 1).tolist()  # a cut lies behind its byte
    loose = loose.tolist()
    ends = [_cuts(strict, loose, a, a + n) for a, n in zip(starts.tolist(), sizes.tolist())]
    counts = np.array([len(e) for e in ends], np.int64)
    if not counts.sum():
        return [np.empty(0, RECORD) for _ in texts]
    stop = np.array([e for es in ends for e in es], np.int64)
    begin = np.empty_like(stop)
    begin[1:] = stop[:-1]
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])[counts > 0]
    begin[first] = starts[counts > 0]
    digest = span_hashes(raw, begin, stop)
    record = np.empty(len(stop), RECORD)
    record["digest"], record["length"] = digest & MASK48, stop - begin
    return [np.unique(r) for r in np.split(record, np.cumsum(counts)[:-1])]


def as_text(chunks: np.ndarray) -> str:
    """16 hex digits for each chunk: 12 of its digest, 4 of its length."""
    if not len(chunks):
        return ""
    return chunks.view(np.uint8).reshape(len(chunks), RECORD.itemsize)[:, 2:].tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex(fingerprint), np.uint8).reshape(-1, 8)
    out = np.zeros((len(raw), RECORD.itemsize), np.uint8)
    out[:, 2:] = raw
    return out.reshape(-1).view(RECORD)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the bytes of a's distinct chunks that b has as well."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    at = np.searchsorted(b["digest"].astype(np.uint64), x := a["digest"].astype(np.uint64))
    at[at == len(b)] = 0
    length = a["length"].astype(np.int64)
    return float(length[b["digest"][at] == x].sum() / length.sum())


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, text and the fingerprint of the text, one row for each row of `docs`."""

    def make():
        def work(c):
            return c | {"fingerprint": [as_text(s) for s in chunk_sets(c["text"])]}

        return work

    return map_rows(
        docs.select("doc_id", "text"), make, "doc_id bigint, text string, fingerprint string"
    )


def with_successor(docs: DataFrame) -> DataFrame:
    """Rows in buckets of consecutive doc_ids, each ended by the row that follows it.

    Columns: bucket, extra (1 for the row that begins the following bucket), doc_id, text;
    sorted within partitions, and no bucket lies in two of them. Bounds are quantiles
    of doc_id, fixed as literals, so that a recomputed task meets the same rows.
    """
    spark = docs.sparkSession
    low = F.lit(-(2**63)).cast("bigint")
    rows = docs.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("bigint"), low).alias("_key"),
    )
    n = 4 * parallelism(spark)
    quantiles = docs.select(F.col("doc_id").cast("bigint").alias("d")).approxQuantile(
        "d", [i / n for i in range(1, n)], 1 / (8 * n)
    )
    bounds = sorted({int(q) for q in quantiles})
    steps = F.array(*[F.lit(b).cast("bigint") for b in bounds])
    key = F.col("_key")
    bucket = F.size(F.filter(steps, lambda b: b <= key)) if bounds else F.lit(0)
    rows = rows.withColumn("bucket", bucket)
    firsts = sorted(
        (r["bucket"], r["k"]) for r in rows.groupBy("bucket").agg(F.min("_key").alias("k")).collect()
    )  # at most n rows
    if not firsts:
        return rows.select("bucket", F.lit(0).alias("extra"), "doc_id", "text")
    before = [(k, firsts[i - 1][0]) for i, (_, k) in enumerate(firsts)]
    link = spark.createDataFrame(before, "_key bigint, bucket int")
    heads = (
        rows.filter(key.isin([k for k, _ in before]))
        .drop("bucket")
        .join(F.broadcast(link), "_key")
        .groupBy("bucket", "_key")
        .agg(F.min("text").alias("text"))
        .select(
            "bucket", F.lit(1).alias("extra"), F.lit(None).cast("bigint").alias("doc_id"), "text"
        )
    )
    return (
        rows.select("bucket", F.lit(0).alias("extra"), F.col("doc_id").cast("bigint"), "text")
        .unionAll(heads)
        .repartition(parallelism(spark), "bucket")
        .sortWithinPartitions("bucket", "extra", "doc_id", "text")
    )


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and the likeness of both pairs.

    The edited form replaces the last quarter of the characters by the first ones of the
    following document. Returns doc_id, n_chars, edited, fingerprint, edited_fingerprint,
    near_edited, near_next.
    """
    schema = (
        "doc_id bigint, n_chars bigint, edited string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )

    def flush(rows):
        texts = [r[3] for r in rows]
        pairs = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i][0] == rows[i + 1][0]]
        edited = []
        for i in pairs:
            quarter = len(texts[i]) // 4
            edited.append(texts[i][: len(texts[i]) - quarter] + texts[i + 1][:quarter])
        sets, changed = chunk_sets(texts), chunk_sets(edited) if edited else []
        prints = [as_text(s) for s in sets]
        return {
            "doc_id": [rows[i][2] for i in pairs],
            "n_chars": [len(texts[i]) for i in pairs],
            "edited": edited,
            "fingerprint": [prints[i] for i in pairs],
            "edited_fingerprint": [as_text(s) for s in changed],
            "near_edited": [containment(sets[i], s) for i, s in zip(pairs, changed)],
            "near_next": [containment(sets[i], sets[i + 1]) for i in pairs],
        }

    def run(batches):
        rows, size = [], 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                rows.append(row)
                size += len(row[3])
                if size > RUN_CHARS:
                    yield pa.RecordBatch.from_pydict(flush(rows), schema=arrow)
                    rows, size = rows[-1:], len(row[3])
        if len(rows) > 1:
            yield pa.RecordBatch.from_pydict(flush(rows), schema=arrow)

    arrow = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64())]
        + [(n, pa.string()) for n in ("edited", "fingerprint", "edited_fingerprint")]
        + [(n, pa.float64()) for n in ("near_edited", "near_next")]
    )
    small_batches(docs.sparkSession)
    return with_successor(docs).mapInArrow(run, schema)

"""WARC archives with an index that is written first and read by.

Each task writes its rows into archives of one gzip member a record and returns, for every
record, where it lies: file, offset, length, URL and payload digest. These index rows are
the output of the write; a repeated task attempt writes files of its own, and only those
that the index names count. Reading starts from index rows: they are sorted by place,
neighbouring ranges are joined into one read, and records are cut out of it.

A response's digest and size are those of the payload read back; a record whose header
says otherwise raises. A revisit, which has no payload, has those of its header.

Files are reached through the file system that the URI of the shared folder names.

Defined results: a NULL payload is empty, a NULL URL an empty target; control characters in
a URL are escaped. Payloads of at least 1000 bytes that recur are stored once, with the
largest page_id; rows that repeat that page_id with that payload are responses as well.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import parallelism, small_batches
from riskweave.session import scratch, written

REVISIT_BYTES = 1000
FILE_BYTES = 512 << 20  # an archive is closed beyond this size
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20  # ranges this near are read at once, up to this much
DATE = "1970-01-01T00:00:00Z"  # the tables carry no capture time

INDEX = (
    "page_id bigint, url string, digest string, record_type string, refers_to bigint, "
    "file string, offset bigint, length bigint"
)
RECORD = (
    "page_id bigint, url string, record_type string, refers_to bigint, digest string, "
    "payload_bytes bigint, payload binary"
)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if re.match(r"\w+:/", uri) else f"file://{uri}")


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _escaped(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record; `refers_to` is set for a revisit, which leaves the payload out."""
    revisit = refers_to is not None
    block = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode() + (b"" if revisit else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_escaped(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
    ]
    if revisit:
        head += [f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of one record as `record` lays them out."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])

    def page(name):
        number = re.fullmatch(r"<urn:page:(-?\d*)>", fields[name])[1] if name in fields else ""
        return int(number) if number else None

    return {
        "page_id": page("WARC-Record-ID"),
        "url": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"],
        "refers_to": page("WARC-Refers-To"),
        "digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload_bytes": size,
        "payload": payload,
    }


def verified(fields: dict) -> dict:
    """The fields of a parsed record, a response's digest and size taken from its payload."""
    if fields["record_type"] != "response":
        return fields
    digest, size = hashlib.sha1(fields["payload"]).hexdigest(), len(fields["payload"])
    if (digest, size) != (fields["digest"], fields["payload_bytes"]):
        raise ValueError(
            f"payload of page {fields['page_id']}: {size} bytes, sha1 {digest}; "
            f"its header says {fields['payload_bytes']} bytes, sha1 {fields['digest']}"
        )
    return {**fields, "digest": digest, "payload_bytes": size}


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, refers_to; refers_to is NULL for responses.

    Only digests and ids are grouped; what comes of it, one row for each payload that
    recurs, meets the pages again by digest.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    recurring = (
        rows.filter(F.octet_length("payload") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .select("digest", "_first")
    )
    other = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return rows.join(recurring, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(other, F.col("_first")).alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record for every row of `pages` into `folder` and returns the index.

    The index is a table in the shared folder; the archives are written once, with it.
    """
    names = [c.split()[0] for c in INDEX.split(", ")]

    def run(batches):
        fs, base = _filesystem(folder)
        fs.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            index = []
            for page_id, url, payload, digest, refers in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None or at > FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                data = gzip.compress(record(page_id, url, payload, digest, refers), 6, mtime=0)
                out.write(data)
                kind = "response" if refers is None else "revisit"
                index.append((page_id, url, digest, kind, refers, name, at, len(data)))
                at += len(data)
            if index:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*index), TYPES)], names=names
                )
        if out is not None:
            out.close()

    small_batches(pages.sparkSession)
    text, number = pa.string(), pa.int64()
    TYPES = [number, text, text, text, number, text, number, number]
    return written(with_revisits(pages).mapInArrow(run, INDEX), "warc-index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that the rows of `index` point at, by joined byte ranges.

    Ranges are dealt out by file and stretch of it, so that one large archive is read by
    many tasks, each in order.
    """

    def flush(f, ranges):
        start, stop = ranges[0][0], ranges[-1][0] + ranges[-1][1]
        f.seek(start)
        data = f.read(stop - start)
        return [verified(parse(gzip.decompress(data[a - start : a - start + n]))) for a, n in ranges]

    def run(batches):
        fs, base = _filesystem(folder)
        name, f, ranges = None, None, []

        def rows(records):
            return pa.RecordBatch.from_pylist(records, schema=arrow)

        for batch in batches:
            for file, offset, length in zip(*[c.to_pylist() for c in batch.columns]):
                end = ranges[-1][0] + ranges[-1][1] if ranges else 0
                far = ranges and (
                    offset > end + GAP_BYTES or offset + length - ranges[0][0] > READ_BYTES
                )
                if ranges and (file != name or far):
                    yield rows(flush(f, ranges))
                    ranges = []
                if file != name:
                    if f is not None:
                        f.close()
                    name, f = file, fs.open_input_file(f"{base}/{file}")
                ranges.append((offset, length))
        if ranges:
            yield rows(flush(f, ranges))
        if f is not None:
            f.close()

    number, text = pa.int64(), pa.string()
    arrow = pa.schema(
        [("page_id", number), ("url", text), ("record_type", text), ("refers_to", number)]
        + [("digest", text), ("payload_bytes", number), ("payload", pa.binary())]
    )
    stretch = F.floor(F.col("offset") / F.lit(4 * READ_BYTES))
    return (
        index.select("file", "offset", "length")
        .repartition(parallelism(index.sparkSession), "file", stretch)
        .sortWithinPartitions("file", "offset")
        .mapInArrow(run, RECORD)
    )


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Writes `pages` as archives in the shared folder and reads every record back.

    A revisit's payload stays empty; its size and digest are those of the page it repeats.
    """
    folder = scratch(pages.sparkSession, "warc")
    return read_records(write_archives(pages, folder), folder)

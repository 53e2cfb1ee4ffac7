"""Small helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Texts are handled in runs of about this many characters, so that the arrays
# built from them stay small whatever the batch size.
RUN_CHARS = 1_000_000
BATCH_ROWS = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession) -> None:
    """Fewer rows in a batch between Spark and Python, as each may hold a long text."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(setting)) > BATCH_ROWS:
        spark.conf.set(setting, BATCH_ROWS)


def mod_crc(column: str, n: int) -> Column:
    """crc32 of the id as text, mod n: the fold that labels are held out by."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % F.lit(n)


def runs(sizes: Sequence[int], limit: int = RUN_CHARS) -> Iterator[tuple[int, int]]:
    """Slices [start, end) of texts of at most `limit` in all, or of one larger text."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def portions(batch: pa.RecordBatch, limit: int = RUN_CHARS) -> Iterator[pa.RecordBatch]:
    """A batch cut by the size of `text`, so that few texts are Python objects at a time."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
    for a, b in runs(sizes, limit):
        yield batch.slice(a, b - a)


def _values(batch: pa.RecordBatch, names: Iterable[str]) -> dict[str, list]:
    out = {n: batch.column(n).to_pylist() for n in names}
    out["text"] = [t or "" for t in batch.column("text").to_pylist()]
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def span_hashes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes in each span [begin, end), the same wherever they stand.

    Differences of running polynomial sums, brought to position 0 by inverse powers.
    """
    base, n = 0x9E3779B97F4A7C15, len(raw)  # odd, so that powers have inverses modulo 2^64
    powers, inverse = _powers(base, n + 1), _powers(pow(base, -1, 1 << 64), n + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + 1) * powers[:n])])
    return mix64((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64))


def _column(values: list, kind: pa.DataType) -> pa.Array:
    if pa.types.is_list(kind) and values and all(isinstance(v, np.ndarray) for v in values):
        offsets = np.cumsum([0, *map(len, values)])
        flat = pa.array(np.concatenate(values), kind.value_type)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat, type=kind)
    return pa.array(values, kind)


def map_rows(
    df: DataFrame,
    make: Callable[[], Callable[[dict[str, list]], dict[str, list]]],
    schema: str,
    limit: int = RUN_CHARS,
) -> DataFrame:
    """Rows through Python in Arrow batches, cut where their texts reach `limit`.

    `make` runs once in each task and returns the function that turns a dict of
    columns into another one; a `text` column that is NULL is handed over as ''.
    """
    small_batches(df.sparkSession)
    names = df.columns
    types = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(types)

    def run(batches):
        work = None
        for batch in batches:
            if not batch.num_rows:
                continue
            work = work or make()
            for part in portions(batch, limit):
                out = work(_values(part, names))
                yield pa.RecordBatch.from_arrays(
                    [_column(out[f.name], f.type) for f in arrow], schema=arrow
                )

    return df.mapInArrow(run, types)


def filter_rows(df: DataFrame, make: Callable[[], Callable[[dict[str, list]], list[bool]]], *names: str) -> DataFrame:
    """The rows of `df`, unchanged, for which the function that `make` returns gives True.

    It gets a dict of the named columns and `text` (NULL as '').
    """

    def run(batches):
        work = None
        for batch in batches:
            if not batch.num_rows:
                continue
            work = work or make()
            mask = [bool(k) for part in portions(batch) for k in work(_values(part, names))]
            yield batch.filter(pa.array(mask, pa.bool_()))

    small_batches(df.sparkSession)
    return df.mapInArrow(run, df.schema)


def frequent(counts: DataFrame, n: str, limit: int) -> DataFrame:
    """The rows with the highest counts `n`, at most `limit`, without a sort: counts are told apart
    in steps of a sixteenth of a doubling, and all rows of a step are in or out."""
    step = F.floor(16 * F.log2(n)).cast("int")
    sizes = counts.groupBy(step.alias("step")).count().collect()  # at most 1,024 rows
    least, held = None, 0
    for row in sorted(sizes, key=lambda r: -r["step"]):
        held += row["count"]
        if held > limit:
            break
        least = row["step"]
    return counts.filter(step >= least) if least is not None else counts.limit(0)

"""Insertion of rows whose key a table, perhaps far larger, does not have yet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from riskweave.session import has_files
from riskweave.sinks.tables import insert_if_absent

KEYS_PER_WORD = 4  # sixteen bits a key
BITS = 4  # set for each key; about one absent key in a hundred passes
MOST_WORDS = 1 << 21  # rows of a filter that is broadcast, some 100 MB


def _word(key: str, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words))


def _bits(key: str) -> Column:
    """A few bits of a 64-bit word, by a second hash of the key."""
    bit = "shiftleft(1L, cast(shiftrightunsigned(xxhash64(`{}`, 1), {}) & 63 as int))"
    return reduce(Column.bitwiseOR, (F.expr(bit.format(key, 6 * i)) for i in range(BITS)))


def bloom_words(new: DataFrame, key: str, keys: int) -> DataFrame:
    """A Bloom filter of the keys as rows (_word, _set): each key sets bits of one word."""
    words = -(-keys // KEYS_PER_WORD)
    return new.groupBy(_word(key, words).alias("_word")).agg(F.bit_or(_bits(key)).alias("_set"))


def perhaps_among(present: DataFrame, new: DataFrame, key: str, keys: int) -> DataFrame:
    """The keys of `present` that may be among the `keys` rows of `new`: all that are, and
    about one in a hundred of the others.

    The filter is broadcast, so it is applied in the scan of `present`, before any exchange. Its
    size is known from the number of keys; beyond `MOST_WORDS` all keys of `present` come back.
    """
    if new.schema[key].dataType != present.schema[key].dataType:
        raise TypeError(f"{key} has another type in the table")
    words = -(-keys // KEYS_PER_WORD)
    found = present.select(F.col(key))
    if words > MOST_WORDS:
        return found
    bloom = F.broadcast(bloom_words(new.select(key), key, keys))
    tested = found.join(bloom, _word(key, words) == F.col("_word"))
    return tested.filter(_bits(key).bitwiseAND(F.col("_set")) == _bits(key)).select(key)


def absent_rows(new: DataFrame, present: DataFrame, key: str, keys: int) -> DataFrame:
    """As `insert_if_absent`, for a `present` far larger than the `keys` rows of `new`: what is
    shuffled of it is about as large as `new`, not as the table."""
    return insert_if_absent(new, perhaps_among(present, new, key, keys), key)


def insert_new(new: DataFrame, path: str, key: str = "order_id") -> int:
    """Appends the rows of `new`, one per key, that the Parquet table does not have yet, and
    returns how many. Repeated, it inserts nothing more. Rows without a key are left out.

    The number is observed by the tasks that write, so nothing is counted again.
    """
    spark = new.sparkSession
    new = new.filter(F.col(key).isNotNull())
    keys = new.count()
    if not keys:
        return 0
    if has_files(spark, path):
        new = absent_rows(new, spark.read.parquet(path), key, keys)
    inserted = Observation()
    new.observe(inserted, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    return inserted.get["n"]

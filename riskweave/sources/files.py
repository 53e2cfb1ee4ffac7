"""File inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def scan_training_input(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    format: str | None = None,
) -> DataFrame:
    """Training rows in the `format` parquet or csv (with a header line); without one, by
    suffix, Parquet if it is `.parquet` and CSV otherwise.

    A CSV file read without `schema` is scanned once more to infer one.
    """
    if format not in (None, "parquet", "csv"):
        raise ValueError(f"no such format: {format}")
    if (format or ("parquet" if path.endswith(".parquet") else "csv")) == "parquet":
        return spark.read.parquet(path)
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def select_present_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    present = set(df.columns)
    return df.select(*[c for c in wanted if c in present])


def drop_incomplete_rows(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Rows of the wanted columns that exist, without any that holds a NULL."""
    return select_present_columns(df, wanted).dropna(how="any")

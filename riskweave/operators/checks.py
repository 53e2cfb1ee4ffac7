"""Checks on tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.schemas import NOT_NULL, TABLE_KEYS


def table_checks(df: DataFrame, required: Sequence[str], key: str) -> DataFrame:
    """Violations per rule, in one aggregate: NULLs in required columns and in the
    key, and rows beyond the first of each key."""
    checks = {f"not_null_{c}": F.count_if(F.col(c).isNull()) for c in [key, *required]}
    checks[f"unique_{key}"] = F.count(key) - F.count_distinct(key)
    one = df.agg(*[c.alias(n) for n, c in checks.items()])
    return one.unpivot([], list(checks), "rule", "violations")


def check_rules(df: DataFrame, table: str) -> DataFrame:
    """`table_checks` by the rules of a known table."""
    return table_checks(df, NOT_NULL[table], TABLE_KEYS[table])


def require_rules(df: DataFrame, table: str) -> None:
    """Raises if rows break the NOT NULL or key rules of a known table."""
    broken = check_rules(df, table).filter("violations > 0").collect()  # a row per rule
    if broken:
        found = ", ".join(f"{r['rule']}: {r['violations']}" for r in broken)
        raise ValueError(f"{table} breaks its rules ({found})")


def verify_output(df: DataFrame | None, name: str, spark) -> DataFrame:
    """One row: missing (an error for the caller to raise), empty (a warning) or ok."""
    if df is None:
        status = "missing"
    else:
        status = "empty" if df.isEmpty() else "ok"
    return spark.createDataFrame([(name, status)], "name string, status string")


def is_empty(df: DataFrame) -> bool:
    """Whether there is nothing to process; reads no more than one row."""
    return df.isEmpty()

"""Checks that return one row of flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.stats import quoted


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def validate_columns(df: DataFrame, required: Sequence[str]) -> bool:
    """All required columns are there and the table is not empty."""
    return not missing_columns(df, required) and not df.isEmpty()


def validate_xy(x: DataFrame | None, y: DataFrame | None, key: str | None = None) -> bool:
    """Both given, equally long, not empty; with a key also the same keys."""
    if x is None or y is None:
        return False
    rows = x.count()
    if rows == 0 or rows != y.count():
        return False
    return key is None or x.join(y, key, "left_anti").isEmpty()


def result_flags(df: DataFrame, expected_rows: int | None = None, expected_columns: Sequence[str] | None = None) -> DataFrame:
    """Row count, missing columns and nulls of a result table in one aggregate."""
    lacking = missing_columns(df, expected_columns or [])
    checked = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(quoted(c)).alias(f"__{i}") for i, c in enumerate(df.columns)],
    )
    nulls = F.lit(False)
    for i in range(len(df.columns)):
        nulls = nulls | (F.col(f"__{i}") < F.col("n_rows"))
    rows_ok = F.col("n_rows") == F.lit(expected_rows) if expected_rows else F.lit(True)
    columns_ok = F.lit(not lacking)
    return checked.select(
        "n_rows", rows_ok.alias("rows_ok"), columns_ok.alias("columns_ok"), nulls.alias("has_nulls"),
        (rows_ok & columns_ok & ~nulls).alias("valid"),
    )

"""Repeatable train/validation splits and folds.

The default forms are pure expressions on the row key: no shuffle, and the same answer after any
re-partitioning. The exact stratified forms number rows per label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.hashing import hash28
from tabloom.operators.rank import number_within

SPLIT_STEPS = 10_000


def is_validation(key: str, test_size: float = 0.2, seed: int = 42, portable: bool = True) -> Column:
    return F.pmod(hash28(key, seed=seed, portable=portable), F.lit(SPLIT_STEPS)) < F.lit(round(test_size * SPLIT_STEPS))


def train_validation(
    df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42, portable: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(train, validation) by hash of the row key; sizes are proportional in expectation."""
    chosen = is_validation(key, test_size, seed, portable)
    return df.filter(~chosen), df.filter(chosen)


def stratified_flag(
    df: DataFrame, label: str, key: str, test_size: float = 0.2, seed: int = 42, to: str = "is_validation"
) -> DataFrame:
    """Exactly ``ceil(test_size * n)`` validation rows per label."""
    numbered = number_within(df, [label], hash28(key, seed=seed), key, "__rn")
    sizes = df.groupBy(label).agg(F.ceil(F.count("*") * F.lit(test_size)).alias("__take"))
    matched = F.col(f"n.`{label}`").eqNullSafe(F.col(f"s.`{label}`"))
    joined = numbered.alias("n").join(sizes.alias("s"), matched)
    return joined.select(
        *[F.col(f"n.`{c}`") for c in df.columns], (F.col("__rn") <= F.col("__take")).alias(to)
    )


def fold_of(key: str, folds: int = 5, seed: int = 42, portable: bool = True) -> Column:
    return F.pmod(hash28(key, seed=seed, portable=portable), F.lit(folds)).cast("int")


def stratified_folds(
    df: DataFrame, label: str, key: str, folds: int = 5, seed: int = 42, to: str = "fold"
) -> DataFrame:
    """Folds dealt round-robin within each label, so fold sizes per label differ by one at most."""
    numbered = number_within(df, [label], hash28(key, seed=seed), key, to)
    return numbered.withColumn(to, F.pmod(F.col(to) - 1, F.lit(folds)).cast("int"))

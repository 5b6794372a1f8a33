"""Lookup joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.stats import quoted

BROADCAST_ROWS = 100_000
SALTS = 64


def lookup_join(
    df: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    defaults: Mapping[str, object] | None = None,
    rows: int | None = None,
    hot: Sequence | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Left join to a table that is unique on ``keys``; unmatched rows get ``defaults``.

    ``rows`` is the known size of ``table``. Up to ``BROADCAST_ROWS`` it is broadcast. Beyond that
    both sides shuffle, and the ``hot`` values of the first key (known from the fit) are spread
    over ``salts`` partitions: their few table rows are repeated, the data rows pick a salt from a
    hash of the whole row, so a lost task recomputes the same partition. Without a known size there
    is no hint and adaptive execution decides from the measured size.
    """
    names = [c for c in table.columns if c not in keys]
    if rows is not None and rows <= BROADCAST_ROWS:
        joined = df.join(F.broadcast(table), list(keys), "left")
    elif hot:
        joined = _salted(df, table, keys, list(hot), salts)
    else:
        joined = df.join(table, list(keys), "left")
    filled = [
        F.coalesce(quoted(n), F.lit(defaults[n])).alias(n) if defaults and n in defaults else quoted(n)
        for n in names
    ]
    return joined.select(*[quoted(c) for c in df.columns], *filled)


def _salted(df, table, keys, hot, salts) -> DataFrame:
    first = quoted(keys[0])
    is_hot = F.coalesce(first.isin(hot), F.lit(False))
    spread = F.pmod(F.xxhash64(*[quoted(c) for c in df.columns]), F.lit(salts)).cast("int")
    left = df.withColumn("__salt", F.when(is_hot, spread).otherwise(0))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = table.withColumn("__salt", F.explode(copies))
    return left.join(right, [*keys, "__salt"], "left").drop("__salt")


def lookup_value(df: DataFrame, column: str, mapping: Mapping, default, to: str) -> DataFrame:
    """Replace-with-default from a driver-side mapping (bounded by what the caller wrote down)."""
    kind = "double" if any(isinstance(v, float) for v in mapping.values()) else "bigint"
    if any(isinstance(v, str) for v in mapping.values()):
        kind = "string"
    table = df.sparkSession.createDataFrame(list(mapping.items()), f"`{column}` string, `{to}` {kind}")
    return lookup_join(df, table, [column], {to: default}, rows=len(mapping))


def _by_key(tables: Sequence[DataFrame], key: str) -> DataFrame:
    """One row per key with the columns of all tables and ``__in``, the numbers of the tables that hold it: one shuffle."""
    names = [c for t in tables for c in t.columns if c != key]
    if len(set(names)) < len(names):
        raise ValueError(f"columns of several tables: {sorted({c for c in names if names.count(c) > 1})}")
    parts = [t.withColumn("__table", F.lit(i)).where(quoted(key).isNotNull()) for i, t in enumerate(tables)]
    while len(parts) > 1:  # pairs of pairs: a plan as deep as the logarithm of the number of tables
        pairs = [parts[i:i + 2] for i in range(0, len(parts), 2)]
        parts = [p[0].unionByName(p[1], allowMissingColumns=True) if len(p) == 2 else p[0] for p in pairs]
    held = [F.first(quoted(c), ignorenulls=True).alias(c) for c in names]
    return parts[0].groupBy(quoted(key)).agg(*held, F.collect_set("__table").alias("__in"))


def align_on_key(tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Row-aligned columns of several tables that share a unique key: the keys that all of them hold."""
    return _by_key(tables, key).where(F.size("__in") == len(tables)).drop("__in")


def missing_keys(tables: Mapping[str, DataFrame], key: str) -> DataFrame:
    """(key, missing): keys that only some tables hold, and the names of those that do not."""
    names = F.array(*[F.lit(n) for n in tables])
    own = [t.select(quoted(key)) for t in tables.values()]
    there = F.transform("__in", lambda i: F.element_at(names, i + 1))
    absent = F.array_except(names, there)
    return _by_key(own, key).select(quoted(key), F.array_sort(absent).alias("missing")).where(F.size("missing") > 0)


def count_shared_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many keys of ``left`` also occur in ``right`` (0 means the sets do not overlap)."""
    keys = left.select(quoted(key)).join(right.select(quoted(key)), key, "left_semi")
    return keys.agg(F.count_distinct(quoted(key)).alias("shared_keys"))

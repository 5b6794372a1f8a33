"""Global ranks, row numbers and running maxima without a single-partition window.

All of them work in two levels: rows fall into value ranges (literal cut points), each range is
ranked on its own, and the totals of the ranges - a table with one row per range - give the offset.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.hashing import HASH_RANGE
from tabloom.operators.lookup import lookup_join
from tabloom.operators.stats import RANGE_ROWS, cut_points, quoted
from tabloom.session import shared_dir


def with_range(df: DataFrame, column: str, cuts: Sequence[float], to: str = "__range") -> DataFrame:
    """Range id of a double column by binary search over literal cut points."""
    splits = [-math.inf, *cuts, math.inf]
    if len(splits) < 3:
        return df.withColumn(to, F.lit(0.0))
    return Bucketizer(splits=splits, inputCol=column, outputCol=to, handleInvalid="keep").transform(df)


def _earlier(columns: Sequence[str], order: str) -> Window:
    return Window.partitionBy(*columns).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def average_rank(df: DataFrame, column: str, to: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Ascending 1-based rank; ties share the mean of their ranks; NULL stays NULL.

    Ties are compressed first, so a value held by a third of the rows is one row while ranking and
    is salted when ranks return to the rows.
    """
    ranks, hot = value_ranks(df, column, to, range_rows)
    return with_ranks(df, column, ranks, hot)


def with_ranks(df: DataFrame, column: str, ranks: DataFrame, hot: Sequence[float]) -> DataFrame:
    """Ranks of values (``__value`` and one column) back on the rows."""
    keyed = df.withColumn("__value", quoted(column).cast(ranks.schema["__value"].dataType))
    return lookup_join(keyed, ranks, ["__value"], hot=hot).drop("__value")


def value_ranks(df: DataFrame, column: str, to: str, range_rows: int = RANGE_ROWS) -> tuple[DataFrame, list[float]]:
    """(__value, rank) of each distinct value, and the values that many rows share."""
    if not isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType, T.IntegerType, T.ShortType, T.ByteType)):
        return _typed_ranks(df, column, to, range_rows)
    points, hot = cut_points(df, quoted(column), range_rows)
    number = quoted(column).cast("double")
    values = df.select(number.alias("__value")).dropna().groupBy("__value").agg(F.count("*").alias("__ties"))
    ranged = with_range(values, "__value", points)
    running = Window.partitionBy("__range").orderBy("__value").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("__before", F.coalesce(F.sum("__ties").over(running), F.lit(0)))
    offsets = _range_offsets(ranged, {"__offset": F.sum("__ties")})
    ranks = local.join(F.broadcast(offsets), "__range").select(
        "__value", (F.col("__offset") + F.col("__before") + (F.col("__ties") + 1) / 2.0).alias(to)
    )
    return ranks, hot


def _typed_ranks(df: DataFrame, column: str, to: str, range_rows: int) -> tuple[DataFrame, list]:
    """The same for longs, decimals, texts and dates, which are compared as what they are: as doubles they would tie.

    Distinct values are dealt by range and sorted; the checkpoint makes the ranges facts before they are counted.
    """
    shared_dir(df.sparkSession)
    values = df.select(quoted(column).alias("__value")).where(F.col("__value").isNotNull()).groupBy("__value").agg(F.count("*").alias("__ties"))
    ordered = values.repartitionByRange("__value").withColumn("__range", F.spark_partition_id()).checkpoint()
    rows = ordered.agg(F.sum("__ties")).first()[0] or 0
    hot = [r["__value"] for r in ordered.where(F.col("__ties") > max(range_rows, rows // 1000)).select("__value").collect()]
    running = Window.partitionBy("__range").orderBy("__value").rowsBetween(Window.unboundedPreceding, -1)
    local = ordered.withColumn("__before", F.coalesce(F.sum("__ties").over(running), F.lit(0)))
    offsets = _range_offsets(ordered, {"__offset": F.sum("__ties")})
    ranks = local.join(F.broadcast(offsets), "__range").select(
        "__value", (F.col("__offset") + F.col("__before") + (F.col("__ties") + 1) / 2.0).alias(to)
    )
    return ranks, hot


def _range_offsets(ranged: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Sums over all earlier ranges; at most as many rows as there are cut points plus one."""
    sums = ranged.groupBy("__range").agg(*[agg.alias(n) for n, agg in totals.items()])
    before = _earlier([], "__range")
    return sums.select(
        "__range", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in totals]
    )


def auc(df: DataFrame, label: str, score: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Exact ROC AUC: share of (positive, negative) pairs in the right order, ties count half."""
    points, _ = cut_points(df, quoted(score), range_rows)
    return _pair_share(
        df.select(quoted(label).cast("int").alias("__y"), quoted(score).cast("double").alias("__value")), [], points
    ).select("auc")


def auc_by(df: DataFrame, group: str, label: str, score: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """AUC per value of ``group`` (for example per class, one against the rest)."""
    points, _ = cut_points(df, quoted(score), range_rows)
    rows = df.select(
        quoted(group).alias(group), quoted(label).cast("int").alias("__y"),
        quoted(score).cast("double").alias("__value"),
    )
    return _pair_share(rows, [group], points).select(group, "auc")


def _pair_share(rows: DataFrame, group: list[str], points: Sequence[float]) -> DataFrame:
    tied = rows.dropna().groupBy(*group, "__value").agg(
        F.sum("__y").alias("__pos"), F.sum(1 - F.col("__y")).alias("__neg")
    )
    ranged = with_range(tied, "__value", points)
    running = (
        Window.partitionBy(*group, "__range").orderBy("__value").rowsBetween(Window.unboundedPreceding, -1)
    )
    negatives_below = F.coalesce(F.sum("__neg").over(running), F.lit(0))
    # counts first become doubles: pair counts pass 2^63 long before row counts do
    pairs = F.col("__pos").cast("double") * (negatives_below + F.col("__neg") / 2.0)
    per_range = (
        ranged.withColumn("__pairs", pairs).groupBy(*group, "__range")
        .agg(F.sum("__pairs").alias("__pairs"), F.sum("__pos").alias("__pos"), F.sum("__neg").alias("__neg"))
    )
    before = F.coalesce(F.sum("__neg").over(_earlier(group, "__range")), F.lit(0))
    total = per_range.withColumn("__cross", F.col("__pos").cast("double") * before).groupBy(*group).agg(
        (F.sum("__pairs") + F.sum("__cross")).alias("__good"),
        F.sum("__pos").cast("double").alias("__p"), F.sum("__neg").cast("double").alias("__n"),
    )
    return total.withColumn("auc", F.try_divide(F.col("__good"), F.col("__p") * F.col("__n")))


def number_within(
    df: DataFrame, group: Sequence[str], order: Column, tie: str, to: str, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """``row_number`` within a group, ordered by a 28-bit hash and then the row key.

    A hash is uniform, so equal hash ranges split even a group with a third of the rows into even
    parts: one range per ``range_rows`` rows of the table, up to 2^16.
    """
    ranges = min(1 << 16, 1 << (df.count() // range_rows).bit_length())
    if ranges == 1:
        plain = Window.partitionBy(*[quoted(g) for g in group]).orderBy("__order", quoted(tie))
        numbered = df.withColumn("__order", order).withColumn(to, F.row_number().over(plain).cast("bigint"))
        return numbered.select(*[quoted(c) for c in df.columns], quoted(to))
    part = F.floor(F.col("__order") / F.lit(HASH_RANGE // ranges)).cast("int")
    ranged = df.withColumn("__order", order).withColumn("__range", part)
    keys = [*group, "__range"]
    sizes = ranged.groupBy(*keys).agg(F.count("*").alias("__size"))
    offsets = sizes.select(
        *keys, F.coalesce(F.sum("__size").over(_earlier(group, "__range")), F.lit(0)).alias("__offset")
    )
    local = ranged.withColumn(
        to, F.row_number().over(Window.partitionBy(*keys).orderBy("__order", quoted(tie)))
    )
    matched = [F.col(f"l.`{k}`").eqNullSafe(F.col(f"o.`{k}`")) for k in keys]
    joined = local.alias("l").join(offsets.alias("o"), matched, "inner")
    return joined.select(
        *[F.col(f"l.`{c}`") for c in df.columns], (F.col(to) + F.col("__offset")).cast("bigint").alias(to)
    )


def number_rows(
    df: DataFrame, order: str, to: str = "id", start: int = 0, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Consecutive numbers in the order of a unique numeric column."""
    points, _ = cut_points(df, quoted(order), range_rows)
    ranged = with_range(df.withColumn("__value", quoted(order).cast("double")), "__value", points)
    local = F.row_number().over(Window.partitionBy("__range").orderBy(quoted(order)))
    offsets = _range_offsets(ranged, {"__offset": F.count("*")})
    numbered = ranged.withColumn("__local", local).join(F.broadcast(offsets), "__range")
    number = (F.col("__local") + F.col("__offset") - 1 + start).cast("bigint").alias(to)
    return numbered.select(number, *[quoted(c) for c in df.columns])


def number_values(values: DataFrame, column: str, to: str, small: int = 100_000) -> DataFrame:
    """0-based position of each distinct value in sorted order, for any ordered type.

    Few values are numbered by one window. Many are range-partitioned, sorted and cut off with a
    checkpoint, so that the number of rows per partition and the order inside it are facts on
    shared storage before they are used.
    """
    if values.limit(small + 1).count() <= small:
        return values.withColumn(to, F.row_number().over(Window.orderBy(quoted(column))).cast("bigint") - 1)
    shared_dir(values.sparkSession)
    at = F.monotonically_increasing_id()
    ordered = (
        values.repartitionByRange(quoted(column)).sortWithinPartitions(quoted(column))
        .withColumn("__part", F.shiftright(at, 33)).withColumn("__at", at.bitwiseAND(F.lit((1 << 33) - 1)))
        .checkpoint()
    )
    sizes = ordered.groupBy("__part").agg(F.count("*").alias("__size"))
    offsets = sizes.select(
        "__part", F.coalesce(F.sum("__size").over(_earlier([], "__part")), F.lit(0)).alias("__offset")
    )
    return ordered.join(F.broadcast(offsets), "__part").select(
        *[quoted(c) for c in values.columns], (F.col("__offset") + F.col("__at")).alias(to)
    )


def running_max(
    df: DataFrame, group: Sequence[str], order: str, column: str, to: str, span: int | None = None,
    exclusive: bool = False, range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Maximum of ``column`` up to the row (``exclusive``: before the row), over an integer order column.

    A NULL group is a group; rows without order are a span of their own, before all others.

    Rows are cut into spans of the order column, of about ``range_rows`` rows or else ``span`` units each; a span's own
    running maximum is combined with the maximum of all earlier spans.
    """
    if span is None:
        points, _ = cut_points(df, quoted(order), range_rows)
        spanned = with_range(df.withColumn("__n", quoted(order).cast("double")), "__n", points, "__span").drop("__n")
        spanned = spanned.withColumn("__span", F.when(quoted(order).isNotNull(), F.col("__span")))
    else:
        spanned = df.withColumn("__span", F.floor(quoted(order) / F.lit(span)).cast("bigint"))
    keys = [*group, "__span"]
    peaks = spanned.groupBy(*keys).agg(F.max(quoted(column)).alias("__peak"))
    earlier = peaks.select(*keys, F.max("__peak").over(_earlier(group, "__span")).alias("__earlier"))
    end = -1 if exclusive else 0
    inside = Window.partitionBy(*keys).orderBy(quoted(order)).rowsBetween(Window.unboundedPreceding, end)
    here = spanned.withColumn("__here", F.max(quoted(column)).over(inside))
    matched = [F.col(f"l.`{k}`").eqNullSafe(F.col(f"o.`{k}`")) for k in keys]
    joined = here.alias("l").join(earlier.alias("o"), matched, "inner")
    return joined.select(
        *[F.col(f"l.`{c}`").alias(c) for c in df.columns], F.greatest(F.col("__here"), F.col("__earlier")).alias(to)
    )

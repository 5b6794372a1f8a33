"""Missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.base import Fitted, Step, present, replace_columns
from tabloom.operators.categories import MISSING
from tabloom.operators.stats import exact_quantiles, numeric_columns, quoted, string_columns, summarize, value


class Imputer(Step):
    """Fill missing values with a statistic of the fitted table.

    numeric: ``mean``, ``median`` (exact; ``approx=True`` for one bounded sketch instead),
    ``most_frequent`` (tie: smallest), ``constant`` (0) or ``knn``. On single columns ``knn`` has
    no distances to work with, which makes it the mean.
    categorical: ``mode`` (tie: smallest; ``'missing'`` if there is no value); anything else fills
    ``'missing'``. Columns complete at fit time are left alone unless ``always``.
    """

    defaults = {
        "numeric_strategy": "mean", "categorical_strategy": "mode", "numeric_cols": None,
        "categorical_cols": None, "always": False, "approx": False,
    }

    def _fit(self, df: DataFrame) -> "ImputerModel":
        numbers = self.resolve(df, numeric_columns, "numeric_cols")
        strings = self.resolve(df, string_columns, "categorical_cols")
        strategy = self.opt("numeric_strategy")
        if strategy not in ("mean", "knn", "median", "most_frequent", "constant"):
            raise ValueError(f"unknown imputation strategy: {strategy}")
        stats = {"held": F.count}
        if strategy in ("mean", "knn"):
            stats["fill"] = F.avg
        if strategy == "median" and self.opt("approx"):
            stats["fill"] = lambda c: F.percentile_approx(c, 0.5, 10_000)
        rows, found = summarize(df, {**dict.fromkeys(numbers, stats), **dict.fromkeys(strings, {"held": F.count})})
        gaps = {c for c in numbers + strings if self.opt("always") or found[c]["held"] < rows}
        lacking_numbers = [c for c in numbers if c in gaps]
        lacking_strings = [c for c in strings if c in gaps]

        if strategy == "median" and not self.opt("approx"):
            middles = exact_quantiles(df, lacking_numbers, [0.5])
            fills = {c: middles[c][0] for c in lacking_numbers}
        elif strategy == "most_frequent":
            fills = most_frequent(df, lacking_numbers)
        elif strategy == "constant":
            fills = dict.fromkeys(lacking_numbers, 0)
        else:
            fills = {c: found[c]["fill"] for c in lacking_numbers}
        modes = most_frequent(df, lacking_strings) if self.opt("categorical_strategy") == "mode" else {}
        for c in lacking_strings:
            fills[c] = MISSING if modes.get(c) is None else modes[c]
        # a column without any value has no statistic: it stays missing
        return ImputerModel(fills={c: _plain(v) for c, v in fills.items() if v is not None})


class ImputerModel(Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        fills = self.fitted["fills"]
        return replace_columns(df, {c: F.coalesce(value(df, c), F.lit(fills[c])) for c in present(df, fills)})


def most_frequent(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent value per column, smallest on a tie: counts per value, then one row per type.

    Columns of one type share a job; only counts are compared, no task holds all values.
    """
    out: dict[str, object] = {}
    kinds: dict[str, list[str]] = {}
    for c in columns:
        kinds.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    for same in kinds.values():
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), value(df, c).alias("v")) for c in same]))
        counts = df.select(pairs.alias("p")).select("p.*").dropna().groupBy("c", "v").agg(F.count("*").alias("n"))
        first = counts.groupBy("c").agg(F.min(F.struct(-F.col("n"), F.col("v"))).alias("e"))  # one row per column
        out.update({r["c"]: r["v"] for r in first.select("c", "e.v").collect()})
    return out


def _plain(v):
    return float(v) if type(v).__name__ == "Decimal" else v


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, one row, one wide aggregate."""
    return df.agg(*[
        (F.count(F.lit(1)) - F.count(value(df, c))).alias(c) for c in df.columns
    ])


def any_null(df: DataFrame) -> DataFrame:
    rows = F.count(F.lit(1))
    flags = [rows > F.count(value(df, c)) for c in df.columns]
    out = flags[0]
    for f in flags[1:]:
        out = out | f
    return df.agg(out.alias("has_nulls"))


def drop_target(df: DataFrame, target: str) -> DataFrame:
    """Everything but the target; a table without it passes unchanged."""
    return df.drop(quoted(target)) if target in df.columns else df

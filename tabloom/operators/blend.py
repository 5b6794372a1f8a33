"""Blends of prediction columns of the same row: projections, apart from the rank blend."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.rank import value_ranks, with_ranks
from tabloom.operators.stats import quoted

# Floors of the geometric mean and of the score-based weights.
GEOMETRIC_FLOOR = 1e-8
WEIGHT_FLOOR = 1e-8


def _total(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def average(columns: Sequence[str]) -> Column:
    return _total([quoted(c) for c in columns]) / F.lit(float(len(columns)))


def weighted(columns: Sequence[str], *, weights: Sequence[float] | None = None) -> Column:
    """Weighted mean; weights default to equal and are normalised by their sum."""
    weights = [1.0] * len(columns) if weights is None else list(weights)
    if len(weights) != len(columns):
        raise ValueError("one weight per prediction column is needed")
    return _total([quoted(c) * F.lit(float(w)) for c, w in zip(columns, weights)]) / F.lit(float(sum(weights)))


def geometric(columns: Sequence[str]) -> Column:
    logs = [F.ln(F.greatest(quoted(c).cast("double"), F.lit(GEOMETRIC_FLOOR))) for c in columns]
    return F.exp(_total(logs) / F.lit(float(len(columns))))


def rank_average(df: DataFrame, columns: Sequence[str], to: str) -> DataFrame:
    """Row mean of the average-tie ranks of each column.

    Every rank table is made from ``df`` itself, so the plan grows by one table and one join a column.
    """
    ranked = df
    for c in columns:
        ranks, hot = value_ranks(df, c, f"__rank_{c}")
        ranked = with_ranks(ranked, c, ranks, hot)
    mean = average([f"__rank_{c}" for c in columns]).alias(to)
    return ranked.select(*[quoted(c) for c in df.columns], mean)


def score_weights(scores: Mapping[str, float]) -> dict[str, float]:
    """Weights proportional to how far a score (higher is better) is above the worst."""
    worst = min(scores.values())
    raised = {m: s - worst + WEIGHT_FLOOR for m, s in scores.items()}
    total = sum(raised.values())
    return {m: r / total for m, r in raised.items()}


def validation_scores(df: DataFrame, label: str, columns: Sequence[str], problem: str = "regression") -> dict[str, float]:
    """Negative squared error or accuracy of each prediction column, from one aggregate."""
    y = quoted(label)
    if problem == "classification":
        exprs = [F.avg((y == quoted(c)).cast("double")) for c in columns]
    else:
        exprs = [-F.avg((y - quoted(c)) * (y - quoted(c))) for c in columns]
    return dict(zip(columns, df.agg(*exprs).first()))


def vote_mean(columns: Sequence[str]) -> Column:
    return average(columns)


def vote_soft(columns: Sequence[str], threshold: float = 0.5) -> Column:
    """Class 1 if the mean probability of class 1 is above one half (a tie goes to class 0)."""
    return (average(columns) > F.lit(threshold)).cast("int")


def mean_probabilities(arrays: Sequence[str]) -> Column:
    """Element-wise mean of probability arrays."""
    zipped = F.arrays_zip(*[quoted(a) for a in arrays])
    return F.transform(zipped, lambda z: _total([z[a] for a in arrays]) / float(len(arrays)))


def argmax(array: Column) -> Column:
    """Position of the largest element, first on a tie."""
    return (F.array_position(array, F.array_max(array)) - 1).cast("int")


def vote_hard(columns: Sequence[str]) -> Column:
    """Most frequent vote, smallest class on a tie; a row-local fold over the sorted votes."""
    votes = F.array_sort(F.array(*[quoted(c) for c in columns]))
    counts = F.transform(F.array_distinct(votes), lambda v: F.size(F.filter(votes, lambda w: w == v)))
    return F.get(F.array_distinct(votes), argmax(counts))


def mean_importance(importances: DataFrame) -> DataFrame:
    """(model, feature, importance) to the mean over the models that report the feature."""
    return importances.groupBy("feature").agg(F.avg("importance").alias("importance"))

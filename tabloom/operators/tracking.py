"""Result log and trial history: latest and best entries, running best, early stop, importances.

A trial table has (trial, score, ts) and one column per parameter, or ``params`` as
map<string,string>. ``study`` columns separate independent searches. A higher score is better.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.operators.rank import running_max
from tabloom.operators.stats import correlation, quoted


def latest_results(log: DataFrame) -> DataFrame:
    """Newest entry per model; among equal timestamps the one written first (lowest ``seq`` and ``row``, which the log keeps)."""
    order = [-F.col(c) for c in ("seq", "row") if c in log.columns]
    newest = F.max_by(F.struct("rmse", "timestamp"), F.struct(F.col("timestamp"), *order))
    return log.groupBy("model").agg(newest.alias("e")).select("model", "e.rmse", "e.timestamp")


def best_model(log: DataFrame) -> DataFrame:
    """Model with the smallest latest score."""
    best = F.min_by(F.struct("model", "rmse", "timestamp"), F.struct("rmse", "model"))
    return latest_results(log).agg(best.alias("e")).select("e.*")


def best_trial(trials: DataFrame, study: Sequence[str] = (), keep: Sequence[str] = ("trial", "params", "score")) -> DataFrame:
    """The first trial that reached the best score."""
    best = F.max_by(F.struct(*keep), F.struct(F.col("score"), -F.col("trial"))).alias("e")
    grouped = trials.groupBy(*study).agg(best) if study else trials.agg(best)
    return grouped.select(*study, "e.*")


def running_best(trials: DataFrame, study: Sequence[str] = (), span: int | None = None) -> DataFrame:
    return running_max(trials, study, "trial", "score", "best_score", span)


def since_improvement(trials: DataFrame, study: Sequence[str] = (), span: int | None = None) -> DataFrame:
    """``no_improvement``: trials since the running best last rose."""
    seen = running_max(trials, study, "trial", "score", "__prev", span, exclusive=True)
    improves = F.col("__prev").isNull() | (F.col("score") > F.col("__prev"))
    seen = seen.withColumn("__improved", F.when(improves, F.col("trial")))
    last = running_max(seen, study, "trial", "__improved", "__last", span)
    return last.select(
        *[quoted(c) for c in trials.columns], F.greatest("__prev", "score").alias("best_score"),
        (F.col("trial") - F.col("__last")).alias("no_improvement"),
    )


def early_stop(trials: DataFrame, rounds: int, study: Sequence[str] = (), span: int | None = None) -> DataFrame:
    """Trial at which a search with this patience ends (NULL: it runs to the end)."""
    counted = since_improvement(trials, study, span)
    stop = F.min(F.when(F.col("no_improvement") >= rounds, F.col("trial"))).alias("stopped_at")
    return counted.groupBy(*study).agg(stop) if study else counted.agg(stop)


def elapsed(trials: DataFrame, study: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """Seconds from the first to the last trial."""
    seconds = F.max(quoted(ts)) - F.min(quoted(ts))
    out = seconds.alias("elapsed")
    return trials.groupBy(*study).agg(out) if study else trials.agg(out)


def cap_trials(trials: DataFrame, n_trials: int) -> DataFrame:
    """The first ``n_trials`` trials of a search."""
    return trials.orderBy("trial").limit(n_trials)


def grid_importance(trials: DataFrame, params: Sequence[str]) -> DataFrame:
    """Spread (population deviation) of the mean score per parameter value, normalised to 1."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(p).alias("param"), quoted(p).cast("string").alias("value")) for p in params
    ]))
    means = (
        trials.select(pairs.alias("p"), "score").select("p.*", "score")
        .groupBy("param", "value").agg(F.avg("score").alias("m"))
    )
    effects = means.groupBy("param").agg(F.stddev_pop("m").alias("effect"))
    return _normalised(effects)


def random_importance(trials: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = ()) -> DataFrame:
    """Strength of the link between a parameter and the score, normalised to 1.

    Numbers: absolute correlation. Categories: correlation ratio (root of the share of the score
    variance that lies between the categories). A constant parameter has none.
    """
    parts = []
    if numeric:
        links = trials.agg(*[F.abs(correlation(quoted(p), F.col("score"))).alias(p) for p in numeric])
        parts.append(links.unpivot([], list(numeric), "param", "effect"))
    if categorical:
        pairs = F.explode(F.array(*[
            F.struct(F.lit(p).alias("param"), quoted(p).cast("string").alias("value")) for p in categorical
        ]))
        sums = (
            trials.select(pairs.alias("p"), "score").select("p.*", "score").groupBy("param", "value")
            .agg(F.count("score").alias("n"), F.avg("score").alias("m"), F.var_pop("score").alias("v"))
        )
        weighted_mean = F.sum(F.col("n") * F.col("m")) / F.sum("n")
        stats = sums.groupBy("param").agg(
            weighted_mean.alias("mean"), F.sum(F.col("n") * F.col("m") * F.col("m")).alias("mm"),
            F.sum(F.col("n") * F.col("v")).alias("within"), F.sum("n").alias("n"),
        )
        between = F.greatest(F.col("mm") - F.col("n") * F.col("mean") * F.col("mean"), F.lit(0.0))
        parts.append(stats.select("param", F.sqrt(F.try_divide(between, between + F.col("within"))).alias("effect")))
    effects = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return _normalised(effects)


def _normalised(effects: DataFrame) -> DataFrame:
    clean = F.when(F.isnan("effect"), 0.0).otherwise(F.coalesce(F.col("effect"), F.lit(0.0)))
    total = F.sum("effect").over(Window.partitionBy(F.lit(1)))  # one row per parameter
    return effects.select("param", clean.alias("effect")).select(
        "param", F.coalesce(F.try_divide(F.col("effect"), total), F.lit(0.0)).alias("importance")
    )

"""Evaluation metrics as aggregates over (actual, predicted) columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.rank import auc, auc_by
from tabloom.operators.stats import exact_quantiles, quoted

# Floor of the relative error, and the metrics where smaller is better.
MAPE_FLOOR = 1e-8
ASCENDING_METRICS = ["mse", "rmse", "mae", "log_loss", "rmsle", "mape"]
EPSILON = 2.220446049250313e-16
REGRESSION_METRICS = ["mse", "rmse", "mae", "r2", "rmsle", "mape", "mean_residual", "std_residual"]


def regression_expressions(actual: str, predicted: str) -> dict[str, Column]:
    y, p = quoted(actual).cast("double"), quoted(predicted).cast("double")
    both = y.isNotNull() & p.isNotNull() & ~F.isnan(y) & ~F.isnan(p)  # NaN is missing, as everywhere
    y, p = F.when(both, y), F.when(both, p)
    error, square = y - p, (y - p) * (y - p)
    logs = F.log1p(F.greatest(p, F.lit(0.0))) - F.log1p(F.greatest(y, F.lit(0.0)))
    return {
        "mse": F.avg(square),
        "rmse": F.sqrt(F.avg(square)),
        "mae": F.avg(F.abs(error)),
        "r2": 1 - F.try_divide(F.sum(square), F.var_pop(y) * F.count(y)),
        "rmsle": F.sqrt(F.avg(F.when(both, logs * logs))),
        "mape": 100 * F.avg(F.abs(error) / F.greatest(F.abs(y), F.lit(MAPE_FLOOR))),
        "mean_residual": F.avg(error),
        "std_residual": F.stddev_pop(error),
    }


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """All regression metrics in one aggregate, optionally per group."""
    wanted = [e.alias(n) for n, e in regression_expressions(actual, predicted).items()]
    return df.groupBy(*[quoted(c) for c in by]).agg(*wanted) if by else df.agg(*wanted)


def error_percentiles(
    df: DataFrame, actual: str, predicted: str, percents: Sequence[int] = (90, 95, 99)
) -> DataFrame:
    """Exact percentiles of the absolute error, one row."""
    errors = df.select(F.abs(quoted(actual) - quoted(predicted)).alias("e"))
    found = exact_quantiles(errors, ["e"], [p / 100 for p in percents])["e"]
    schema = ", ".join(f"percentile_{p}_error double" for p in percents)
    return df.sparkSession.createDataFrame([tuple(found)], schema)


def confusion_matrix(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Cells that occur: (actual, predicted, n)."""
    return df.groupBy(quoted(actual).alias("actual"), quoted(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def full_confusion_matrix(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """The square matrix including zero cells; labels are those seen on either side."""
    cells = confusion_matrix(df, actual, predicted)
    sides = F.collect_set("actual"), F.collect_set("predicted")
    labels = cells.agg(F.sort_array(F.array_union(*sides)).alias("labels"))  # one row of class labels
    actuals = labels.select(F.explode("labels").alias("actual"), "labels")
    square = actuals.select("actual", F.explode("labels").alias("predicted"))
    return square.join(cells, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("n", F.lit(0)).alias("n")
    )


def class_scores(cells: DataFrame) -> DataFrame:
    """Precision, recall and F1 per class from confusion cells; 0/0 is 0."""
    sides = F.explode(F.array(
        F.struct(
            F.col("actual").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("guessed"),
            F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit"),
        ),
        F.struct(
            F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("support"),
            F.col("n").alias("guessed"), F.lit(0).cast("bigint").alias("hit"),
        ),
    ))
    sums = cells.select(sides.alias("s")).select("s.*").groupBy("class").agg(
        *[F.sum(c).alias(c) for c in ("support", "guessed", "hit")]
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    return sums.select(
        "class", "support",
        ratio(F.col("hit"), F.col("guessed")).alias("precision"),
        ratio(F.col("hit"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hit"), F.col("guessed") + F.col("support")).alias("f1"),
    )


def binary_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = (), positive=1) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class."""
    y, p = quoted(actual), quoted(predicted)
    hit = F.count_if((y == F.lit(positive)) & (p == F.lit(positive))).cast("double")
    guessed = F.count_if(p == F.lit(positive)).cast("double")
    support = F.count_if(y == F.lit(positive)).cast("double")
    zero = F.lit(0.0)
    wanted = [
        F.avg((y == p).cast("double")).alias("accuracy"),
        F.coalesce(F.try_divide(hit, guessed), zero).alias("precision"),
        F.coalesce(F.try_divide(hit, support), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * hit, guessed + support), zero).alias("f1"),
    ]
    return df.groupBy(*[quoted(c) for c in by]).agg(*wanted) if by else df.agg(*wanted)


def multiclass_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Accuracy with macro and support-weighted precision, recall and F1, from confusion cells."""
    scores = class_scores(confusion_matrix(df, actual, predicted))
    weight = F.sum("support")
    wanted = [(F.sum(F.col("recall") * F.col("support")) / weight).alias("accuracy")]
    for m in ("precision", "recall", "f1"):
        wanted.append(F.avg(m).alias(f"{m}_macro"))
        wanted.append((F.sum(F.col(m) * F.col("support")) / weight).alias(f"{m}_weighted"))
    return scores.agg(*wanted)


def log_loss_expression(true_probability: Column) -> Column:
    bounded = F.least(F.greatest(true_probability, F.lit(EPSILON)), F.lit(1 - EPSILON))
    return -F.avg(F.when(true_probability.isNotNull(), F.ln(bounded)))


def log_loss(df: DataFrame, actual: str, probability: str) -> DataFrame:
    """Binary log loss; ``probability`` is that of class 1."""
    p = quoted(probability).cast("double")
    return df.agg(log_loss_expression(F.when(quoted(actual) == 1, p).otherwise(1 - p)).alias("log_loss"))


def log_loss_multiclass(df: DataFrame, actual: str, probabilities: str) -> DataFrame:
    """Log loss for an array of probabilities indexed by the class number."""
    return df.agg(log_loss_expression(F.get(quoted(probabilities), quoted(actual).cast("int"))).alias("log_loss"))


def auc_one_vs_rest(df: DataFrame, actual: str, probabilities: str) -> DataFrame:
    """Macro average over the classes of the AUC of each class against the rest."""
    long = df.select(
        quoted(actual).alias("__actual"), F.posexplode(quoted(probabilities)).alias("class", "score")
    ).select("class", "score", (F.col("__actual") == F.col("class")).cast("int").alias("y"))
    return auc_by(long, "class", "y", "score").agg(F.avg("auc").alias("auc_ovr"))


def cost_metric(df: DataFrame, actual: str, predicted: str, costs: DataFrame) -> DataFrame:
    """Total and mean cost; ``costs`` holds (actual, predicted, cost), one row per matrix cell."""
    cells = confusion_matrix(df, actual, predicted)
    priced = cells.join(costs, ["actual", "predicted"], "left")
    total = F.sum(F.col("n") * F.coalesce(F.col("cost"), F.lit(0.0)))
    return priced.agg(total.alias("total_cost"), (total / F.sum("n")).alias("avg_cost_per_sample"))


def business_metrics(df: DataFrame, actual: str, predicted: str, costs: DataFrame | None = None) -> DataFrame:
    """Relative error, error percentiles and - with a cost table - the cost, as one row."""
    mape = regression_expressions(actual, predicted)["mape"].alias("mean_absolute_percentage_error")
    row = {**df.agg(mape).first().asDict(), **error_percentiles(df, actual, predicted).first().asDict()}
    if costs is not None:
        row = {**cost_metric(df, actual, predicted, costs).first().asDict(), **row}
    schema = ", ".join(f"`{n}` double" for n in row)
    return df.sparkSession.createDataFrame([tuple(float(v) if v is not None else None for v in row.values())], schema)


def classification_metrics(
    df: DataFrame, actual: str, predicted: str, probability: str | None = None
) -> DataFrame:
    """Binary metrics for exactly two actual classes, macro and weighted ones otherwise.

    ``probability``: that of class 1 (two classes) or an array over all classes.
    """
    classes = df.select(quoted(actual)).distinct().limit(3).count()
    if classes == 2:
        out = binary_metrics(df, actual, predicted)
        if probability:
            out = _beside(out, auc(df, actual, probability), log_loss(df, actual, probability))
        return out
    out = multiclass_metrics(df, actual, predicted)
    if probability:
        out = _beside(
            out, auc_one_vs_rest(df, actual, probability), log_loss_multiclass(df, actual, probability)
        )
    return out


def _beside(*rows: DataFrame) -> DataFrame:
    """One-row tables side by side."""
    first, *rest = [r.withColumn("__one", F.lit(1)) for r in rows]
    for other in rest:
        first = first.join(other, "__one")
    return first.drop("__one")


def evaluate(
    df: DataFrame, actual: str, predicted: str, problem: str = "regression", probability: str | None = None
) -> DataFrame:
    """The metrics of a problem type."""
    if problem == "regression":
        return regression_metrics(df, actual, predicted)
    if problem in ("classification", "binary_classification"):
        return classification_metrics(df, actual, predicted, probability)
    raise ValueError(f"unknown problem type: {problem}")


def metric(df: DataFrame, name: str, actual: str, predicted: str) -> float:
    """One metric by its short name; ``f1`` is the weighted one, ``predicted`` a probability for auc and logloss."""
    if name in ("rmse", "rmsle", "mae", "mape", "mse", "r2"):
        return df.agg(regression_expressions(actual, predicted)[name]).first()[0]
    if name == "accuracy":
        return df.agg(F.avg((quoted(actual) == quoted(predicted)).cast("double"))).first()[0]
    if name == "f1":
        return multiclass_metrics(df, actual, predicted).first()["f1_weighted"]
    if name == "auc":
        return auc(df, actual, predicted).first()[0]
    if name == "logloss":
        return log_loss(df, actual, predicted).first()[0]
    raise ValueError(f"unknown metric: {name}")


def to_long(metrics: DataFrame, model: str = "model") -> DataFrame:
    """(model, metric, value) rows from one wide row per model."""
    names = [c for c in metrics.columns if c != model]
    return metrics.unpivot([model], names, "metric", "value")


def leaderboard(results: DataFrame, primary: str = "rmse", metrics: Sequence[str] | None = None) -> DataFrame:
    """(model, metric, value) rows to one row per model, best model first."""
    wide = results.groupBy("model").pivot("metric", list(metrics) if metrics else None).agg(F.first("value"))
    if primary not in wide.columns:
        return wide
    order = quoted(primary).asc_nulls_last() if primary in ASCENDING_METRICS else quoted(primary).desc_nulls_last()
    return wide.orderBy(order, "model")

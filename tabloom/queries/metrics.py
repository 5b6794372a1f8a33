"""Evaluation metrics, ranks and leaderboards."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.operators import metrics as M
from tabloom.operators.rank import auc, average_rank
from tabloom.queries.common import (
    CLASSES,
    PREDICTIONS,
    SCORES,
    classes,
    predictions,
    query,
    rnd,
    scores,
    sql_rnd,
    table,
)

# metric -> SQL over y and p
_REGRESSION = {
    "mse": "avg((y - p) * (y - p))",
    "rmse": "sqrt(avg((y - p) * (y - p)))",
    "mae": "avg(abs(y - p))",
    "r2": "1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y))",
    "rmsle": "sqrt(avg(power(ln(1 + greatest(p, 0)) - ln(1 + greatest(y, 0)), 2)))",
    "mape": "100 * avg(abs(y - p) / greatest(1e-8, abs(y)))",
    "mean_residual": "avg(y - p)",
    "std_residual": "stddev_pop(y - p)",
}


def _sql_from(prediction: str) -> str:
    return f"(SELECT y, {prediction} AS p, grp FROM pred)"


_ALL = ", ".join(f"{sql_rnd(e, 3)} AS {n}" for n, e in _REGRESSION.items())


def _rounded(df, digits=3, keep=()):
    floats = {f.name for f in df.schema if f.dataType.simpleString() == "double"}
    return df.select(*[rnd(c, digits).alias(c) if c in floats and c not in keep else F.col(c) for c in df.columns])


@query("metrics_regression", f"WITH {PREDICTIONS} SELECT {_ALL} FROM {_sql_from('m1')}")
def regression(spark, folder):
    return _rounded(M.regression_metrics(predictions(spark, folder), "y", "m1"))


@query("metrics_nan", f"""
    WITH {PREDICTIONS} SELECT {_ALL} FROM (SELECT y, m1 AS p FROM pred WHERE o_orderkey % 13 <> 0 AND o_orderkey % 11 <> 0)""")
def regression_nan(spark, folder):
    """NaN on either side is missing."""
    key, nan = F.col("o_orderkey"), F.lit(float("nan"))
    rows = predictions(spark, folder).withColumn("m1", F.when(key % 13 == 0, nan).otherwise(F.col("m1")))
    return _rounded(M.regression_metrics(rows.withColumn("y", F.when(key % 11 == 0, nan).otherwise(F.col("y"))), "y", "m1"))


@query("metrics_by_group", f"WITH {PREDICTIONS} SELECT grp, {_ALL} FROM {_sql_from('m1')} GROUP BY grp")
def regression_by_group(spark, folder):
    return _rounded(M.regression_metrics(predictions(spark, folder), "y", "m1", by=["grp"]))


_LONG = f"WITH {PREDICTIONS} SELECT model, {_ALL} FROM (SELECT 'm1' AS model, y, m1 AS p FROM pred UNION ALL SELECT 'm2', y, m2 FROM pred) GROUP BY model"


def _long(spark, folder):
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("p")) for m in ("m1", "m2")]))
    return predictions(spark, folder).select("y", pairs.alias("s")).select("y", "s.model", "s.p")


@query("metrics_by_model", _LONG)
def regression_by_model(spark, folder):
    return _rounded(M.regression_metrics(_long(spark, folder), "y", "p", by=["model"]))


@query("leaderboard", _LONG)
def board(spark, folder):
    long = M.to_long(M.regression_metrics(_long(spark, folder), "y", "p", by=["model"]))
    return _rounded(M.leaderboard(long, "rmse", M.REGRESSION_METRICS))


@query("metrics_error_percentiles", f"""
    WITH {PREDICTIONS}
    SELECT {", ".join(f"{sql_rnd(f'quantile_cont(abs(y - m1), 0.{p})')} AS percentile_{p}_error" for p in (90, 95, 99))} FROM pred""")
def percentiles(spark, folder):
    return _rounded(M.error_percentiles(predictions(spark, folder), "y", "m1"), 4)


_BINARY = """avg(CAST(y = guess AS INT)) AS accuracy,
    coalesce(count(*) FILTER (y = 1 AND guess = 1) / nullif(count(*) FILTER (guess = 1), 0), 0) AS precision,
    coalesce(count(*) FILTER (y = 1 AND guess = 1) / nullif(count(*) FILTER (y = 1), 0), 0) AS recall,
    coalesce(2 * count(*) FILTER (y = 1 AND guess = 1) / nullif(count(*) FILTER (guess = 1) + count(*) FILTER (y = 1), 0), 0) AS f1"""
_AUC = """(SELECT (sum(r) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2)
           / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0))
    FROM (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS r FROM scores))"""
_EPS = "2.220446049250313e-16"


def _sql_log_loss(p: str) -> str:
    return f"-avg(ln(least(greatest({p}, {_EPS}), 1 - {_EPS})))"


def _six(*names: str) -> str:
    return ", ".join(f"{sql_rnd(n, 6)} AS {n}" for n in names)


@query("metrics_binary", f"""
    WITH {SCORES} SELECT {_six('accuracy', 'precision', 'recall', 'f1')} FROM (SELECT {_BINARY} FROM scores)""")
def binary(spark, folder):
    return _rounded(M.binary_metrics(scores(spark, folder), "y", "guess"), 6)


@query("metric_auc", f"WITH {SCORES} SELECT {sql_rnd(_AUC, 6)} AS auc")
def binary_auc(spark, folder):
    return _rounded(auc(scores(spark, folder), "y", "p"), 6)


@query("metric_logloss", f"""
    WITH {SCORES} SELECT {sql_rnd(_sql_log_loss('CASE WHEN y = 1 THEN p ELSE 1 - p END'), 6)} AS log_loss FROM scores""")
def binary_log_loss(spark, folder):
    return _rounded(M.log_loss(scores(spark, folder), "y", "p"), 6)


@query("metric_logloss_multiclass", f"""
    WITH {CLASSES} SELECT {sql_rnd(_sql_log_loss('CASE y WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END'), 6)} AS log_loss FROM classes""")
def multi_log_loss(spark, folder):
    return _rounded(M.log_loss_multiclass(classes(spark, folder), "y", "p"), 6)


_PER_CLASS = """labels AS (SELECT y AS k FROM classes UNION SELECT guess FROM classes),
    per AS (SELECT k, count(*) FILTER (y = k) AS sup, count(*) FILTER (guess = k) AS gue,
                   count(*) FILTER (y = k AND guess = k) AS hit FROM classes, labels GROUP BY k),
    sc AS (SELECT k, sup, hit, coalesce(hit / nullif(gue, 0), 0) AS pr, coalesce(hit / nullif(sup, 0), 0) AS re,
                  coalesce(2 * hit / nullif(gue + sup, 0), 0) AS f FROM per)"""
_MULTI = f"""{sql_rnd('sum(hit) / sum(sup)', 6)} AS accuracy,
    {sql_rnd('avg(pr)', 6)} AS precision_macro, {sql_rnd('sum(pr * sup) / sum(sup)', 6)} AS precision_weighted,
    {sql_rnd('avg(re)', 6)} AS recall_macro, {sql_rnd('sum(re * sup) / sum(sup)', 6)} AS recall_weighted,
    {sql_rnd('avg(f)', 6)} AS f1_macro, {sql_rnd('sum(f * sup) / sum(sup)', 6)} AS f1_weighted"""


@query("metrics_multiclass", f"WITH {CLASSES}, {_PER_CLASS} SELECT {_MULTI} FROM sc")
def multiclass(spark, folder):
    return _rounded(M.multiclass_metrics(classes(spark, folder), "y", "guess"), 6)


def _class_auc(k: int) -> str:
    return f"""(SELECT (sum(r) FILTER (y = {k}) - count(*) FILTER (y = {k}) * (count(*) FILTER (y = {k}) + 1) / 2)
        / (count(*) FILTER (y = {k}) * count(*) FILTER (y <> {k}))
        FROM (SELECT y, rank() OVER (ORDER BY p{k}) + (count(*) OVER (PARTITION BY p{k}) - 1) / 2.0 AS r FROM classes))"""


@query("metric_auc_ovr", f"""
    WITH {CLASSES} SELECT {sql_rnd(f'({_class_auc(0)} + {_class_auc(1)} + {_class_auc(2)}) / 3', 6)} AS auc_ovr""")
def multi_auc(spark, folder):
    return _rounded(M.auc_one_vs_rest(classes(spark, folder), "y", "p"), 6)


@query("confusion_matrix", f"""
    WITH {CLASSES}, labels AS (SELECT y AS k FROM classes UNION SELECT guess FROM classes)
    SELECT a.k AS actual, b.k AS predicted, (SELECT count(*) FROM classes WHERE y = a.k AND guess = b.k) AS n
    FROM labels a, labels b""")
def confusion(spark, folder):
    return M.full_confusion_matrix(classes(spark, folder), "y", "guess")


_COSTS = "(CASE WHEN y = guess THEN 0.0 WHEN y > guess THEN 5.0 ELSE 1.5 END)"


def _costs(spark, folder):
    """Cost of each cell, from the labels that occur."""
    cells = M.full_confusion_matrix(classes(spark, folder), "y", "guess")
    a, p = F.col("actual"), F.col("predicted")
    return cells.select("actual", "predicted", F.when(a == p, 0.0).when(a > p, 5.0).otherwise(1.5).alias("cost"))


@query("cost_metric", f"""
    WITH {CLASSES} SELECT {sql_rnd(f'sum({_COSTS})', 6)} AS total_cost, {sql_rnd(f'avg({_COSTS})', 6)} AS avg_cost_per_sample
    FROM classes""")
def cost(spark, folder):
    return _rounded(M.cost_metric(classes(spark, folder), "y", "guess", _costs(spark, folder)), 6)


@query("business_metrics", f"""
    WITH {CLASSES}
    SELECT {sql_rnd(f'sum({_COSTS})', 4)} AS total_cost, {sql_rnd(f'avg({_COSTS})', 4)} AS avg_cost_per_sample,
           {sql_rnd('100 * avg(abs(y - guess) / greatest(1e-8, abs(y)))', 0)} AS mean_absolute_percentage_error,
           {", ".join(f"{sql_rnd(f'quantile_cont(abs(y - guess)::DOUBLE, 0.{p})')} AS percentile_{p}_error" for p in (90, 95, 99))}
    FROM classes""")
def business(spark, folder):
    out = M.business_metrics(classes(spark, folder), "y", "guess", _costs(spark, folder))
    return out.select(*[
        rnd(c, 0 if c.startswith("mean") else 4).alias(c) for c in out.columns
    ])


@query("metrics_dispatch", f"""
    WITH {SCORES}
    SELECT {_six('accuracy', 'precision', 'recall', 'f1')}, {sql_rnd(_AUC, 6)} AS auc,
           (SELECT {sql_rnd(_sql_log_loss('CASE WHEN y = 1 THEN p ELSE 1 - p END'), 6)} FROM scores) AS log_loss
    FROM (SELECT {_BINARY} FROM scores)""")
def dispatched(spark, folder):
    return _rounded(M.evaluate(scores(spark, folder), "y", "guess", "binary_classification", "p"), 6)


@query("metrics_dispatch_multiclass", f"""
    WITH {CLASSES}, {_PER_CLASS}
    SELECT {_MULTI}, {sql_rnd(f'({_class_auc(0)} + {_class_auc(1)} + {_class_auc(2)}) / 3', 6)} AS auc_ovr,
           (SELECT {sql_rnd(_sql_log_loss('CASE y WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END'), 6)} FROM classes) AS log_loss
    FROM sc""")
def dispatched_multiclass(spark, folder):
    return _rounded(M.evaluate(classes(spark, folder), "y", "guess", "classification", "p"), 6)


@query("metrics_short_names", f"""
    WITH {PREDICTIONS}, {SCORES}, {CLASSES}, {_PER_CLASS},
    reg AS (SELECT {_ALL} FROM {_sql_from('m1')})
    SELECT 'rmse' AS metric, rmse AS value FROM reg UNION ALL SELECT 'rmsle', rmsle FROM reg
    UNION ALL SELECT 'mae', mae FROM reg UNION ALL SELECT 'mape', mape FROM reg
    UNION ALL SELECT 'accuracy', {sql_rnd('avg(CAST(y = guess AS INT))', 3)} FROM scores
    UNION ALL SELECT 'f1', {sql_rnd('sum(f * sup) / sum(sup)', 3)} FROM sc
    UNION ALL SELECT 'auc', {sql_rnd(_AUC, 3)}
    UNION ALL SELECT 'logloss', {sql_rnd(_sql_log_loss('CASE WHEN y = 1 THEN p ELSE 1 - p END'), 3)} FROM scores""")
def short_names(spark, folder):
    pred, binary_rows, multi = predictions(spark, folder), scores(spark, folder), classes(spark, folder)
    found = [(n, M.metric(pred, n, "y", "m1")) for n in ("rmse", "rmsle", "mae", "mape")]
    found.append(("accuracy", M.metric(binary_rows, "accuracy", "y", "guess")))
    found.append(("f1", M.metric(multi, "f1", "y", "guess")))
    found += [(n, M.metric(binary_rows, n, "y", "p")) for n in ("auc", "logloss")]
    return _rounded(spark.createDataFrame(found, "metric string, value double"))


@query("rank_average_ties", """
    SELECT o_orderkey, rank() OVER (ORDER BY o_orderkey % 97) + (count(*) OVER (PARTITION BY o_orderkey % 97) - 1) / 2.0 AS r
    FROM orders""")
def ranks(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", (F.col("o_orderkey") % 97).alias("v"))
    return average_rank(rows, "v", "r").select("o_orderkey", "r")

"""Models. Linear ones on one feature have a closed form that SQL can check."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.operators.metrics import regression_metrics
from tabloom.operators.split import is_validation, train_validation
from tabloom.plans.chain import Chain
from tabloom.plans.models import (
    ModelSet,
    TabularModel,
    default_models,
    ensemble_models,
    model_by_name,
    tuned_models,
)
from tabloom.plans.workflow import Workflow
from tabloom.queries.common import VALIDATION, query, rnd, sql_rnd, table
from tabloom.session import scratch_path

KEY = "o_orderkey"


def regression_rows(spark, folder):
    key, c = F.col(KEY), F.col("o_custkey").cast("double")
    h = (key % 1000).cast("double")
    return table(spark, folder, "orders").select(
        key, c.alias("c"), h.alias("h"), (F.col("o_totalprice") / 1000 + c * 0.05 + h * 0.01).alias("y"),
        is_validation(KEY).alias("held"),
    )


REG = f"""reg AS (
    SELECT o_orderkey, o_custkey::DOUBLE AS c, (o_orderkey % 1000)::DOUBLE AS h,
           o_totalprice / 1000 + o_custkey * 0.05::DOUBLE + (o_orderkey % 1000) * 0.01::DOUBLE AS y, {VALIDATION} AS held
    FROM orders),
    fit AS (SELECT count(*) AS n, avg(c) AS mc, stddev_pop(c) AS sc, avg(y) AS my, covar_pop(c, y) / stddev_pop(c) AS g
            FROM reg WHERE NOT held)"""
# weight of the standardised feature
WEIGHTS = {
    "linear": "g",
    "ridge": "n * g / (n + 5000.0)",
    "lasso": "sign(g) * greatest(abs(g) - 2.0, 0)",
    "elasticnet": "sign(g) * greatest(abs(g) - 1.0, 0) / 2.0",
}
SETTINGS = {
    "linear": {}, "ridge": {"alpha": 5000.0}, "lasso": {"alpha": 2.0}, "elasticnet": {"alpha": 2.0, "l1_ratio": 0.5},
}


def sql_prediction(kind: str) -> str:
    return f"my + ({WEIGHTS[kind]}) * (c - mc) / sc"


def linear_model(kind: str) -> TabularModel:
    return model_by_name(kind, **SETTINGS[kind])


def _linear(kind: str):
    def run(spark, folder):
        rows = regression_rows(spark, folder)
        model = linear_model(kind).fit(rows.filter("not held"), ["c"], "y")
        return model.predict(rows, "p").select(KEY, rnd("p").alias("p"))

    return run


for _kind in WEIGHTS:
    query(f"model_{_kind}", f"WITH {REG} SELECT o_orderkey, {sql_rnd(sql_prediction(_kind))} AS p FROM reg, fit")(_linear(_kind))


@query("model_persist", f"WITH {REG} SELECT o_orderkey, {sql_rnd(sql_prediction('ridge'))} AS p FROM reg, fit")
def saved_model(spark, folder):
    rows = regression_rows(spark, folder)
    path = scratch_path(spark, "models")
    ModelSet([linear_model("ridge")]).fit(rows.filter("not held"), ["c"], "y").save(spark, path)
    return ModelSet.load(spark, path).predict(rows).select(KEY, rnd("ridge").alias("p"))


@query("multi_model_predict", f"""
    WITH {REG} SELECT o_orderkey, {", ".join(f"{sql_rnd(sql_prediction(k))} AS {k}" for k in WEIGHTS)} FROM reg, fit""")
def many_models(spark, folder):
    rows = regression_rows(spark, folder)
    models = ModelSet([linear_model(k) for k in WEIGHTS]).fit(rows.filter("not held"), ["c"], "y")
    return models.predict(rows).select(KEY, *[rnd(k).alias(k) for k in WEIGHTS])


@query("feature_importance", f"""
    WITH {REG} {" UNION ALL ".join(f"SELECT '{k}' AS model, 'c' AS feature, {sql_rnd(f'abs({w})')} AS importance FROM fit" for k, w in WEIGHTS.items())}""")
def importance(spark, folder):
    rows = regression_rows(spark, folder)
    models = ModelSet([linear_model(k) for k in WEIGHTS]).fit(rows.filter("not held"), ["c"], "y")
    return models.get_feature_importances(spark).select("model", "feature", rnd("importance").alias("importance"))


def binary_rows(spark, folder):
    key = F.col(KEY)
    return table(spark, folder, "orders").select(
        key, (key % 2).cast("double").alias("x"), (key % 3 % 2).cast("int").alias("y"),
        F.col("o_custkey").cast("double").alias("c"), F.col("o_totalprice").alias("price"),
    )


@query("model_logistic", f"""
    SELECT o_orderkey, {sql_rnd('avg(y) OVER (PARTITION BY x)')} AS p
    FROM (SELECT o_orderkey, o_orderkey % 2 AS x, CAST(o_orderkey % 3 % 2 AS INT) AS y FROM orders)""")
def logistic(spark, folder):
    """Hardly penalised, on a 0/1 feature: the probability is the mean label of the group."""
    rows = binary_rows(spark, folder)
    model = model_by_name("logistic", C=1e12).fit(rows, ["x"], "y")
    return model.score_column(rows, "p").select(KEY, rnd("p").alias("p"))


@query("predict_proba", f"""
    SELECT o_orderkey, CAST(avg(y) OVER (PARTITION BY x) > 0.5 AS DOUBLE) AS p,
           {sql_rnd('1 - avg(y) OVER (PARTITION BY x)')} AS p0, {sql_rnd('avg(y) OVER (PARTITION BY x)')} AS p1
    FROM (SELECT o_orderkey, o_orderkey % 2 AS x, CAST(o_orderkey % 3 % 2 AS INT) AS y FROM orders)""")
def probabilities(spark, folder):
    rows = binary_rows(spark, folder)
    model = model_by_name("ridge", "classification", C=1e12).fit(rows, ["x"], "y")
    scored = model.transform(rows, "p", "proba")
    return scored.select(KEY, "p", rnd(F.col("proba")[0]).alias("p0"), rnd(F.col("proba")[1]).alias("p1"))


# Boosted trees on 0/1 features, without sampling: the first tree predicts the mean of each combination, and the
# others, fitted to what it leaves, add nothing. Numbers of rounds are the queries' own.
WHOLE = {"subsample": 1.0, "colsample_bytree": 1.0}
SMALL = {"n_estimators": 5, "max_depth": 3}


def flag_rows(spark, folder):
    key = F.col(KEY)
    return table(spark, folder, "orders").select(
        key, (key % 2).cast("double").alias("a"), (key % 3 % 2).cast("double").alias("b"), F.lit(1.0).alias("flat"),
        (F.col("o_totalprice") / 1000 + key % 2 * 40 + key % 3 % 2 * 7).alias("y"),
        (F.col("o_custkey") % (key % 2 + 2) > 0).cast("int").alias("flag"), is_validation(KEY).alias("held"),
    )


FLAGS = f"""flags AS (
    SELECT o_orderkey, o_orderkey % 2 AS a, o_orderkey % 3 % 2 AS b,
           o_totalprice / 1000 + o_orderkey % 2 * 40 + o_orderkey % 3 % 2 * 7 AS y,
           CAST(o_custkey % (o_orderkey % 2 + 2) > 0 AS INT) AS flag, {VALIDATION} AS held
    FROM orders),
    means AS (SELECT a, b, avg(y) AS m, 2 * avg(flag) - 1 AS f FROM flags WHERE NOT held GROUP BY a, b)"""


def _boosted(kind: str):
    def run(spark, folder):
        rows = flag_rows(spark, folder)
        model = ModelSet([model_by_name(kind, n_estimators=4, max_depth=3, **WHOLE)]).fit(rows.filter("not held"), ["a", "b"], "y").models[0]
        return model.predict(rows, "p").select(KEY, rnd("p", 3).alias("p"))

    return run


_GROUP_MEANS = f"WITH {FLAGS} SELECT o_orderkey, {sql_rnd('m', 3)} AS p FROM flags JOIN means USING (a, b)"
query("model_gbt_xgb", _GROUP_MEANS)(_boosted("xgboost"))
query("model_gbt_lgb", _GROUP_MEANS)(_boosted("lightgbm"))
query("model_gbt_cat", _GROUP_MEANS)(_boosted("catboost"))


@query("model_gbt_classify", f"""
    WITH {FLAGS} SELECT o_orderkey, {sql_rnd('1 / (1 + exp(-2 * f))')} AS p FROM flags JOIN means USING (a, b)""")
def boosted_classes(spark, folder):
    rows = flag_rows(spark, folder)
    model = model_by_name("xgboost", "classification", n_estimators=1, max_depth=2, **WHOLE).fit(rows.filter("not held"), ["a", "b"], "flag")
    return model.score_column(rows, "p").select(KEY, rnd("p").alias("p"))


@query("model_gbt_multiclass", f"""
    WITH three AS (SELECT o_orderkey, o_orderkey % 2 AS a, o_custkey % (o_orderkey % 2 + 2) AS k FROM orders),
    own AS (SELECT *, {", ".join(f"1 / (1 + exp(-2 * (2 * avg(CAST(k = {c} AS DOUBLE)) OVER (PARTITION BY a) - 1))) AS p{c}" for c in range(3))} FROM three)
    SELECT o_orderkey, {", ".join(f"{sql_rnd(f'p{c} / (p0 + p1 + p2)')} AS p{c}" for c in range(3))} FROM own""")
def boosted_many_classes(spark, folder):
    """Three classes: a booster each against the rest, one round."""
    key = F.col(KEY)
    rows = table(spark, folder, "orders").select(
        key, (key % 2).cast("double").alias("a"), (F.col("o_custkey") % (key % 2 + 2)).cast("int").alias("k"),
    )
    model = model_by_name("catboost", "classification", n_estimators=1, max_depth=2).fit(rows, ["a"], "k")
    scored = model.transform(rows, "p", "proba")
    return scored.select(KEY, *[rnd(F.col("proba")[c]).alias(f"p{c}") for c in range(3)])


@query("gbt_early_stop", f"""
    WITH {FLAGS} SELECT o_orderkey, 2.0::DOUBLE + 4 * a AS p, 1 AS n_trees FROM flags""")
def early_stop(spark, folder):
    """The first tree is exact on the training rows, so no later round lowers the loss of the held ones."""
    rows = flag_rows(spark, folder)
    exact = F.col("a") * 4 + 2
    train = rows.filter("not held").withColumn("y", exact)
    held = rows.filter("held").withColumn("y", exact + F.col("b"))
    model = model_by_name("xgboost", n_estimators=40, max_depth=3, early_stopping_rounds=3, **WHOLE).fit(train, ["a", "b"], "y", held)
    trees = model.model.stages[-1].getNumTrees
    return model.predict(rows, "p").select(KEY, rnd("p").alias("p"), F.lit(trees).alias("n_trees"))


@query("feature_importance_trees", """
    SELECT model, feature, CAST(feature = 'a' AS DOUBLE) AS importance
    FROM (VALUES ('xgboost'), ('catboost')) m(model), (VALUES ('a'), ('flat')) f(feature), (SELECT count(*) FROM orders)""")
def tree_importance(spark, folder):
    """A flag that says something and a column that is flat."""
    rows = flag_rows(spark, folder)
    models = ModelSet([model_by_name(k, n_estimators=1, max_depth=3, **WHOLE) for k in ("xgboost", "catboost")])
    models.fit(rows.filter("not held"), ["a", "flat"], "y")
    return models.get_feature_importances(spark).select("model", "feature", rnd("importance").alias("importance"))


_RIDGE = """line AS (SELECT count(*) AS n, avg(a) AS ma, stddev_pop(a) AS sa, avg(y) AS my, covar_pop(a, y) / stddev_pop(a) AS g
                     FROM flags WHERE NOT held),
    one AS (SELECT a, avg(y) AS m FROM flags WHERE NOT held GROUP BY a)"""


def _set(name: str, make, models: list[str], rounds: int):
    def run(spark, folder):
        rows = flag_rows(spark, folder)
        fitted = ModelSet(make(n_estimators=rounds, **WHOLE)).fit(rows.filter("not held"), ["a"], "y")
        return fitted.predict(rows).select(KEY, *[rnd(m.name, 3).alias(m.name) for m in fitted.models])

    means = [f"{sql_rnd('my + n * g / (n + 1.0) * (a - ma) / sa' if m == 'ridge' else 'm', 3)} AS {m}" for m in models]
    query(name, f"WITH {FLAGS}, {_RIDGE} SELECT o_orderkey, {', '.join(means)} FROM flags JOIN one USING (a), line")(run)


_set("model_defaults", default_models, ["xgboost", "lightgbm", "catboost", "ridge"], 2)
_set("model_tuned_set", tuned_models, [f"{b}_{s}" for b in ("xgb", "lgb", "cb") for s in ("conservative", "balanced")], 2)
_set("model_ensemble_set", ensemble_models, [f"{b}_{i}" for b in ("xgboost", "lightgbm", "catboost") for i in (1, 2, 3)], 2)


@query("model_multiclass")
def multiclass(spark, folder):
    """Ten classes over the elements of the embedding."""
    vectors = table(spark, folder, "embeddings")
    inputs = [f"e{i}" for i in range(64)]
    rows = vectors.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(inputs)])
    model = model_by_name("logistic").fit(rows, inputs, "label")
    return model.transform(rows, "p", "proba").select("vec_id", "label", "p", rnd(F.array_max("proba")).alias("top"))


_VALIDATION_METRICS = ", ".join(f"{sql_rnd(e, 3)} AS {n}" for n, e in {
    "mse": "avg((y - p) * (y - p))", "rmse": "sqrt(avg((y - p) * (y - p)))", "mae": "avg(abs(y - p))",
    "r2": "1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y))",
}.items())


@query("fit_and_score", f"""
    WITH src AS (SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_custkey END AS c,
                        o_totalprice / 1000 + o_custkey * 0.05::DOUBLE AS y, {VALIDATION} AS held FROM orders),
    m AS (SELECT avg(c) AS a FROM src WHERE NOT held),
    imp AS (SELECT y, held, coalesce(c, a) AS c FROM src, m),
    q AS (SELECT quantile_cont(c, 0.25) AS q1, quantile_cont(c, 0.75) AS q3 FROM imp WHERE NOT held),
    clip AS (SELECT y, held, least(greatest(c, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)) AS c FROM imp, q),
    line AS (SELECT regr_slope(y, c) AS s, regr_intercept(y, c) AS i FROM clip WHERE NOT held),
    scored AS (SELECT y, i + s * c AS p FROM clip, line WHERE held)
    SELECT {_VALIDATION_METRICS} FROM scored""")
def fit_and_score(spark, folder):
    """Split, impute, clip, scale and fit on the training part; metrics on the validation part."""
    key = F.col(KEY)
    rows = table(spark, folder, "orders").select(
        key, F.when(key % 17 != 0, F.col("o_custkey")).alias("c"),
        (F.col("o_totalprice") / 1000 + F.col("o_custkey") * 0.05).alias("y"),
    )
    train, validation = train_validation(rows, KEY)
    chain = Chain(key=KEY, label="y").remove_step("feature_selector").remove_step("categorical_encoder").fit(train)
    model = model_by_name("linear").fit(chain.transform(train), ["c"], "y")
    scored = model.predict(chain.transform(validation), "p")
    return regression_metrics(scored, "y", "p").select(*[rnd(m, 3).alias(m) for m in ("mse", "rmse", "mae", "r2")])


@query("workflow")
def whole_flow(spark, folder):
    """The whole flow with two models, ending in result files that are read back."""
    rows = table(spark, folder, "orders").select(
        KEY, "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate", "o_totalprice"
    )
    flow = Workflow("o_totalprice", KEY, models=[model_by_name("ridge"), model_by_name("catboost", **SMALL)]).fit(rows)
    paths = flow.write(rows, scratch_path(spark, "workflow"))
    return spark.read.option("header", True).schema(f"{KEY} bigint, o_totalprice double").csv(paths["ensemble"])


# Boosters on histograms. One round on two flags has a closed form: the mean, and for each leaf a step of its gradients.

_STEP = "0.3::DOUBLE * sign(g) * greatest(abs(g) - 40.0, 0) / (n + 25.0)"


@query("model_newton_penalties", f"""
    WITH {FLAGS}, base AS (SELECT avg(y) AS m FROM flags WHERE NOT held),
    leaf AS (SELECT a, b, sum(y - m) AS g, count(*) AS n FROM flags, base WHERE NOT held GROUP BY a, b)
    SELECT o_orderkey, {sql_rnd(f"m + {_STEP}", 3)} AS p FROM flags JOIN leaf USING (a, b), base""")
def penalised_tree(spark, folder):
    rows = flag_rows(spark, folder)
    model = model_by_name("xgboost", engine="histogram", n_estimators=1, max_depth=2, learning_rate=0.3, reg_lambda=25.0, reg_alpha=40.0, **WHOLE)
    model.fit(rows.filter("not held"), ["a", "b"], "y")
    return model.predict(rows, "p").select(KEY, rnd("p", 3).alias("p"))


@query("model_leafwise", f"""
    WITH {FLAGS}, base AS (SELECT avg(y) AS m FROM flags WHERE NOT held),
    leaf AS (SELECT a, sum(y - m) AS g, count(*) AS n FROM flags, base WHERE NOT held GROUP BY a)
    SELECT o_orderkey, {sql_rnd("m + 0.5::DOUBLE * g / (n + 2.0)", 3)} AS p FROM flags JOIN leaf USING (a), base""")
def leafwise_tree(spark, folder):
    """Two leaves: the flag with the higher gain is split, the other one is not."""
    rows = flag_rows(spark, folder)
    model = model_by_name("lightgbm", engine="histogram", n_estimators=1, num_leaves=2, learning_rate=0.5, lambda_l2=2.0, **WHOLE)
    model.fit(rows.filter("not held"), ["b", "a"], "y")
    return model.predict(rows, "p").select(KEY, rnd("p", 3).alias("p"))


@query("model_symmetric", f"""
    WITH {FLAGS}, base AS (SELECT ln(avg(flag) / (1 - avg(flag))) AS m, avg(flag) AS q FROM flags WHERE NOT held),
    leaf AS (SELECT a, b, sum(q - flag) / (sum(q * (1 - q)) + 3.0) AS step FROM flags, base WHERE NOT held GROUP BY a, b)
    SELECT o_orderkey, {sql_rnd("1 / (1 + exp(-(m - 0.1::DOUBLE * step)))")} AS p FROM flags JOIN leaf USING (a, b), base""")
def symmetric_tree(spark, folder):
    """One Newton step on the log loss in each of the four leaves of a symmetric tree."""
    rows = flag_rows(spark, folder)
    model = model_by_name("catboost", "classification", engine="histogram", n_estimators=1, max_depth=2)
    model.fit(rows.filter("not held"), ["a", "b"], "flag")
    return model.score_column(rows, "p").select(KEY, rnd("p").alias("p"))


@query("gbt_patience")
def boosting_with_patience(spark, folder):
    """All orders, real columns and a category, default rounds and patience on held rows; a test bounds the loss."""
    rows = table(spark, folder, "orders").select(
        KEY, "o_orderpriority", (F.col("o_custkey") % 97).cast("double").alias("c"), F.dayofyear("o_orderdate").cast("double").alias("day"),
        (F.sin(F.dayofyear("o_orderdate") / 58.0) * 10 + (F.col("o_custkey") % 97) / 10.0 + F.col("o_totalprice") / 100000).alias("y"),
        is_validation(KEY).alias("held"),
    )
    model = model_by_name("catboost", engine="histogram", cat_features=["o_orderpriority"], key=KEY, learning_rate=0.3, max_depth=4)
    model.fit(rows.filter("not held"), ["c", "day", "o_orderpriority"], "y", rows.filter("held"))
    trees = model.model.stages[-1].getNumTrees
    return model.predict(rows, "p").select(KEY, "held", "y", "p", F.lit(trees).alias("n_trees"))

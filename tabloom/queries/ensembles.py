"""Blends, votes and stacks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.operators import blend
from tabloom.plans.ensembles import StackingEnsemble, create_ensemble, diverse_ensembles
from tabloom.plans.models import ModelConfig, TabularModel, create_model, model_config, register_model
from tabloom.queries.common import CLASSES, PREDICTIONS, VALIDATION, classes, predictions, query, rnd, sql_hash, sql_rnd, table
from tabloom.queries.models import REG, SMALL, binary_rows, linear_model, regression_rows, sql_prediction

KEY = "o_orderkey"


def _blend(make):
    def run(spark, folder):
        return predictions(spark, folder).select(KEY, rnd(make()).alias("blend"))

    return run


def _sql_blend(expression: str) -> str:
    return f"WITH {PREDICTIONS} SELECT o_orderkey, {sql_rnd(expression)} AS blend FROM pred"


query("blend_average", _sql_blend("(m1 + m2) / 2"))(_blend(lambda: blend.average(["m1", "m2"])))
query("blend_weighted", _sql_blend("(3 * m1 + 7 * m2) / 10"))(_blend(lambda: blend.weighted(["m1", "m2"], weights=[3, 7])))
query("blend_geometric", _sql_blend("exp((ln(greatest(m1, 1e-8)) + ln(greatest(m2, 1e-8))) / 2)"))(
    _blend(lambda: blend.geometric(["m1", "m2"])))
query("vote_mean", _sql_blend("(m1 + m2) / 2"))(_blend(lambda: blend.vote_mean(["m1", "m2"])))


@query("blend_rank_average", f"""
    WITH {PREDICTIONS}
    SELECT o_orderkey, ((rank() OVER (ORDER BY m1) + (count(*) OVER (PARTITION BY m1) - 1) / 2.0)
                        + (rank() OVER (ORDER BY m2) + (count(*) OVER (PARTITION BY m2) - 1) / 2.0)) / 2 AS blend
    FROM pred""")
def rank_blend(spark, folder):
    return blend.rank_average(predictions(spark, folder).select(KEY, "m1", "m2"), ["m1", "m2"], "blend").select(KEY, "blend")


@query("blend_weighted_fit", f"""
    WITH {PREDICTIONS}, three AS (SELECT *, (m1 + m2) / 2 + 500 AS m3, {VALIDATION} AS held FROM pred),
    sc AS (SELECT -avg((y - m1) * (y - m1)) AS a, -avg((y - m2) * (y - m2)) AS b, -avg((y - m3) * (y - m3)) AS c FROM three WHERE held),
    ra AS (SELECT a - least(a, b, c) + 1e-8 AS a, b - least(a, b, c) + 1e-8 AS b, c - least(a, b, c) + 1e-8 AS c FROM sc)
    SELECT o_orderkey, {sql_rnd('(m1 * a + m2 * b + m3 * c) / (a + b + c)', 1)} AS blend FROM three, ra""")
def weighted_by_score(spark, folder):
    from tabloom.operators.split import train_validation

    names = ["m1", "m2", "m3"]
    rows = predictions(spark, folder).withColumn("m3", (F.col("m1") + F.col("m2")) / 2 + 500)
    _, validation = train_validation(rows, KEY)
    weights = blend.score_weights(blend.validation_scores(validation, "y", names))
    return rows.select(KEY, rnd(blend.weighted(names, weights=list(weights.values())), 1).alias("blend"))


@query("vote_soft", f"WITH {CLASSES} SELECT o_orderkey, CAST((p0 + p1 + p2 / 2) / 3 > 0.25 AS INT) AS vote FROM classes")
def soft(spark, folder):
    p = F.col("p")
    rows = classes(spark, folder).select(KEY, p[0].alias("a"), p[1].alias("b"), (p[2] / 2).alias("c"))
    return rows.select(KEY, blend.vote_soft(["a", "b", "c"], threshold=0.25).alias("vote"))


@query("vote_soft_multiclass", f"""
    WITH {CLASSES}, mean AS (SELECT o_orderkey, round((p0 + p1) / 2, 9) AS a, round((p1 + p2) / 2, 9) AS b, round((p2 + p0) / 2, 9) AS c FROM classes)
    SELECT o_orderkey, CAST(CASE WHEN a >= b AND a >= c THEN 0 WHEN b >= c THEN 1 ELSE 2 END AS INT) AS vote FROM mean""")
def soft_multiclass(spark, folder):
    p = F.col("p")
    rows = classes(spark, folder).select(KEY, "p", F.array(p[1], p[2], p[0]).alias("q"))
    mean = F.transform(blend.mean_probabilities(["p", "q"]), lambda v: F.round(v, 9))
    return rows.select(KEY, blend.argmax(mean).alias("vote"))


@query("vote_hard", """
    WITH votes AS (SELECT o_orderkey, unnest([o_orderkey % 3, o_orderkey % 4, o_orderkey % 5]) AS v FROM orders),
    counted AS (SELECT o_orderkey, v, row_number() OVER (PARTITION BY o_orderkey ORDER BY count(*) DESC, v) AS rn
                FROM votes GROUP BY o_orderkey, v)
    SELECT o_orderkey, v AS vote FROM counted WHERE rn = 1""")
def hard(spark, folder):
    key = F.col(KEY)
    rows = table(spark, folder, "orders").select(key, *[(key % k).alias(f"v{k}") for k in (3, 4, 5)])
    return rows.select(KEY, blend.vote_hard(["v3", "v4", "v5"]).alias("vote"))


@query("importance_mean", f"SELECT p_brand AS feature, {sql_rnd('avg(p_retailprice)')} AS importance FROM part GROUP BY p_brand")
def mean_importance(spark, folder):
    long = table(spark, folder, "part").select(
        F.col("p_type").alias("model"), F.col("p_brand").alias("feature"), F.col("p_retailprice").alias("importance")
    )
    return blend.mean_importance(long).select("feature", rnd("importance").alias("importance"))


class OneFeature(TabularModel):
    """A linear model that looks at one of the features only: an example of a model of one's own."""

    def __init__(self, config: ModelConfig):
        super().__init__(ModelConfig(config.name, "linear", config.params, config.target_type))

    def fit(self, df, features, label, validation=None):
        return super().fit(df, [self.config.params["feature"]], label, validation)


register_model("one_feature", OneFeature)


def _bases():
    linear = model_config("linear").params
    return [
        create_model(ModelConfig(f"on_{f}", "one_feature", {**linear, "feature": f})) for f in ("c", "h")
    ]


# two standardised inputs b0, b1 against y with penalty on the squared weights
_META = """st AS (SELECT count(*) AS n, avg(b0) AS m0, stddev_pop(b0) AS s0, avg(b1) AS m1, stddev_pop(b1) AS s1, avg(y) AS my,
           covar_pop(b0, y) / stddev_pop(b0) AS g0, covar_pop(b1, y) / stddev_pop(b1) AS g1, corr(b0, b1) AS r FROM meta),
    wt AS (SELECT *, n * ((n + {a}) * g0 - n * r * g1) / ((n + {a}) * (n + {a}) - n * r * n * r) AS w0,
                  n * ((n + {a}) * g1 - n * r * g0) / ((n + {a}) * (n + {a}) - n * r * n * r) AS w1 FROM st)"""
_FULL = """full_fit AS (SELECT regr_slope(y, c) AS kc, regr_intercept(y, c) AS ic, regr_slope(y, h) AS kh, regr_intercept(y, h) AS ih FROM reg)"""
_FOLDS = f"""folded AS (SELECT *, {sql_hash('o_orderkey')} % 5 AS fold FROM reg),
    per AS (SELECT k.fold, regr_slope(y, c) AS kc, regr_intercept(y, c) AS ic, regr_slope(y, h) AS kh, regr_intercept(y, h) AS ih
            FROM folded, (SELECT DISTINCT fold FROM folded) k WHERE folded.fold <> k.fold GROUP BY k.fold),
    meta AS (SELECT o_orderkey, y, ic + kc * c AS b0, ih + kh * h AS b1 FROM folded JOIN per USING (fold))"""


@query("stack_oof_features", f"""
    WITH {REG}, {_FOLDS} SELECT o_orderkey, {sql_rnd('b0')} AS base_0, {sql_rnd('b1')} AS base_1 FROM meta""")
def oof_features(spark, folder):
    rows = regression_rows(spark, folder)
    out = StackingEnsemble(_bases(), key=KEY).meta_features(rows, ["c", "h"], "y")
    return out.select(KEY, rnd("base_0").alias("base_0"), rnd("base_1").alias("base_1"))


@query("stack_oof", f"""
    WITH {REG}, {_FULL}, {_FOLDS}, {_META.format(a='1.0')}
    SELECT o_orderkey, {sql_rnd('my + w0 * (ic + kc * c - m0) / s0 + w1 * (ih + kh * h - m1) / s1', 3)} AS p FROM reg, full_fit, wt""")
def stacked(spark, folder):
    rows = regression_rows(spark, folder)
    ensemble = create_ensemble(_bases(), "stacking", key=KEY).fit(rows, ["c", "h"], "y")
    return ensemble.transform(rows, "p").select(KEY, rnd("p", 3).alias("p"))


@query("stack_in_sample", f"""
    WITH {REG}, {_FULL}, meta AS (SELECT y, ic + kc * c AS b0, ih + kh * h AS b1 FROM reg, full_fit), {_META.format(a='0.0')}
    SELECT o_orderkey, {sql_rnd('my + w0 * (ic + kc * c - m0) / s0 + w1 * (ih + kh * h - m1) / s1', 3)} AS p FROM reg, full_fit, wt""")
def stacked_in_sample(spark, folder):
    rows = regression_rows(spark, folder)
    ensemble = StackingEnsemble(_bases(), out_of_fold=False).fit(rows, ["c", "h"], "y")
    return ensemble.transform(rows, "p").select(KEY, rnd("p", 3).alias("p"))


_RIDGE, _LASSO = sql_prediction("ridge"), sql_prediction("lasso")


@query("ensemble_by_type", f"""
    WITH {REG}, pair AS (SELECT o_orderkey, y, held, {_RIDGE} AS a, {_LASSO} AS b FROM reg, fit),
    sc AS (SELECT -avg((y - a) * (y - a)) AS sa, -avg((y - b) * (y - b)) AS sb FROM pair WHERE held),
    ra AS (SELECT sa - least(sa, sb) + 1e-8 AS wa, sb - least(sa, sb) + 1e-8 AS wb FROM sc)
    SELECT o_orderkey, {sql_rnd('(a + b) / 2')} AS average, {sql_rnd('(a + b) / 2')} AS voting_soft,
           {sql_rnd('(a * wa + b * wb) / (wa + wb)')} AS weighted
    FROM pair, ra""")
def by_type(spark, folder):
    rows = regression_rows(spark, folder)
    train, validation, out = rows.filter("not held"), rows.filter("held"), rows
    for kind in ("average", "voting_soft", "weighted"):
        ensemble = create_ensemble([linear_model("ridge"), linear_model("lasso")], kind)
        out = ensemble.fit(train, ["c"], "y", validation).transform(out, kind)
    return out.select(KEY, *[rnd(k).alias(k) for k in ("average", "voting_soft", "weighted")])


@query("ensemble_diverse")
def diverse(spark, folder):
    rows = regression_rows(spark, folder)
    train, out = rows.filter("not held"), rows
    for i, ensemble in enumerate(diverse_ensembles(key=KEY, n_estimators=1, max_depth=2)):
        out = ensemble.fit(train, ["c", "h"], "y", rows.filter("held")).transform(out, f"e{i}")
    return out.select(KEY, *[rnd(f"e{i}").alias(f"e{i}") for i in range(3)])


@query("stack_classify")
def stacked_classes(spark, folder):
    rows = binary_rows(spark, folder)
    bases = [create_model(model_config("logistic")), create_model(model_config("catboost", "classification", **SMALL))]
    ensemble = StackingEnsemble(bases, key=KEY, folds=3).fit(rows, ["x", "c", "price"], "y")
    out = ensemble.transform(rows, "p")
    return out.select(KEY, "p", rnd(F.col("p_probability")[1]).alias("p1"))

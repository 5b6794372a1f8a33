"""Parameter grids, draws and searches. Ridge on one feature has closed-form scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.plans.models import model_by_name
from tabloom.plans.search import (
    Search,
    SearchConfig,
    auto_search,
    load_search,
    param_grid,
    quick_search,
    sample_params,
    score,
)
from tabloom.queries.common import query, rnd, sql_hash, sql_rnd, table
from tabloom.queries.models import REG, binary_rows, regression_rows
from tabloom.session import scratch_path

KEY = "o_orderkey"
ALPHAS = [1.0, 1000.0, 20000.0]


def _values(spark, folder, name, column):
    """The distinct values of a low-cardinality column, in order."""
    return [r[0] for r in table(spark, folder, name).select(column).distinct().orderBy(column).collect()]


@query("param_grid", """
    SELECT row_number() OVER (ORDER BY brand, flag, size) - 1 AS trial, brand, flag, size
    FROM (SELECT DISTINCT p_brand AS brand FROM part), (SELECT DISTINCT l_returnflag AS flag FROM lineitem),
         (SELECT DISTINCT p_size AS size FROM part)""")
def grid(spark, folder):
    return param_grid(spark, {
        "size": _values(spark, folder, "part", "p_size"), "brand": _values(spark, folder, "part", "p_brand"),
        "flag": _values(spark, folder, "lineitem", "l_returnflag"),
    })


def _sql_u(name: str) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', p_partkey::VARCHAR, '{name}', '42')), 1, 7))::BIGINT / 268435456.0)"


@query("param_sample", f"""
    SELECT p_partkey, {sql_rnd(f"0.6 + {_sql_u('subsample')} * 0.4", 9)} AS subsample,
           {sql_rnd(f"exp(ln(0.01) + {_sql_u('rate')} * (ln(0.3) - ln(0.01)))", 9)} AS rate,
           3 + CAST(floor({_sql_u('depth')} * 8) AS BIGINT) AS depth,
           ['a', 'b', 'c'][1 + CAST(floor({_sql_u('kind')} * 3) AS BIGINT)] AS kind,
           [10, 20][1 + CAST(floor({_sql_u('bins')} * 2) AS BIGINT)] AS bins, 7 AS fixed
    FROM part""")
def sample(spark, folder):
    space = {
        "subsample": {"type": "uniform", "low": 0.6, "high": 1.0},
        "rate": {"type": "loguniform", "low": 0.01, "high": 0.3},
        "depth": {"type": "int", "low": 3, "high": 10},
        "kind": {"type": "choice", "choices": ["a", "b", "c"]},
        "bins": [10, 20],
        "fixed": 7,
    }
    out = sample_params(table(spark, folder, "part").select("p_partkey"), space, trial="p_partkey")
    return out.withColumn("subsample", rnd("subsample", 9)).withColumn("rate", rnd("rate", 9))


def _sql_ridge_scores(columns: str) -> str:
    """Negative squared error on the held rows for each penalty."""
    per = " UNION ALL ".join(
        f"SELECT {i}::BIGINT AS trial, {a}::DOUBLE AS alpha, "
        f"-avg(power(y - (my + n * g / (n + {a}::DOUBLE) * (c - mc) / sc), 2)) AS score FROM reg, fit WHERE held"
        for i, a in enumerate(ALPHAS))
    return f"WITH {REG}, tr AS ({per}) SELECT {columns} FROM tr"


def _grid_search(spark, folder, **settings):
    rows = regression_rows(spark, folder)
    search = Search(SearchConfig({"alpha": ALPHAS}, n_trials=10, **settings), "grid")
    return search.run(model_by_name("ridge"), rows.filter("not held"), ["c"], "y", rows.filter("held"))


@query("search_holdout", _sql_ridge_scores(f"alpha, {sql_rnd('score', 3)} AS score"))
def holdout(spark, folder):
    rows = regression_rows(spark, folder)
    found = []
    for alpha in ALPHAS:
        model = model_by_name("ridge", alpha=alpha).fit(rows.filter("not held"), ["c"], "y")
        found.append((alpha, score(model, rows.filter("held"), "y", "neg_mean_squared_error")))
    return spark.createDataFrame(found, "alpha double, score double").select("alpha", rnd("score", 3).alias("score"))


@query("search_grid", _sql_ridge_scores(f"trial, alpha, {sql_rnd('score', 3)} AS score"))
def grid_search(spark, folder):
    trials = _grid_search(spark, folder).trials()
    return trials.select("trial", F.col("params")["alpha"].cast("double").alias("alpha"), rnd("score", 3).alias("score"))


@query("search_best", _sql_ridge_scores(
    f"arg_max(alpha, score) AS alpha, {sql_rnd('max(score)', 3)} AS best_score, count(*) AS n_trials"))
def search_best(spark, folder):
    summary = _grid_search(spark, folder).summary()
    rows = [(summary["best_params"]["alpha"], summary["best_score"], summary["n_trials"])]
    out = spark.createDataFrame(rows, "alpha double, best_score double, n_trials bigint")
    return out.withColumn("best_score", rnd("best_score", 3))


@query("trials_persist", _sql_ridge_scores(f"trial, alpha, {sql_rnd('score', 3)} AS score, 'grid' AS method, 10 AS n_trials"))
def saved_trials(spark, folder):
    path = scratch_path(spark, "search")
    _grid_search(spark, folder).save(path)
    config, method, trials = load_search(spark, path)
    return trials.select(
        "trial", F.col("params")["alpha"].cast("double").alias("alpha"), rnd("score", 3).alias("score"),
        F.lit(method).alias("method"), F.lit(config.n_trials).alias("n_trials"),
    )


def _sql_cv() -> str:
    per = " UNION ALL ".join(
        f"SELECT {a}::DOUBLE AS alpha, k.fold, -avg(power(y - (my + n * g / (n + {a}::DOUBLE) * (c - mc) / sc), 2)) AS s "
        f"FROM folded JOIN k ON folded.fold = k.fold GROUP BY k.fold" for a in ALPHAS)
    return f"""WITH {REG}, folded AS (SELECT *, {sql_hash('o_orderkey')} % 5 AS fold FROM reg),
    k AS (SELECT f.fold, count(*) AS n, avg(c) AS mc, stddev_pop(c) AS sc, avg(y) AS my, covar_pop(c, y) / stddev_pop(c) AS g
          FROM folded, (SELECT DISTINCT fold FROM folded) f WHERE folded.fold <> f.fold GROUP BY f.fold),
    per AS ({per}) SELECT alpha, {sql_rnd('avg(s)', 3)} AS score FROM per GROUP BY alpha"""


@query("search_cv", _sql_cv())
def cross_validated(spark, folder):
    rows = regression_rows(spark, folder)
    search = Search(SearchConfig({"alpha": ALPHAS}, cv_folds=5), "grid")
    trials = search.run(model_by_name("ridge"), rows, ["c"], "y", key=KEY).trials()
    return trials.select(F.col("params")["alpha"].cast("double").alias("alpha"), rnd("score", 3).alias("score"))


_DRAWN = " UNION ALL ".join(
    f"SELECT {t}::BIGINT AS trial, exp(ln(0.1) + ('0x' || substr(md5(concat_ws('|', '{t}', 'alpha', '42')), 1, 7))::BIGINT"
    " / 268435456.0 * (ln(1000) - ln(0.1))) AS alpha" for t in range(6))


@query("search_random", f"""
    WITH {REG}, drawn AS ({_DRAWN}),
    tr AS (SELECT trial, alpha, -avg(power(y - (my + n * g / (n + alpha) * (c - mc) / sc), 2)) AS score
           FROM reg, fit, drawn WHERE held GROUP BY trial, alpha),
    best AS (SELECT *, max(score) OVER (ORDER BY trial ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM tr),
    stale AS (SELECT *, trial - max(CASE WHEN seen IS NULL OR score > seen THEN trial END) OVER (ORDER BY trial) AS stale FROM best)
    SELECT trial, {sql_rnd('alpha')} AS alpha, {sql_rnd('score', 3)} AS score FROM stale
    WHERE trial <= coalesce((SELECT min(trial) FROM stale WHERE stale >= 3), 99)""")
def random_search(spark, folder):
    """Penalties follow from the trial's hash; the search ends after three trials without a better score."""
    rows = regression_rows(spark, folder)
    space = {"alpha": {"type": "loguniform", "low": 0.1, "high": 1000}}
    search = Search(SearchConfig(space, n_trials=6, early_stopping_rounds=3), "bayesian")
    result = search.run(model_by_name("ridge"), rows.filter("not held"), ["c"], "y", rows.filter("held"))
    alpha = F.col("params")["alpha"].cast("double")
    return result.trials().select("trial", rnd(alpha).alias("alpha"), rnd("score", 3).alias("score"))


@query("search_auto", _sql_ridge_scores(f"'grid' AS method, trial, {sql_rnd('score', 3)} AS score"))
def automatic(spark, folder):
    rows = regression_rows(spark, folder)
    search = auto_search({"alpha": ALPHAS}, n_trials=3)
    result = search.run(model_by_name("ridge"), rows.filter("not held"), ["c"], "y", rows.filter("held"))
    return result.trials().select(F.lit(search.method).alias("method"), "trial", rnd("score", 3).alias("score"))


@query("search_boosted")
def boosted(spark, folder):
    """A preset space on boosted trees, scored by weighted F1."""
    rows = binary_rows(spark, folder)
    search = quick_search("catboost", "classification", "random", n_trials=2)
    search.config.search_space.update({"n_estimators": [2, 3], "max_depth": [2, 3]})
    result = search.run(model_by_name("catboost", "classification"), rows, ["c", "price"], "y", rows)
    return result.trials().select("trial", F.map_keys("params").alias("names"), rnd("score").alias("score")).withColumn(
        "names", F.concat_ws(",", F.array_sort("names")))



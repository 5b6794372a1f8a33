"""Trial histories. Trials come from the part table: a brand is a study, a part a trial."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.operators import tracking as T
from tabloom.queries.common import query, rnd, sql_rnd, table

_TRIALS = """trials AS (
    SELECT p_brand AS study, p_partkey AS trial, (p_partkey * 7919 % 1009) / 10.0 AS score, p_size AS depth, p_type AS kind,
           p_retailprice AS ts
    FROM part)"""


def _trials(spark, folder):
    key = F.col("p_partkey")
    return table(spark, folder, "part").select(
        F.col("p_brand").alias("study"), key.alias("trial"), (key * 7919 % 1009 / 10.0).alias("score"),
        F.col("p_size").alias("depth"), F.col("p_type").alias("kind"), F.col("p_retailprice").alias("ts"),
    )


_BEST = f"""{_TRIALS},
    best AS (SELECT *, max(score) OVER (PARTITION BY study ORDER BY trial) AS best_score FROM trials),
    marked AS (SELECT *, CASE WHEN score > coalesce(lag(best_score) OVER (PARTITION BY study ORDER BY trial), -1) THEN trial END AS up FROM best),
    stale AS (SELECT *, row_number() OVER (PARTITION BY study ORDER BY trial) AS n,
                     trial - max(up) OVER (PARTITION BY study ORDER BY trial) AS no_improvement FROM marked)"""


@query("trials_running_best", f"WITH {_BEST} SELECT study, trial, score, best_score FROM best")
def running(spark, folder):
    rows = _trials(spark, folder).select("study", "trial", "score")
    return T.running_best(rows, ["study"], span=500)


_NULL_STUDY = "CASE WHEN study LIKE '%1' THEN NULL ELSE study END"


@query("trials_running_best_null", f"""
    WITH {_TRIALS}, gappy AS (SELECT {_NULL_STUDY} AS study, trial, score FROM trials)
    SELECT study, trial, score, max(score) OVER (PARTITION BY study ORDER BY trial) AS best_score FROM gappy""")
def running_null(spark, folder):
    """Trials without a study are a study."""
    study = F.when(~F.col("study").endswith("1"), F.col("study"))
    return T.running_best(_trials(spark, folder).select(study.alias("study"), "trial", "score"), ["study"], span=500)


@query("trials_since_improvement", f"WITH {_BEST} SELECT study, trial, best_score, no_improvement FROM stale")
def stale(spark, folder):
    rows = _trials(spark, folder).select("study", "trial", "score")
    return T.since_improvement(rows, ["study"], span=500).drop("score")


@query("trials_early_stop", f"""
    WITH {_BEST} SELECT study, min(trial) FILTER (no_improvement >= 400) AS stopped_at FROM stale GROUP BY study""")
def stopped(spark, folder):
    rows = _trials(spark, folder).select("study", "trial", "score")
    return T.early_stop(rows, 400, ["study"], span=500)


@query("trials_elapsed", f"WITH {_TRIALS} SELECT study, {sql_rnd('max(ts) - min(ts)')} AS elapsed FROM trials GROUP BY study")
def elapsed(spark, folder):
    return T.elapsed(_trials(spark, folder), ["study"]).select("study", rnd("elapsed").alias("elapsed"))


@query("trials_best", f"""
    WITH {_TRIALS}
    SELECT study, trial, depth, kind, score
    FROM (SELECT *, row_number() OVER (PARTITION BY study ORDER BY score DESC, trial) AS rn FROM trials) WHERE rn = 1""")
def best(spark, folder):
    return T.best_trial(_trials(spark, folder), ["study"], ["trial", "depth", "kind", "score"])


@query("trials_cap", f"WITH {_TRIALS} SELECT trial, score FROM trials ORDER BY trial LIMIT 100")
def capped(spark, folder):
    return T.cap_trials(_trials(spark, folder).select("trial", "score"), 100)


@query("param_importance_grid", f"""
    WITH {_TRIALS},
    means AS (SELECT 'depth' AS param, depth::VARCHAR AS v, avg(score) AS m FROM trials GROUP BY depth
              UNION ALL SELECT 'kind', kind, avg(score) FROM trials GROUP BY kind),
    eff AS (SELECT param, stddev_pop(m) AS e FROM means GROUP BY param)
    SELECT param, {sql_rnd('e / (SELECT sum(e) FROM eff)', 6)} AS importance FROM eff""")
def grid_importance(spark, folder):
    out = T.grid_importance(_trials(spark, folder), ["depth", "kind"])
    return out.select("param", rnd("importance", 6).alias("importance"))


@query("param_importance_random", f"""
    WITH {_TRIALS},
    num AS (SELECT 'depth' AS param, abs(corr(depth, score)) AS e FROM trials UNION ALL SELECT 'ts', abs(corr(ts, score)) FROM trials),
    per AS (SELECT kind, count(*) AS n, avg(score) AS m FROM trials GROUP BY kind),
    cat AS (SELECT 'kind' AS param,
                   sqrt((SELECT sum(n * (m - (SELECT avg(score) FROM trials)) * (m - (SELECT avg(score) FROM trials))) FROM per)
                        / (SELECT var_pop(score) * count(*) FROM trials)) AS e),
    eff AS (SELECT * FROM num UNION ALL SELECT * FROM cat)
    SELECT param, {sql_rnd('e / (SELECT sum(e) FROM eff)', 6)} AS importance FROM eff""")
def random_importance(spark, folder):
    out = T.random_importance(_trials(spark, folder), ["depth", "ts"], ["kind"])
    return out.select("param", rnd("importance", 6).alias("importance"))

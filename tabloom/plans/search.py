"""Parameter search: candidates come from a DataFrame, fits run on Spark, trials form a table."""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions.hashing import uniform
from tabloom.operators import tracking
from tabloom.operators.metrics import metric
from tabloom.operators.split import fold_of, stratified_folds
from tabloom.operators.stats import quoted
from tabloom.plans import gram
from tabloom.plans.models import TabularModel, persisted
from tabloom.sources.results import load_model_config, save_model_config

TRIAL_SCHEMA = "trial bigint, params map<string,string>, score double, ts double"


@dataclass
class SearchConfig:
    search_space: dict
    n_trials: int = 100
    cv_folds: int = 5
    scoring: str = "neg_mean_squared_error"
    random_state: int = 42
    timeout: float | None = None
    early_stopping_rounds: int | None = None
    threads: int = 4

    def to_dict(self) -> dict:
        return asdict(self)

    @classmethod
    def from_dict(cls, data: dict) -> "SearchConfig":
        return cls(**data)


# candidates


def param_grid(spark: SparkSession, space: Mapping[str, Sequence], limit: int | None = None) -> DataFrame:
    """(trial, one column per parameter): all combinations, names sorted, the last name varying fastest.

    The trial number is read as a number with one digit per parameter, so nothing is joined and the
    grid is generated in parallel.
    """
    names = sorted(space)
    total = math.prod(len(space[n]) for n in names)
    rows = spark.range(total if limit is None else min(total, limit)).select(F.col("id").alias("trial"))
    out, stride = [], total
    for n in names:
        stride //= len(space[n])
        digit = F.floor(F.col("trial") / F.lit(stride)) % F.lit(len(space[n]))
        out.append(F.get(F.array(*[F.lit(v) for v in space[n]]), digit.cast("int")).alias(n))
    return rows.select("trial", *out)


def sample_params(trials: DataFrame, space: Mapping, seed: int = 42, trial: str = "trial") -> DataFrame:
    """Append one drawn value per parameter; a draw depends on the trial, the parameter and the seed only."""
    drawn = [_draw(space[n], uniform(quoted(trial), F.lit(n), seed=seed)).alias(n) for n in space]
    return trials.select("*", *drawn)


def _draw(rule, u: Column) -> Column:
    if isinstance(rule, Mapping):
        kind = rule.get("type")
        if kind == "choice":
            return _pick(rule["choices"], u)
        if kind not in ("uniform", "loguniform", "int"):
            raise ValueError(f"unknown parameter rule: {rule}")
        low, high = rule["low"], rule["high"]
        if kind == "int":
            return (F.lit(low) + F.floor(u * F.lit(high - low + 1))).cast("bigint")
        if kind == "uniform":
            return F.lit(float(low)) + u * F.lit(float(high - low))
        return F.exp(F.lit(math.log(low)) + u * F.lit(math.log(high) - math.log(low)))
    return _pick(rule, u) if isinstance(rule, (list, tuple)) else F.lit(rule)


def _pick(values: Sequence, u: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.floor(u * F.lit(len(values))).cast("int"))


def grid_candidates(spark: SparkSession, config: SearchConfig) -> DataFrame:
    return param_grid(spark, config.search_space, config.n_trials)


def random_candidates(spark: SparkSession, config: SearchConfig) -> DataFrame:
    trials = spark.range(config.n_trials).select(F.col("id").alias("trial"))
    return sample_params(trials, config.search_space, config.random_state)


# Names a search can have; the model-based ones draw at random, as they do without their libraries.
METHODS: dict[str, Callable[[SparkSession, SearchConfig], DataFrame]] = {
    "grid": grid_candidates,
    "random": random_candidates,
    "bayesian": random_candidates,
    "optuna": random_candidates,
}


def register_method(name: str, candidates: Callable[[SparkSession, SearchConfig], DataFrame]) -> None:
    METHODS[name] = candidates


def available_methods() -> list[str]:
    return list(METHODS)


def choose_method(space: Mapping, n_trials: int = 100) -> str:
    """By budget; a grid needs a list for every parameter."""
    listed = all(isinstance(v, (list, tuple)) for v in space.values())
    if n_trials <= 20 and listed:
        return "grid"
    return "random" if n_trials <= 100 else "optuna"


# scoring

SCORES = {
    "neg_mean_squared_error": ("mse", -1.0),
    "neg_mean_absolute_error": ("mae", -1.0),
    "r2": ("r2", 1.0),
    "accuracy": ("accuracy", 1.0),
    "f1": ("f1", 1.0),
    "f1_weighted": ("f1", 1.0),
    "roc_auc": ("auc", 1.0),
}


GRAM_SCORES = ("neg_mean_squared_error", "r2")


def _gram_score(rows: gram.Gram, fit: gram.LinearFit, scoring: str) -> float:
    mse, spread = gram.squared_errors(rows, fit)
    return -mse if scoring == "neg_mean_squared_error" else 1 - mse / spread


def score(model: TabularModel, df: DataFrame, label: str, scoring: str) -> float:
    """Score of a fitted model on a table; higher is better."""
    if scoring not in SCORES:
        raise ValueError(f"unknown scoring: {scoring}")
    name, sign = SCORES[scoring]
    scored = model.score_column(df, "__score") if scoring == "roc_auc" else model.predict(df, "__score")
    return sign * metric(scored, name, label, "__score")


class Search:
    """Fit and score candidates, ``threads`` at a time; results count in trial order.

    The next trial starts when one ends. At the ``timeout`` the jobs of running trials are cancelled, and so are those of
    trials that ran ahead of one that ended the search.
    """

    def __init__(self, config: SearchConfig, method: str = "random"):
        if method not in METHODS:
            raise ValueError(f"unknown search method: {method}")
        self.config, self.method = config, method
        self.history: list[dict] = []
        self.failures: list[dict] = []
        self.splits: list | None = None

    def run(
        self, model: TabularModel, df: DataFrame, features: Sequence[str], label: str,
        validation: DataFrame | None = None, key: str | None = None,
    ) -> "SearchResult":
        """Score on ``validation``, or by the mean over ``cv_folds`` folds of the row key."""
        c = self.config
        if validation is not None:
            held = validation.select(*features, label).persist()
            rows = df.select(*features, label)
        elif key is None:
            raise ValueError("cross-validation needs a row key")
        else:
            held, rows = None, df.select(key, *features, label)
            if model.classifies:
                rows = stratified_folds(rows, label, key, c.cv_folds, c.random_state, "__fold")
            else:
                rows = rows.withColumn("__fold", fold_of(key, c.cv_folds, c.random_state))
        self.splits = self._splits(model, rows, held, features, label)
        if self.splits is not None:
            self._run(model, rows, held, features, label)
        else:
            with persisted(rows, [model]) as data:
                self._run(model, data, held, features, label)
        if held is not None:
            held.unpersist()
        return SearchResult(self, model, df.sparkSession)

    def _splits(self, model: TabularModel, rows: DataFrame, held: DataFrame | None, features, label: str) -> list | None:
        """(fitted part, scored part) as sums of products, if these are all a trial needs: no trial reads the rows then."""
        c = self.config
        if not gram.applies(model.config.model_type, model.config.target_type, model.config.params) or c.scoring not in GRAM_SCORES:
            return None
        if set(c.search_space) - {"alpha", "l1_ratio", "max_iter"}:
            return None
        parts = gram.fold_grams(rows, features, label, None if held is not None else "__fold")
        if parts is None:
            return None
        if held is not None:
            scored = gram.fold_grams(held, features, label)
            # sums of two tables have two shifts, and each is used on its own
            return None if scored is None else [(parts[0], scored[0])]
        if set(parts) != set(range(c.cv_folds)) or len(parts) < 2:
            return None
        whole = sum(list(parts.values())[1:], list(parts.values())[0])
        return [(whole - parts[k], parts[k]) for k in range(c.cv_folds)]

    def _run(self, model: TabularModel, data: DataFrame, held: DataFrame | None, features, label: str) -> None:
        c, spark = self.config, data.sparkSession
        candidates = METHODS[self.method](spark, c).orderBy("trial").limit(c.n_trials).collect()
        started, best, stale = time.time(), -math.inf, 0
        run, running = uuid.uuid4().hex, {}
        sc = spark.sparkContext

        def trial(params: dict) -> float | str:
            tag = f"{run}-{params['trial']}"
            sc.addJobTag(tag)
            running[params["trial"]] = tag
            try:
                return self._trial(model, params, data, held, features, label)
            finally:
                running.pop(params["trial"], None)
                sc.removeJobTag(tag)

        pool = ThreadPoolExecutor(max_workers=c.threads)
        found = [(r.asDict(), pool.submit(inheritable_thread_target(trial), r.asDict())) for r in candidates]
        try:
            for params, future in found:
                left = None if c.timeout is None else max(0.0, started + c.timeout - time.time())
                number = params.pop("trial")
                try:
                    result = future.result(left)
                except TimeoutError:
                    self._late(found, running)
                    return
                if isinstance(result, str):
                    self.failures.append({"trial": number, "params": params, "error": result})
                    continue
                self.history.append({"trial": number, "params": params, "score": result, "ts": time.time()})
                stale = 0 if result > best else stale + 1
                best = max(best, result)
                if c.early_stopping_rounds and stale >= c.early_stopping_rounds:
                    return
        finally:
            for _, future in found:
                future.cancel()
            while running:  # a trial may start another job between two looks
                for tag in list(running.values()):
                    sc.cancelJobsWithTag(tag)
                time.sleep(0.05)
            pool.shutdown()

    def _late(self, found, running) -> None:
        """Trials that run at the deadline are listed; those that ended in time still count, those that did not start do not."""
        known = {t["trial"] for t in [*self.history, *self.failures]}
        for number, (params, future) in enumerate(found):
            number = params.pop("trial", number)
            if number in known:
                continue
            if future.done() and not future.cancelled() and future.exception() is None and not isinstance(future.result(), str):
                self.history.append({"trial": number, "params": params, "score": future.result(), "ts": time.time()})
            elif number in running:
                self.failures.append({"trial": number, "params": params, "error": "TimeoutError: cancelled at the deadline"})

    def _trial(self, model, params, data, held, features, label) -> float | str:
        """The score, or what is wrong with a candidate that cannot be fitted. Failures of the cluster are raised."""
        settings = {k: v for k, v in params.items() if k != "trial"}
        c = self.config
        try:
            if self.splits is not None:
                set_ = model.copy().set_params(**settings).config
                return float(np.mean([_gram_score(test, gram.solve(train, set_.model_type, set_.params), c.scoring) for train, test in self.splits]))
            if held is not None:
                fitted = model.copy().set_params(**settings).fit(data, features, label, held)
                return score(fitted, held, label, c.scoring)
            folds = []
            for k in range(c.cv_folds):
                fitted = model.copy().set_params(**settings).fit(data.filter(F.col("__fold") != k), features, label)
                folds.append(score(fitted, data.filter(F.col("__fold") == k), label, c.scoring))
            return sum(folds) / len(folds)
        except (ValueError, TypeError, IllegalArgumentException) as e:
            return f"{type(e).__name__}: {e}"


class SearchResult:
    def __init__(self, search: Search, model: TabularModel, spark: SparkSession):
        if not search.history:
            raise ValueError("no trial of the search succeeded")
        self.search, self.model, self.spark = search, model, spark

    @property
    def best(self) -> dict:
        return max(self.search.history, key=lambda t: (t["score"], -t["trial"]))

    def apply_best_params(self) -> TabularModel:
        return self.model.set_params(**self.best["params"])

    def failed(self) -> DataFrame:
        """(trial, params, error) of the candidates that could not be fitted."""
        rows = [(t["trial"], {k: str(v) for k, v in t["params"].items()}, t["error"]) for t in self.search.failures]
        return self.spark.createDataFrame(rows, "trial bigint, params map<string,string>, error string")

    def trials(self) -> DataFrame:
        """(trial, params, score, ts); at most ``n_trials`` rows."""
        return trial_table(self.spark, self.search.history)

    def summary(self) -> dict:
        history = self.search.history
        return {
            "best_score": self.best["score"], "best_params": dict(self.best["params"]),
            "n_trials": len(history), "optimization_time": history[-1]["ts"] - history[0]["ts"],
        }

    def param_importance(self) -> DataFrame:
        """Spread of means for a grid, correlation with the score otherwise."""
        space = self.search.config.search_space
        columns = [F.col("params")[n].alias(n) for n in space]
        table = self.trials().select("score", *columns)
        if self.search.method == "grid":
            return tracking.grid_importance(table, list(space))
        text = [n for n in space if any(isinstance(t["params"][n], str) for t in self.search.history)]
        return tracking.random_importance(table, [n for n in space if n not in text], text)

    def save(self, folder: str) -> None:
        self.trials().write.mode("overwrite").parquet(f"{folder}/trials")
        save_model_config(self.spark, {**self.search.config.to_dict(), "method": self.search.method}, "search", folder)


def trial_table(spark: SparkSession, history: Sequence[Mapping]) -> DataFrame:
    rows = [
        (t["trial"], {k: str(v) for k, v in t["params"].items()}, float(t["score"]), float(t["ts"])) for t in history
    ]
    return spark.createDataFrame(rows, TRIAL_SCHEMA)


def load_search(spark: SparkSession, folder: str) -> tuple[SearchConfig, str, DataFrame]:
    """(config, method, trials) of a saved search."""
    data = load_model_config(spark, "search", folder)
    method = data.pop("method")
    return SearchConfig.from_dict(data), method, spark.read.parquet(f"{folder}/trials")


# presets

# Search spaces of the boosters, limited to settings Spark ML's trees have.
_SAMPLING = {"type": "uniform", "low": 0.6, "high": 1.0}
_RATE = {"type": "loguniform", "low": 0.01, "high": 0.3}
GRID_SPACES = {
    "sampled": {
        "n_estimators": [100, 500, 1000],
        "max_depth": [3, 4, 5, 6],
        "learning_rate": [0.01, 0.1, 0.2],
        "subsample": [0.8, 0.9, 1.0],
        "colsample_bytree": [0.8, 0.9, 1.0],
    },
    "catboost": {
        "n_estimators": [100, 500, 1000],
        "max_depth": [3, 4, 5, 6],
        "learning_rate": [0.01, 0.1, 0.2],
        "max_bins": [32, 64, 128],
    },
}
RANDOM_SPACES = {
    "sampled": {
        "n_estimators": {"type": "int", "low": 100, "high": 2000},
        "max_depth": {"type": "int", "low": 3, "high": 10},
        "learning_rate": _RATE,
        "subsample": _SAMPLING,
        "colsample_bytree": _SAMPLING,
    },
    "catboost": {
        "n_estimators": {"type": "int", "low": 100, "high": 2000},
        "max_depth": {"type": "int", "low": 3, "high": 10},
        "learning_rate": _RATE,
        "max_bins": {"type": "int", "low": 32, "high": 255},
    },
}
QUICK_SPACES = {
    "sampled": {
        "n_estimators": {"type": "int", "low": 100, "high": 1000},
        "max_depth": {"type": "int", "low": 3, "high": 8},
        "learning_rate": _RATE,
        "subsample": {"type": "uniform", "low": 0.7, "high": 1.0},
        "colsample_bytree": {"type": "uniform", "low": 0.7, "high": 1.0},
    },
    "catboost": {
        "n_estimators": {"type": "int", "low": 100, "high": 1000},
        "max_depth": {"type": "int", "low": 3, "high": 8},
        "learning_rate": _RATE,
    },
}


def preset_search(
    model_type: str, target_type: str = "regression", kind: str = "quick", n_trials: int | None = None
) -> SearchConfig:
    """Settings for a booster: ``grid`` (200 trials), ``random`` (200, patience 50), ``quick`` (100)."""
    if model_type not in ("xgboost", "lightgbm", "catboost"):
        raise ValueError(f"no preset search for {model_type}")
    spaces = {"grid": GRID_SPACES, "random": RANDOM_SPACES, "quick": QUICK_SPACES}[kind]
    space = dict(spaces["catboost" if model_type == "catboost" else "sampled"])
    return SearchConfig(
        search_space=space,
        n_trials=n_trials or (100 if kind == "quick" else 200),
        scoring="f1_weighted" if target_type == "classification" else "neg_mean_squared_error",
        early_stopping_rounds=50 if kind == "random" else None,
    )


def auto_search(space: Mapping, n_trials: int = 100, **settings) -> Search:
    return Search(SearchConfig(dict(space), n_trials=n_trials, **settings), choose_method(space, n_trials))


def quick_search(model_type: str, target_type: str = "regression", method: str = "optuna", n_trials: int = 100) -> Search:
    return Search(preset_search(model_type, target_type, "quick", n_trials), method)

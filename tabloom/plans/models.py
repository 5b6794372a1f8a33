"""Models by name on Spark ML: boosted trees and linear models with one set of settings."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.operators.base import Fitted, append_columns
from tabloom.operators.ordered import OrderedTargetEncoder
from tabloom.operators.stats import quoted, value
from tabloom.plans.boosting import Booster, BoostSettings
from tabloom.sources.results import load_model_config, save_model_config

BOOSTERS = ("xgboost", "lightgbm", "catboost")
LINEAR = ("linear", "ridge", "lasso", "elasticnet", "logistic")


@dataclass
class ModelConfig:
    name: str
    model_type: str
    params: dict = field(default_factory=dict)
    target_type: str = "regression"
    random_state: int = 42

    def to_dict(self) -> dict:
        return {
            "name": self.name, "model_type": self.model_type, "params": dict(self.params),
            "target_type": self.target_type, "random_state": self.random_state,
        }

    @classmethod
    def from_dict(cls, data: dict) -> "ModelConfig":
        return cls(**data)

    def save(self, spark, folder: str) -> str:
        return save_model_config(spark, self.to_dict(), self.name, folder)

    @classmethod
    def load(cls, spark, name: str, folder: str) -> "ModelConfig | None":
        found = load_model_config(spark, name, folder)
        return None if found is None else cls.from_dict(found)


# Starting settings per model. ``n_estimators`` is the number of boosting rounds, an upper
# bound if there is a validation table and a patience.
MODEL_DEFAULTS = {
    "xgboost": {
        "n_estimators": 1000, "max_depth": 6, "learning_rate": 0.1, "subsample": 0.8,
        "colsample_bytree": 0.8, "early_stopping_rounds": 50,
    },
    "lightgbm": {
        "n_estimators": 1000, "max_depth": 6, "learning_rate": 0.1, "subsample": 0.8,
        "colsample_bytree": 0.8, "max_bins": 255, "early_stopping_rounds": 50,
    },
    "catboost": {"n_estimators": 1000, "max_depth": 6, "learning_rate": 0.1, "early_stopping_rounds": 50},
    "linear": {"fit_intercept": True},
    "ridge": {"alpha": 1.0, "max_iter": 1000, "C": 1.0},
    "lasso": {"alpha": 1.0, "max_iter": 1000, "C": 1.0},
    "elasticnet": {"alpha": 1.0, "l1_ratio": 0.5, "max_iter": 1000, "C": 1.0},
    "logistic": {"C": 1.0, "penalty": "l2", "max_iter": 1000},
}
# With engine="histogram" the boosters are those of plans/boosting.py: fixed values, how each of them grows its trees,
# and its starting penalties.
HISTOGRAM = {
    "xgboost": {"growth": "level", "reg_lambda": 1.0, "min_child_weight": 1.0},
    "lightgbm": {"growth": "leaf", "num_leaves": 31, "reg_lambda": 0.0, "min_child_weight": 0.001, "min_child_samples": 20},
    "catboost": {"growth": "symmetric", "reg_lambda": 3.0, "min_child_weight": 0.0},
}
HISTOGRAM_KNOWN = {
    "engine", "growth", "num_leaves", "reg_lambda", "reg_alpha", "gamma", "min_child_weight", "min_child_samples",
    "top_rate", "other_rate", "cat_features", "key",
}
# Settings each kind of model understands beside its starting ones. Penalties on leaves, leaf counts, minimal child
# weights and the like have no form in Spark ML's trees, the default engine: they are refused rather than ignored.
KNOWN = {
    **dict.fromkeys(BOOSTERS, {"n_estimators", "max_depth", "learning_rate", "subsample", "colsample_bytree", "early_stopping_rounds", "max_bins"}),
    **dict.fromkeys(("linear", "ridge", "lasso", "elasticnet", "logistic"), {"alpha", "l1_ratio", "max_iter", "C", "fit_intercept", "penalty"}),
}
ALIASES = {
    "iterations": "n_estimators", "num_boost_round": "n_estimators", "num_trees": "n_estimators", "depth": "max_depth",
    "l2_leaf_reg": "reg_lambda", "lambda_l2": "reg_lambda", "lambda_l1": "reg_alpha", "min_split_gain": "gamma",
    "min_data_in_leaf": "min_child_samples",
}


def _settings(model_type: str, params: dict, engine: str | None = None) -> dict:
    """Aliases resolved; a setting that would be ignored is an error."""
    named = {ALIASES.get(k, k): v for k, v in params.items()}
    engine = named.get("engine", engine)
    if engine not in (None, "spark", "histogram"):
        raise ValueError(f"unknown engine: {engine}")
    if model_type in KNOWN:
        known = KNOWN[model_type] | ({"engine"} if model_type in BOOSTERS else set())
        if model_type in BOOSTERS and engine == "histogram":
            known = known | HISTOGRAM_KNOWN
        if unknown := set(named) - known:
            hint = ", but with engine='histogram'" if model_type in BOOSTERS and unknown <= HISTOGRAM_KNOWN else ""
            raise ValueError(f"{model_type} has no such settings here{hint}: {sorted(unknown)}")
    return named


def model_config(model_type: str, target_type: str = "regression", name: str | None = None, **params) -> ModelConfig:
    """Starting settings with overrides; the boosters' alias names are understood."""
    if model_type not in MODEL_DEFAULTS:
        raise ValueError(f"unknown model: {model_type}")
    if model_type == "logistic":
        target_type = "classification"
    named = _settings(model_type, params)
    own = HISTOGRAM[model_type] if named.get("engine") == "histogram" else {}
    return ModelConfig(name or model_type, model_type, {**MODEL_DEFAULTS[model_type], **own, **named}, target_type)


class ScaledInputs(Fitted):
    """Appends ``__s_<column>``: features on population-standard scale, for the linear models."""

    def _transform(self, df: DataFrame) -> DataFrame:
        scales = self.fitted["scales"]
        return append_columns(df, {
            f"__s_{c}": (value(df, c).cast("double") - F.lit(m)) / F.lit(w) for c, (m, w) in scales.items()
        })


class Copied(Fitted):
    """Appends ``__c_<column>``, a copy that later stages may replace."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return append_columns(df, {f"__c_{c}": quoted(c) for c in self.fitted["columns"]})


class OneAgainstRest(Fitted):
    """``__probability`` and ``__prediction`` from a booster for each class."""

    def _transform(self, df: DataFrame) -> DataFrame:
        names = [f"__probability_{c}" for c in range(self.fitted["classes"])]
        own = [(F.col(n) if isinstance(df.schema[n].dataType, T.ArrayType) else vector_to_array(n))[1] for n in names]
        scored = df.withColumn("__own", F.array(*own))
        total = F.aggregate("__own", F.lit(0.0), lambda a, x: a + x)
        scored = scored.withColumn("__probability", F.transform("__own", lambda x: x / total))
        best = F.array_position("__probability", F.array_max("__probability")) - 1
        return scored.withColumn("__prediction", best.cast("double"))


def stopping_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """(best round, whether the patience ran out): the first lowest loss before ``patience`` rounds without a lower one."""
    best = 0
    for at, loss in enumerate(losses):
        if loss < losses[best]:
            best = at
        elif at - best >= patience:
            return best, True
    return best, False


class TabularModel:
    """One model over named feature columns.

    ``fit`` takes one table with features and label; ``transform`` appends ``prediction`` (and for
    classes ``probability``, an array) under the model's name, as one lazy plan.
    """

    def __init__(self, config: ModelConfig):
        self.config = config
        self.features: list[str] | None = None
        self.model: PipelineModel | None = None

    @property
    def name(self) -> str:
        return self.config.name

    @property
    def classifies(self) -> bool:
        return self.config.target_type == "classification"

    def get_params(self) -> dict:
        return dict(self.config.params)

    def set_params(self, **params) -> "TabularModel":
        self.config.params.update(_settings(self.config.model_type, params, self.config.params.get("engine")))
        return self

    def copy(self, name: str | None = None) -> "TabularModel":
        data = self.config.to_dict()
        return type(self)(ModelConfig.from_dict({**data, "name": name or data["name"]}))

    # fitting

    def fit(self, df: DataFrame, features: Sequence[str], label: str, validation: DataFrame | None = None) -> "TabularModel":
        self.features = list(features)
        if self.config.model_type in BOOSTERS and self.config.params.get("engine") == "histogram":
            self.model = self._fit_histogram(df, label, validation)
            return self
        used = [*self.features, label]
        train = df.select(*[value(df, c).cast("double").alias(c) for c in used]).dropna(subset=[label])
        if self.config.model_type in BOOSTERS:
            self.model = self._fit_trees(train, label, validation)
        else:
            self.model = self._fit_linear(train, label)
        return self

    def _assembler(self, columns: Sequence[str]) -> VectorAssembler:
        return VectorAssembler(inputCols=list(columns), outputCol="__features", handleInvalid="keep")

    def _outputs(self, estimator):
        estimator.setFeaturesCol("__features").setPredictionCol("__prediction")
        if self.classifies:
            estimator.setProbabilityCol("__probability").setRawPredictionCol("__raw")
        return estimator

    def _fit_trees(self, train: DataFrame, label: str, validation: DataFrame | None) -> PipelineModel:
        p, assembler = self.config.params, self._assembler(self.features)
        settings = {
            "labelCol": label, "maxDepth": int(p["max_depth"]), "seed": self.config.random_state,
            "subsamplingRate": float(p.get("subsample", 1.0)), "maxBins": int(p.get("max_bins", 32)),
            "featureSubsetStrategy": str(float(p["colsample_bytree"])) if p.get("colsample_bytree", 1.0) < 1 else "all",
        }
        settings["stepSize"] = float(p["learning_rate"])
        prepared = assembler.transform(train)
        held = None
        if validation is not None and p.get("early_stopping_rounds"):
            used = [*self.features, label]
            held = validation.select(*[value(validation, c).cast("double").alias(c) for c in used]).dropna(subset=[label])
            held = assembler.transform(held)
        classes = 2
        if self.classifies:
            top = train.agg(F.max(label)).first()[0]
            classes = int(top or 0) + 1
        if classes <= 2:
            return PipelineModel([assembler, self._boost(prepared, held, label, settings)])
        # one booster for each class against the rest; their probabilities are divided by their sum
        stages = [assembler]
        for c in range(classes):
            own = F.when(F.col(f"`{label}`") == c, 1.0).otherwise(0.0)
            parts = [None if t is None else t.withColumn("__own", own) for t in (prepared, held)]
            booster = self._boost(*parts, "__own", {**settings, "labelCol": "__own"})
            booster.setPredictionCol(f"__prediction_{c}").setRawPredictionCol(f"__raw_{c}").setProbabilityCol(f"__probability_{c}")
            stages.append(booster)
        return PipelineModel([*stages, OneAgainstRest(classes=classes)])

    def _boost(self, train: DataFrame, held: DataFrame | None, label: str, settings: dict):
        """A booster with all rounds or, given held rows, cut after the best round once ``patience`` rounds did not improve it.

        A run with fewer rounds is the beginning of a longer one, so rounds are added until the patience has run out.
        """
        rounds, patience = int(self.config.params["n_estimators"]), self.config.params.get("early_stopping_rounds")
        estimator = self._outputs(GBTClassifier(**settings) if self.classifies else GBTRegressor(**settings))
        if held is None:
            return estimator.setMaxIter(rounds).fit(train)
        tried = min(rounds, 2 * int(patience))
        while True:
            model = estimator.setMaxIter(tried).fit(train)
            losses = model.evaluateEachIteration(held) if self.classifies else model.evaluateEachIteration(held, "squared")
            best, stopped = stopping_round(losses, int(patience))
            if stopped or tried == rounds:
                return model if best + 1 == tried else estimator.setMaxIter(best + 1).fit(train)
            tried = min(rounds, 2 * tried)

    def _fit_histogram(self, df: DataFrame, label: str, validation: DataFrame | None) -> PipelineModel:
        """Boosters of plans/boosting.py. ``cat_features`` become ordered target statistics along a hash of ``key``."""
        p = self.config.params
        names = {f for f in BoostSettings.__dataclass_fields__} & set(p)
        settings = {n: p[n] for n in names} | {"max_bins": int(p.get("max_bins", 255)), "seed": self.config.random_state}
        settings["objective"] = "logistic" if self.classifies else "squared"
        cats, key = list(p.get("cat_features") or []), p.get("key")
        inputs = [f"__c_{c}" if c in cats else c for c in self.features]
        train, held, before = df.dropna(subset=[label]), None, []
        if cats:
            copied = Copied(columns=cats)
            train = copied.transform(train)
            encoder = OrderedTargetEncoder(columns=[f"__c_{c}" for c in cats], label=label, key=key, seed=self.config.random_state).fit(train)
            before = [copied, encoder]
            train = encoder.encode_fitted(train)
        if validation is not None and p.get("early_stopping_rounds"):
            held = PipelineModel(before).transform(validation.dropna(subset=[label]))
            held = held.select(*[value(held, c).cast("double").alias(c) for c in [*inputs, label]]).dropna(subset=[label])
        train = train.select(*[value(train, c).cast("double").alias(c) for c in [*inputs, label]]).dropna(subset=[label])
        classes = int(train.agg(F.max(label)).first()[0] or 0) + 1 if self.classifies else 2
        if classes <= 2:
            return PipelineModel([*before, self._boosted(train, held, inputs, label, settings)])
        boosters = []
        for c in range(classes):
            own = F.when(quoted(label) == c, 1.0).otherwise(0.0)
            parts = [None if t is None else t.withColumn(label, own) for t in (train, held)]
            boosters.append(self._boosted(*parts, inputs, label, settings).named(f"_{c}"))
        return PipelineModel([*before, *boosters, OneAgainstRest(classes=classes)])

    def _boosted(self, train: DataFrame, held: DataFrame | None, inputs: Sequence[str], label: str, settings: dict):
        booster = Booster(train, inputs, label, BoostSettings(**settings), held)
        try:
            return booster.fit()
        finally:
            booster.close()

    def _fit_linear(self, train: DataFrame, label: str) -> PipelineModel:
        stats = [F.count(F.lit(1)), F.stddev_pop(label)]
        for c in self.features:
            stats += [F.avg(quoted(c)), F.stddev_pop(quoted(c))]
        rows, spread, *pairs = train.agg(*stats).first()
        scaled = ScaledInputs(scales={
            c: [pairs[2 * i] or 0.0, pairs[2 * i + 1] or 1.0] for i, c in enumerate(self.features)
        })
        assembler = self._assembler([f"__s_{c}" for c in self.features])
        estimator = self._outputs(self._linear_estimator(label, rows, spread or 1.0))
        fitted = estimator.fit(assembler.transform(scaled.transform(train)))
        return PipelineModel([scaled, assembler, fitted])

    def _linear_estimator(self, label: str, rows: int, spread: float):
        """Translate penalties on the sum of squares to Spark ML's penalties on the mean."""
        p, kind = self.config.params, self.config.model_type
        common = {"labelCol": label, "standardization": False}
        if self.classifies:
            penalty = p.get("penalty") or {"lasso": "l1", "elasticnet": "elasticnet"}.get(kind, "l2")
            mix = {"l2": 0.0, "l1": 1.0, "elasticnet": float(p.get("l1_ratio", 0.5))}[penalty]
            return LogisticRegression(
                regParam=1.0 / (float(p.get("C", 1.0)) * rows), elasticNetParam=mix,
                maxIter=int(p.get("max_iter", 1000)), tol=1e-8, **common,
            )
        alpha = float(p.get("alpha", 1.0))
        intercept = bool(p.get("fit_intercept", True))
        if kind == "linear":
            return LinearRegression(regParam=0.0, solver="normal", fitIntercept=intercept, **common)
        if kind == "ridge":
            return LinearRegression(
                regParam=alpha * spread / rows, elasticNetParam=0.0, solver="normal", fitIntercept=intercept, **common
            )
        share = 1.0 if kind == "lasso" else float(p.get("l1_ratio", 0.5))
        strength = alpha * share + spread * alpha * (1 - share)
        return LinearRegression(
            regParam=strength, elasticNetParam=alpha * share / strength if strength else 0.0,
            solver="normal", maxIter=int(p.get("max_iter", 1000)), tol=1e-10, fitIntercept=intercept, **common,
        )

    # use

    def transform(self, df: DataFrame, prediction: str | None = None, probability: str | None = None) -> DataFrame:
        if self.model is None:
            raise ValueError("fit the model before predicting")
        scored = self.model.transform(df)
        out = [quoted(c) for c in df.columns]
        out.append(F.col("__prediction").alias(prediction or self.name))
        if self.classifies:
            vector = not isinstance(scored.schema["__probability"].dataType, T.ArrayType)
            array = vector_to_array("__probability") if vector else F.col("__probability")
            out.append(array.alias(probability or f"{self.name}_probability"))
        return scored.select(*out)

    def predict(self, df: DataFrame, to: str | None = None) -> DataFrame:
        to = to or self.name
        return self.transform(df, to, "__unused").drop("__unused")

    def predict_proba(self, df: DataFrame, to: str | None = None) -> DataFrame:
        if not self.classifies:
            raise ValueError("only classifiers give probabilities")
        return self.transform(df, "__unused", to or f"{self.name}_probability").drop("__unused")

    def score_column(self, df: DataFrame, to: str) -> DataFrame:
        """What blends and stacking use: the prediction, or the probability of class 1."""
        if not self.classifies:
            return self.predict(df, to)
        scored = self.predict_proba(df, "__p")
        return scored.withColumn(to, F.col("__p")[1]).drop("__p")

    def get_feature_importance(self) -> dict[str, float]:
        """Tree importances, or absolute coefficients (first class row)."""
        if self.model is None:
            raise ValueError("fit the model first")
        last = self.model.stages[-1]
        if isinstance(last, OneAgainstRest):
            found = [s.featureImportances.toArray() for s in self.model.stages if hasattr(s, "featureImportances")]
            weights = sum(found) / len(found)
        elif self.config.model_type in BOOSTERS:
            weights = last.featureImportances.toArray()
        elif self.classifies:
            weights = abs(last.coefficientMatrix.toArray()[0])
        else:
            weights = abs(last.coefficients.toArray())
        return {c: float(w) for c, w in zip(self.features, weights)}

    def save(self, spark, path: str) -> None:
        if self.model is None:
            raise ValueError("fit the model before saving")
        self.model.write().overwrite().save(f"{path}/model")
        save_model_config(spark, {**self.config.to_dict(), "features": self.features}, "fitted", path)

    @classmethod
    def load(cls, spark, path: str) -> "TabularModel":
        data = load_model_config(spark, "fitted", path)
        features = data.pop("features")
        model = cls(ModelConfig.from_dict(data))
        model.features, model.model = features, PipelineModel.load(f"{path}/model")
        return model


_model_types: dict[str, Callable[[ModelConfig], TabularModel]] = {}
_configs: dict[str, Callable[..., ModelConfig]] = {}


def register_model(name: str, build: Callable[[ModelConfig], TabularModel]) -> None:
    _model_types[name] = build


def register_config(name: str, make: Callable[..., ModelConfig]) -> None:
    _configs[name] = make


def create_model(config: ModelConfig) -> TabularModel:
    if config.model_type in _model_types:
        return _model_types[config.model_type](config)
    if config.model_type not in MODEL_DEFAULTS:
        raise ValueError(f"unknown model type: {config.model_type}")
    return TabularModel(config)


def model_by_name(model_type: str, target_type: str = "regression", name: str | None = None, **params) -> TabularModel:
    if model_type in _configs:
        return create_model(_configs[model_type](target_type=target_type, **params))
    return create_model(model_config(model_type, target_type, name, **params))


def available_models() -> list[str]:
    return [*MODEL_DEFAULTS, *(_n for _n in _model_types if _n not in MODEL_DEFAULTS)]


def default_models(target_type: str = "regression", **params) -> list[TabularModel]:
    """The three boosters and a ridge; for classes the ridge is a logistic one."""
    boosters = [model_by_name(b, target_type, **params) for b in BOOSTERS]
    name = "logistic_ridge" if target_type == "classification" else "ridge"
    return [*boosters, model_by_name("ridge", target_type, name)]


# Fixed values: (learning rate, depth) of the three strengths of each booster in the ensemble set.
ENSEMBLE_STRENGTHS = [(0.05, 4), (0.1, 6), (0.2, 8)]


def ensemble_models(target_type: str = "regression", **params) -> list[TabularModel]:
    """Nine models: each booster at three strengths."""
    return [
        model_by_name(b, target_type, f"{b}_{i}", learning_rate=rate, max_depth=depth, **params)
        for b in BOOSTERS for i, (rate, depth) in enumerate(ENSEMBLE_STRENGTHS, 1)
    ]


# The tuned set, a conservative and a balanced form of each booster.
TUNED = {
    "conservative": {"learning_rate": 0.05, "max_depth": 4, "n_estimators": 1500, "subsample": 0.8, "colsample_bytree": 0.8},
    "balanced": {"learning_rate": 0.1, "max_depth": 6, "n_estimators": 1000, "subsample": 0.9, "colsample_bytree": 0.9},
}


def tuned_models(target_type: str = "regression", **params) -> list[TabularModel]:
    """Six models: each booster conservative and balanced; catboost without sampling."""
    out = []
    for short, booster in (("xgb", "xgboost"), ("lgb", "lightgbm"), ("cb", "catboost")):
        for style, settings in TUNED.items():
            kept = {k: v for k, v in settings.items() if booster != "catboost" or not k.endswith(("sample", "bytree"))}
            out.append(model_by_name(booster, target_type, f"{short}_{style}", **{**kept, **params}))
    return out


def in_threads(jobs: Iterable[Callable[[], object]], threads: int = 4) -> list:
    """Run independent fits side by side; each is a series of Spark jobs, the driver only waits."""
    with ThreadPoolExecutor(max_workers=threads) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(j)) for j in jobs]]


@contextmanager
def persisted(df: DataFrame, models: Sequence[TabularModel]) -> Iterator[DataFrame]:
    """The table kept for repeated passes; boosters get at least one partition per core.

    Boosting is bound by computing, not by reading, so a few large partitions would leave cores
    idle. The number of partitions is read off the persisted plan: nothing runs twice for it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    held = [df.persist()]
    if any(m.config.model_type in BOOSTERS for m in models) and df.rdd.getNumPartitions() < cores:
        held.append(df.repartition(cores).persist())
    try:
        yield held[-1]
    finally:
        for d in held:
            d.unpersist()


class ModelSet:
    """Several models on the same features, fitted side by side on one persisted table."""

    def __init__(self, models: Sequence[TabularModel], threads: int = 4):
        self.models, self.threads = list(models), threads
        self.features: list[str] | None = None

    def fit(self, df: DataFrame, features: Sequence[str], label: str, validation: DataFrame | None = None) -> "ModelSet":
        self.features = list(features)
        held = validation.select(*features, label).persist() if validation is not None else None
        with persisted(df.select(*features, label), self.models) as train:
            in_threads([lambda m=m: m.fit(train, features, label, held) for m in self.models], self.threads)
        if held is not None:
            held.unpersist()
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        """One prediction column per model, one chained plan over one scan."""
        for m in self.models:
            df = m.predict(df)
        return df

    def predict_proba(self, df: DataFrame) -> DataFrame:
        for m in self.models:
            if m.classifies:
                df = m.predict_proba(df)
        return df

    def score_columns(self, df: DataFrame, prefix: str = "base_") -> DataFrame:
        for i, m in enumerate(self.models):
            df = m.score_column(df, f"{prefix}{i}")
        return df

    def get_feature_importances(self, spark) -> DataFrame:
        """(model, feature, importance) rows."""
        rows = [(m.name, f, v) for m in self.models for f, v in m.get_feature_importance().items()]
        return spark.createDataFrame(rows, "model string, feature string, importance double")

    def save(self, spark, folder: str) -> None:
        for i, m in enumerate(self.models):
            m.save(spark, f"{folder}/{m.name}_{i}")
        names = [m.name for m in self.models]
        save_model_config(
            spark, {"n_models": len(names), "model_names": names, "feature_names": self.features}, "set", folder
        )

    @classmethod
    def load(cls, spark, folder: str) -> "ModelSet":
        meta = load_model_config(spark, "set", folder)
        out = cls([TabularModel.load(spark, f"{folder}/{n}_{i}") for i, n in enumerate(meta["model_names"])])
        out.features = meta["feature_names"]
        return out


def describe(models: Sequence[TabularModel], spark) -> DataFrame:
    """(model, type, param, value) rows of a list of models."""
    rows = [
        (m.name, m.config.model_type, k, json.dumps(v)) for m in models for k, v in sorted(m.get_params().items())
    ]
    return spark.createDataFrame(rows, "model string, model_type string, param string, value string")

"""Ensembles of fitted models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators import blend
from tabloom.operators.split import fold_of, stratified_folds
from tabloom.operators.stats import quoted
from tabloom.plans import gram
from tabloom.plans.models import ModelSet, TabularModel, in_threads, model_by_name, persisted, tuned_models
from tabloom.session import scratch_path


class Ensemble:
    """Common shape: fit on a table, append one prediction column lazily.

    For classes the blended quantity is the probability (array); the prediction is its argmax.
    """

    name = "ensemble"

    def __init__(self, models: Sequence[TabularModel]):
        self.set = ModelSet(models)

    @property
    def classifies(self) -> bool:
        return self.set.models[0].classifies

    def _members(self, df: DataFrame) -> DataFrame:
        """``__p<i>``: prediction, or probability array, of each model."""
        for i, m in enumerate(self.set.models):
            df = m.predict_proba(df, f"__p{i}") if self.classifies else m.predict(df, f"__p{i}")
        return df

    def get_feature_importance(self, spark) -> DataFrame:
        return blend.mean_importance(self.set.get_feature_importances(spark))


class BlendEnsemble(Ensemble):
    """``average``, or ``weighted`` by validation score (three folds if there is no validation table)."""

    def __init__(self, models: Sequence[TabularModel], method: str = "average", key: str | None = None):
        super().__init__(models)
        if method not in ("average", "weighted"):
            raise ValueError(f"unknown blend: {method}")
        self.method, self.key, self.name = method, key, f"ensemble_{method}"
        self.weights: list[float] | None = None

    def fit(self, df: DataFrame, features: Sequence[str], label: str, validation: DataFrame | None = None) -> "BlendEnsemble":
        self.set.fit(df, features, label, validation)
        if self.method == "weighted":
            scores = self._scores(df, features, label, validation)
            self.weights = list(blend.score_weights(scores).values())
        return self

    def _scores(self, df, features, label, validation) -> dict[str, float]:
        problem = "classification" if self.classifies else "regression"
        names = [f"__v{i}" for i in range(len(self.set.models))]
        if validation is not None:
            scored = validation
            for n, m in zip(names, self.set.models):
                scored = m.predict(scored, n)
            return blend.validation_scores(scored, label, names, problem)
        if self.key is None:
            raise ValueError("weights without a validation table need a row key for the folds")
        folded = df.withColumn("__fold", fold_of(self.key, 3))
        out = _out_of_fold(self.set.models, folded, features, label, 3, lambda m, t, to: m.predict(t, to), "__v")
        per_fold = out.groupBy("__fold")
        y = quoted(label)
        exprs = [
            F.avg((y == quoted(n)).cast("double") if self.classifies else -(y - quoted(n)) * (y - quoted(n))).alias(n)
            for n in names
        ]
        row = per_fold.agg(*exprs).agg(*[F.avg(n) for n in names]).first()
        return dict(zip(names, row))

    def transform(self, df: DataFrame, to: str | None = None) -> DataFrame:
        to, count = to or self.name, len(self.set.models)
        names = [f"__p{i}" for i in range(count)]
        members = self._members(df)
        weights = self.weights or [1.0 / count] * count
        if self.classifies:
            zipped = F.arrays_zip(*[quoted(n) for n in names])
            mixed = F.transform(zipped, lambda z: sum((z[n] * w for n, w in zip(names[1:], weights[1:])), z[names[0]] * weights[0]))
            members = members.withColumn("__mix", mixed)
            out = [blend.argmax(F.col("__mix")).cast("double").alias(to), F.col("__mix").alias(f"{to}_probability")]
        else:
            out = [blend.weighted(names, weights=weights).alias(to)]
        return members.select(*[quoted(c) for c in df.columns], *out)


class VotingEnsemble(Ensemble):
    """Regression: mean. Classes: ``soft`` (mean probability) or ``hard`` (majority, smallest class on a tie)."""

    def __init__(self, models: Sequence[TabularModel], voting: str = "soft"):
        super().__init__(models)
        if voting not in ("soft", "hard"):
            raise ValueError(f"unknown voting: {voting}")
        self.voting, self.name = voting, f"voting_{voting}"

    def fit(self, df: DataFrame, features: Sequence[str], label: str, validation: DataFrame | None = None) -> "VotingEnsemble":
        self.set.fit(df, features, label, validation)
        return self

    def transform(self, df: DataFrame, to: str | None = None) -> DataFrame:
        to, names = to or self.name, [f"__p{i}" for i in range(len(self.set.models))]
        if not self.classifies:
            vote = blend.vote_mean(names)
            members = self._members(df)
        elif self.voting == "soft":
            members = self._members(df)
            vote = blend.argmax(blend.mean_probabilities(names)).cast("double")
        else:
            members = df
            for n, m in zip(names, self.set.models):
                members = m.predict(members, n)
            vote = blend.vote_hard(names)
        return members.select(*[quoted(c) for c in df.columns], vote.alias(to))


def _solvable(model: TabularModel) -> bool:
    c = model.config
    return type(model) is TabularModel and gram.applies(c.model_type, c.target_type, c.params)


def _out_of_fold(models, folded: DataFrame, features, label, folds: int, score, prefix: str) -> DataFrame:
    """Each row scored by models that were fitted without the row's fold, feature columns dropped.

    Linear models of all folds come from one pass, which adds up products of columns by fold, and their scores are a
    projection. Otherwise folds x models fits run side by side over one persisted table. The scores are written to the
    shared folder while that table is held, so what follows neither repeats the folds nor the scoring.
    """
    parts = gram.fold_grams(folded, features, label, "__fold") if all(_solvable(m) for m in models) and folds > 1 else None
    if parts is not None and set(parts) == set(range(folds)):
        whole = sum(list(parts.values())[1:], list(parts.values())[0])
        out = folded
        for i, m in enumerate(models):
            fits = [gram.solve(whole - parts[k], m.config.model_type, m.config.params) for k in range(folds)]
            out = out.withColumn(f"{prefix}{i}", gram.by_fold(folded, fits, "__fold"))
        return out.drop(*features)
    with persisted(folded, models) as rows:
        fitted = in_threads([
            lambda m=m, k=k: m.copy().fit(rows.filter(F.col("__fold") != k), features, label)
            for k in range(folds) for m in models
        ])
        parts = None
        for k in range(folds):
            part = rows.filter(F.col("__fold") == k)
            for i in range(len(models)):
                part = score(fitted[k * len(models) + i], part, f"{prefix}{i}")
            parts = part if parts is None else parts.unionByName(part)
        path = scratch_path(folded.sparkSession, "out-of-fold")
        parts.drop(*features).write.parquet(path)
    return folded.sparkSession.read.parquet(path)


class StackingEnsemble(Ensemble):
    """A linear model over base predictions ``base_0..``.

    ``out_of_fold`` (default): the meta model learns from predictions on rows the bases did not
    see; otherwise from in-sample predictions, which leak the target and are kept for comparison.
    """

    name = "stacking"

    def __init__(
        self, models: Sequence[TabularModel], meta: TabularModel | None = None, folds: int = 5,
        key: str | None = None, out_of_fold: bool = True,
    ):
        super().__init__(models)
        if out_of_fold and key is None:
            raise ValueError("out-of-fold stacking needs a row key")
        self.folds, self.key, self.out_of_fold = folds, key, out_of_fold
        kind = "classification" if self.classifies else "regression"
        start = "ridge" if out_of_fold else ("logistic" if self.classifies else "linear")
        self.meta = meta or model_by_name(start, kind, "meta")
        self.inputs = [f"base_{i}" for i in range(len(models))]

    def meta_features(self, df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
        """Key, label and ``base_<i>`` columns for the training rows."""
        if not self.out_of_fold:
            return self.set.score_columns(df)
        rows = df.select(self.key, label, *features)
        if self.classifies:
            folded = stratified_folds(rows, label, self.key, self.folds, to="__fold")
        else:
            folded = rows.withColumn("__fold", fold_of(self.key, self.folds))
        out = _out_of_fold(
            self.set.models, folded, features, label, self.folds, lambda m, t, to: m.score_column(t, to), "base_"
        )
        return out.select(self.key, label, *self.inputs)

    def fit(self, df: DataFrame, features: Sequence[str], label: str, validation: DataFrame | None = None) -> "StackingEnsemble":
        self.set.fit(df, features, label, validation)
        with persisted(self.meta_features(df, features, label).select(label, *self.inputs), [self.meta]) as rows:
            self.meta.fit(rows, self.inputs, label)
        return self

    def transform(self, df: DataFrame, to: str | None = None) -> DataFrame:
        to = to or self.name
        scored = self.meta.transform(self.set.score_columns(df), to, f"{to}_probability")
        extra = [quoted(f"{to}_probability")] if self.classifies else []
        return scored.select(*[quoted(c) for c in df.columns], quoted(to), *extra)


def create_ensemble(models: Sequence[TabularModel], kind: str = "average", *, key: str | None = None, **options):
    if kind in ("average", "weighted"):
        return BlendEnsemble(models, kind, key=key, **options)
    if kind == "stacking":
        return StackingEnsemble(models, key=key, **options)
    if kind in ("voting_soft", "voting_hard", "voting"):
        return VotingEnsemble(models, options.pop("voting", kind.partition("_")[2] or "soft"), **options)
    raise ValueError(f"unknown ensemble type: {kind}")


def diverse_ensembles(target_type: str = "regression", *, key: str | None = None, **params) -> list[Ensemble]:
    """Average of the first three tuned models, weighted blend of the other three, stack of all six."""
    models = tuned_models(target_type, **params)
    return [
        create_ensemble([m.copy() for m in models[:3]], "average"),
        create_ensemble([m.copy() for m in models[3:]], "weighted", key=key),
        create_ensemble([m.copy() for m in models], "stacking", key=key),
    ]

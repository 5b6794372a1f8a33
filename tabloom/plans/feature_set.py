"""Composable and automatic feature sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.base import append_columns, replace_columns
from tabloom.operators.categories import MISSING
from tabloom.operators.features import (
    CategoryFeatures,
    DatetimeFeatures,
    FeatureModel,
    FeatureStep,
    GroupAggregateFeatures,
    InteractionFeatures,
    NumericFeatures,
    PolynomialFeatures,
    TargetEncodingFeatures,
)
from tabloom.operators.stats import numeric_columns, quoted, string_columns, value
from tabloom.operators.windows import lag_features, rolling_rows


class FeatureSet:
    """Feature steps that all read the *input* columns; their outputs are appended in step order.

    Steps that are plain expressions end up in one projection; steps with category tables add one
    lookup per column.
    """

    def __init__(self, *, label: str | None = None, key: str | None = None):
        self.label, self.key = label, key
        self.steps: list[FeatureStep] = []
        self.models: list[FeatureModel] | None = None
        self.names: list[str] | None = None
        self.windows: list = []

    def _add(self, step: FeatureStep) -> "FeatureSet":
        self.steps.append(step.set_params(label=self.label, key=self.key))
        return self

    def add_numeric_features(self, transformations=("log", "sqrt", "square")) -> "FeatureSet":
        return self._add(NumericFeatures(transformations=list(transformations)))

    def add_categorical_features(self, min_frequency: int = 10) -> "FeatureSet":
        return self._add(CategoryFeatures(min_frequency=min_frequency))

    def add_interaction_features(self, max_interactions: int = 50) -> "FeatureSet":
        return self._add(InteractionFeatures(max_interactions=max_interactions))

    def add_polynomial_features(self, degree: int = 2) -> "FeatureSet":
        return self._add(PolynomialFeatures(degree=degree))

    def add_datetime_features(self, features=("year", "month", "day", "dayofweek", "is_weekend")) -> "FeatureSet":
        return self._add(DatetimeFeatures(features=list(features)))

    def add_aggregation_features(self, aggregates=("mean", "std", "min", "max", "count")) -> "FeatureSet":
        return self._add(GroupAggregateFeatures(aggregates=list(aggregates)))

    def add_target_encoding(self, folds: int = 5) -> "FeatureSet":
        return self._add(TargetEncodingFeatures(folds=folds))

    def add_lag_features(self, entity: str, order: list[str], columns: list[str], lags=(1,)) -> "FeatureSet":
        self.windows.append(lambda df: lag_features(df, entity, order, columns, lags))
        return self

    def add_rolling_features(self, entity: str, order: list[str], columns: list[str], window: int = 3) -> "FeatureSet":
        self.windows.append(lambda df: rolling_rows(df, entity, order, columns, window))
        return self

    def fit(self, df: DataFrame) -> "FeatureSet":
        self.models = [s.fit(df) for s in self.steps]
        self.names = self.transform(df).columns
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return self._apply(df, out_of_fold=False)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        """Like fit and transform, with the target encoding out-of-fold on the fitted rows."""
        self.fit(df)
        return self._apply(df, out_of_fold=True)

    def _apply(self, df: DataFrame, out_of_fold: bool) -> DataFrame:
        if self.models is None:
            raise ValueError("fit the feature set before transforming")
        out, order, plain = df, list(df.columns), {}
        for step, model in zip(self.steps, self.models):
            if type(model)._transform is FeatureModel._transform:
                plain.update(model.expressions(df))
                order += [n for n in model.get_feature_names_out() if n in plain]
            elif out_of_fold and isinstance(step, TargetEncodingFeatures) and step.opt("key"):
                out = step.out_of_fold(out)
                order += model.get_feature_names_out()
            else:
                out = model.transform(out)
                order += [n for n in model.get_feature_names_out() if n in out.columns]
        out = append_columns(out, plain).select(*[quoted(c) for c in dict.fromkeys(order)])
        for window in self.windows:
            out = window(out)
        return out

    def get_feature_names_out(self) -> list[str]:
        if self.names is None:
            raise ValueError("fit the feature set first")
        return list(self.names)


# What an automatic set builds unless told otherwise.
AUTO_DEFAULTS = {
    "numeric_features": True,
    "categorical_features": True,
    "interaction_features": True,
    "polynomial_features": False,
    "target_encoding": False,
    "datetime_features": True,
    "aggregation_features": False,
    "numeric_transformations": ["log", "sqrt", "square"],
    "min_frequency": 10,
    "max_interactions": 50,
}


class AutoFeatures:
    """A feature set built from flags; its output has no missing numbers or strings."""

    def __init__(self, config: dict | None = None, *, label: str | None = None, key: str | None = None):
        self.config = {**AUTO_DEFAULTS, **(config or {})}
        on = self.config.get
        self.features = FeatureSet(label=label, key=key)
        if on("numeric_features"):
            self.features.add_numeric_features(on("numeric_transformations"))
        if on("categorical_features"):
            self.features.add_categorical_features(on("min_frequency"))
        if on("interaction_features"):
            self.features.add_interaction_features(on("max_interactions"))
        if on("polynomial_features"):
            self.features.add_polynomial_features(on("polynomial_degree") or 2)
        if on("datetime_features"):
            self.features.add_datetime_features()
        if on("aggregation_features"):
            self.features.add_aggregation_features()
        if on("target_encoding") and label:
            self.features.add_target_encoding()
        entity, order = on("entity"), on("order")
        if (on("lag_features") or on("window_features")) and not entity:
            raise ValueError("lag and window features need an entity and an order")
        if on("lag_features") and entity:
            self.features.add_lag_features(entity, order, on("window_columns"), on("lags") or [1])
        if on("window_features") and entity:
            self.features.add_rolling_features(entity, order, on("window_columns"), on("window") or 3)

    def fit(self, df: DataFrame) -> "AutoFeatures":
        self.features.fit(df)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return fill_missing(self.features.transform(df))

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return fill_missing(self.features.fit_transform(df))

    def get_feature_names_out(self) -> list[str]:
        return self.features.get_feature_names_out()


def fill_missing(df: DataFrame) -> DataFrame:
    filled = {c: F.coalesce(value(df, c), F.lit(0).cast(df.schema[c].dataType)) for c in numeric_columns(df)}
    filled.update({c: F.coalesce(quoted(c), F.lit(MISSING)) for c in string_columns(df)})
    return replace_columns(df, filled)

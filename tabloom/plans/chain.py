"""Preprocessing chains."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators.base import Fitted, Step
from tabloom.operators.encode import CategoricalEncoder
from tabloom.operators.impute import Imputer
from tabloom.operators.outliers import OutlierClipper
from tabloom.operators.scale import Scaler
from tabloom.operators.select import FeatureSelector, FeatureSelectorModel
from tabloom.operators.split import is_validation, stratified_flag


class FunctionStep(Transformer):
    """Any ``DataFrame -> DataFrame`` function as a step."""

    def __init__(self, function: Callable[[DataFrame], DataFrame]):
        super().__init__()
        self.function = function

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.transform(self.function)


def default_steps() -> list[tuple[str, Step]]:
    return [
        ("missing_handler", Imputer()),
        ("outlier_handler", OutlierClipper()),
        ("categorical_encoder", CategoricalEncoder()),
        ("numeric_scaler", Scaler()),
        ("feature_selector", FeatureSelector()),
    ]


def configured_steps(config: dict) -> list[tuple[str, Step]]:
    """Steps by flags and strategies; selection is off unless asked for."""
    steps: list[tuple[str, Step]] = []
    if config.get("handle_missing", True):
        steps.append(("missing_handler", Imputer(
            numeric_strategy=config.get("numeric_impute_strategy", "mean"),
            categorical_strategy=config.get("categorical_impute_strategy", "mode"),
        )))
    if config.get("handle_outliers", True):
        steps.append(("outlier_handler", OutlierClipper(
            method=config.get("outlier_method", "iqr"), threshold=config.get("outlier_threshold", 1.5),
        )))
    if config.get("encode_categorical", True):
        steps.append(("categorical_encoder", CategoricalEncoder(method=config.get("encoding_method", "label"))))
    if config.get("scale_numeric", True):
        steps.append(("numeric_scaler", Scaler(method=config.get("scaling_method", "standard"))))
    if config.get("select_features", False):
        steps.append(("feature_selector", FeatureSelector(
            method=config.get("feature_selection_method", "variance"),
            threshold=config.get("feature_selection_threshold", 0.01),
        )))
    return steps


class Chain:
    """Named steps, fitted in order on one table; label and key pass through untouched."""

    def __init__(
        self, steps: Sequence[tuple[str, Estimator | Transformer]] | None = None, *,
        label: str | None = None, key: str | None = None, config: dict | None = None,
    ):
        if steps is None:
            steps = default_steps() if config is None else configured_steps(config)
        self.steps = list(steps)
        self.label, self.key = label, key
        self.model: PipelineModel | None = None
        self.output: list[str] | None = None

    def add_step(self, name: str, step, position: int | None = None) -> "Chain":
        self.steps.insert(len(self.steps) if position is None else position, (name, step))
        return self

    def remove_step(self, name: str) -> "Chain":
        self.steps = [s for s in self.steps if s[0] != name]
        return self

    def get_params(self) -> dict:
        """``{step__setting: value}`` over all steps."""
        return {
            f"{name}__{k}": v for name, step in self.steps if isinstance(step, Step)
            for k, v in step.get_params().items()
        }

    def set_params(self, **params) -> "Chain":
        by_name = dict(self.steps)
        for full, setting in params.items():
            name, _, option = full.partition("__")
            if name not in by_name or not option:
                raise ValueError(f"unknown step setting: {full}")
            by_name[name].set_params(**{option: setting})
        return self

    def fit(self, df: DataFrame) -> "Chain":
        for _, step in self.steps:
            if isinstance(step, Step):
                step.set_params(label=self.label, key=self.key)
        self.model = Pipeline(stages=[s for _, s in self.steps]).fit(df)
        self.output = self.model.transform(df).columns
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.model is None:
            raise ValueError("fit the chain before transforming")
        return self.model.transform(df)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    def get_feature_names_out(self) -> list[str]:
        if self.model is None:
            raise ValueError("fit the chain first")
        last = self.model.stages[-1] if self.model.stages else None
        if isinstance(last, FeatureSelectorModel):
            return last.selected_features
        return [c for c in self.output or [] if c not in (self.label, self.key)]

    def save(self, path: str) -> None:
        if self.model is None:
            raise ValueError("fit the chain before saving")
        _with_tables(self.model, lambda at, i, name, held: _copied_table(held, name, f"{path}_tables/{at}-{i}")).write().overwrite().save(path)

    def load(self, path: str) -> "Chain":
        self.model = PipelineModel.load(path)
        return self


def _copied_table(held: dict, column: str, to: str) -> dict:
    """A table of categories, copied beside the saved chain, which then needs no scratch folder."""
    table = SparkSession.getActiveSession().read.parquet(held["path"])
    if not held["coded"]:
        table = table.filter(F.col("column") == column)
    table.write.mode("overwrite").parquet(to)
    return {**held, "path": to}


def _with_tables(model: PipelineModel, change) -> PipelineModel:
    """The chain with each stored category table replaced; steps without one are shared."""
    stages = []
    for at, stage in enumerate(model.stages):
        state = stage.fitted if isinstance(stage, Fitted) and stage.isDefined(stage.state) else {}
        table = state.get("table")
        if isinstance(table, dict) and any("path" in c for c in table.get("columns", {}).values()):
            columns = {n: change(at, i, n, c) if "path" in c else c for i, (n, c) in enumerate(table["columns"].items())}
            stage = stage.copy()
            stage._set(state={**state, "table": {**table, "columns": columns}})
        stages.append(stage)
    return PipelineModel(stages)


class Preprocessor:
    """Split, chain and feature names in one object."""

    def __init__(self, config: dict | None = None, *, key: str, portable: bool = True):
        self.config, self.key, self.portable = config or {}, key, portable
        self.chain: Chain | None = None
        self.label: str | None = None
        self.feature_names: list[str] | None = None

    def prepare_data(
        self, df: DataFrame, label: str, test_size: float = 0.2, seed: int = 42, stratify: bool = False
    ) -> tuple[DataFrame, DataFrame]:
        """(train, validation); ``stratify`` makes the share exact within each label."""
        self.label = label
        self.feature_names = [c for c in df.columns if c not in (label, self.key)]
        if stratify:
            flagged = stratified_flag(df, label, self.key, test_size, seed, "__validation")
            return flagged.filter("not __validation").drop("__validation"), flagged.filter("__validation").drop("__validation")
        chosen = is_validation(self.key, test_size, seed, self.portable)
        return df.filter(~chosen), df.filter(chosen)

    def create_chain(self, steps=None) -> Chain:
        self.chain = Chain(steps, label=self.label, key=self.key, config=None if steps else self.config or None)
        return self.chain

    def fit_transform(self, train: DataFrame) -> DataFrame:
        return (self.chain or self.create_chain()).fit_transform(train)

    def transform(self, df: DataFrame) -> DataFrame:
        if self.chain is None:
            raise ValueError("fit before transforming")
        return self.chain.transform(df)

    def process_train_test(self, train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
        return self.fit_transform(train), self.transform(test)

    def get_feature_names_out(self) -> list[str]:
        if self.chain is None:
            raise ValueError("fit first")
        return self.chain.get_feature_names_out()

    def save(self, path: str) -> None:
        if self.chain is not None:
            self.chain.save(path)

    def load(self, path: str) -> None:
        if self.chain is None:
            self.create_chain()
        self.chain.load(path)


def quick_preprocess(df: DataFrame, label: str, key: str, config: dict | None = None) -> dict:
    """Split, fit on train, apply to both."""
    preprocessor = Preprocessor(config, key=key)
    train, test = preprocessor.process_train_test(*preprocessor.prepare_data(df, label))
    return {
        "train": train, "test": test, "preprocessor": preprocessor,
        "feature_names": preprocessor.get_feature_names_out(),
    }

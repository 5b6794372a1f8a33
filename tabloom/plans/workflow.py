"""The whole flow: split, preprocess, features, models, scores, predictions, result files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators import blend
from tabloom.operators.metrics import evaluate, regression_metrics
from tabloom.operators.stats import numeric_columns, quoted
from tabloom.plans.chain import Preprocessor
from tabloom.plans.ensembles import Ensemble, create_ensemble
from tabloom.plans.feature_set import AutoFeatures, FeatureSet
from tabloom.plans.models import ModelSet, TabularModel, default_models, ensemble_models, model_by_name
from tabloom.plans.presets import ProblemConfig
from tabloom.plans.search import Search, SearchConfig
from tabloom.sources.results import ResultWriter


class Workflow:
    """Fit on a training table, score a validation part, predict any table with the same columns."""

    def __init__(
        self, label: str, key: str, problem: str = "regression", models: Sequence[TabularModel] | None = None,
        ensemble: bool = False, config: dict | None = None,
    ):
        self.label, self.key, self.problem = label, key, problem
        chosen = list(models) if models else default_models(problem)
        self.models = ModelSet(chosen + (ensemble_models(problem) if ensemble else []))
        self.config = config
        self.feature_config: dict | None = None
        self.methods: list[str] = []
        self.optimization: dict = {}
        self.ensembles: dict[str, Ensemble] = {}
        self.preprocessor: Preprocessor | None = None
        self.features: FeatureSet | AutoFeatures | None = None
        self.inputs: list[str] | None = None

    @classmethod
    def from_settings(
        cls, settings: ProblemConfig, key: str, label: str | None = None, features: dict | None = None, **model_settings
    ) -> "Workflow":
        """A flow that does what the settings say: steps, features, models, ensembles, and the search it offers.

        ``features`` adds what a preset cannot know, such as entity and order of a time series; ``model_settings`` go to
        every model.
        """
        models = [model_by_name(n, settings.problem_type, **model_settings) for n in settings.modeling["models"]]
        flow = cls(label or settings.target_column, key, settings.problem_type, models, config=settings.preprocessing)
        flow.feature_config = {**settings.feature_engineering, **(features or {})}
        flow.optimization = dict(settings.optimization)
        if settings.modeling.get("use_ensemble") and settings.ensemble.get("use_ensemble"):
            flow.methods = list(settings.ensemble["methods"])
        return flow

    def search(self, space: dict, **changes) -> Search:
        """The search of the settings over a parameter space."""
        wanted = {"method": "random", **self.optimization, **changes}
        method = wanted.pop("method")
        scoring = "f1_weighted" if self.problem == "classification" else "neg_mean_squared_error"
        return Search(SearchConfig(dict(space), **{"scoring": scoring, **wanted}), method)

    def feature_set(self) -> FeatureSet | AutoFeatures:
        if self.feature_config is not None:
            return AutoFeatures(self.feature_config, label=self.label, key=self.key)
        return (
            FeatureSet(label=self.label, key=self.key).add_numeric_features().add_categorical_features()
            .add_interaction_features().add_datetime_features()
        )

    def fit(self, df: DataFrame) -> "Workflow":
        self.preprocessor = Preprocessor(self.config, key=self.key)
        train, validation = self.preprocessor.prepare_data(df, self.label)
        train, validation = self.preprocessor.process_train_test(train, validation)
        prepared = train.persist()  # every feature step is fitted on it
        self.features = self.feature_set()
        wide = self.features.fit_transform(prepared)
        self.inputs = numeric_columns(wide, exclude=(self.label, self.key))
        self.validation = self.features.transform(validation)
        self.models.fit(wide, self.inputs, self.label, self.validation)
        for method in self.methods:
            ensemble = create_ensemble([m.copy() for m in self.models.models], method, key=self.key)
            self.ensembles[f"ensemble_{method}"] = ensemble.fit(wide, self.inputs, self.label, self.validation)
        prepared.unpersist()
        return self

    def validation_metrics(self) -> DataFrame:
        """One row of metrics per model, by problem type."""
        scored = self.models.predict(self.validation)
        names = [m.name for m in self.models.models]
        if self.problem == "regression":  # scored once, all models in one aggregate
            pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), quoted(n).alias("__p")) for n in names]))
            long = scored.select(quoted(self.label), pairs.alias("x")).select(quoted(self.label), "x.*")
            return regression_metrics(long, self.label, "__p", by=["model"])
        out = None
        for m in self.models.models:
            row = evaluate(scored, self.label, m.name, self.problem).select(F.lit(m.name).alias("model"), "*")
            out = row if out is None else out.unionByName(row)
        return out

    def predict(self, df: DataFrame) -> DataFrame:
        """Key and one prediction column per model and ensemble."""
        if self.preprocessor is None:
            raise ValueError("fit the workflow before predicting")
        prepared = self.features.transform(self.preprocessor.transform(df.drop(self.label)))
        names = [*[m.name for m in self.models.models], *self.ensembles]
        scored = self.models.predict(prepared)
        for name, ensemble in self.ensembles.items():
            scored = ensemble.transform(scored, name)
        return scored.select(quoted(self.key), *[quoted(n) for n in names])

    def write(self, df: DataFrame, folder: str) -> dict[str, str]:
        """One result folder per model and one for their mean."""
        predictions, names = self.predict(df).persist(), [m.name for m in self.models.models]
        writer = ResultWriter(folder, self.key, self.label)
        paths = writer.write_each(predictions, names, ids=self.key)
        mean = predictions.withColumn("__mean", blend.average(names))
        paths["ensemble"] = writer.write(mean, "__mean", ids=self.key, name="ensemble_submission")
        predictions.unpersist()
        return paths

"""Ready-made settings for preprocessing, features, models and searches."""

from __future__ import annotations

import copy
from dataclasses import dataclass, field

# The settings a problem starts from.
PREPROCESSING = {
    "handle_missing": True,
    "handle_outliers": True,
    "encode_categorical": True,
    "scale_numeric": True,
    "numeric_impute_strategy": "mean",
    "categorical_impute_strategy": "mode",
    "outlier_method": "iqr",
    "outlier_threshold": 1.5,
    "encoding_method": "label",
    "scaling_method": "standard",
}
FEATURES = {
    "numeric_features": True,
    "categorical_features": True,
    "interaction_features": True,
    "polynomial_features": False,
    "datetime_features": True,
    "aggregation_features": False,
    "numeric_transformations": ["log", "sqrt", "square"],
    "min_frequency": 10,
    "max_interactions": 50,
}
MODELING = {
    "models": ["xgboost", "lightgbm", "catboost"],
    "use_ensemble": True,
    "ensemble_methods": ["average", "weighted", "stacking"],
}
SEARCH = {"method": "optuna", "n_trials": 100, "cv_folds": 5, "timeout": None, "early_stopping_rounds": 20}
ENSEMBLE = {"use_ensemble": True, "methods": ["average", "weighted"], "meta_model": "ridge"}


@dataclass
class ProblemConfig:
    problem_type: str = "regression"
    target_column: str = "target"
    id_column: str = "id"
    preprocessing: dict | None = None
    feature_engineering: dict | None = None
    modeling: dict | None = None
    optimization: dict | None = None
    ensemble: dict | None = None

    def __post_init__(self):
        encoded = {**FEATURES, "target_encoding": self.problem_type == "classification"}
        starts = {
            "preprocessing": PREPROCESSING, "feature_engineering": encoded, "modeling": MODELING,
            "optimization": SEARCH, "ensemble": ENSEMBLE,
        }
        for name, start in starts.items():
            if getattr(self, name) is None:
                setattr(self, name, copy.deepcopy(start))


@dataclass
class CompetitionConfig:
    """A named task: where its data is, how it is scored, and the settings to use."""

    name: str
    type: str
    metric: str
    train_path: str
    test_path: str
    sample_path: str | None = None
    config: ProblemConfig | None = field(default=None)

    def __post_init__(self):
        if self.config is None:
            self.config = ProblemConfig(problem_type=self.type)


# Presets by kind of problem.
PRESETS = {
    "regression": {
        "problem_type": "regression",
        "preprocessing": {
            "handle_missing": True, "handle_outliers": True, "encode_categorical": True,
            "scale_numeric": True, "outlier_method": "iqr", "outlier_threshold": 2.0,
        },
        "feature_engineering": {
            "numeric_features": True, "categorical_features": True, "interaction_features": True,
            "polynomial_features": True, "target_encoding": False, "max_interactions": 100,
        },
        "optimization": {"method": "optuna", "n_trials": 200, "cv_folds": 5},
    },
    "classification": {
        "problem_type": "classification",
        "preprocessing": {
            "handle_missing": True, "handle_outliers": False, "encode_categorical": True,
            "scale_numeric": True, "encoding_method": "target",
        },
        "feature_engineering": {
            "numeric_features": True, "categorical_features": True, "interaction_features": True,
            "target_encoding": True, "max_interactions": 50,
        },
        "optimization": {"method": "bayesian", "n_trials": 150, "cv_folds": 5},
    },
    "tabular": {
        "problem_type": "regression",
        "preprocessing": {
            "handle_missing": True, "handle_outliers": True, "encode_categorical": True, "scale_numeric": False,
        },
        "feature_engineering": {
            "numeric_features": True, "categorical_features": True, "interaction_features": True,
            "polynomial_features": False, "target_encoding": True, "aggregation_features": True,
        },
        "modeling": {"models": ["xgboost", "lightgbm", "catboost"], "use_ensemble": True},
    },
    "time_series": {
        "problem_type": "regression",
        "feature_engineering": {
            "numeric_features": True, "datetime_features": True, "lag_features": True,
            "window_features": True, "interaction_features": False,
        },
    },
}


def preset(kind: str) -> ProblemConfig:
    if kind not in PRESETS:
        raise ValueError(f"unknown preset: {kind}")
    return ProblemConfig(**copy.deepcopy(PRESETS[kind]))


# Known tasks.
COMPETITIONS = {
    "house_prices": ("House Prices", "regression", "rmse", "data/house_prices", "regression"),
    "titanic": ("Titanic", "classification", "accuracy", "data/titanic", "classification"),
    "tabular_playground": ("Tabular Playground", "regression", "rmse", "data/tabular", "tabular"),
}


def competition(name: str) -> CompetitionConfig:
    title, kind, metric, folder, settings = COMPETITIONS[name]
    return CompetitionConfig(
        title, kind, metric, f"{folder}/train.csv", f"{folder}/test.csv", config=preset(settings)
    )

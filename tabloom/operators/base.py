"""Base classes: a fit is a few aggregate jobs, a fitted step is a lazy projection or lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame

from tabloom.operators.stats import numeric_columns, quoted, string_columns


class Step(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """An estimator whose settings are one JSON-able dictionary.

    Common settings: ``columns`` (default: by type at fit time), ``label`` and ``key`` (never
    transformed unless named in ``columns``).
    """

    options = Param(Params._dummy(), "options", "settings of the step")
    defaults: dict = {}

    def __init__(self, **options):
        super().__init__()
        self._set(options={**{"columns": None, "label": None, "key": None}, **self.defaults})
        self.set_params(**options)

    def get_params(self) -> dict:
        return dict(self.getOrDefault(self.options))

    def set_params(self, **options) -> "Step":
        known = self.get_params()
        unknown = set(options) - set(known)
        if unknown:
            raise ValueError(f"unknown settings for {type(self).__name__}: {sorted(unknown)}")
        self._set(options={**known, **options})
        return self

    def opt(self, name: str):
        return self.getOrDefault(self.options)[name]

    def resolve(self, df: DataFrame, by_type, setting: str = "columns") -> list[str]:
        """Named columns that exist, or all columns of the type except label and key."""
        named = self.opt(setting)
        if named is not None:
            return [c for c in named if c in df.columns]
        return by_type(df, exclude=(self.opt("label"), self.opt("key")))

    def numeric(self, df: DataFrame) -> list[str]:
        return self.resolve(df, numeric_columns)

    def strings(self, df: DataFrame) -> list[str]:
        return self.resolve(df, string_columns)


class Fitted(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted step: ``state`` holds its statistics, one entry per column, as JSON values."""

    state = Param(Params._dummy(), "state", "fitted values")

    def __init__(self, **state):
        super().__init__()
        if state:
            self._set(state=state)

    @property
    def fitted(self) -> dict:
        return self.getOrDefault(self.state)


def replace_columns(df: DataFrame, changed: dict[str, Column]) -> DataFrame:
    """One projection that swaps columns in place and keeps the schema order."""
    return df.select(*[changed[c].alias(c) if c in changed else quoted(c) for c in df.columns])


def append_columns(df: DataFrame, added: dict[str, Column]) -> DataFrame:
    """One projection that keeps every column and appends the new ones."""
    return df.select(*[quoted(c) for c in df.columns], *[e.alias(n) for n, e in added.items()])


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]

"""Column selection."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.base import Fitted, Step, present
from tabloom.operators.products import correlations_with, sample_variances
from tabloom.operators.stats import aggregate_columns, correlation, numeric_columns, quoted, string_columns, value


#: Columns from which on statistics come from block products: one aggregate expression per column would not compile.
WIDE = 200


class FeatureSelector(Step):
    """Choose columns from one aggregate over all numeric columns.

    ``variance``: sample variance above the threshold. ``correlation``: absolute Pearson
    correlation with the label, best ``n_features`` or all above the threshold, best first. Other
    methods, or no label, keep everything. String columns always stay and come last. Label and key
    pass through in front.
    """

    defaults = {"method": "variance", "threshold": 0.01, "n_features": None}

    def _fit(self, df: DataFrame) -> "FeatureSelectorModel":
        held = [c for c in (self.opt("key"), self.opt("label")) if c]
        strings = string_columns(df, exclude=held)
        scores = self.scores(df)
        if scores is None:
            chosen = [c for c in df.columns if c not in held]
            return FeatureSelectorModel(held=held, selected=chosen)
        if self.opt("method") == "variance":
            chosen = [c for c, s in scores if s > self.opt("threshold")]
        else:
            ranked = sorted(scores, key=lambda cs: (math.isnan(cs[1]), -cs[1]))
            if self.opt("n_features"):
                chosen = [c for c, _ in ranked[: self.opt("n_features")]]
            else:
                chosen = [c for c, s in ranked if s > self.opt("threshold")]
        return FeatureSelectorModel(held=held, selected=chosen + strings)

    def scores(self, df: DataFrame) -> list[tuple[str, float]] | None:
        columns, label = self.numeric(df), self.opt("label")
        if len(columns) > WIDE and self.opt("method") == "variance":
            return list(sample_variances(df, columns).items())
        if len(columns) > WIDE and self.opt("method") == "correlation" and label:
            return [(c, abs(v)) for c, v in correlations_with(df, columns, label).items()]
        if self.opt("method") == "variance":
            found = aggregate_columns(df, columns, s=F.var_samp)
        elif self.opt("method") == "correlation" and label:
            found = aggregate_columns(df, columns, s=lambda c: F.abs(correlation(c, value(df, label))))
        else:
            return None
        return [(c, math.nan if v["s"] is None else float(v["s"])) for c, v in found.items()]


class FeatureSelectorModel(Fitted):
    @property
    def selected_features(self) -> list[str]:
        return list(self.fitted["selected"])

    def _transform(self, df: DataFrame) -> DataFrame:
        wanted = [*self.fitted["held"], *self.fitted["selected"]]
        return select_available(df, wanted)


def select_available(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[quoted(c) for c in dict.fromkeys(present(df, wanted))])


def select_by_type(df: DataFrame, *kinds: str) -> DataFrame:
    """Columns of the kinds ``numeric`` and/or ``categorical``, in schema order."""
    chosen = set()
    if "numeric" in kinds:
        chosen |= set(numeric_columns(df))
    if "categorical" in kinds:
        chosen |= set(string_columns(df))
    return df.select(*[quoted(c) for c in df.columns if c in chosen])

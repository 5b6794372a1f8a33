"""Numeric scaling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.base import Fitted, Step, present, replace_columns
from tabloom.operators.stats import aggregate_columns, exact_quantiles, value


class Scaler(Step):
    """``(x - centre) / width`` per column, from one aggregate over all columns.

    ``standard``: mean and *population* standard deviation. ``minmax``: minimum and range.
    ``robust``: exact median and interquartile range. A zero width counts as 1.
    """

    defaults = {"method": "standard", "approx": False}

    def _fit(self, df: DataFrame) -> "ScalerModel":
        columns, method = self.numeric(df), self.opt("method")
        if method == "standard":
            found = aggregate_columns(df, columns, a=F.avg, b=F.stddev_pop)
            pairs = {c: (v["a"], v["b"]) for c, v in found.items()}
        elif method == "minmax":
            found = aggregate_columns(df, columns, a=F.min, b=F.max)
            pairs = {c: (v["a"], None if v["a"] is None else v["b"] - v["a"]) for c, v in found.items()}
        elif method == "robust":
            if self.opt("approx"):
                found = aggregate_columns(df, columns, q=lambda c: F.percentile_approx(c, [0.25, 0.5, 0.75], 10_000))
                quartiles = {c: found[c]["q"] or [None] * 3 for c in columns}
            else:
                quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
            pairs = {c: (m, None if m is None else q3 - q1) for c, (q1, m, q3) in quartiles.items()}
        else:
            raise ValueError(f"unknown scaling method: {method}")
        return ScalerModel(scales={
            c: [float(centre), float(width) or 1.0] for c, (centre, width) in pairs.items() if centre is not None
        })


class ScalerModel(Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        scales = self.fitted["scales"]
        return replace_columns(df, {
            c: (value(df, c).cast("double") - F.lit(scales[c][0])) / F.lit(scales[c][1])
            for c in present(df, scales)
        })

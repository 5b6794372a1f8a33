"""Outlier clipping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.columns import clip
from tabloom.operators.base import Fitted, Step, present, replace_columns
from tabloom.operators.stats import aggregate_columns, exact_quantiles, value


class OutlierClipper(Step):
    """Clip numeric columns; no row is removed and missing values stay missing.

    ``iqr``: quartiles -+ threshold * (Q3 - Q1), exact linear quantiles (``approx=True`` takes one
    bounded sketch). ``zscore``: mean -+ threshold * sample standard deviation.
    """

    defaults = {"method": "iqr", "threshold": 1.5, "approx": False}

    def _fit(self, df: DataFrame) -> "OutlierClipperModel":
        columns, k, method = self.numeric(df), self.opt("threshold"), self.opt("method")
        if method == "iqr":
            if self.opt("approx"):
                found = aggregate_columns(df, columns, q=lambda c: F.percentile_approx(c, [0.25, 0.75], 10_000))
                quartiles = {c: found[c]["q"] or [None, None] for c in columns}
            else:
                quartiles = exact_quantiles(df, columns, [0.25, 0.75])
            spans = {c: (q1, q3, None if q1 is None else q3 - q1) for c, (q1, q3) in quartiles.items()}
        elif method == "zscore":
            found = aggregate_columns(df, columns, mean=F.avg, std=F.stddev_samp)
            spans = {c: (v["mean"], v["mean"], v["std"]) for c, v in found.items()}
        else:
            raise ValueError(f"unknown outlier method: {method}")
        return OutlierClipperModel(bounds={
            c: [float(low) - k * width, float(high) + k * width]
            for c, (low, high, width) in spans.items() if width is not None
        })


class OutlierClipperModel(Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        bounds = self.fitted["bounds"]
        return replace_columns(df, {c: clip(value(df, c), *bounds[c]) for c in present(df, bounds)})

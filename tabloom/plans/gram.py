"""Linear models from cross-products: every fold and every penalty of a search from one pass over the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.base import Fitted
from tabloom.operators.products import one_row, pair_sums
from tabloom.operators.stats import quoted, value

#: Features up to which the normal equations are solved on the driver (a few MB a fold).
MOST = 500


@dataclass
class Gram:
    """Sums over some rows of features and label, shifted: matrix of products, vector of sums, number of rows."""

    features: list[str]
    shift: np.ndarray
    n: float
    sums: np.ndarray
    products: np.ndarray

    def __add__(self, other: "Gram") -> "Gram":
        return Gram(self.features, self.shift, self.n + other.n, self.sums + other.sums, self.products + other.products)

    def __sub__(self, other: "Gram") -> "Gram":
        return Gram(self.features, self.shift, self.n - other.n, self.sums - other.sums, self.products - other.products)

    def covariance(self) -> np.ndarray:
        mean = self.sums / self.n
        return self.products / self.n - np.outer(mean, mean)


def fold_grams(df: DataFrame, features: Sequence[str], label: str, fold: str | None = None) -> dict[int, Gram] | None:
    """A Gram per fold, or None where they do not hold: rows with missing features, or too many features.

    Rows without a label are left out.
    """
    if len(features) > MOST:
        return None
    names = [*features, "__label"]
    rows = df.select(*[value(df, c).cast("double").alias(c) for c in features], value(df, label).cast("double").alias("__label"), *([fold] if fold else []))
    rows = rows.where(F.col("__label").isNotNull())
    shifts = one_row(rows, names)
    if not shifts:
        return None
    out = {}
    for k, s in pair_sums(rows, names, names, fold, shifts=shifts).items():
        n = s["n"].diagonal()
        if (s["n"] != n.max()).any():
            return None
        out[k] = Gram(list(features), np.array([shifts[c] for c in names]), float(n[0]), s["x"].diagonal(), s["xy"])
    return out


class Weights(list):
    def toArray(self) -> np.ndarray:
        return np.array(self)


class LinearFit(Fitted):
    """``__prediction``: intercept and weights on the columns as they are; ``coefficients`` are those of scaled columns."""

    @property
    def coefficients(self) -> Weights:
        return Weights(self.fitted["scaled"])

    def expression(self, df: DataFrame) -> Column:
        return linear(df, self.fitted["features"], self.fitted["weights"], self.fitted["intercept"])

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("__prediction", self.expression(df))


def linear(df: DataFrame, features: Sequence[str], weights: Sequence, intercept) -> Column:
    """Weights and intercept may be numbers or columns."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    total = lit(intercept)
    for c, w in zip(features, weights):
        total = total + value(df, c).cast("double") * lit(w)
    return total


def penalties(kind: str, params: Mapping, n: float) -> tuple[float, float]:
    """(l1, l2) on scaled weights, beside half the mean of squares."""
    alpha = float(params.get("alpha", 1.0))
    if kind == "linear":
        return 0.0, 0.0
    if kind == "ridge":
        return 0.0, alpha / n
    share = 1.0 if kind == "lasso" else float(params.get("l1_ratio", 0.5))
    return alpha * share, alpha * (1 - share)


def solve(g: Gram, kind: str, params: Mapping, tolerance: float = 1e-12, most: int = 100_000) -> LinearFit:
    """The fit on the rows of a Gram: direct without an absolute penalty, by coordinate descent with one."""
    cov, mean = g.covariance(), g.sums / g.n + g.shift
    variance = np.maximum(cov.diagonal(), 0.0)
    scale = np.sqrt(variance[:-1])
    scale[variance[:-1] <= 1e-14 * np.maximum(g.products.diagonal()[:-1] / g.n, 1e-300)] = 0.0
    used = scale > 0
    q = cov[:-1, :-1][np.ix_(used, used)] / np.outer(scale[used], scale[used])
    r = cov[:-1, -1][used] / scale[used]
    l1, l2 = penalties(kind, params, g.n)
    if not l1:
        w = np.linalg.lstsq(q + l2 * np.eye(len(r)), r, rcond=1e-12)[0] if len(r) else np.zeros(0)
    else:
        w = np.zeros(len(r))
        for _ in range(most):
            step = 0.0
            for j in range(len(w)):
                rho = r[j] - q[j] @ w + q[j, j] * w[j]
                new = np.sign(rho) * max(abs(rho) - l1, 0.0) / (q[j, j] + l2)
                step, w[j] = max(step, abs(new - w[j])), new
            if step <= tolerance * max(1.0, np.abs(r).max()):
                break
    scaled = np.zeros(len(scale))
    scaled[used] = w
    weights = np.divide(scaled, scale, out=np.zeros(len(scale)), where=used)
    return LinearFit(
        features=g.features, weights=weights.tolist(), intercept=float(mean[-1] - weights @ mean[:-1]), scaled=scaled.tolist(),
    )


def squared_errors(g: Gram, fit: LinearFit) -> tuple[float, float]:
    """(mean squared error, variance of the label) of a fit on the rows of a Gram."""
    w = np.append(-np.array(fit.fitted["weights"]), 1.0)
    mean = g.sums / g.n
    bias = float((mean + g.shift) @ w - fit.fitted["intercept"])
    cov = g.covariance()
    return float(w @ cov @ w) + bias * bias, float(cov[-1, -1])


def applies(kind: str, target_type: str, params: Mapping) -> bool:
    return kind in ("linear", "ridge", "lasso", "elasticnet") and target_type == "regression" and bool(params.get("fit_intercept", True))


def by_fold(df: DataFrame, fits: Sequence[LinearFit], fold: str) -> Column:
    """Prediction of the fit with the number in ``fold``."""
    pick = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), quoted(fold) + 1)
    features = fits[0].fitted["features"]
    weights = [pick([f.fitted["weights"][j] for f in fits]) for j in range(len(features))]
    return linear(df, features, weights, pick([f.fitted["intercept"] for f in fits]))


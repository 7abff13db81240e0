"""Linear regressors solved from cross products.

The table is read once (per set of folds); every penalty and every fold is then a small
columns x columns problem. Predictions are plain arithmetic expressions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.columns import col
from tablewright.functions.gram import Gram, grams, total

KINDS = ("linear_regression", "ridge", "lasso", "elastic_net")


@dataclass
class LinearModel:
    kind: str
    features: list[str]
    coefficients: list[float]
    intercept: float
    params: dict = field(default_factory=dict)

    def expression(self) -> Column:
        out = F.lit(self.intercept)
        for c, w in zip(self.features, self.coefficients):
            out = out + col(c).cast("double") * F.lit(w)
        return out

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        return df.withColumn(output, self.expression())

    def weights(self) -> list[float]:
        return [abs(w) for w in self.coefficients]


def _descend(cross: np.ndarray, right: np.ndarray, n: float, alpha: float, ratio: float,
             max_iter: int, tol: float = 1e-12) -> np.ndarray:
    """Coordinate descent for the penalised least squares problem on centred cross products."""
    w = np.zeros(len(right))
    l1, l2 = alpha * ratio * n, alpha * (1 - ratio) * n
    diagonal = np.diag(cross)
    residual = right.copy()
    for _ in range(max_iter):
        largest = 0.0
        for j in range(len(w)):
            if diagonal[j] <= 0:
                continue
            pull = residual[j] + diagonal[j] * w[j]
            new = np.sign(pull) * max(abs(pull) - l1, 0.0) / (diagonal[j] + l2)
            if new != w[j]:
                residual -= cross[:, j] * (new - w[j])
                largest = max(largest, abs(new - w[j]) * np.sqrt(diagonal[j]))
                w[j] = new
        if largest <= tol * max(np.sqrt(abs(right) / np.maximum(diagonal, 1e-300)).max(), 1.0):
            break
    return w


def solve(g: Gram, kind: str = "linear_regression", alpha: float = 1.0, l1_ratio: float = 0.5,
          max_iter: int = 1000) -> LinearModel:
    """Fit from cross products of ``[features..., label]``; the intercept is not penalised."""
    if kind not in KINDS:
        raise ValueError(f"unknown linear model: {kind}")
    centred = g.centred()
    cross, right = centred[:-1, :-1], centred[:-1, -1]
    size = np.sqrt(np.clip(np.diag(cross), 0, None))
    size[size <= 1e-12 * np.sqrt(g.n) * np.maximum(np.abs(g.means[:-1]), 1e-300)] = 0.0
    live = size > 0
    w = np.zeros(len(right))
    params: dict = {}
    if live.any():
        c, r, s = cross[np.ix_(live, live)], right[live], size[live]
        if kind == "linear_regression":
            w[live] = np.linalg.pinv(c / np.outer(s, s), rcond=1e-12, hermitian=True) @ (r / s) / s
        elif kind == "ridge":
            params = {"alpha": alpha}
            w[live] = np.linalg.solve(c + alpha * np.eye(len(s)), r)
        else:
            ratio = 1.0 if kind == "lasso" else l1_ratio
            params = {"alpha": alpha, "max_iter": max_iter}
            if kind == "elastic_net":
                params["l1_ratio"] = l1_ratio
            w[live] = _descend(c, r, g.n, alpha, ratio, max_iter)
    means = g.means
    return LinearModel(kind, g.names[:-1], [float(x) for x in w],
                       float(means[-1] - w @ means[:-1]), params)


def squared_error(g: Gram, model: LinearModel) -> float:
    """Sum of squared errors of a model on the rows behind ``g``."""
    w = np.append(-np.asarray(model.coefficients), 1.0)
    lift = float(w @ g.shift) - model.intercept
    return float(w @ g.cross @ w + 2 * lift * (w @ g.sums) + g.n * lift * lift)


def fit_linear(df: DataFrame, features: list[str], label: str, kind: str = "linear_regression",
               **params) -> LinearModel:
    return solve(grams(df, [*features, label])[0], kind, **params)


def fold_grams(df: DataFrame, features: list[str], label: str, fold: str) -> dict[int, Gram]:
    return grams(df, [*features, label], F.col(fold))


def fold_errors(parts: dict[int, Gram], kind: str, **params) -> list[float]:
    """Mean squared error on each fold of the model fitted on the other folds."""
    everything = total(list(parts.values()))
    return [squared_error(parts[f], solve(everything - parts[f], kind, **params)) / parts[f].n
            for f in sorted(parts)]

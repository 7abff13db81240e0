"""Support vector regression by distributed gradient steps.

Linear kernel: epsilon-insensitive loss with an L2 penalty. RBF kernel: the same on random
Fourier features, an approximation of the kernel. Each step sums one gradient over the table;
tasks emit one partial vector each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.columns import col, one_row
from tablewright.session import spread, stage


@dataclass
class SupportModel:
    features: list[str]
    kernel: str
    means: np.ndarray
    scales: np.ndarray
    directions: np.ndarray | None
    phases: np.ndarray | None
    weights_: np.ndarray
    intercept: float
    params: dict

    def _lift(self):
        means, scales, directions, phases = self.means, self.scales, self.directions, self.phases

        def lift(x):
            z = (x - means) / scales
            if directions is None:
                return z
            z = z @ directions
            z += phases
            np.cos(z, out=z)
            z *= np.sqrt(2.0 / len(phases))
            return z

        return lift

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        lift, w, b, d = self._lift(), self.weights_, self.intercept, len(self.features)

        @F.pandas_udf("double")
        def predict(*cells):
            import numpy as np
            import pandas as pd

            x = np.column_stack([c.to_numpy(dtype=float) for c in cells])
            return pd.Series(lift(x) @ w + b)

        return df.withColumn(output, predict(*[col(c).cast("double") for c in self.features[:d]]))

    def weights(self) -> list[float]:
        if self.kernel != "linear":
            raise ValueError("only a linear kernel has feature weights")
        return [float(abs(w / s)) for w, s in zip(self.weights_, self.scales)]


def fit_svr(df: DataFrame, features: list[str], label: str, C: float = 1.0,
            kernel: str = "rbf", gamma: str | float = "scale", epsilon: float = 0.1,
            steps: int = 60, components: int = 64, seed: int = 42) -> SupportModel:
    """Minimise ``|w|^2 / 2 + C * sum(max(0, |error| - epsilon))`` with adaptive steps."""
    if kernel not in ("rbf", "linear"):
        raise ValueError(f"unknown kernel: {kernel}")
    d = len(features)
    # dealt evenly and written once, as every step reads all rows
    rows = stage(spread(df.select(*[col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)],
                                  col(label).cast("double").alias("y"))), "svr")
    gaps = one_row(rows, [F.count_if(F.col(c).isNull() | F.isnan(c)) for c in rows.columns])
    if any(gaps):
        raise ValueError("columns with missing values: " + ", ".join(
            f"{c} ({n})" for c, n in zip([*features, label], gaps) if n))
    n, middle, deviation, *flat = one_row(rows, [
        F.count(F.lit(1)), F.percentile_approx("y", 0.5), F.stddev_pop("y"),
        *[f(f"x{i}") for i in range(d) for f in (F.avg, F.stddev_pop)]])
    means = np.array(flat[::2])
    deviations = np.array([s or 1.0 for s in flat[1::2]])
    # scaled inputs have unit variance, for which "scale" and "auto" both mean 1 / columns
    width = 1.0 / d if isinstance(gamma, str) else float(gamma)
    rng = np.random.default_rng(seed)
    directions = phases = None
    if kernel == "rbf":
        directions = rng.normal(scale=np.sqrt(2 * width), size=(d, components))
        phases = rng.uniform(0, 2 * np.pi, components)
    size = d if kernel == "linear" else components
    deviation = deviation or 1.0
    model = SupportModel(list(features), kernel, means, deviations, directions, phases,
                         np.zeros(size), float(middle),
                         {"C": C, "kernel": kernel, "gamma": gamma, "epsilon": epsilon})
    lift = model._lift()
    seen = np.zeros(size + 1)
    best, best_loss = (model.weights_.copy(), model.intercept), np.inf

    def gradient(w, b):
        def pull(batches):
            out = np.zeros(size + 2)
            for batch in batches:
                *xs, y = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
                z = lift(np.column_stack(xs))
                error = z @ w + b - y
                over = np.abs(error) > epsilon
                sign = np.sign(error) * over
                out[:size] += sign @ z
                out[size] += sign.sum()
                out[size + 1] += (np.abs(error) - epsilon)[over].sum()
            yield pa.RecordBatch.from_arrays([pa.array([out.tolist()])], ["sums"])

        return pull

    for _ in range(steps):
        w, b = model.weights_, model.intercept
        # one short row a task, in the order of the parts
        found = rows.mapInArrow(gradient(w, b), "sums array<double>").collect()
        sums = np.sum([r["sums"] for r in found], axis=0)
        loss = 0.5 * float(w @ w) + C * sums[-1]
        if loss < best_loss:
            best, best_loss = (w.copy(), b), loss
        slope = np.append(w / max(C * n, 1e-12) + sums[:size] / n, sums[size] / n)
        seen += slope * slope
        move = slope / np.sqrt(np.maximum(seen, 1e-24)) * deviation * 0.3
        # the penalty keeps |w| below C * n * |z|, which the step must respect for a small C
        model.weights_ = w - np.clip(move[:-1], -C * n, C * n)
        model.intercept = float(b - move[-1])
    model.weights_, model.intercept = best
    return model

"""Feature scores and selection, and principal components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.binning import with_histogram_bin
from tablewright.functions.columns import anchors, col, one_row
from tablewright.functions.gram import gram
from tablewright.session import spread, stage

LARGEST = 1.7976931348623157e308
SEED = 42
SUMS = ["position", "n", "sx", "sxx", "sxy", "sy", "syy"]


def _f(n: int, sx: float, sxx: float, sxy: float, sy: float, syy: float) -> float:
    both = sxy - sx * sy / n
    spread = (sxx - sx * sx / n) * (syy - sy * sy / n)
    if spread <= 0:
        return 0.0
    square = both * both / spread
    return square / (1 - square) * (n - 2) if square < 1 else LARGEST


def f_score_rows(df: DataFrame, features: list[str], label: str) -> list[tuple[str, int, float]]:
    """(feature, position, score) of every feature, from one pass of plain sums.

    Six sums a feature are more columns than Spark compiles, so tasks add up their own batches and
    send a row for each feature.
    """
    names = [*features, label]
    cells = [(col(c).cast("double") - F.lit(s)).alias(f"x{i}")
             for i, (c, s) in enumerate(zip(names, anchors(df, [col(c) for c in names])))]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(len(features), np.int64), np.zeros((5, len(features)))
        for batch in batches:
            there = [c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns]
            *xs, y = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            for i, x in enumerate(xs):
                seen = there[i] & there[-1]
                n[i] += np.count_nonzero(seen)
                x, y_ = (x, y) if seen.all() else (x[seen], y[seen])
                sums[:, i] += x.sum(), (x * x).sum(), (x * y_).sum(), y_.sum(), (y_ * y_).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(features))), pa.array(n), *map(pa.array, sums)], SUMS)

    found = df.select(*cells).mapInArrow(task, "position long, n long, " + ", ".join(f"{c} double" for c in SUMS[2:])) \
        .groupBy("position").agg(*[F.sum(c).alias(c) for c in SUMS[1:]]).collect()
    rows = {r["position"]: [r[c] for c in SUMS[1:]] for r in found}
    return [(c, i, _f(*rows[i]) if i in rows and rows[i][0] > 2 else 0.0) for i, c in enumerate(features)]


SCORE_SCHEMA = "feature string, position long, score double"


def f_scores(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """F statistic of each feature against the label.

    A row counts for a feature if both cells are present. A constant feature scores 0, a
    perfectly correlated one the largest double.
    """
    return df.sparkSession.createDataFrame(f_score_rows(df, features, label), SCORE_SCHEMA)


def mutual_info(df: DataFrame, features: list[str], label: str, bins: int = 20) -> DataFrame:
    """Mutual information (nats) of binned feature and binned label.

    The table is melted to (feature, bin, bin) and counted map-side, so the shuffle carries at
    most features x bins x bins rows per task.
    """
    names = [*features, label]
    flat = one_row(df, [f(col(c).cast("double")) for c in names for f in (F.min, F.max)])
    ends = {c: (flat[2 * i], flat[2 * i + 1]) for i, c in enumerate(names)}

    def cell(c: str, position: int) -> Column:
        low, high = (F.lit(x).cast("double") for x in ends[c])
        return F.struct(F.lit(position).cast("bigint").alias("position"),
                        col(c).cast("double").alias("x"), low.alias("low"), high.alias("high"))

    def binned(rows: DataFrame, value: str, low: Column, high: Column, name: str) -> DataFrame:
        # a constant column has one bin; one unit of width keeps its value inside
        high = F.when(high == low, low + 1).otherwise(high)
        return with_histogram_bin(rows, value, low, high, bins, name)

    cells = df.select(col(label).cast("double").alias("y"),
                      F.inline(F.array(*[cell(c, i) for i, c in enumerate(features)])))
    both = binned(binned(cells, "x", F.col("low"), F.col("high"), "bx"), "y",
                  *[F.lit(x).cast("double") for x in ends[label]], "by")
    joint = both.groupBy("position", "bx", "by").agg(F.count(F.lit(1)).cast("double").alias("n")) \
        .na.drop()
    of = Window.partitionBy("position")
    shares = joint.select(
        "position", "n", F.sum("n").over(of).alias("total"),
        F.sum("n").over(Window.partitionBy("position", "bx")).alias("nx"),
        F.sum("n").over(Window.partitionBy("position", "by")).alias("ny"))
    scores = shares.groupBy("position").agg(F.sum(
        F.col("n") / F.col("total")
        * F.log(F.col("n") * F.col("total") / (F.col("nx") * F.col("ny")))).alias("score"))
    names = F.array(*[F.lit(c) for c in features])
    return scores.select(F.get(names, F.col("position").cast("int")).alias("feature"), "position",
                         F.greatest("score", F.lit(0.0)).alias("score"))


def assemble(df: DataFrame, features: list[str], label: str | None = None,
             output: str = "features") -> DataFrame:
    out = VectorAssembler(inputCols=features, outputCol=output, handleInvalid="error").transform(df)
    return out.withColumn("label", col(label).cast("double")) if label else out


def forest_scores(df: DataFrame, features: list[str], label: str, trees: int = 100,
                  depth: int = 10, seed: int = SEED) -> DataFrame:
    """Impurity importance from a random forest that sees all features at each split."""
    plain = spread(df.select(*[col(c) for c in features], col(label).alias("_y")), "forest")
    data = assemble(plain, features, "_y").select("features", "label")
    model = RandomForestRegressor(numTrees=trees, maxDepth=depth, seed=seed,
                                  featureSubsetStrategy="all", subsamplingRate=1.0).fit(data)
    weights = model.featureImportances.toArray()
    rows = [(c, i, float(weights[i])) for i, c in enumerate(features)]
    return df.sparkSession.createDataFrame(rows, SCORE_SCHEMA)


def importance(df: DataFrame, features: list[str], label: str, method: str = "random_forest",
               **options) -> DataFrame:
    tools = {"random_forest": forest_scores, "mutual_info": mutual_info, "f_regression": f_scores}
    if method not in tools:
        raise ValueError(f"unknown importance method: {method}")
    return tools[method](df, features, label, **options)


def top(scores: DataFrame, n: int = 10) -> DataFrame:
    return scores.orderBy(F.desc("score"), "position").limit(n)


def k_best(scores: DataFrame, k: int = 15) -> DataFrame:
    """The k highest scores in column order; among equal scores the later column wins."""
    return scores.orderBy(F.desc("score"), F.desc("position")).limit(k).orderBy("position")


def above_percentile(scores: DataFrame, percent: float = 70.0) -> DataFrame:
    """Scores at or above the interpolated percentile, highest first (one row per column)."""
    cut = one_row(scores, [F.percentile("score", percent / 100.0)])[0]
    return scores.filter(F.col("score") >= F.lit(cut)).orderBy(F.desc("score"), "position")


def eliminate(df: DataFrame, features: list[str], label: str, k: int, trees: int = 50,
              depth: int = 10, step: int = 1, seed: int = SEED) -> list[str]:
    """Recursive elimination: refit a forest and drop the least important column until k remain."""
    left = list(features)
    data = stage(df.select(*[col(c) for c in [*features, label]]), "elimination")
    while len(left) > k:
        rows = forest_scores(data, left, label, trees, depth, seed).collect()
        worst = sorted(rows, key=lambda r: (r["score"], r["position"]))[:min(step, len(left) - k)]
        gone = {r["feature"] for r in worst}
        left = [c for c in left if c not in gone]
    return left


def select(df: DataFrame, features: list[str], label: str, method: str = "k_best", k: int = 15,
           known: DataFrame | None = None, **options) -> list[str]:
    """Names of the selected features; ``known`` F statistics are not computed again."""
    if method == "k_best":
        scores = f_scores(df, features, label) if known is None else known
        return [r["feature"] for r in k_best(scores, k).collect()]
    if method == "rfe":
        return eliminate(df, features, label, k, **options)
    if method == "importance_threshold":
        scores = importance(df, features, label, **{"method": "random_forest", **options})
        return [r["feature"] for r in above_percentile(scores).collect()]
    raise ValueError(f"unknown selection method: {method}")


@dataclass
class Components:
    """Fitted principal components; applied as centred linear expressions."""

    columns: list[str]
    means: list[float]
    loadings: np.ndarray
    explained: list[float]

    def transform(self, df: DataFrame, keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
        parts = []
        for j in range(self.loadings.shape[1]):
            total = F.lit(0.0)
            for c, m, w in zip(self.columns, self.means, self.loadings[:, j]):
                total = total + (col(c).cast("double") - F.lit(m)) * F.lit(float(w))
            parts.append(total.alias(f"PC_{j + 1}"))
        return df.select(*parts, *[col(c) for c in keep])


def fit_components(df: DataFrame, columns: list[str], n_components: float | int = 0.95,
                   ) -> Components:
    """Principal components of the covariance, which is summed in one distributed pass.

    A fraction keeps the fewest components whose cumulative variance exceeds it. The largest
    loading of every component is positive.
    """
    g = gram(df, columns)
    values, vectors = np.linalg.eigh(g.centred() / max(g.n - 1, 1))
    order = np.argsort(values)[::-1]
    values, vectors = np.clip(values[order], 0, None), vectors[:, order]
    ratio = values / values.sum() if values.sum() > 0 else values
    if isinstance(n_components, float) and n_components < 1:
        k = int(np.searchsorted(np.cumsum(ratio), n_components, side="right")) + 1
    else:
        k = int(n_components)
    k = min(k, len(columns))
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(columns))])
    return Components(list(columns), [float(m) for m in g.means], (vectors * sign)[:, :k],
                      [float(r) for r in ratio[:k]])

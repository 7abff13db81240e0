"""Tree regressors on Spark ML, and extra trees built from random cut points."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, RandomForestRegressor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.columns import col, one_row
from tablewright.operators.select import assemble
from tablewright.session import spread

DEEPEST = 30
DEFAULT_DEPTH = 10


def depth_of(max_depth: int | None) -> int:
    """``None`` asks for unlimited depth, for which Spark's maximum stands; more is an error."""
    if max_depth is not None and int(max_depth) > DEEPEST:
        raise ValueError(f"trees can be {DEEPEST} levels deep, not {max_depth}")
    return DEEPEST if max_depth is None else int(max_depth)


@dataclass
class TreeModel:
    kind: str
    features: list[str]
    model: object
    params: dict

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        data = assemble(df, self.features, output="_features")
        self.model.setFeaturesCol("_features").setPredictionCol(output)
        return self.model.transform(data).drop("_features")

    def weights(self) -> list[float]:
        return [float(w) for w in self.model.featureImportances.toArray()]


def fit_tree(df: DataFrame, features: list[str], label: str, kind: str,
             n_estimators: int = 100, max_depth: int | None = DEFAULT_DEPTH,
             min_samples_leaf: int = 1, min_samples_split: int = 2, learning_rate: float = 0.1,
             seed: int = 42, max_bins: int = 32) -> TreeModel:
    """Decision tree, random forest or gradient boosting.

    Spark has no minimum split size; a split needs two leaves, so half of it bounds the leaf.
    """
    plain = spread(df.select(*[col(c) for c in features], col(label).alias("_y")), "trees")
    data = assemble(plain, features, "_y").select("features", "label")
    leaf = max(int(min_samples_leaf), int(min_samples_split) // 2)
    common = {"maxDepth": depth_of(max_depth), "minInstancesPerNode": leaf, "seed": seed,
              "maxBins": max_bins}
    params = {"max_depth": max_depth, "min_samples_leaf": min_samples_leaf,
              "min_samples_split": min_samples_split}
    if kind == "decision_tree":
        tool = DecisionTreeRegressor(**common)
    elif kind == "random_forest":
        tool = RandomForestRegressor(numTrees=n_estimators, featureSubsetStrategy="all", **common)
        params["n_estimators"] = n_estimators
    elif kind == "gradient_boosting":
        tool = GBTRegressor(maxIter=n_estimators, stepSize=learning_rate, **common)
        params.update(n_estimators=n_estimators, learning_rate=learning_rate)
    else:
        raise ValueError(f"unknown tree model: {kind}")
    return TreeModel(kind, list(features), tool.fit(data), params)


@dataclass
class ExtraTreesModel:
    """Mean over forests whose columns are cut at random points, one set of points per forest."""

    features: list[str]
    cuts: list[list[list[float]]]
    forests: list[object]
    params: dict

    def _coded(self, df: DataFrame, cuts: list[list[float]], prefix: str) -> DataFrame:
        """Number of cut points at or below each value, by binary search."""
        names = [f"{prefix}{i}" for i in range(len(self.features))]
        splits = [[float("-inf"), *points, float("inf")] for points in cuts]
        wide = df.withColumns({f"{n}_raw": col(c).cast("double")
                               for n, c in zip(names, self.features)})
        cutter = Bucketizer(splitsArray=[x if len(x) > 2 else [x[0], 0.0, x[1]] for x in splits],
                            inputCols=[f"{n}_raw" for n in names], outputCols=names)
        return cutter.transform(wide).drop(*[f"{n}_raw" for n in names])

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        out, answers = df, []
        for k, (cuts, forest) in enumerate(zip(self.cuts, self.forests)):
            prefix = f"_x{k}_"
            names = [f"{prefix}{i}" for i in range(len(self.features))]
            out = assemble(self._coded(out, cuts, prefix), names, output=f"_v{k}").drop(*names)
            forest.setFeaturesCol(f"_v{k}").setPredictionCol(f"_p{k}")
            out = forest.transform(out).drop(f"_v{k}")
            answers.append(f"_p{k}")
        mean = sum((F.col(a) for a in answers), F.lit(0.0)) / F.lit(float(len(answers)))
        return out.withColumn(output, mean).drop(*answers)

    def weights(self) -> list[float]:
        parts = [f.featureImportances.toArray() for f in self.forests]
        return [float(w) for w in np.mean(parts, axis=0)]


def fit_extra_trees(df: DataFrame, features: list[str], label: str, n_estimators: int = 100,
                    max_depth: int | None = DEFAULT_DEPTH, min_samples_split: int = 2,
                    groups: int = 5, points: int = 24, seed: int = 42) -> ExtraTreesModel:
    """Forests without bootstrap over randomly placed cut points.

    Cut points are uniform between a column's extremes. Several forests with their own points
    give the randomness that single trees have in the classic method.
    """
    df = spread(df.select(*[col(c) for c in features], col(label).alias("_y")), "trees")
    flat = one_row(df, [f(col(c).cast("double")) for c in features for f in (F.min, F.max)])
    rng = np.random.default_rng(seed)
    groups = min(groups, n_estimators)
    params = {"n_estimators": n_estimators, "max_depth": max_depth,
              "min_samples_split": min_samples_split}
    model = ExtraTreesModel(list(features), [], [], params)
    for k in range(groups):
        cuts = [sorted(float(x) for x in rng.uniform(low, high, points)) if low < high else []
                for low, high in zip(flat[::2], flat[1::2])]
        model.cuts.append(cuts)
        names = [f"_x{i}" for i in range(len(features))]
        data = assemble(model._coded(df, cuts, "_x"), names, "_y").select("features", "label")
        trees = n_estimators // groups + (1 if k < n_estimators % groups else 0)
        forest = RandomForestRegressor(
            numTrees=trees, maxDepth=depth_of(max_depth), bootstrap=False, maxBins=points + 2,
            minInstancesPerNode=max(1, min_samples_split // 2), seed=seed + k,
            featureSubsetStrategy="onethird")
        model.forests.append(forest.fit(data))
    return model

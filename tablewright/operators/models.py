"""Registry of regressors with one fit / transform / weights interface."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.fixed_values import PARAM_GRIDS
from tablewright.operators.linear import KINDS, fit_linear
from tablewright.operators.neighbors import knn_predict
from tablewright.operators.support import SupportModel, fit_svr
from tablewright.operators.trees import ExtraTreesModel, fit_extra_trees, fit_tree


@dataclass
class NeighborModel:
    """Keeps the training table; the neighbours are found when rows are scored."""

    train: DataFrame
    features: list[str]
    label: str
    params: dict

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        return knn_predict(self.train, df, self.features, self.label,
                           self.params.get("n_neighbors", 5),
                           self.params.get("weights", "uniform"), output)

    def weights(self) -> list[float]:
        raise ValueError("nearest neighbours have no feature weights")


def _neighbors(df, features, label, **params):
    return NeighborModel(df.select(*features, label), list(features), label, params)


def _linear(kind: str):
    return lambda df, features, label, **p: fit_linear(df, features, label, kind, **p)


def _tree(kind: str, **defaults):
    return lambda df, features, label, **p: fit_tree(df, features, label, kind, **{**defaults, **p})


# name -> function (table, features, label, **parameters) that returns a fitted model
REGISTRY: dict[str, Callable] = {
    **{kind: _linear(kind) for kind in KINDS},
    "decision_tree": _tree("decision_tree"),
    "random_forest": _tree("random_forest"),
    "gradient_boosting": _tree("gradient_boosting", max_depth=3),
    "extra_trees": fit_extra_trees,
    "svr": fit_svr,
    "knn": _neighbors,
}


def name_of(model) -> str:
    """The registry's name of a fitted model."""
    own = {ExtraTreesModel: "extra_trees", SupportModel: "svr", NeighborModel: "knn"}
    name = own.get(type(model)) or getattr(model, "kind", None)
    if name not in REGISTRY:
        raise ValueError(f"not a model of the registry: {type(model).__name__}")
    return name


def grid(name: str) -> dict[str, list]:
    """Hyper-parameter grid of a model; empty where there is nothing to tune."""
    return PARAM_GRIDS.get(name, {})


def fit(name: str, df: DataFrame, features: list[str], label: str, **params):
    if name not in REGISTRY:
        raise ValueError(f"unknown model: {name}")
    return REGISTRY[name](df, features, label, **params)


def weight_table(df: DataFrame, model, features: list[str], limit: int = 20) -> DataFrame:
    """Top features by tree importance or absolute coefficient, ascending."""
    rows = [(c, i, w) for i, (c, w) in enumerate(zip(features, model.weights()))]
    table = df.sparkSession.createDataFrame(rows, "feature string, position long, importance double")
    best = table.orderBy(F.desc("importance"), F.desc("position")).limit(limit)
    return best.orderBy("importance", "position").drop("position")

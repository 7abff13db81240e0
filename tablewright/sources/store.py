"""Models, deployment packages, run results and histories on shared storage."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

import numpy as np
from pyspark.ml.regression import (DecisionTreeRegressionModel, GBTRegressionModel,
                                   RandomForestRegressionModel)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.fixed_values import LOG_ENTRIES_KEPT
from tablewright.operators.clean import fill
from tablewright.operators.features import FeaturePlan
from tablewright.operators.linear import LinearModel
from tablewright.operators.models import NeighborModel
from tablewright.operators.monitor import baseline
from tablewright.operators.scale import Scaler
from tablewright.operators.support import SupportModel
from tablewright.operators.trees import ExtraTreesModel, TreeModel
from tablewright.sources.history import History

TREE_LOADERS = {"decision_tree": DecisionTreeRegressionModel,
                "random_forest": RandomForestRegressionModel,
                "gradient_boosting": GBTRegressionModel}


def plain(value):
    """A JSON-friendly copy of a nested report."""
    if isinstance(value, dict):
        return {str(k): plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple, set)):
        return [plain(v) for v in value]
    if isinstance(value, np.ndarray):
        return value.tolist()
    if isinstance(value, np.generic):
        return value.item()
    return value if isinstance(value, (str, int, float, bool, type(None))) else str(value)


def write_json(spark: SparkSession, path: str, value) -> str:
    """One JSON document as a one-row text table, on any storage Spark can write."""
    spark.createDataFrame([(json.dumps(plain(value)),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)
    return path


def read_json(spark: SparkSession, path: str):
    return json.loads("\n".join(r.value for r in spark.read.text(path).collect()))


def save_model(spark: SparkSession, model, path: str, info: dict | None = None) -> str:
    """Save any fitted model of the registry, with an optional info document."""
    about = {"class": type(model).__name__, "features": model.features, "params": model.params}
    if isinstance(model, LinearModel):
        about["model"] = asdict(model)
    elif isinstance(model, TreeModel):
        about["kind"] = model.kind
        model.model.write().overwrite().save(f"{path}/model")
    elif isinstance(model, ExtraTreesModel):
        about["cuts"] = model.cuts
        for i, forest in enumerate(model.forests):
            forest.write().overwrite().save(f"{path}/model_{i}")
    elif isinstance(model, SupportModel):
        about["model"] = {k: plain(v) for k, v in vars(model).items()}
    elif isinstance(model, NeighborModel):
        about["label"] = model.label
        model.train.write.mode("overwrite").parquet(f"{path}/train")
    else:
        raise TypeError(f"cannot save {type(model).__name__}")
    write_json(spark, f"{path}/about", about)
    if info is not None:
        write_json(spark, f"{path}/info", info)
    return path


def load_model(spark: SparkSession, path: str):
    about = read_json(spark, f"{path}/about")
    kind = about["class"]
    if kind == "LinearModel":
        return LinearModel(**about["model"])
    if kind == "TreeModel":
        loader = TREE_LOADERS[about["kind"]]
        return TreeModel(about["kind"], about["features"], loader.load(f"{path}/model"),
                         about["params"])
    if kind == "ExtraTreesModel":
        forests = [RandomForestRegressionModel.load(f"{path}/model_{i}")
                   for i in range(len(about["cuts"]))]
        return ExtraTreesModel(about["features"], about["cuts"], forests, about["params"])
    if kind == "SupportModel":
        arrays = {k: np.asarray(v) if isinstance(v, list) and k != "features" else v
                  for k, v in about["model"].items()}
        return SupportModel(**arrays)
    return NeighborModel(spark.read.parquet(f"{path}/train"), about["features"], about["label"],
                         about["params"])


def latest_model(names: DataFrame, column: str = "name") -> DataFrame:
    """Last name, in text order, of those that are models and not info documents."""
    return names.filter(F.col(column).startswith("best_model_")
                        & ~F.col(column).contains("_info")) \
        .agg(F.max(column).alias("latest_model"))


@dataclass
class Package:
    """A deployed model with what its training learned on the way from raw rows to features."""

    model: object
    settings: dict
    plan: FeaturePlan | None = None
    fills: dict | None = None
    scaler: Scaler | None = None
    late_scaler: Scaler | None = None

    def score(self, rows: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Predictions for raw rows, with or without the target; ``keep`` columns pass through."""
        held = [c for c in keep or [] if c in rows.columns]
        if self.fills:
            rows = fill(rows, self.fills)
        if self.scaler:
            rows = self.scaler.transform(rows)
        if self.plan:
            rows = self.plan.transform(rows, held)
        if self.late_scaler:
            rows = self.late_scaler.transform(rows)
        return self.model.transform(rows)


def save_package(spark: SparkSession, folder: str, model, metadata: dict, features: list[str],
                 training: DataFrame, target: str = "price", at: str | None = None,
                 plan: FeaturePlan | None = None, fills: dict | None = None,
                 scaler: Scaler | None = None, late_scaler: Scaler | None = None) -> dict:
    """Model, metadata, baseline statistics and deployment settings in one folder.

    ``plan``, ``fills`` and the scalers (before and after the features) are kept with them, so that
    ``load_package`` can score raw rows.
    """
    save_model(spark, model, f"{folder}/model")
    write_json(spark, f"{folder}/preparation", {
        "plan": asdict(plan) if plan else None, "fills": fills,
        "scaler": asdict(scaler) if scaler else None,
        "late_scaler": asdict(late_scaler) if late_scaler else None})
    write_json(spark, f"{folder}/metadata", metadata)
    baseline(training, target).write.mode("overwrite").parquet(f"{folder}/feature_stats")
    settings = {
        "model_version": metadata.get("version", "1.0"),
        "deployment_date": at or str(spark.sql("select current_timestamp()").first()[0]),
        "model_type": getattr(model, "kind", type(model).__name__),
        "feature_count": len(features),
        "expected_features": features,
        "performance_baseline": metadata.get("test", {}),
        "monitoring_enabled": True,
        "drift_detection_enabled": True,
    }
    write_json(spark, f"{folder}/deployment_config", settings)
    return settings


def load_package(spark: SparkSession, folder: str) -> Package:
    """A saved package, ready to score."""
    made = read_json(spark, f"{folder}/preparation")

    def scaler(name: str) -> Scaler | None:
        return Scaler(**made[name]) if made[name] else None

    return Package(load_model(spark, f"{folder}/model"),
                   read_json(spark, f"{folder}/deployment_config"),
                   FeaturePlan(**made["plan"]) if made["plan"] else None, made["fills"],
                   scaler("scaler"), scaler("late_scaler"))


def load_baseline(spark: SparkSession, folder: str, training: DataFrame | None = None,
                  target: str = "price") -> DataFrame | None:
    """Baseline statistics of a package, else computed from the training table."""
    from tablewright.sources.tables import read_table

    found = read_table(spark, f"{folder}/feature_stats", "parquet", missing="none")
    if found is not None:
        return found
    return None if training is None else baseline(training, target)


def append_history(rows: DataFrame, path: str, batch: int | None = None) -> str:
    """Add rows to a history table (metrics, prediction log, alerts), those of a batch only once."""
    History(rows.sparkSession, path).append(rows, batch)
    return path


def read_history(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows of a history, or None if there is none yet."""
    return History(spark, path).read()


def trim_history(spark: SparkSession, path: str, ts: str = "ts", rows: int = LOG_ENTRIES_KEPT, after: int = 0) -> str:
    """Keep the newest ``rows`` rows of a history of more than ``after`` parts; older ones are dropped for good."""
    History(spark, path).shorten(rows, ts, after)
    return path

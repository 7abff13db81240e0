"""Whole jobs: clean, engineer, train, evaluate, deploy, and the run that chains them."""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators import (charts, clean, features, metrics, models, monitor, profile,
                                   scale, select, split, tune)
from tablewright.session import stage, together
from tablewright.sources import store
from tablewright.sources.config import load_settings
from tablewright.sources.history import PARTS
from tablewright.sources.tables import read_table, write_table

log = logging.getLogger(__name__)


# ---- cleaning -------------------------------------------------------------------------------

@dataclass
class CleanResult:
    table: DataFrame
    raw: DataFrame
    reports: dict[str, DataFrame] = field(default_factory=dict)
    scaler: scale.Scaler | None = None
    fills: dict | None = None


def clean_job(raw: DataFrame, missing: str = "mean", duplicates: bool = True,
              outliers: bool = True, method: str = "iqr", scaling: str | None = None,
              target: str = "price", impute_target: bool = True, sequential: bool = True,
              ) -> CleanResult:
    """Impute, drop duplicates, filter outliers, fix types, scale; reports stay lazy.

    The deduplicated table is written once, as the outlier filter reads its columns several times;
    the report counts from it too.
    """
    columns = None if impute_target else [c for c in raw.columns if c != target]
    fills = None
    if missing in clean.FILL_STRATEGIES:
        fills = clean.fit_fill(raw, missing, columns)
        filled = clean.fill(raw, fills)
    else:
        filled = clean.impute(raw, missing, columns)
    out = CleanResult(filled, raw, fills=fills)
    out.reports["missing"] = clean.missing_report(raw, filled, missing)
    if duplicates:
        groups = clean.row_groups(filled)
        out.reports["duplicates"] = clean.copies_report(groups)
        out.table = clean.distinct_rows(groups)
    if outliers:
        base = out.table if duplicates else stage(out.table, "filled")
        names = [c for c in profile.numeric_columns(base) if c != target]
        rules = clean.fit_outliers(base, method, names, sequential=sequential)
        out.reports["outliers"] = rules.report(base)
        out.table = rules.apply(base)
    out.table = clean.validate_types(out.table)
    if scaling:
        out.scaler = scale.fit_scaler(out.table, scaling, [target])
        out.table = out.scaler.transform(out.table)
    return out


# ---- features -------------------------------------------------------------------------------

@dataclass
class FeatureResult:
    table: DataFrame
    plan: features.FeaturePlan
    scores: DataFrame
    report: DataFrame
    components: select.Components | None = None


def feature_job(df: DataFrame, target: str = "price", domain: bool = True,
                interactions: bool = True, polynomial: bool = False, binned: bool = True,
                method: str | None = "k_best", k: int = 15, pca: bool = False,
                pca_components: float | int = 0.95, importance: str = "f_regression",
                exclude_leaky: bool = True, keep: list[str] | None = None) -> FeatureResult:
    """Build, fill, score and select features; ``keep`` columns are passed through."""
    data = df.drop(*(keep or []))
    plan = features.fit_features(data, target, domain, interactions, polynomial, binned,
                                 exclude_leaky=exclude_leaky)
    wide = plan.transform(data)
    # one row per feature: read once, then reused for the selection and the report
    found = select.importance(wide, plan.features, target, importance)
    scores = df.sparkSession.createDataFrame(found.collect(), found.schema)
    known = scores if importance == "f_regression" else None
    if method and k < len(plan.features):
        plan.features = select.select(wide, plan.features, target, method, k, known)
    table, components = plan.transform(df, keep), None
    if pca:
        components = select.fit_components(table, plan.features, pca_components)
        table = components.transform(table, [*(keep or []), target])
    top = [r["feature"] for r in select.top(scores).collect()]
    final = len(components.explained) if components else None
    report = features.feature_report(plan, table, len(data.columns) - 1, method, top, pca, final)
    return FeatureResult(table, plan, scores, report, components)


# ---- training -------------------------------------------------------------------------------

@dataclass
class TrainResult:
    best_name: str
    model: object
    features: list[str]
    metrics: DataFrame
    cross_validation: DataFrame | None
    tuned: DataFrame | None
    test: DataFrame
    report: dict
    fitted: dict = field(default_factory=dict)


def train_one(name: str, position: int, train: DataFrame, val: DataFrame, columns: list[str],
              target: str, **params) -> tuple[object, dict]:
    start = time.monotonic()
    model = models.fit(name, train, columns, target, **params)
    seconds = time.monotonic() - start
    wanted = ["mse", "rmse", "mae", "r2"]
    row = {"model": name, "position": position, "training_time": seconds}
    for part, rows in (("train", train), ("val", val)):
        found = metrics.metrics_row(model.transform(rows), target, metrics=wanted)
        row.update({f"{part}_{m}": found[m] for m in wanted})
    return model, row


METRIC_SCHEMA = "model string, position int, training_time double, " + ", ".join(
    f"{p}_{m} double" for p in ("train", "val") for m in ("mse", "rmse", "mae", "r2"))


def train_job(df: DataFrame, target: str = "price", names: list[str] | None = None,
              cv: bool = True, tuning: bool = True, top: int = 3, test_size: float = 0.2,
              val_size: float = 0.1, cv_folds: int = 5, method: str = "grid_search",
              grids: dict[str, dict] | None = None, seed: int = 42, parallelism: int = 4,
              ) -> TrainResult:
    """Split, cross-validate, fit all models, tune the best ones, test the winner.

    A model that fails is left out with a warning. A model without a grid is refitted as it is.
    """
    names = list(names or models.REGISTRY)
    prepared = split.prepare(df, target)
    columns, _ = features.split_target(prepared, target)
    parts = stage(split.split(prepared, test_size, val_size, seed=seed), "split")
    train, val, test = (parts.filter(F.col("part") == p).drop("part")
                        for p in ("train", "val", "test"))
    folded = tune.cross_validate(train, columns, target, names, cv_folds,
                                 parallelism=parallelism) if cv else None
    fitted, rows = {}, []
    work = [partial(train_one, name, i, train, val, columns, target)
            for i, name in enumerate(names)]
    for name, found in zip(names, together(df.sparkSession, work, parallelism)):
        if isinstance(found, Exception):
            log.warning("training of %s failed: %s", name, found)
        else:
            fitted[name], row = found
            rows.append(row)
    if not rows:
        raise RuntimeError("no model could be trained")
    order = list(rows[0])
    spark = df.sparkSession
    table = spark.createDataFrame([tuple(r[c] for c in order) for r in rows], METRIC_SCHEMA)
    ranked = sorted(rows, key=lambda r: (r["val_rmse"], r["position"]))
    best_name, best_score = ranked[0]["model"], ranked[0]["val_rmse"]
    model, tuned = fitted[best_name], []
    if tuning:
        for row in ranked[:top]:
            name = row["model"]
            try:
                params = {}
                if (grids or {}).get(name) or models.grid(name):
                    params, _, _ = tune.search(train, columns, target, name, method,
                                               grid=(grids or {}).get(name), seed=seed,
                                               parallelism=parallelism)
                better, new = train_one(name, row["position"], train, val, columns, target,
                                        **params)
                tuned.append(new)
                if new["val_rmse"] < best_score:
                    best_name, best_score, model = f"{name}_tuned", new["val_rmse"], better
            except Exception as error:
                log.warning("tuning of %s failed: %s", name, error)
    tested = model.transform(test)
    found = metrics.metrics_row(tested, target, metrics=["mse", "rmse", "mae", "r2"])
    sizes = {r["part"]: r["count"] for r in parts.groupBy("part").count().collect()}
    report = {
        "winner": best_name, "validation_rmse": best_score,
        "test": {m: found[m] for m in ("rmse", "mae", "r2", "mse")},
        "fitted": sorted(fitted), "tuned": [r["model"] for r in tuned], "cross_validated": cv,
        "columns": columns, "rows": {p: sizes.get(p, 0) for p in ("train", "val", "test")},
    }
    tuned_table = spark.createDataFrame([tuple(r[c] for c in order) for r in tuned],
                                        METRIC_SCHEMA) if tuned else None
    return TrainResult(best_name, model, columns, table, folded, tuned_table, test, report, fitted)


# ---- evaluation -----------------------------------------------------------------------------

def evaluate_job(test: DataFrame, model, columns: list[str], target: str = "price",
                 name: str = "Model", with_charts: bool = True, with_curve: bool = True,
                 ) -> dict[str, DataFrame]:
    """Metrics and chart tables of a model on test rows.

    The learning curve fits the model anew for each of ten sizes and five folds of all test rows;
    linear models read the rows once for all of them.
    """
    scored = stage(model.transform(test), "scored")
    out = {"metrics": metrics.evaluate(scored, target).withColumn("model", F.lit(name)),
           "predictions": scored.select(F.col(target).alias("actual"),
                                        F.col("prediction").alias("predicted"))}
    if not with_charts:
        return out
    out |= {
        "actual_vs_predicted": charts.actual_vs_predicted(scored, target),
        "reference_line": charts.reference_line(scored, target),
        "residuals": charts.residuals(scored, target),
        "residual_histogram": charts.residual_histogram(scored, target),
        "normal_curve": charts.normal_curve(scored, target),
        "quantile_pairs": charts.quantile_pairs(scored, target),
        "abs_error_vs_actual": charts.abs_error_vs_actual(scored, target),
        "pct_histogram": charts.pct_histogram(scored, target),
    }
    try:
        out["box_statistics"] = charts.box_statistics(scored, target)
    except ValueError as error:
        log.warning("no error boxes: %s", error)
    try:
        out["feature_importance"] = models.weight_table(test, model, columns)
    except ValueError as error:
        log.warning("no feature importance: %s", error)
    if with_curve:
        try:
            out["learning_curve"] = tune.learning_curve(test, columns, target,
                                                        models.name_of(model), **model.params)
        except ValueError as error:
            log.warning("no learning curve: %s", error)
    return out


def compare_models(fitted: dict, test: DataFrame, target: str) -> DataFrame:
    """One row of metrics for each fitted model on the same rows."""
    parts = [metrics.evaluate(m.transform(test), target).withColumn("model", F.lit(name))
             for name, m in fitted.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return stage(out, "model_scores")


# ---- whole run ------------------------------------------------------------------------------

STAGES = ["preprocessing", "feature_engineering", "model_training", "evaluation", "deployment"]
STATUS_SCHEMA = "run_id string, stage string, position int, status string, error string"


def run_id(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")


def run_summary(status: DataFrame, stages: int = len(STAGES)) -> DataFrame:
    """Stages that succeeded and success rate of each run."""
    good = F.count_if(F.col("status") == "success")
    return status.groupBy("run_id").agg(
        good.alias("successful_stages"),
        F.round(good * F.lit(100.0) / F.lit(stages), 1).alias("success_rate"))


def run(spark: SparkSession, settings: dict | None = None, settings_path: str | None = None,
        ) -> tuple[DataFrame, dict]:
    """Run all stages in order; a stage runs only if the one before it succeeded.

    Returns the status table and the results by stage.
    """
    cfg = load_settings(spark, settings_path, settings)
    ident, results, status = run_id(), {}, []
    target, paths, reports = cfg["data"]["target_column"], cfg["data"], cfg["output"]["reports_dir"]

    def preprocessing():
        p = cfg["preprocessing"]
        scaling = p["scale_method"] if p["scale_at"] == "clean" else None
        done = clean_job(read_table(spark, paths["raw_data_path"]), p["missing_strategy"],
                         p["remove_duplicates"], p["handle_outliers"], p["outlier_method"],
                         scaling, target, p["impute_target"], p["sequential_outliers"])
        write_table(done.table, paths["processed_data_path"])
        for name, table in done.reports.items():
            write_table(table, f"{reports}/{ident}/cleaning_{name}", "parquet")
        quality = profile.before_after(done.raw, read_table(spark, paths["processed_data_path"]))
        write_table(quality, f"{reports}/{ident}/quality", "parquet")
        return {"output_path": paths["processed_data_path"], "fills": done.fills,
                "scaler": done.scaler}

    def feature_engineering():
        f = cfg["feature_engineering"]
        table = read_table(spark, paths["processed_data_path"])
        done = feature_job(table, target, f["create_domain_features"], f["create_interactions"],
                           f["create_polynomial"], f["create_binned"],
                           f["feature_selection_method"], f["k_features"], f["apply_pca"],
                           f["pca_components"], f["importance_method"], f["exclude_leaky"])
        out, late = done.table, None
        if cfg["preprocessing"]["scale_at"] == "after_features":
            late = scale.fit_scaler(out, cfg["preprocessing"]["scale_method"], [target])
            out = late.transform(out)
        write_table(out, paths["engineered_data_path"])
        write_table(done.report, f"{reports}/{ident}/features", "parquet")
        store.write_json(spark, f"{reports}/{ident}/feature_plan", done.plan.to_json())
        return {"output_path": paths["engineered_data_path"], "features": done.plan.features,
                "plan": done.plan, "late_scaler": late}

    def model_training():
        m = cfg["model_training"]
        done = train_job(read_table(spark, paths["engineered_data_path"]), target, m["models"],
                         m["perform_cv"], m["tune_best_models"], m["top_models_to_tune"],
                         m["test_size"], m["val_size"], m["cv_folds"], m["tuning_method"],
                         m.get("grids"), m["seed"])
        path = f"{cfg['output']['models_dir']}/best_model_{ident}"
        store.save_model(spark, done.model, path, done.report)
        write_table(done.metrics, f"{reports}/{ident}/training", "parquet")
        return {"model_path": path, "result": done, "report": done.report}

    def evaluation():
        done = results["model_training"]["result"]
        e = cfg["evaluation"]
        tables = evaluate_job(done.test, done.model, done.features, target, done.best_name,
                              e["save_plots"], e["learning_curve"])
        if e["create_comparison"] or e["generate_report"]:
            scores = compare_models(done.fitted | {done.best_name: done.model}, done.test, target)
        if e["create_comparison"]:
            long = metrics.long_metrics(scores)
            tables |= {"comparison": metrics.compare(long), "heat": metrics.heat(long),
                       "ranks": metrics.rank(long)}
        if e["generate_report"]:
            tables["report"] = metrics.report_rows(scores)
        for name, table in tables.items():
            write_table(table, f"{reports}/{ident}/evaluation_{name}", "parquet")
        return {"tables": sorted(tables)}

    def deployment():
        d, done = cfg["deployment"], results["model_training"]["result"]
        training = read_table(spark, paths["engineered_data_path"])
        if d["save_model_package"]:
            first, second = results["preprocessing"], results["feature_engineering"]
            fills = {k: v for k, v in (first["fills"] or {}).items() if k != target}
            store.save_package(spark, d["deployment_dir"], done.model, done.report, done.features,
                               training, target, plan=second["plan"], fills=fills,
                               scaler=first["scaler"], late_scaler=second["late_scaler"])
        if d["enable_monitoring"]:
            base = store.load_baseline(spark, d["deployment_dir"], training, target)
            write_table(base, f"{d['monitoring_dir']}/baseline_stats", "parquet")
            watch = d["monitoring_dir"]
            row = [(ident, done.best_name, *(float(done.report["test"][m]) for m in ("rmse", "mae", "r2")))]
            store.append_history(
                spark.createDataFrame(row, "run_id string, model string, rmse double, mae double, r2 double")
                .withColumn("ts", F.current_timestamp()), f"{watch}/metrics")
            if d["save_model_package"]:  # the package as it will be used, on the rows this run began with
                served = store.load_package(spark, d["deployment_dir"])
                answers = served.score(read_table(spark, paths["raw_data_path"]).drop(target))
                store.append_history(monitor.prediction_log(answers), f"{watch}/prediction_log")
            for name in ("metrics", "prediction_log"):
                store.trim_history(spark, f"{watch}/{name}", after=PARTS)
            seen = monitor.summary(spark, store.read_history(spark, f"{watch}/alerts"),
                                   store.read_history(spark, f"{watch}/metrics"), base is not None)
            for name, table in seen.items():
                write_table(table, f"{watch}/{name}", "parquet")
        return {"deployment_dir": d["deployment_dir"], "monitoring_dir": d["monitoring_dir"]}

    jobs = [preprocessing, feature_engineering, model_training, evaluation, deployment]
    for i, (name, job) in enumerate(zip(STAGES, jobs)):
        try:
            results[name] = {**job(), "status": "success"}
            status.append((ident, name, i, "success", None))
        except Exception as error:
            log.exception("stage %s failed", name)
            results[name] = {"status": "failed", "error": str(error)}
            status.append((ident, name, i, "failed", str(error)))
            break
    table = spark.createDataFrame(status, STATUS_SCHEMA)
    write_table(table, f"{reports}/status", "parquet", "append", ["run_id"])
    kept = {s: {k: v for k, v in r.items() if k not in ("result", "plan", "fills", "scaler", "late_scaler")}
            for s, r in results.items()}
    store.write_json(spark, f"{reports}/{ident}/results", kept)
    return table, results

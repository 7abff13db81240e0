"""Sources, settings, the chained run and the stream."""

import json

import pytest
from pyspark.sql import functions as F

from tablewright.fixed_values import RAW_COLUMNS, SERVING_COLUMNS
from tablewright.operators import features, models, monitor, profile, serve
from tablewright.plans import jobs
from tablewright.session import stage, staging_root
from tablewright.sources import store, synth
from tablewright.sources.config import load_settings, merge
from tablewright.sources.tables import read_table, write_table
from tablewright.streaming.monitoring import score_stream


@pytest.fixture(scope="module")
def raw(spark):
    return stage(synth.generate(spark, 1500), "raw")


def test_synthetic_table(spark, raw):
    clean = synth.listings(spark, 3000)
    assert clean.columns == RAW_COLUMNS
    row = clean.agg(F.min("age"), F.max("age"), F.min("sqft_lot"), F.max("price"),
                    F.avg("sqft_living"), F.countDistinct("grade")).first()
    assert row[0] == 0 and row[1] <= 100 and row[2] >= 1000 and row[3] <= 2000000
    assert 1900 < row[4] < 2100 and row[5] == 13
    share = profile.totals(raw).first()
    assert 1550 < share["total_rows"] < 1700
    assert 0.12 < share["missing_cells"] / (9 * share["total_rows"]) < 0.16


def test_csv_and_missing_file(spark, raw, tmp_path):
    path = write_table(raw, str(tmp_path / "t.csv"))
    back = read_table(spark, path)
    assert [t for _, t in back.dtypes] == ["double"] * 9
    assert back.exceptAll(raw).count() == 0 and back.count() == raw.count()
    assert read_table(spark, str(tmp_path / "no.csv"), missing="none") is None
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_table(spark, str(tmp_path / "no.csv"))
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    path = write_table(nan, str(tmp_path / "nan"))
    assert read_table(spark, path).filter("x is null").count() == 1


def test_settings(spark, tmp_path, caplog):
    assert merge({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}, "d": 4}) == \
        {"a": {"b": 3, "c": 2}, "d": 4}
    path = tmp_path / "s.json"
    path.write_text(json.dumps({"feature_engineering": {"k_features": 7}}))
    cfg = load_settings(spark, str(path), {"model_training": {"seed": 1}})
    assert cfg["feature_engineering"]["k_features"] == 7
    assert cfg["feature_engineering"]["create_binned"] and cfg["model_training"]["seed"] == 1
    path.write_text("{broken")
    assert load_settings(spark, str(path))["feature_engineering"]["k_features"] == 15
    assert "not used" in caplog.text


def test_stage_uses_the_shared_folder(spark):
    assert staging_root(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_feature_plan_for_serving(raw):
    cleaned = jobs.clean_job(raw).table
    done = jobs.feature_job(cleaned, polynomial=True, k=12)
    assert len(done.plan.features) == 12 and done.table.columns[-1] == "price"
    again = features.FeaturePlan.from_json(done.plan.to_json())
    one = cleaned.limit(3)
    assert again.transform(one).exceptAll(done.plan.transform(one)).count() == 0
    gap = one.withColumn("sqft_living", F.lit(None).cast("double"))
    filled = again.transform(gap)
    assert filled.filter(" or ".join(f"`{c}` is null" for c in again.features)).count() == 0
    assert not [c for c in jobs.feature_job(cleaned, k=60).plan.features if "price" in c]
    unpriced = one.drop("price")
    assert again.transform(unpriced).columns == again.features
    assert again.transform(unpriced).exceptAll(done.table.select(*again.features)).count() == 0
    open_ = jobs.feature_job(cleaned, exclude_leaky=False, k=60).plan
    assert {"price_per_sqft", "price_per_sqft_binned"} <= set(open_.features)
    with pytest.raises(ValueError, match="price_per_sqft"):
        open_.transform(unpriced)
    part = jobs.feature_job(cleaned, method=None, pca=True)
    assert part.table.columns[0] == "PC_1" and part.components.explained[0] > 0.5


def settings(tmp_path, **training):
    return {
        "data": {"raw_data_path": str(tmp_path / "raw.csv"),
                 "processed_data_path": str(tmp_path / "processed"),
                 "engineered_data_path": str(tmp_path / "engineered")},
        "deployment": {"deployment_dir": str(tmp_path / "deploy"),
                       "monitoring_dir": str(tmp_path / "monitor")},
        "output": {"models_dir": str(tmp_path / "models"), "reports_dir": str(tmp_path / "reports")},
        "model_training": {"models": ["linear_regression", "ridge", "lasso", "decision_tree"],
                           "grids": {"decision_tree": {"max_depth": [3]}}, **training},
    }


def test_whole_run(spark, raw, tmp_path):
    write_table(raw, str(tmp_path / "raw.csv"))
    status, results = jobs.run(spark, settings(tmp_path))
    assert [r["status"] for r in status.orderBy("position").collect()] == ["success"] * 5
    assert jobs.run_summary(status).first()["success_rate"] == 100.0
    report = results["model_training"]["report"]
    assert len(report["columns"]) == 15
    assert report["tuned"] and report["test"]["r2"] > 0.4
    package = str(tmp_path / "deploy")
    cfg = store.read_json(spark, f"{package}/deployment_config")
    assert cfg["feature_count"] == 15 and cfg["model_version"] == "1.0"
    assert store.load_baseline(spark, package).count() == 15
    served = store.load_package(spark, package)
    rows = raw.drop("price").withColumn("id", F.monotonically_increasing_id())
    answers = served.score(rows, keep=["id"])
    assert answers.count() == raw.count() and answers.filter("prediction is null").count() == 0
    model = store.load_model(spark, f"{package}/model")
    table = spark.read.parquet(str(tmp_path / "engineered"))
    assert model.transform(table).filter("prediction is null").count() == 0
    ident = status.first()["run_id"]
    made = store.read_json(spark, f"{tmp_path}/reports/{ident}/results")["evaluation"]["tables"]
    assert {"comparison", "heat", "ranks", "report", "learning_curve", "quantile_pairs"} <= set(made)
    watched = spark.read.parquet(str(tmp_path / "monitor" / "summary")).first()
    assert watched["total_alerts"] == 0 and watched["rmse"] == report["test"]["rmse"]
    assert store.read_history(spark, str(tmp_path / "monitor" / "metrics")).count() == 1
    logged = store.read_history(spark, str(tmp_path / "monitor" / "prediction_log")).first()
    assert logged["input_rows"] == logged["prediction_count"] == raw.count()
    advice = spark.read.parquet(str(tmp_path / "monitor" / "recommendations"))
    assert "no_metrics" not in {r["rule"] for r in advice.collect()}


def test_run_stops_at_the_first_failure(spark, tmp_path):
    status, results = jobs.run(spark, settings(tmp_path))
    assert [(r["stage"], r["status"]) for r in status.collect()] == [("preprocessing", "failed")]
    assert "PATH_NOT_FOUND" in results["preprocessing"]["error"]
    assert jobs.run_summary(status).first()["success_rate"] == 0.0


def test_rules_and_serving_features(spark):
    rows = spark.createDataFrame(
        [(2000.0, 1.0, 3.0, 7.0, 3.0, 2.0, 10.0, 7500.0),
         (0.0, 1.0, 6.0, 7.0, -1.0, 2.0, 10.0, None)],
        ", ".join(f"{c} double" for c in SERVING_COLUMNS))
    checked = serve.check_rows(rows)
    assert serve.good_rows(checked).count() == 1
    assert set(serve.bad_rows(checked).first()["violations"]) == \
        {"sqft_living", "condition", "bedrooms", "sqft_lot"}
    made = serve.serving_features(rows).first()
    assert made["quality_score"] == 21 and made["size_category_encoded"] == 1
    assert made["total_sqft_binned"] == 9 and made["sqft_per_bedroom_binned"] == 3
    text = rows.selectExpr("cast(sqft_living as string) sqft_living", "'abc' floors")
    assert serve.check_rows(text).first()["violations"] == ["floors"]


def test_stream_scores_logs_and_alerts(spark, raw, tmp_path):
    names = [c for c in SERVING_COLUMNS]
    training = jobs.clean_job(raw).table
    model = models.fit("ridge", training, names, "price")
    base = monitor.baseline(training.select(*names))
    incoming = training.select(*[(F.col(c) + 9000).alias(c) if c == "sqft_living" else F.col(c)
                                 for c in names])
    source = str(tmp_path / "in")
    incoming.repartition(2).write.parquet(source)
    rows = spark.readStream.schema(incoming.schema).parquet(source)
    query = score_stream(rows, model, names, base, str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination()
    out = str(tmp_path / "out")
    scored = spark.read.parquet(f"{out}/predictions")
    rejected = spark.read.parquet(f"{out}/rejected")
    assert scored.count() + rejected.count() == incoming.count()
    assert store.read_history(spark, f"{out}/prediction_log").count() == 1
    alert = store.read_history(spark, f"{out}/alerts").first()
    assert alert["affected_features"] == "sqft_living"

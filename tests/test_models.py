"""Models against closed forms, optimality conditions and plain sense."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright.operators import linear, metrics, models, select, serve, split, support, tune
from tablewright.sources import store

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(4)
    n = 400
    x = pd.DataFrame({"a": rng.normal(1000, 30, n), "b": rng.normal(size=n),
                      "c": rng.integers(0, 9, n) * 1.0})
    x["y"] = 2 * x.a - 30 * x.b + 5 * x.c + rng.normal(0, 5, n)
    x["id"] = np.arange(n)
    return x


@pytest.fixture(scope="module")
def df(spark, pdf):
    return spark.createDataFrame(pdf).repartition(3).cache()


def centred(pdf):
    x, y = pdf[NAMES].to_numpy(), pdf.y.to_numpy()
    return x - x.mean(axis=0), y - y.mean()


def test_ols_and_ridge(df, pdf):
    x, y = centred(pdf)
    for kind, alpha in (("linear_regression", 0.0), ("ridge", 7.0)):
        model = linear.fit_linear(df, NAMES, "y", kind, alpha=alpha)
        want = np.linalg.solve(x.T @ x + alpha * np.eye(3), x.T @ y)
        np.testing.assert_allclose(model.coefficients, want, rtol=1e-8)
        assert model.intercept == pytest.approx(pdf.y.mean() - want @ pdf[NAMES].mean())


@pytest.mark.parametrize("ratio", [1.0, 0.3])
def test_lasso_and_elastic_net_conditions(df, pdf, ratio):
    """The gradient of the loss must cancel the penalty's subgradient."""
    x, y = centred(pdf)
    kind = "lasso" if ratio == 1 else "elastic_net"
    params = {"alpha": 3.0, **({} if ratio == 1 else {"l1_ratio": ratio})}
    w = np.array(linear.fit_linear(df, NAMES, "y", kind, **params).coefficients)
    slope = x.T @ (y - x @ w) / len(y) - 3.0 * (1 - ratio) * w
    for g, v in zip(slope, w):
        if v:
            assert g == pytest.approx(3.0 * ratio * np.sign(v), rel=1e-6)
        else:
            assert abs(g) <= 3.0 * ratio + 1e-9


def test_constant_and_repeated_columns(df):
    wide = df.withColumn("k", F.lit(4.0)).withColumn("again", F.col("b"))
    plain = linear.fit_linear(df, NAMES, "y")
    model = linear.fit_linear(wide, [*NAMES, "k", "again"], "y")
    assert model.coefficients[3] == 0.0
    assert model.coefficients[1] + model.coefficients[4] == \
        pytest.approx(plain.coefficients[1], rel=1e-6)


def test_folds_equal_direct_fits(df, pdf):
    table = tune.cross_validate(df, NAMES, "y", ["linear_regression", "ridge", "nonsense"], 5,
                                "id").collect()
    found = {r["model"]: r for r in table}
    assert found["nonsense"]["rmse_cv"] is None
    scores = []
    for held in np.array_split(np.arange(len(pdf)), 5):
        train, test = pdf.drop(index=held), pdf.iloc[held]
        x, y = centred(train)
        w = np.linalg.lstsq(x, y, rcond=None)[0]
        e = test.y - train.y.mean() - (test[NAMES] - train[NAMES].mean()) @ w
        scores.append((e ** 2).mean())
    got = found["linear_regression"]
    np.testing.assert_allclose(got["fold_scores"], scores, rtol=1e-8)
    assert got["std_cv_score"] == pytest.approx(np.std(scores))
    assert got["rmse_cv"] == pytest.approx(np.sqrt(np.mean(scores)))


def test_folds_of_other_models_agree_with_linear_path(df):
    data = split.folds(df, 3, "id")
    quick = tune.fold_scores(data, NAMES, "y", "ridge", "fold", 3, alpha=2.0)
    slow = []
    for f in range(3):
        model = models.fit("ridge", data.filter(F.col("fold") != f), NAMES, "y", alpha=2.0)
        slow.append(tune._mse(model, data.filter(F.col("fold") == f), "y"))
    np.testing.assert_allclose(quick, slow, rtol=1e-8)


def test_search(df):
    params, mse, results = tune.search(df, NAMES, "y", "ridge", key="id")
    assert [r[0]["alpha"] for r in results] == [0.1, 1.0, 10.0, 100.0]
    assert mse == min(r[1] for r in results) and params["alpha"] in (0.1, 1.0)
    _, _, some = tune.search(df, NAMES, "y", "elastic_net", "random_search", n_iter=4)
    assert len(some) == 4 and len({str(r[0]) for r in some}) == 4
    plain, _, one = tune.search(df, NAMES, "y", "linear_regression")
    assert plain == {} and len(one) == 1
    with pytest.raises(ValueError):
        tune.search(df, NAMES, "y", "ridge", "guessing")


def test_learning_curve_of_any_model(df):
    quick = tune.learning_curve(df, NAMES, "y", "linear_regression", 3, [0.5, 1.0], "id").collect()
    assert [r["train_size"] for r in quick] == [133, 266]
    assert quick[1]["val_rmse_mean"] < 8
    slow = tune.learning_curve(df, NAMES, "y", "decision_tree", 2, [1.0], "id", max_depth=3)
    assert slow.first()["train_rmse_mean"] < slow.first()["val_rmse_mean"]


FAST = {"decision_tree": {"max_depth": 4}, "random_forest": {"n_estimators": 5, "max_depth": 4},
        "gradient_boosting": {"n_estimators": 5}, "extra_trees": {"n_estimators": 6,
                                                                  "max_depth": 4},
        "svr": {"kernel": "linear", "C": 10.0}, "knn": {"n_neighbors": 3},
        "linear_regression": {}, "lasso": {}, "elastic_net": {}, "ridge": {}}


@pytest.mark.parametrize("name", list(models.REGISTRY))
def test_every_model_beats_the_mean_and_survives_saving(spark, df, tmp_path, name):
    model = models.fit(name, df, NAMES, "y", **FAST[name])
    scored = model.transform(df)
    assert metrics.metrics_row(scored, "y")["r2"] > 0.2
    store.save_model(spark, model, str(tmp_path / "m"), {"note": name})
    again = store.load_model(spark, str(tmp_path / "m")).transform(df)
    both = scored.select("id", F.col("prediction").alias("p")).join(
        again.select("id", "prediction"), "id")
    assert both.agg(F.max(F.abs(F.col("p") - F.col("prediction")))).first()[0] < 1e-6
    assert store.read_json(spark, str(tmp_path / "m" / "info")) == {"note": name}
    if name != "knn":
        table = models.weight_table(df, model, NAMES, 2).collect()
        assert len(table) == 2 and table[0]["importance"] <= table[1]["importance"]


def test_kernel_svr(df):
    small = df.withColumn("y", F.col("b") * F.col("b"))
    model = models.fit("svr", small, ["b"], "y", C=10.0, steps=80)
    assert metrics.metrics_row(model.transform(small), "y")["r2"] > 0.5


def test_forest_selection(df):
    wide = df.withColumn("noise", F.rand(1))
    left = select.select(wide, [*NAMES, "noise"], "y", "rfe", 2, trees=3, depth=4)
    assert set(left) == {"a", "b"}
    top = select.select(wide, [*NAMES, "noise"], "y", "importance_threshold", trees=3, depth=4)
    # the 70th percentile of four scores lies above the third one
    assert top == ["a"]
    with pytest.raises(ValueError):
        select.select(wide, NAMES, "y", "magic")


def test_split_is_exact_and_stable(df):
    parts = split.split(df)
    sizes = {r["part"]: r["count"] for r in parts.groupBy("part").count().collect()}
    assert sizes == {"test": 80, "val": 40, "train": 280}
    again = split.split(df.repartition(7))
    same = parts.join(again.withColumnRenamed("part", "other"), "id").filter("part <> other")
    assert same.count() == 0
    assert split.split_sizes(1197) == (837, 120, 240)


def test_scoring_checks(df, caplog):
    model = models.fit("ridge", df, NAMES, "y")
    extra = df.select("c", "id", "b", "a")
    assert serve.score(extra, model, NAMES).columns == [*NAMES, "prediction"]
    assert "extra_features" in caplog.text
    with pytest.raises(ValueError, match="missing_features"):
        serve.score(df.select("a", "id"), model, NAMES)
    with pytest.raises(ValueError):
        serve.score(df, None, NAMES)
    valid, out, issues = serve.check_schema(df.select("a", F.lit("t").alias("b"), "c"), NAMES)
    assert valid and out.columns == NAMES and issues == [("warning", "not_numeric", "b")]


@pytest.mark.parametrize("kernel", ["linear", "rbf"])
def test_svr_steps_read_rows_dealt_once(df, monkeypatch, kernel):
    """A fit ends, on the written parts: its steps deal no rows again."""
    dealt = []
    real = support.spread
    monkeypatch.setattr(support, "spread", lambda rows: dealt.append(rows) or real(rows))
    model = support.fit_svr(df, NAMES, "y", C=10.0, kernel=kernel, steps=3)
    assert len(dealt) == 1 and np.isfinite(model.weights_).all() and len(model.weights_) == (3 if kernel == "linear" else 64)
    assert model.transform(df).where("prediction is null or isnan(prediction)").count() == 0

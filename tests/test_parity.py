"""Operators against pandas and numpy on small random tables."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright.functions.binning import labelled, numbered, with_histogram_bin
from tablewright.operators import charts, clean, features, metrics, monitor, profile, scale, select


def nullable(spark, pdf):
    df = spark.createDataFrame(pdf)
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if t == "double" else F.col(c)
                       for c, t in df.dtypes])


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(3)
    n = 500
    out = pd.DataFrame({"a": rng.normal(10, 4, n).round(1), "b": rng.integers(0, 5, n) * 1.0,
                        "c": rng.exponential(50, n).round(), "k": np.full(n, 5.0)})
    out.loc[rng.random(n) < 0.1, "a"] = np.nan
    out.loc[rng.random(n) < 0.2, "c"] = np.nan
    out["price"] = 3 * out.b + rng.normal(0, 1, n)
    return pd.concat([out, out.iloc[:60]], ignore_index=True)


@pytest.fixture(scope="module")
def df(spark, pdf):
    return nullable(spark, pdf).cache()


def test_cut_and_edges(spark):
    values = [None, -1.0, 0.0, 0.5, 5.0, 5.1, 15.0, 30.0, 50.0, 100.0, 101.0]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(
        labelled(F.col("v"), [0, 5, 15, 30, 50, 100], list("ABCDE"))).collect()]
    want = pd.cut(pd.Series(values, dtype=float), [0, 5, 15, 30, 50, 100], labels=list("ABCDE"))
    assert got == [None if pd.isna(w) else w for w in want]


def test_equal_width_bins(df, pdf):
    edges = features.fit_bins(df, ["a", "b", "c", "k"])
    assert "k" not in edges
    got = features.add_bins(df, edges).toPandas()
    for c in ("a", "b", "c"):
        want = pd.cut(pdf[c], min(5, pdf[c].nunique()), labels=False)
        np.testing.assert_array_equal(
            np.sort(got[f"{c}_binned"].astype(float)), np.sort(want.astype(float)))


def test_bins_of_few_values(spark):
    rows = [(1.0, float(i % 3)) for i in range(50)] + [(2.0, 2.0)]
    edges = features.fit_bins(spark.createDataFrame(rows, "x double, y double"), ["x", "y"])
    assert len(edges["x"]) == 3 and len(edges["y"]) == 4


def test_histogram(spark):
    rng = np.random.default_rng(0)
    values = np.append(rng.integers(0, 100, 500) / 7, [0.0, 100 / 7])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = charts.histogram(df, F.col("v"), 13).orderBy("bin").toPandas()
    want, edges = np.histogram(values, 13)
    assert got.n.tolist() == want.tolist()
    np.testing.assert_allclose(got.bin_low, edges[:-1])
    one = spark.createDataFrame([(2.0,)] * 3, "v double")
    assert charts.histogram(one, F.col("v"), 4).agg(F.sum("n")).first()[0] == 3


def test_histogram_bin_at_edges(spark):
    low, high = F.lit(0.0), F.lit(0.7)
    rows = spark.createDataFrame([(i * 0.1,) for i in range(8)], "v double")
    got = [r["b"] for r in with_histogram_bin(rows, "v", low, high, 7, "b").collect()]
    edges = np.linspace(0, 0.7, 8)
    want = [int(np.histogram([i * 0.1], edges)[0].argmax()) for i in range(7)] + [6]
    assert got == want


def test_describe_and_missing(df, pdf):
    got = profile.describe(df).toPandas().set_index("column_name")
    want = pdf.describe().T
    for ours, theirs in zip(["n", "mean", "std", "min", "q25", "q50", "q75", "max"],
                            want.columns):
        np.testing.assert_allclose(got.loc[want.index, ours].astype(float), want[theirs])
    assert profile.duplicate_count(df).first()[0] == pdf.duplicated().sum()
    found = {r["column_name"]: r["missing_count"] for r in profile.missing_table(df).collect()}
    assert found == {c: n for c, n in pdf.isna().sum().items() if n}


def test_types(df):
    kinds = {r["column_name"]: r["kind"] for r in profile.column_types(
        df.withColumn("t", F.lit("x")).withColumn("f", F.lit(True))).collect()}
    assert kinds["a"] == "numeric" and kinds["t"] == "categorical" and kinds["f"] == "other"


def test_dedup(df, pdf):
    for keep in ("first", "last", False):
        assert clean.dedup(df, keep).count() == len(pdf.drop_duplicates(keep=keep))
    once = clean.dedup(df)
    assert clean.dedup(once).count() == once.count()
    with pytest.raises(ValueError):
        clean.dedup(df, "middle")


def test_sequential_iqr(df, pdf):
    want = pdf
    for c in ["a", "c"]:
        q1, q3 = want[c].quantile(0.25), want[c].quantile(0.75)
        width = 1.5 * (q3 - q1)
        want = want[~((want[c] < q1 - width) | (want[c] > q3 + width))]
    rules = clean.fit_outliers(df, "iqr", ["a", "c"])
    assert rules.apply(df).count() == len(want)
    removed = rules.report(df).agg(F.sum("rows_removed")).first()[0]
    assert removed == len(pdf) - len(want) > 0


def test_zscore_skips_constant_and_keeps_nulls(df, pdf):
    rules = clean.fit_outliers(df, "zscore", ["a", "k"])
    z = (pdf.a - pdf.a.mean()) / pdf.a.std(ddof=0)
    assert rules.apply(df).count() == (~(z.abs() > 3)).sum()


def test_impute(df, pdf):
    for strategy, want in (("mean", pdf.fillna(pdf.mean())), ("median", pdf.fillna(pdf.median())),
                           ("constant", pdf.fillna(0)), ("mode", pdf.fillna(pdf.mode().iloc[0]))):
        got = clean.impute(df, strategy).toPandas()
        for c in pdf:
            np.testing.assert_allclose(np.sort(got[c]), np.sort(want[c]), rtol=1e-12)
    assert clean.impute(df, "drop_rows").count() == len(pdf.dropna())
    only = clean.impute(df, "mean", ["a"])
    assert only.filter("a is null").count() == 0 and only.filter("c is null").count() > 0
    with pytest.raises(ValueError):
        clean.impute(df, "guess")


def test_scaling(df, pdf):
    base = clean.impute(df, "mean")
    got = scale.scale(base, "standard", ["price"]).agg(
        *[f(c) for c in "abck" for f in (F.avg, F.stddev_pop)]).first()
    np.testing.assert_allclose(got, [0, 1, 0, 1, 0, 1, 0, 0], atol=1e-9)
    low, high = scale.scale(base, "minmax", ["price"]).agg(F.min("a"), F.max("a")).first()
    assert (low, high) == (0.0, 1.0)
    with pytest.raises(ValueError):
        scale.scale(base, "other")
    text = base.select(F.lit("x").alias("t"))
    assert scale.scale(text).columns == ["t"]


def test_f_scores(df, pdf):
    got = {r["feature"]: r["score"] for r in select.f_scores(df, ["a", "b", "c", "k"],
                                                            "price").collect()}
    for c in ("a", "b", "c"):
        both = pdf[[c, "price"]].dropna()
        r2 = both.corr().iloc[0, 1] ** 2
        assert got[c] == pytest.approx(r2 / (1 - r2) * (len(both) - 2), rel=1e-9)
    assert got["k"] == 0.0
    same = select.f_scores(df.withColumn("p", F.col("price") * 2), ["p"], "price").first()
    assert same["score"] > 1e12


def test_k_best_ties(spark):
    scores = spark.createDataFrame([("a", 0, 1.0), ("b", 1, 2.0), ("c", 2, 2.0), ("d", 3, 1.0)],
                                   "feature string, position long, score double")
    assert [r["feature"] for r in select.k_best(scores, 3).collect()] == ["b", "c", "d"]
    assert [r["feature"] for r in select.k_best(scores, 1).collect()] == ["c"]


def test_mutual_info_and_components(df, pdf):
    got = {r["feature"]: r["score"]
           for r in select.mutual_info(df, ["a", "b", "k"], "price").collect()}
    assert got["b"] > got["a"] and got["k"] == pytest.approx(0, abs=1e-12)
    base = clean.impute(df, "mean")
    names = ["a", "b", "c"]
    x = base.select(*names).toPandas().to_numpy()
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    parts = select.fit_components(base, names, 3)
    np.testing.assert_allclose(parts.explained, values / values.sum(), rtol=1e-9)
    z = parts.transform(base).toPandas().to_numpy()
    np.testing.assert_allclose(z.mean(axis=0), 0, atol=1e-8)
    np.testing.assert_allclose(z.var(axis=0, ddof=1), values, rtol=1e-9)
    assert len(select.fit_components(base, names, 0.95).explained) == 1


def test_metrics(spark):
    y = np.array([100.0, 200.0, 0.0, 400.0, 50.0])
    p = np.array([104.0, 150.0, 10.0, 400.0, 61.0])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)] + [(1.0, None)],
                               "label double, prediction double")
    got = metrics.metrics_row(df)
    e = p - y
    assert got["test_size"] == 5
    assert got["mse"] == pytest.approx((e ** 2).mean())
    assert got["r2"] == pytest.approx(1 - (e ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert got["explained_variance"] == pytest.approx(1 - e.var() / y.var())
    assert got["max_error"] == 50 and got["mean_error"] == pytest.approx(e.mean())
    assert got["residual_std"] == pytest.approx(e.std())
    floor = np.maximum(np.abs(y), np.finfo(float).eps)
    assert got["mean_abs_percentage_error"] == pytest.approx((np.abs(e) / floor).mean() * 100)
    assert [got[f"accuracy_within_{t}pct"] for t in (5, 10, 20)] == [40.0, 40.0, 40.0]
    flat = spark.createDataFrame([(2.0, 2.0), (2.0, 2.0)], "label double, prediction double")
    assert metrics.metrics_row(flat)["r2"] == 1.0


def test_quintiles_and_quantile_plot(spark):
    rng = np.random.default_rng(2)
    p, y = rng.integers(0, 60, 400) * 1.0, rng.integers(1, 60, 400) * 1.0
    df = spark.createDataFrame(list(zip(y.tolist(), p.tolist())),
                               "label double, prediction double")
    got = charts.quintiles(df).groupBy("prediction_range").count().collect()
    want = pd.qcut(p, 5, labels=["Very Low", "Low", "Medium", "High", "Very High"]).value_counts()
    assert {r[0]: r[1] for r in got} == want.to_dict()
    points = charts.quantile_pairs(df).orderBy("rank").toPandas()
    np.testing.assert_allclose(points.residual, np.sort(p - y))
    medians = (np.arange(1, 401) - 0.3175) / 400.365
    medians[-1] = 0.5 ** (1 / 400)
    medians[0] = 1 - medians[-1]
    from statistics import NormalDist
    np.testing.assert_allclose(points.theoretical, [NormalDist().inv_cdf(m) for m in medians])


def test_drift_guards(spark):
    base = spark.createDataFrame([(1.0, 5.0, None), (3.0, 5.0, None)],
                                 "a double, k double, e double")
    new = spark.createDataFrame([(50.0, 6.0, 1.0, 2.0)], "a double, k double, e double, x double")
    got = {r["column_name"]: r for r in monitor.drift(monitor.baseline(base), new).collect()}
    assert set(got) == {"a", "k", "e"}
    assert got["a"]["drift_detected"] and got["a"]["spread_ratio"] is None
    assert got["k"]["z_score"] is None and got["k"]["range_violation"]
    assert not got["e"]["drift_detected"]
    alert = monitor.drift_alert(monitor.drift(monitor.baseline(base), new)).first()
    assert alert["affected_features"] == "a,k"
    same = monitor.drift(monitor.baseline(base), base.select("a"))
    assert monitor.drift_alert(same).count() == 0
    assert monitor.critical_value() == pytest.approx(1.959963984540054)


def test_recommendations(spark):
    history = spark.createDataFrame([(1, 10.0), (2, 12.0)], "ts int, rmse double")
    rules = [r["rule"] for r in monitor.recommendations(spark, 11, history, True).collect()]
    assert rules == ["many_alerts", "declining"]
    rules = [r["rule"] for r in monitor.recommendations(spark, 0, None, False).collect()]
    assert rules == ["no_metrics", "no_baseline"]


def test_degradation_of_zero_baseline(spark):
    schema = "metric string, value double"
    got = monitor.degradation(spark.createDataFrame([("rmse", 1.0), ("r2", 0.5)], schema),
                              spark.createDataFrame([("rmse", 0.0), ("r2", 0.4)], schema))
    rows = {r["metric"]: r for r in got.collect()}
    assert rows["rmse"]["degradation_pct"] is None and not rows["rmse"]["degraded"]
    assert rows["r2"]["threshold_exceeded"] and not rows["r2"]["degraded"]


def test_numbered_bins(spark):
    rows = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (2.0,), (None,)], "v double")
    got = [r[0] for r in rows.select(numbered(F.col("v"), [0, 1, 2], True)).collect()]
    assert got == [0, 0, 1, 1, None]
    assert math.isclose(sum(x for x in got if x is not None), 2)

"""Training, cross-validation and tuning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.clean_queries import FEATURES
from catalog.clean_queries import near_sql
from catalog.fixtures import sql
from catalog.registry import query, rounded
from tablewright.operators import linear, metrics, models, split, tune

KEY = "row_key"

ORDERED = ("SELECT *, row_number() OVER (ORDER BY row_key) - 1 AS pos, count(*) OVER () AS n"
           " FROM listings")


@query("m_split", sql(
    "SELECT row_key, price, CASE WHEN pos < test THEN 'test' WHEN pos < test + val THEN 'val' ELSE"
    " 'train' END AS part FROM (SELECT *, CAST(ceil((n - test) * 0.125e0) AS BIGINT) AS val FROM"
    " (SELECT *, CAST(ceil(n * 0.2e0) AS BIGINT) AS test FROM ordered))", "listings",
    extra={"ordered": ORDERED}))
def _(t):
    df = t.listings(key=True).select("row_key", "price")
    return split.split(df, key=KEY)


@query("m_split_hash", sql(
    "SELECT 'test' AS part, CAST(ceil(count(*) * 0.2e0) AS BIGINT) AS n FROM listings UNION ALL"
    " SELECT 'val', CAST(ceil((count(*) - ceil(count(*) * 0.2e0)) * 0.125e0) AS BIGINT) FROM"
    " listings UNION ALL SELECT 'train', CAST(count(*) - ceil(count(*) * 0.2e0) - ceil((count(*)"
    " - ceil(count(*) * 0.2e0)) * 0.125e0) AS BIGINT) FROM listings", "listings"))
def _(t):
    """Sizes of the pseudo-random split."""
    return split.split(t.listings()).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


def line_sql(kind: str, slope: str) -> str:
    return sql(f"SELECT '{kind}' AS model, round(s, 6) AS slope, round(my - s * mx, 4) AS intercept"
               f" FROM (SELECT {slope} AS s, mx, my FROM (SELECT covar_pop(price, sqft_living) AS"
               " sxy, var_pop(sqft_living) AS sxx, count(*) AS n, avg(sqft_living) AS mx,"
               " avg(price) AS my FROM listings))", "listings")


def line(t, kind: str, **params):
    model = linear.fit_linear(t.listings(), ["sqft_living"], "price", kind, **params)
    return rounded(t.spark.createDataFrame(
        [(kind, model.coefficients[0], model.intercept)],
        "model string, slope double, intercept double"), {"slope": 6, "intercept": 4})


@query("m_ols1", line_sql("linear_regression", "sxy / sxx"))
def _(t):
    return line(t, "linear_regression")


@query("m_ridge1", line_sql("ridge", "sxy * n / (sxx * n + 1000000)"))
def _(t):
    return line(t, "ridge", alpha=1e6)


@query("m_lasso1", line_sql("lasso", "sign(sxy) * greatest(abs(sxy) - 10000, 0) / sxx"))
def _(t):
    return line(t, "lasso", alpha=1e4)


@query("m_enet1", line_sql(
    "elastic_net", "sign(sxy) * greatest(abs(sxy) - 5000, 0) / (sxx + 5000)"))
def _(t):
    return line(t, "elastic_net", alpha=1e4, l1_ratio=0.5)


FOLDED = {"ordered": ORDERED,
          "folded": "SELECT *, CASE WHEN pos < (n % {k}) * (n // {k} + 1) THEN pos // (n // {k} + 1)"
                    " ELSE (pos - (n % {k})) // (n // {k}) END AS fold FROM ordered"}


def folded_sql(k: int) -> dict[str, str]:
    return {name: q.replace("{k}", str(k)) for name, q in FOLDED.items()}


FOLD_MSE = ("SELECT f.fold, avg(power(price - i - s * sqft_living, 2)) AS mse FROM folded AS f"
            " JOIN fits USING (fold) GROUP BY f.fold")
FITS = ("SELECT g.fold, regr_slope(price, sqft_living) AS s, regr_intercept(price, sqft_living) AS"
        " i FROM folded AS f JOIN (SELECT DISTINCT fold FROM folded) AS g ON f.fold <> g.fold"
        " GROUP BY g.fold")


@query("m_cv_ols1", sql(
    "SELECT 'linear_regression' AS model, round(avg(mse), 0) AS mean_cv_score,"
    " round(stddev_pop(mse), 0) AS std_cv_score, round(sqrt(avg(mse)), 4) AS rmse_cv FROM"
    f" ({FOLD_MSE})", "listings", extra={**folded_sql(5), "fits": FITS}))
def _(t):
    df = t.listings(key=True).select("row_key", "sqft_living", "price")
    found = tune.cross_validate(df, ["sqft_living"], "price", ["linear_regression"], 5, KEY)
    return rounded(found.drop("fold_scores"),
                   {"mean_cv_score": 0, "std_cv_score": 0, "rmse_cv": 4})


ALPHAS = [0.1, 1.0, 10.0, 100.0]


@query("m_grid", sql(
    "SELECT 'ridge' AS model, position, 'alpha=' || a AS params, round(sqrt(avg(mse)), 4) AS"
    " rmse_cv FROM (SELECT position, a, f.fold, avg(power(price - my - s * (sqft_living - mx), 2))"
    " AS mse FROM folded AS f JOIN (SELECT g.fold, position, a, avg(sqft_living) AS mx, avg(price)"
    " AS my, covar_pop(price, sqft_living) * count(*) / (var_pop(sqft_living) * count(*) + alpha)"
    " AS s FROM folded AS f JOIN (SELECT DISTINCT fold FROM folded) AS g ON f.fold <> g.fold,"
    " (VALUES " + ", ".join(f"(CAST({i} AS BIGINT), {a}e0, '{a}')" for i, a in enumerate(ALPHAS))
    + ") AS v(position, alpha, a) GROUP BY g.fold, position, a, alpha) USING (fold) GROUP BY"
      " position, a, f.fold) GROUP BY position, a", "listings", extra=folded_sql(3)))
def _(t):
    df = t.listings(key=True).select("row_key", "sqft_living", "price")
    _, _, results = tune.search(df, ["sqft_living"], "price", "ridge", "grid_search", 3, key=KEY)
    return rounded(tune.search_table(df, "ridge", results).drop("mean_cv_score"), 4)


@query("m_random")
def _(t):
    """Twenty settings drawn from the elastic net grid, on all features."""
    df = t.listings(key=True)
    _, _, results = tune.search(df, FEATURES, "price", "elastic_net", "random_search", 3, 20,
                                key=KEY)
    return tune.search_table(df, "elastic_net", results)


def scored(t, name: str, **params):
    """Fit on the training part of the split and report the errors on the test part."""
    parts = split.split(t.listings(key=True), key=KEY)
    model = models.fit(name, parts.filter("part = 'train'"), FEATURES, "price", **params)
    return metrics.evaluate(model.transform(parts.filter("part = 'test'")), "price") \
        .withColumn("model", F.lit(name))


MODEL_RUNS = {
    "m_ols": ("linear_regression", {}), "m_ridge": ("ridge", {"alpha": 10.0}),
    "m_lasso": ("lasso", {"alpha": 1.0}), "m_enet": ("elastic_net", {"alpha": 0.01}),
    "m_tree": ("decision_tree", {}),
    "m_rf": ("random_forest", {}),
    "m_gbt": ("gradient_boosting", {}),
    "m_xt": ("extra_trees", {}),
    "m_svr": ("svr", {"C": 1.0, "kernel": "linear"}),
    "m_svr_rbf": ("svr", {"C": 1.0}),
    "m_knn": ("knn", {}),
    "m_knn_distance": ("knn", {"weights": "distance"}),
}


def _register(name: str, kind: str, params: dict) -> None:
    query(name)(lambda t: scored(t, kind, **params))


for _name, (_kind, _params) in MODEL_RUNS.items():
    _register(_name, _kind, _params)


@query("m_knn_part", sql(
    "SELECT p_partkey, round(avg(price), 6) AS prediction FROM (SELECT q.p_partkey, d.price, row_number() OVER (PARTITION BY q.p_partkey"
    f" ORDER BY {near_sql('q', 'd', ['size', 'spot'], 2)}, d.price) AS place FROM rows AS q JOIN rows AS d ON q.p_partkey % 4 = 0 AND"
    " d.p_partkey % 4 > 0) WHERE place <= 5 GROUP BY p_partkey",
    extra={"rows": "SELECT p_partkey, CAST(p_size AS DOUBLE) AS size, CAST(p_partkey % 101 AS DOUBLE) AS spot, p_retailprice AS price FROM part"}))
def _(t):
    rows = t.read("part").selectExpr("p_partkey", "CAST(p_size AS DOUBLE) AS size", "CAST(p_partkey % 101 AS DOUBLE) AS spot", "p_retailprice AS price")
    model = models.fit("knn", rows.where("p_partkey % 4 > 0"), ["size", "spot"], "price")
    return rounded(model.transform(rows.where("p_partkey % 4 = 0")).select("p_partkey", "prediction"))


# ---- choice among models ----------------------------------------------------------------------

MODEL_TABLE = {"models": "SELECT model, CAST(CASE model WHEN 'sqft_living' THEN 0 WHEN 'grade'"
                         " THEN 1 ELSE 2 END AS INTEGER) AS position, sqrt(avg(power(prediction -"
                         " label, 2))) AS rmse, 1 - avg(power(prediction - label, 2)) /"
                         " var_pop(label) AS r2 FROM scored GROUP BY model"}


def model_table(t):
    order = F.when(F.col("model") == "sqft_living", 0).when(F.col("model") == "grade", 1) \
        .otherwise(2)
    return metrics.evaluate(t.scored_models(), by=["model"], metrics=["rmse", "r2"]) \
        .drop("rows", "test_size").withColumn("position", order.cast("int"))


@query("m_best", sql("SELECT model, position, round(rmse, 4) AS rmse, round(r2, 6) AS r2 FROM"
                     " models ORDER BY models.rmse, position LIMIT 1", "scored",
                     extra=MODEL_TABLE))
def _(t):
    return rounded(metrics.best(model_table(t)), {"rmse": 4, "r2": 6})


@query("m_best_r2", sql("SELECT model, position, round(rmse, 4) AS rmse, round(r2, 6) AS r2 FROM"
                        " models ORDER BY models.r2 DESC, position LIMIT 1", "scored",
                        extra=MODEL_TABLE))
def _(t):
    return rounded(metrics.best(model_table(t), "r2"), {"rmse": 4, "r2": 6})


@query("m_topk", sql("SELECT model, position, round(rmse, 4) AS rmse, round(r2, 6) AS r2 FROM"
                     " models ORDER BY models.rmse, position LIMIT 2", "scored",
                     extra=MODEL_TABLE))
def _(t):
    return rounded(metrics.top_models(model_table(t), 2), {"rmse": 4, "r2": 6})


@query("m_tuned_choice", sql(
    "SELECT model, position, is_tuned, CASE WHEN is_tuned THEN model || '_tuned' ELSE model END AS"
    " final_name, round(rmse, 4) AS rmse FROM (SELECT model, position, rmse, false AS is_tuned FROM"
    " models UNION ALL SELECT model, position, rmse * CASE WHEN model = 'grade' THEN 0.5e0 ELSE 1"
    " END, true FROM models) AS u ORDER BY u.rmse, is_tuned, position LIMIT 1", "scored",
    extra=MODEL_TABLE))
def _(t):
    table = model_table(t)
    better = F.when(F.col("model") == "grade", F.col("rmse") * 0.5).otherwise(F.col("rmse"))
    return rounded(metrics.tuned_choice(table, table.withColumn("rmse", better)), 4)


@query("e_importance")
def _(t):
    model = models.fit("ridge", t.listings(), FEATURES, "price")
    return models.weight_table(t.listings(), model, FEATURES)


@query("e_importance_forest")
def _(t):
    df = t.listings()
    model = models.fit("random_forest", df, FEATURES, "price", n_estimators=5, max_depth=5)
    return models.weight_table(df, model, FEATURES)


def curve_sql(k: int = 5) -> str:
    """Train and validation RMSE of a one-feature line for ten prefix sizes and k folds."""
    sizes = ("SELECT CAST(floor(i / 10.0e0 * (max(n) - (max(n) // {k} + CASE WHEN max(n) % {k} > 0"
             " THEN 1 ELSE 0 END))) AS BIGINT) AS take FROM ordered, range(1, 11) AS r(i)"
             " GROUP BY i").replace("{k}", str(k))
    extra = {**folded_sql(k), "sizes": sizes,
             "placed": "SELECT g.fold AS held, f.sqft_living, f.price, row_number() OVER"
                       " (PARTITION BY g.fold ORDER BY pos) AS place FROM folded AS f JOIN (SELECT"
                       " DISTINCT fold FROM folded) AS g ON f.fold <> g.fold",
             "lines": "SELECT held, take, regr_slope(price, sqft_living) AS s,"
                      " regr_intercept(price, sqft_living) AS i FROM placed JOIN sizes ON place <="
                      " take GROUP BY held, take",
             "fitted": "SELECT held, take, sqrt(avg(power(price - i - s * sqft_living, 2))) AS e"
                       " FROM placed JOIN lines USING (held) WHERE place <= take GROUP BY held,"
                       " take",
             "tested": "SELECT held, take, sqrt(avg(power(price - i - s * sqft_living, 2))) AS e"
                       " FROM folded JOIN lines ON fold = held GROUP BY held, take"}
    return sql("SELECT take AS train_size, round(avg(a.e), 3) AS train_rmse_mean,"
               " round(stddev_pop(a.e), 3) AS train_rmse_std, round(avg(b.e), 3) AS val_rmse_mean,"
               " round(stddev_pop(b.e), 3) AS val_rmse_std FROM fitted AS a JOIN tested AS b USING"
               " (held, take) GROUP BY take", "listings", extra=extra)


@query("e_learning", curve_sql())
def _(t):
    df = t.listings(key=True).select("row_key", "sqft_living", "price")
    return rounded(tune.learning_curve(df, ["sqft_living"], "price", "linear_regression",
                                       key=KEY), 3)

"""Metric, chart and model comparison queries on whole-number one-feature predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fixtures import sql
from catalog.registry import query, rounded
from tablewright.fixed_values import QUINTILE_LABELS
from tablewright.functions.normal import normal_quantile
from tablewright.operators import charts, metrics, split

E = "(prediction - label)"
PCT = "(abs((prediction - label) / NULLIF(label, 0)) * 100)"
METRIC_SQL = {
    "mse": f"avg({E} * {E})", "rmse": f"sqrt(avg({E} * {E}))", "mae": f"avg(abs({E}))",
    "r2": f"1 - avg({E} * {E}) / var_pop(label)",
    "explained_variance": f"1 - var_pop({E}) / var_pop(label)",
    "max_error": f"max(abs({E}))", "mean_error": f"avg({E})",
    "mean_abs_percentage_error":
        f"avg(abs({E}) / greatest(abs(label), 2.220446049250313e-16)) * 100",
    "residual_std": f"stddev_pop({E})", "mean_residual": f"avg({E})",
    **{f"accuracy_within_{p}pct": f"avg(CASE WHEN {PCT} <= {p} THEN 1.0e0 ELSE 0.0e0 END) * 100"
       for p in (5, 10, 20)},
}
DIGITS = {**dict.fromkeys(METRIC_SQL, 4), "mse": 0, "r2": 8, "explained_variance": 8}


def metric_list(names: list[str] | None = None) -> str:
    return ", ".join(f"round({METRIC_SQL[m]}, {DIGITS[m]}) AS {m}" for m in names or METRIC_SQL)


def metric_query(name: str, names: list[str]) -> None:
    @query(name, sql(f"SELECT count(*) AS rows, count(*) AS test_size, {metric_list(names)} FROM predictions",
                     "predictions"))
    def _(t):
        return rounded(metrics.evaluate(t.predictions(), metrics=names), DIGITS)


metric_query("e_metrics", ["mse", "rmse", "mae", "r2"])
metric_query("e_expl_var", ["explained_variance"])
metric_query("e_maxerr", ["max_error"])
metric_query("e_mean_error", ["mean_error", "mean_residual", "residual_std"])
metric_query("e_mape", ["mean_abs_percentage_error"])
metric_query("e_within", [f"accuracy_within_{p}pct" for p in (5, 10, 20)])


@query("e_all_by_model", sql(f"SELECT model, count(*) AS rows, count(*) AS test_size, {metric_list()} FROM scored"
                             " GROUP BY model", "scored"))
def _(t):
    return rounded(metrics.evaluate(t.scored_models(), by=["model"]), DIGITS)


@query("e_actual_predicted", sql("SELECT label AS actual, prediction AS predicted FROM predictions",
                                 "predictions"))
def _(t):
    return charts.actual_vs_predicted(t.predictions())


@query("e_reference_line", sql(
    "SELECT least(min(label), min(prediction)) AS line_min, greatest(max(label), max(prediction))"
    f" AS line_max, round({METRIC_SQL['r2']}, 8) AS r2 FROM predictions", "predictions"))
def _(t):
    return rounded(charts.reference_line(t.predictions()), 8)


@query("e_residuals", sql(f"SELECT prediction AS predicted, {E} AS residual FROM predictions",
                          "predictions"))
def _(t):
    return charts.residuals(t.predictions())


@query("e_abs_error", sql(f"SELECT label AS actual, abs{E} AS abs_error FROM predictions",
                          "predictions"))
def _(t):
    return charts.abs_error_vs_actual(t.predictions())


def binned(value: str, bins: int) -> dict[str, str]:
    """CTEs ``vals``, ``ends`` and ``hits`` of an equal-width histogram."""
    guess = f"least(floor((v - lo) / (hi - lo) * {bins}), {bins - 1})"
    step = f"((hi - lo) / {bins})"
    return {
        "vals": f"SELECT {value} AS v FROM predictions",
        "ends": "SELECT min(v) AS lo, max(v) AS hi FROM vals",
        "hits": f"SELECT {guess} - CASE WHEN v < {guess} * {step} + lo THEN 1 ELSE 0 END + CASE"
                f" WHEN {guess} < {bins - 1} AND v >= ({guess} + 1) * {step} + lo THEN 1 ELSE 0 END"
                " AS b FROM vals, ends WHERE v IS NOT NULL",
    }


def bars(bins: int, more: str = "") -> str:
    step = f"((hi - lo) / {bins})"
    return (f"SELECT CAST(i AS BIGINT) AS bin, round(i * {step} + lo, 4) AS bin_low, round(CASE"
            f" WHEN i = {bins - 1} THEN hi ELSE (i + 1) * {step} + lo END, 4) AS bin_high,"
            f" coalesce(n, 0) AS n{more} FROM range({bins}) AS r(i) CROSS JOIN ends LEFT JOIN"
            " (SELECT b, count(*) AS n FROM hits GROUP BY b) AS h ON h.b = i")


@query("e_resid_hist", sql(bars(50), "predictions", extra=binned(E, 50)))
def _(t):
    return rounded(charts.residual_histogram(t.scored()), 4)


@query("e_pct_hist", sql(bars(30, ", round((SELECT quantile_cont(v, 0.5) FROM vals), 6) AS median"),
                         "predictions", extra=binned(PCT, 30)))
def _(t):
    return rounded(charts.pct_histogram(t.scored()), {"bin_low": 4, "bin_high": 4})


@query("e_normal_curve", sql(
    "SELECT CAST(i AS BIGINT) AS point, round(CASE WHEN i = 99 THEN hi ELSE i * ((hi - lo) / 99) +"
    " lo END, 3) AS x, round(exp(-0.5e0 * power((CASE WHEN i = 99 THEN hi ELSE i * ((hi - lo) / 99)"
    " + lo END - mu) / sigma, 2)) * n * (hi - lo) / 50 / (sqrt(2 * pi()) * sigma), 4) AS y FROM"
    f" range(100) AS r(i), (SELECT count(*) AS n, avg({E}) AS mu, stddev_pop({E}) AS sigma,"
    f" min({E}) AS lo, max({E}) AS hi FROM predictions)", "predictions"))
def _(t):
    return rounded(charts.normal_curve(t.scored()), {"x": 3, "y": 4})


RANKED = {"ranked": f"SELECT v, row_number() OVER (ORDER BY v) AS rank, count(*) OVER () AS n FROM"
                    f" (SELECT {E} AS v FROM predictions)",
          "medians": "SELECT *, CASE WHEN rank = n THEN power(0.5e0, 1e0 / n) WHEN rank = 1 THEN"
                     " 1e0 - power(0.5e0, 1e0 / n) ELSE (rank - 0.3175e0) / (n + 0.365e0) END AS p"
                     " FROM ranked"}


@query("e_qq", sql("SELECT rank, v AS residual FROM ranked", "predictions", extra=RANKED))
def _(t):
    return rounded(charts.quantile_pairs(t.scored()).select("rank", "residual"), 4)


@query("e_qq_points", sql(
    f"SELECT rank, round({normal_quantile('p')}, 6) AS theoretical, v AS residual FROM medians",
    "predictions", extra=RANKED))
def _(t):
    """With the theoretical normal order medians."""
    return rounded(charts.quantile_pairs(t.scored()), {"theoretical": 6, "residual": 4})


EDGES = ("SELECT " + ", ".join(f"quantile_cont(prediction, {i / 5}) AS e{i}" for i in range(6))
         + " FROM predictions")
RANGE = "CASE " + " ".join(f"WHEN prediction <= e{i + 1} THEN '{x}'"
                           for i, x in enumerate(QUINTILE_LABELS)) + " END"
FIFTHS = {"edges": EDGES,
          "fifths": f"SELECT label AS actual, prediction AS predicted, {E} AS residual, abs{E} AS"
                    f" abs_error, {PCT} AS pct_error, {RANGE} AS prediction_range FROM"
                    " predictions, edges"}


@query("e_quintiles", sql(
    "SELECT actual, predicted, residual, abs_error, round(pct_error, 6) AS pct_error,"
    " prediction_range FROM fifths", "predictions", extra=FIFTHS))
def _(t):
    return rounded(charts.quintiles(t.scored()))


def box_sql(measure: str) -> str:
    return (f"SELECT '{measure}' AS measure, f.prediction_range, count(*) AS n, round(min({measure})"
            f" FILTER ({measure} >= q25 - 1.5e0 * (q75 - q25)), 4) AS whisker_low,"
            f" round(q25, 4) AS q25, round(q50, 4) AS median, round(q75, 4) AS q75,"
            f" round(max({measure}) FILTER ({measure} <= q75 + 1.5e0 * (q75 - q25)), 4) AS"
            f" whisker_high, count(*) FILTER ({measure} < q25 - 1.5e0 * (q75 - q25) OR {measure} >"
            f" q75 + 1.5e0 * (q75 - q25)) AS outliers FROM fifths AS f JOIN (SELECT"
            f" prediction_range, quantile_cont({measure}, 0.25) AS q25, quantile_cont({measure},"
            f" 0.5) AS q50, quantile_cont({measure}, 0.75) AS q75 FROM fifths GROUP BY"
            " prediction_range) AS q ON f.prediction_range = q.prediction_range GROUP BY"
            " f.prediction_range, q25, q50, q75")


@query("e_box", sql(f"{box_sql('abs_error')} UNION ALL {box_sql('pct_error')}", "predictions",
                    extra=FIFTHS))
def _(t):
    return rounded(charts.box_statistics(t.scored()), 4)


LONG = {"wide": "SELECT model, " + ", ".join(f"{q} AS {m}" for m, q in METRIC_SQL.items())
                + " FROM scored GROUP BY model",
        "long": " UNION ALL ".join(f"SELECT model, '{m}' AS metric, {m} AS value FROM wide"
                                   for m in METRIC_SQL)}


def long(t):
    return metrics.long_metrics(metrics.evaluate(t.scored_models(), by=["model"]))


@query("e_compare", sql("SELECT model, " + ", ".join(
    f"round(max(value) FILTER (metric = '{m}'), {DIGITS[m]}) AS {m}" for m in METRIC_SQL)
    + " FROM long GROUP BY model", "scored", extra=LONG))
def _(t):
    return rounded(metrics.compare(long(t)), DIGITS)


@query("e_heat", sql(
    "SELECT model, metric, round(value, 4) AS value, round(CASE WHEN metric NOT IN ("
    + ", ".join(f"'{m}'" for m in metrics.HEAT_UNSCALED)
    + ") AND max(value) OVER (PARTITION BY metric) > 0 THEN value / max(value) OVER (PARTITION BY"
      " metric) ELSE value END, 6) AS normalised FROM long WHERE metric IN ("
    + ", ".join(f"'{m}'" for m in metrics.HEAT_METRICS) + ")", "scored", extra=LONG))
def _(t):
    return rounded(metrics.heat(long(t)), {"value": 4})


@query("e_rank", sql(
    "SELECT model, metric, round(value, 4) AS value, row_number() OVER (PARTITION BY metric ORDER"
    " BY CASE WHEN metric = 'rmse' THEN value ELSE -value END, model) AS rank FROM long WHERE"
    " metric IN ('rmse', 'r2')", "scored", extra=LONG))
def _(t):
    return rounded(metrics.rank(long(t)), 4)


@query("e_report", sql(
    "SELECT model, count(*) AS test_size, round(" + METRIC_SQL["rmse"] + ", 2) AS rmse, round("
    + METRIC_SQL["mae"] + ", 2) AS mae, round(" + METRIC_SQL["r2"] + ", 3) AS r2, round("
    + METRIC_SQL["mean_abs_percentage_error"] + ", 2) AS mape, round("
    + METRIC_SQL["accuracy_within_10pct"] + ", 1) AS within_10pct FROM scored GROUP BY model",
    "scored"))
def _(t):
    return metrics.report_rows(metrics.evaluate(t.scored_models(), by=["model"]))


@query("e_holdout", sql(
    "SELECT row_key, label, prediction FROM (SELECT *, row_number() OVER (ORDER BY row_key) AS pos,"
    " count(*) OVER () AS n FROM predictions) WHERE pos > floor(n * 0.8e0)", "predictions"))
def _(t):
    return split.holdout(t.scored(), 0.8, "row_key")


@query("e_sample", sql(
    "SELECT row_key, label, prediction FROM predictions ORDER BY (row_key % 2147483647) * 48271 %"
    " 2147483647, row_key LIMIT 500", "predictions"))
def _(t):
    """500 rows in the order of a portable hash of the row key."""
    scattered = F.expr("(row_key % 2147483647) * 48271 % 2147483647")
    return charts.sample_rows(t.scored(), 500, scattered)

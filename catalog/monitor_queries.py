"""Input checks, scoring, drift and monitoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.clean_queries import FEATURES
from catalog.evaluation_queries import METRIC_SQL
from catalog.fixtures import COLUMN_LIST, sql
from catalog.profile_queries import MISSING, per_column
from catalog.registry import query, rounded
from tablewright.operators import linear, metrics, models, monitor, serve
from tablewright.operators.monitor import critical_value

SHIFTED = ", ".join({"sqft_living": "sqft_living + 4000 AS sqft_living",
                     "grade": "grade * 3 AS grade"}.get(c, c) for c in COLUMN_LIST.split(", "))
NOW = {"current": f"SELECT {SHIFTED} FROM dirty"}


def current(t):
    """A later batch: with gaps and copies, larger living areas and stretched grades."""
    return t.dirty().selectExpr(*SHIFTED.split(", "))


@query("v_nulls", sql(f"SELECT * FROM ({MISSING.replace('FROM dirty', 'FROM current')}) WHERE"
                      " missing_count > 0", "dirty", extra=NOW))
def _(t):
    return serve.null_report(current(t))


BASE = {"base": per_column(
    "SELECT '{c}' AS column_name, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min,"
    " max({c}) AS max, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50,"
    " quantile_cont({c}, 0.75) AS q75 FROM listings", FEATURES)}
CURRENT = {**NOW, **BASE, "now": per_column(
    "SELECT '{c}' AS column_name, count({c}) AS n, avg({c}) AS mean, stddev_samp({c}) AS std,"
    " min({c}) AS min, max({c}) AS max, count(*) FILTER ({c} < (SELECT min FROM base WHERE"
    " column_name = '{c}')) AS below_min, count(*) FILTER ({c} > (SELECT max FROM base WHERE"
    " column_name = '{c}')) AS above_max FROM current", FEATURES)}
CRITICAL = f"{critical_value()!r}"
DRIFT = {**CURRENT, "tests": f"""SELECT n.*, b.mean AS base_mean, b.std AS base_std,
    b.min AS base_min, b.max AS base_max,
    CASE WHEN b.std > 0 THEN abs(n.mean - b.mean) / b.std END AS z_score,
    CAST({CRITICAL} AS DOUBLE) AS critical_value,
    CASE WHEN b.std > 0 AND n.std > 0 THEN n.std / b.std END AS spread_ratio,
    (below_min + above_max) / CAST(n.n AS DOUBLE) AS violation_rate
    FROM now AS n JOIN base AS b USING (column_name)""",
    "verdicts": f"""SELECT *, coalesce(z_score > {CRITICAL}, false) AS mean_shift,
    coalesce(spread_ratio > 2 OR spread_ratio < 0.5, false) AS spread_change,
    violation_rate > 0.1 AS range_violation FROM tests"""}
ROUND = ["mean", "std", "min", "max", "base_mean", "base_std", "base_min", "base_max", "z_score",
         "critical_value", "spread_ratio", "violation_rate"]


def drift(t):
    return monitor.drift(monitor.baseline(t.listings()), current(t))


@query("v_baseline", sql("SELECT column_name, " + ", ".join(
    f"round({f}, 5) AS {f}" for f in monitor.BASELINE_FIELDS) + " FROM base", "listings",
    extra=BASE))
def _(t):
    return rounded(monitor.baseline(t.listings()), 5)


@query("v_current", sql("SELECT column_name, n, round(mean, 5) AS mean, round(std, 5) AS std, min,"
                        " max FROM now", "dirty", "listings", extra=CURRENT))
def _(t):
    return rounded(monitor.current(current(t), FEATURES), 5)


def drift_part(name: str, columns: list[str]) -> None:
    cells = ", ".join(f"round({c}, 6) AS {c}" if c in ROUND else c for c in columns)

    @query(name, sql(f"SELECT column_name, {cells} FROM verdicts", "dirty", "listings",
                     extra=DRIFT))
    def _(t):
        return rounded(drift(t).select("column_name", *columns))


drift_part("v_mean_shift", ["z_score", "critical_value", "mean_shift"])
drift_part("v_spread", ["spread_ratio", "spread_change"])
drift_part("v_range", ["below_min", "above_max", "violation_rate", "range_violation"])


@query("v_verdict", sql(
    "SELECT column_name, n, below_min, above_max, mean_shift, spread_change, range_violation,"
    " mean_shift OR spread_change OR range_violation AS drift_detected, "
    + ", ".join(f"round({c}, 5) AS {c}" for c in ROUND) + " FROM verdicts", "dirty", "listings",
    extra=DRIFT))
def _(t):
    return rounded(drift(t), 5)


@query("v_alert", sql(
    "SELECT 'drift' AS alert_type, string_agg(column_name, ',' ORDER BY column_name) AS"
    " affected_features, count(*) AS affected_count FROM verdicts WHERE mean_shift OR"
    " spread_change OR range_violation HAVING count(*) > 0", "dirty", "listings", extra=DRIFT))
def _(t):
    return monitor.drift_alert(drift(t)).drop("ts")


@query("v_predlog", sql(
    "SELECT count(*) AS input_rows, CAST(2 AS BIGINT) AS input_columns, count(prediction) AS"
    " prediction_count, round(avg(prediction), 4) AS mean, round(stddev_pop(prediction), 4) AS std,"
    " min(prediction) AS min, max(prediction) AS max FROM predictions", "predictions"))
def _(t):
    return rounded(monitor.prediction_log(t.predictions()).drop("ts"), 4)


@query("v_last1000", "SELECT event_id, ts, value FROM events ORDER BY ts DESC, event_id DESC LIMIT"
                     " 1000")
def _(t):
    """The last 1000 entries of a log."""
    return monitor.latest(t.read("events").select("event_id", "ts", "value"),
                          [F.desc("ts"), F.desc("event_id")])


@query("v_perf", sql(
    "SELECT 'line' AS model_name, count(*) AS sample_size, round(" + METRIC_SQL["rmse"]
    + ", 4) AS rmse, round(" + METRIC_SQL["mae"] + ", 4) AS mae, round(" + METRIC_SQL["r2"]
    + ", 8) AS r2, round(avg(prediction), 4) AS mean_prediction, round(avg(label), 4) AS"
      " mean_actual FROM predictions", "predictions"))
def _(t):
    return rounded(monitor.performance(t.predictions(), "line").drop("ts"),
                   {"rmse": 4, "mae": 4, "r2": 8, "mean_prediction": 4, "mean_actual": 4})


PAIR = {"pair": "SELECT model, metric, value FROM (SELECT model, " + METRIC_SQL["rmse"]
                + " AS rmse, " + METRIC_SQL["mae"] + " AS mae, " + METRIC_SQL["r2"]
                + " AS r2 FROM scored GROUP BY model) UNPIVOT (value FOR metric IN (rmse, mae, r2))",
        "loss": "SELECT a.metric, a.value AS current_value, b.value AS baseline_value, CASE WHEN"
                " a.metric = 'r2' THEN b.value - a.value ELSE a.value - b.value END /"
                " NULLIF(b.value, 0) AS change FROM pair AS a JOIN pair AS b USING (metric) WHERE"
                " a.model = 'grade' AND b.model = 'sqft_living'"}


def loss(t):
    """A worse model against the baseline model."""
    long = metrics.long_metrics(metrics.evaluate(t.scored_models(), by=["model"],
                                                 metrics=["rmse", "mae", "r2"]))
    return monitor.degradation(long.filter("model = 'grade'"),
                               long.filter("model = 'sqft_living'"))


@query("v_degrade", sql(
    "SELECT metric, round(current_value, 4) AS current_value, round(baseline_value, 4) AS"
    " baseline_value, round(change * 100, 4) AS degradation_pct, coalesce(abs(change) > 0.1, false)"
    " AS threshold_exceeded, coalesce(change > 0.1, false) AS degraded FROM loss", "scored",
    extra=PAIR))
def _(t):
    return rounded(loss(t), 4)


@query("v_degrade_alert", sql(
    "SELECT 'performance_degradation' AS alert_type, string_agg(metric, ',' ORDER BY metric) AS"
    " affected_features, count(*) AS affected_count, 'fit again' AS recommendation"
    " FROM loss WHERE change > 0.1 HAVING count(*) > 0", "scored", extra=PAIR))
def _(t):
    return monitor.degradation_alert(loss(t)).drop("ts")


def last_ts(t):
    return F.lit(t.read("events").agg(F.max("ts")).first()[0])


@query("v_week", "SELECT count(*) AS total_alerts, count(*) FILTER (ts > (SELECT max(ts) FROM"
                 " events) - INTERVAL 7 DAY) AS recent_alerts FROM events")
def _(t):
    return monitor.alert_counts(t.read("events"), "ts", last_ts(t))


@query("v_recent", "SELECT event_id, ts, event_type FROM events WHERE ts > (SELECT max(ts) FROM"
                   " events) - INTERVAL 7 DAY ORDER BY ts DESC, event_id DESC LIMIT 5")
def _(t):
    return monitor.recent_alerts(t.read("events").select("event_id", "ts", "event_type"), "ts",
                                 last_ts(t), ["event_id"])


HISTORY = ("SELECT date_trunc('day', ts) AS day, sqrt(avg(value * value)) AS rmse FROM events"
           " GROUP BY 1")


@query("v_recommend", "SELECT CAST(day AS TIMESTAMP) AS ts, round(rmse, 6) AS rmse,"
       " round(previous, 6) AS previous_rmse, round((rmse - previous) / NULLIF(previous, 0), 6) AS"
       " rmse_change, coalesce((rmse - previous) / NULLIF(previous, 0) > 0.1, false) AS declining"
       f" FROM (SELECT *, lag(rmse) OVER (ORDER BY day) AS previous FROM ({HISTORY}))")
def _(t):
    history = t.read("events").groupBy(F.date_trunc("day", "ts").alias("ts")) \
        .agg(F.sqrt(F.avg(F.col("value") * F.col("value"))).alias("rmse"))
    return rounded(monitor.rmse_changes(history))


RULE_ROWS = ("row_key, sqft_living, floors - 1 AS floors, condition, grade + 2 AS grade,"
             " bedrooms - 2 AS bedrooms, bathrooms, age, sqft_lot")
RULE_SQL = {"sqft_living": "sqft_living <= 0", "floors": "floors <= 0",
            "condition": "condition < 1 OR condition > 5", "grade": "grade < 1 OR grade > 13",
            "bedrooms": "bedrooms < 0", "bathrooms": "bathrooms <= 0", "age": "age < 0",
            "sqft_lot": "sqft_lot <= 0"}


@query("v_rules", sql(
    "SELECT row_key, concat_ws(',', " + ", ".join(
        f"CASE WHEN {c} IS NULL OR {r} THEN '{c}' END" for c, r in RULE_SQL.items())
    + ") AS broken, NOT (" + " OR ".join(f"{c} IS NULL OR {r}" for c, r in RULE_SQL.items())
    + f") AS is_valid FROM (SELECT {RULE_ROWS} FROM dirty)", "dirty"))
def _(t):
    checked = serve.check_rows(t.dirty(key=True).selectExpr(*RULE_ROWS.split(", ")))
    return checked.select("row_key", F.array_join("violations", ",").alias("broken"), "is_valid")


@query("v_ppsf", sql(
    "SELECT row_key, prediction, sqft_living, round(prediction / NULLIF(sqft_living, 0), 6) AS"
    " price_per_sqft FROM predictions JOIN listings USING (row_key)", "predictions"))
def _(t):
    rows = t.listings(key=True)
    model = linear.fit_linear(rows, ["sqft_living"], "price")
    scored = rows.select("row_key", "sqft_living",
                         F.round(model.expression(), 0).alias("prediction"))
    return rounded(serve.price_per_area(scored))


def floor_bin(value: str, width: int, last: int) -> str:
    return f"least(CAST(floor(({value}) / CAST({width} AS DOUBLE)) AS BIGINT), {last})"


SERVE_SIZE = ("CAST(CASE WHEN sqft_living < 1500 THEN 0 WHEN sqft_living < 2500 THEN 1 WHEN"
              " sqft_living < 4000 THEN 2 ELSE 3 END AS BIGINT)")
PER_BED = "sqft_living / greatest(bedrooms, 1.0e0)"


@query("v_serving", sql(
    "SELECT sqft_living, floors, condition, grade, sqft_living + sqft_lot AS total_sqft, grade *"
    f" condition AS quality_score, {SERVE_SIZE} AS size_category_encoded, round({PER_BED}, 6) AS"
    f" sqft_per_bedroom, {floor_bin('sqft_living', 500, 9)} AS sqft_living_binned,"
    f" {floor_bin('floors', 1, 3)} AS floors_binned, {floor_bin('grade', 3, 4)} AS grade_binned,"
    f" {floor_bin('sqft_living + sqft_lot', 1000, 15)} AS total_sqft_binned,"
    f" {floor_bin('grade * condition', 5, 12)} AS quality_score_binned, {SERVE_SIZE} AS"
    f" size_category_encoded_binned, {floor_bin(PER_BED, 200, 10)} AS sqft_per_bedroom_binned FROM"
    " listings", "listings"))
def _(t):
    return rounded(serve.serving_features(t.listings()))


@query("v_score")
def _(t):
    """Batch scoring with schema check, target and key kept aside."""
    rows = t.listings(key=True)
    model = models.fit("ridge", rows, FEATURES, "price")
    return serve.score(rows.select(*FEATURES, "row_key"), model, FEATURES, keep=["row_key"])


@query("v_summary", "SELECT CAST(day AS TIMESTAMP) AS ts, round(rmse, 6) AS rmse, total_alerts,"
       " recent_alerts FROM (SELECT count(*) AS total_alerts, count(*) FILTER (ts > (SELECT max(ts)"
       " FROM events) - INTERVAL 7 DAY) AS recent_alerts FROM events), (SELECT * FROM"
       f" ({HISTORY}) ORDER BY day DESC LIMIT 1)")
def _(t):
    """The latest metrics beside the alert totals, events standing for alerts."""
    return rounded(watched(t)["summary"])


@query("v_rule_codes", "SELECT rule FROM (SELECT unnest(['many_alerts', 'no_baseline', 'declining'])"
       " AS rule) WHERE (rule = 'many_alerts' AND (SELECT count(*) FROM events) > 10) OR rule ="
       " 'no_baseline' OR (rule = 'declining' AND (SELECT (rmse - previous) / NULLIF(previous, 0) >"
       f" 0.1 FROM (SELECT *, lag(rmse) OVER (ORDER BY day) AS previous FROM ({HISTORY})) ORDER BY"
       " day DESC LIMIT 1))")
def _(t):
    """Which of the four rules hold for a history without stored baseline."""
    return watched(t)["recommendations"].select("rule")


@query("v_rule_empty", "SELECT rule FROM (SELECT unnest(['many_alerts', 'no_metrics']) AS rule) WHERE"
       " (rule = 'many_alerts' AND (SELECT count(*) FROM events WHERE value > 1000000) > 10)"
       " OR (rule = 'no_metrics' AND (SELECT count(*) FROM events WHERE value < -1000000) = 0)")
def _(t):
    """Alerts and evaluations beyond a limit that no event reaches, and a stored baseline."""
    events = t.read("events")
    base = monitor.baseline(t.read("part").select("p_size", "p_retailprice"))
    alerts = events.where("value > 1000000").select("ts", F.col("event_type").alias("alert_type"))
    history = events.where("value < -1000000").select("ts", F.col("value").alias("rmse"))
    return monitor.summary(t.spark, alerts, history, base.head(1) != [], last_ts(t))["recommendations"].select("rule")


def watched(t):
    events = t.read("events")
    history = events.groupBy(F.date_trunc("day", "ts").alias("ts")) \
        .agg(F.sqrt(F.avg(F.col("value") * F.col("value"))).alias("rmse"))
    alerts = events.select("ts", F.col("event_type").alias("alert_type"))
    return monitor.summary(t.spark, alerts, history, False, last_ts(t))


SCHEMA_ROWS = [("warning", "feature_count", "expected 8, got 9", "count(*)"),
               ("issue", "missing_features", "sqft_basement", "count(*)"),
               ("warning", "extra_features", "row_key,price", "count(*)")]
# what the rules of floors, grade and the others reject in a batch whose values are moved down
RULES_SQL = {"sqft_living": "{c} <= 0", "bedrooms": "{c} < 0", "bathrooms": "{c} <= 0", "sqft_lot": "{c} <= 0",
             "floors": "{c} <= 0", "condition": "{c} < 1 OR {c} > 5", "grade": "{c} < 1 OR {c} > 13"}
for _c, _rule in RULES_SQL.items():
    SCHEMA_ROWS += [("warning", "missing_cells", _c, f"count(*) FILTER (batch.{_c} IS NULL)"),
                    ("issue", "non_finite_cells", _c, f"count(*) FILTER (isinf(batch.{_c}))"),
                    ("issue", "rule_broken", _c, f"count(*) FILTER ({_rule.format(c='batch.' + _c)})")]
LOWERED = ", ".join(f"CASE WHEN {c} > 4 AND row_key % 100 = 7 THEN CAST('Infinity' AS DOUBLE) ELSE {c} - 1 END AS {c}" if c == "grade"
                    else f"{c} - 1 AS {c}" for c in RULES_SQL)


@query("v_schema", sql(" UNION ALL ".join(
    f"SELECT * FROM (SELECT '{level}' AS level, '{check}' AS \"check\", '{detail}' AS detail, {cells} AS cells FROM batch) WHERE cells > 0"
    for level, check, detail, cells in SCHEMA_ROWS), "dirty", extra={"batch": f"SELECT row_key, {LOWERED}, price FROM dirty"}))
def _(t):
    """Issues of a batch that lacks a column, has others, and holds bad cells."""
    rows = t.dirty(key=True).selectExpr("row_key", *LOWERED.split(", "), "price")
    return serve.batch_report(rows, [*RULES_SQL, "sqft_basement"])
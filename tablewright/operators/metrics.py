"""Regression metrics, model comparison and ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.fixed_values import MAPE_FLOOR
from tablewright.functions.columns import col

METRICS = ["mse", "rmse", "mae", "r2", "explained_variance", "max_error", "mean_error",
           "mean_abs_percentage_error", "residual_std", "mean_residual", "accuracy_within_5pct",
           "accuracy_within_10pct", "accuracy_within_20pct"]
LOWER_IS_BETTER = ("mse", "rmse", "mae")


def pct_error(label: str, prediction: str) -> Column:
    """Absolute percentage error; NULL where the actual value is zero."""
    e = col(prediction) - col(label)
    return F.abs(F.try_divide(e, col(label))) * 100


def _explained(lost: Column, spread: Column) -> Column:
    return F.when(spread > 0, 1 - F.try_divide(lost, spread)) \
        .when(lost == 0, F.lit(1.0)).when(lost.isNotNull(), F.lit(0.0))


def metric_columns(label: str = "label", prediction: str = "prediction") -> dict[str, Column]:
    """All metrics as aggregate columns, so any grouping can use them in one pass.

    Rows without an actual or predicted value do not count.
    """
    p = col(prediction).cast("double")
    y = F.when(p.isNotNull(), col(label).cast("double"))
    e = p - y
    mse = F.avg(e * e)
    pct = pct_error(label, prediction)
    within = {t: F.avg(F.when(pct <= t, 1.0).when(e.isNotNull(), 0.0)) * 100
              for t in (5, 10, 20)}
    return {
        "mse": mse, "rmse": F.sqrt(mse), "mae": F.avg(F.abs(e)),
        "r2": _explained(mse, F.var_pop(y)),
        "explained_variance": _explained(F.var_pop(e), F.var_pop(y)),
        "max_error": F.max(F.abs(e)), "mean_error": F.avg(e),
        "mean_abs_percentage_error":
            F.avg(F.abs(e) / F.greatest(F.abs(y), F.lit(MAPE_FLOOR))) * 100,
        "residual_std": F.stddev_pop(e), "mean_residual": F.avg(e),
        **{f"accuracy_within_{t}pct": share for t, share in within.items()},
    }


def evaluate(df: DataFrame, label: str = "label", prediction: str = "prediction",
             by: list[str] | None = None, metrics: list[str] | None = None) -> DataFrame:
    """Rows, rows with both values (``test_size``) and metrics of the latter; a single aggregation."""
    found = metric_columns(label, prediction)
    aggs = [F.count(F.lit(1)).alias("rows"), F.count(col(prediction) - col(label)).alias("test_size"),
            *[found[m].alias(m) for m in metrics or METRICS]]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def metrics_row(df: DataFrame, label: str = "label", prediction: str = "prediction",
                metrics: list[str] | None = None) -> dict[str, float]:
    return evaluate(df, label, prediction, metrics=metrics).first().asDict()


def long_metrics(table: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """(model, metric, value) from one wide row per model."""
    names = metrics or [m for m in METRICS if m in table.columns]
    return table.select("model", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
        for m in names])))


def compare(long: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """Models x metrics table."""
    return long.groupBy("model").pivot("metric", metrics or METRICS).agg(F.first("value"))


# fixed values: metrics of the comparison heat map; the second list is shown as it is
HEAT_METRICS = ["rmse", "mae", "r2", "explained_variance", "mean_abs_percentage_error",
                "accuracy_within_10pct"]
HEAT_UNSCALED = ["r2", "explained_variance", "accuracy_within_5pct", "accuracy_within_10pct",
                 "accuracy_within_20pct"]


def heat(long: DataFrame) -> DataFrame:
    """Error metrics divided by the largest value over all models."""
    rows = long.filter(F.col("metric").isin(HEAT_METRICS))
    peak = F.max("value").over(Window.partitionBy("metric"))
    scaled = F.when(~F.col("metric").isin(HEAT_UNSCALED) & (peak > 0), F.col("value") / peak) \
        .otherwise(F.col("value"))
    return rows.withColumn("normalised", scaled)


def rank(long: DataFrame) -> DataFrame:
    """Rank of each model by RMSE (ascending) and R2 (descending); ties in model name order."""
    rows = long.filter(F.col("metric").isin("rmse", "r2"))
    order = F.when(F.col("metric") == "rmse", F.col("value")).otherwise(-F.col("value"))
    w = Window.partitionBy("metric").orderBy(order, "model")
    return rows.withColumn("rank", F.row_number().over(w).cast("bigint"))


def report_rows(table: DataFrame) -> DataFrame:
    """The lines of an evaluation report."""
    return table.select("model", "test_size", F.round("rmse", 2).alias("rmse"),
                        F.round("mae", 2).alias("mae"), F.round("r2", 3).alias("r2"),
                        F.round("mean_abs_percentage_error", 2).alias("mape"),
                        F.round("accuracy_within_10pct", 1).alias("within_10pct"))


def best(table: DataFrame, metric: str = "rmse") -> DataFrame:
    """Best model of a (model, position, metrics...) table; the first one wins ties."""
    value = F.col(metric).asc_nulls_last() if metric in LOWER_IS_BETTER \
        else F.col(metric).desc_nulls_last()
    return table.orderBy(value, "position").limit(1)


def top_models(table: DataFrame, k: int = 3) -> DataFrame:
    return table.orderBy(F.col("rmse").asc_nulls_last(), "position").limit(k)


def tuned_choice(plain: DataFrame, tuned: DataFrame) -> DataFrame:
    """Final model: a tuned one replaces the best plain one only if it is strictly better."""
    rows = plain.select("model", "position", "rmse").withColumn("is_tuned", F.lit(False)) \
        .unionByName(tuned.select("model", "position", "rmse")
                     .withColumn("is_tuned", F.lit(True)))
    name = F.when(F.col("is_tuned"), F.concat("model", F.lit("_tuned"))).otherwise(F.col("model"))
    return rows.withColumn("final_name", name) \
        .orderBy(F.col("rmse").asc_nulls_last(), "is_tuned", "position").limit(1)

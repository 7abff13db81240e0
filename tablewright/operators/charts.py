"""Tables behind the evaluation charts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.fixed_values import QUINTILE_LABELS
from tablewright.functions.binning import equal_edges, labelled, with_histogram_bin
from tablewright.functions.columns import col, one_row
from tablewright.functions.normal import normal_quantile
from tablewright.functions.quantiles import exact_quantiles
from tablewright.functions.ranking import blocks_by_rank, global_index, order_key
from tablewright.operators.metrics import metric_columns, pct_error
from tablewright.session import stage


def errors(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Actual, predicted, residual, absolute and percentage error of every row."""
    y, p = col(label), col(prediction)
    return df.select(y.alias("actual"), p.alias("predicted"), (p - y).alias("residual"),
                     F.abs(p - y).alias("abs_error"), pct_error(label, prediction)
                     .alias("pct_error"))


def actual_vs_predicted(df: DataFrame, label: str = "label", prediction: str = "prediction",
                        ) -> DataFrame:
    return errors(df, label, prediction).select("actual", "predicted")


def reference_line(df: DataFrame, label: str = "label", prediction: str = "prediction",
                   ) -> DataFrame:
    """Both ends of the perfect-prediction line and the r2 shown next to it."""
    y, p = col(label), col(prediction)
    return df.agg(F.least(F.min(y), F.min(p)).alias("line_min"),
                  F.greatest(F.max(y), F.max(p)).alias("line_max"),
                  metric_columns(label, prediction)["r2"].alias("r2"))


def residuals(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return errors(df, label, prediction).select("predicted", "residual")


def abs_error_vs_actual(df: DataFrame, label: str = "label", prediction: str = "prediction",
                        ) -> DataFrame:
    return errors(df, label, prediction).select("actual", "abs_error")


def histogram(df: DataFrame, value: Column, bins: int) -> DataFrame:
    """Count per equal-width bin, empty bins included; last bin closed."""
    rows = df.select(value.cast("double").alias("v"))
    low, high = one_row(rows, [F.min("v"), F.max("v")])
    if low is None:
        return df.sparkSession.createDataFrame(
            [], "bin long, bin_low double, bin_high double, n long")
    if low == high:
        low, high = low - 0.5, high + 0.5
    edges = equal_edges(low, high, bins)
    frame = df.sparkSession.createDataFrame(
        [(i, edges[i], edges[i + 1]) for i in range(bins)],
        "bin long, bin_low double, bin_high double")
    # rows without a value form a NULL bin, which the frame does not have
    sizes = with_histogram_bin(rows, "v", F.lit(low), F.lit(high), bins, "bin") \
        .groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    return frame.join(sizes, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def residual_histogram(df: DataFrame, label: str = "label", prediction: str = "prediction",
                       bins: int = 50) -> DataFrame:
    return histogram(df, col(prediction) - col(label), bins)


def normal_curve(df: DataFrame, label: str = "label", prediction: str = "prediction",
                 bins: int = 50, points: int = 100) -> DataFrame:
    """Normal density with the residuals' moments, scaled to the histogram."""
    e = col(prediction) - col(label)
    n, mu, sigma, low, high = one_row(
        df, [F.count(e), F.avg(e), F.stddev_pop(e), F.min(e), F.max(e)])
    step = (high - low) / (points - 1)
    grid = df.sparkSession.range(points).withColumn(
        "x", F.when(F.col("id") == points - 1, F.lit(float(high)))
        .otherwise(F.col("id") * F.lit(step) + F.lit(float(low))))
    z = (F.col("x") - F.lit(mu)) / F.lit(sigma)
    height = n * (high - low) / bins / (math.sqrt(2 * math.pi) * sigma)
    return grid.select(F.col("id").alias("point"), "x",
                       (F.exp(-0.5 * z * z) * F.lit(height)).alias("y"))


def quantile_pairs(df: DataFrame, label: str = "label", prediction: str = "prediction",
                   ) -> DataFrame:
    """Normal probability plot: every residual against its normal order median.

    The residuals are range-sorted once; the median of a rank is a column of it.
    """
    rows = df.select((col(prediction) - col(label)).cast("double").alias("residual")) \
        .filter("residual is not null")
    n = one_row(rows, [F.count("residual")])[0]
    ranked = global_index(rows, [F.col("residual")], "position")
    last = repr(0.5 ** (1.0 / max(n, 1)))
    order = F.expr(f"CASE WHEN position = {n - 1} THEN {last} WHEN position = 0 THEN 1e0 - {last}"
                   f" ELSE (position + 1 - 0.3175e0) / ({n} + 0.365e0) END")
    return ranked.withColumn("_p", order).select(
        (F.col("position") + 1).alias("rank"), F.expr(normal_quantile("_p")).alias("theoretical"),
        "residual")


def fit_quintiles(df: DataFrame, prediction: str = "prediction") -> list[float]:
    probs = [i / 5 for i in range(6)]
    edges = exact_quantiles(df, [prediction], probs)[prediction]
    if len(set(edges)) < len(edges):
        raise ValueError("predictions have too few distinct values for five bins")
    return edges


def quintiles(df: DataFrame, label: str = "label", prediction: str = "prediction",
              edges: list[float] | None = None) -> DataFrame:
    """Errors with the labelled fifth of the predictions each row falls into."""
    edges = edges or fit_quintiles(df, prediction)
    return errors(df, label, prediction).withColumn(
        "prediction_range", labelled(F.col("predicted"), edges, QUINTILE_LABELS, True))


def box_statistics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                   ) -> DataFrame:
    """Median, quartiles and whiskers of absolute and percentage error per prediction fifth.

    Each (measure, fifth) is a column of its own for the exact quantiles, so a fifth of the
    table is never gathered in one group.
    """
    rows = stage(quintiles(df, label, prediction), "fifths")
    cells = {(m, q): F.when(F.col("prediction_range") == q, F.col(m))
             for m in ("abs_error", "pct_error") for q in QUINTILE_LABELS}
    found = exact_quantiles(rows, {f"{m}|{q}": e for (m, q), e in cells.items()},
                            [0.25, 0.5, 0.75])
    aggs, keys = [], []
    for (m, q), e in cells.items():
        q1, q2, q3 = found[f"{m}|{q}"]
        if q1 is None:
            continue
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        keys.append((m, q, q1, q2, q3))
        aggs += [F.count(e), F.min(F.when(e >= low, e)), F.max(F.when(e <= high, e)),
                 F.count_if((e < low) | (e > high))]
    flat = one_row(rows, aggs)
    out = []
    for i, (m, q, q1, q2, q3) in enumerate(keys):
        size, low, high, fliers = flat[4 * i: 4 * i + 4]
        out.append((m, q, size, low, q1, q2, q3, high, fliers))
    return df.sparkSession.createDataFrame(
        out, "measure string, prediction_range string, n long, whisker_low double, q25 double, "
             "median double, q75 double, whisker_high double, outliers long")


def pct_histogram(df: DataFrame, label: str = "label", prediction: str = "prediction",
                  bins: int = 30) -> DataFrame:
    """Histogram of percentage errors with their median in every row."""
    value = pct_error(label, prediction)
    median = exact_quantiles(df, {"v": value}, [0.5])["v"][0]
    return histogram(df, value, bins).withColumn("median", F.lit(median).cast("double"))


def sample_rows(df: DataFrame, size: int = 500, key: Column | str | None = None, minimum: int = 100,
                ) -> DataFrame:
    """``size`` rows in pseudo-random order, or all of them; empty at or below ``minimum`` rows."""
    n = df.count()
    if n <= minimum:
        return df.limit(0)
    key = order_key(df.columns) if key is None else key
    if n <= size:
        return df
    return blocks_by_rank(df, key, [size, n - size], "_part").filter("_part = 0").drop("_part")

"""Bins as plain CASE expressions over literal edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def right_closed(value: Column, edges: list[float], results: list[Column],
                 include_lowest: bool = False) -> Column:
    """``results[i]`` where ``edges[i] < value <= edges[i+1]``; NULL outside all bins."""
    first = value >= F.lit(float(edges[0])) if include_lowest else value > F.lit(float(edges[0]))
    case = F.when(~first, F.lit(None))
    for upper, result in zip(edges[1:], results):
        case = case.when(value <= F.lit(float(upper)), result)
    return case


def labelled(value: Column, edges: list[float], labels: list[str],
             include_lowest: bool = False) -> Column:
    return right_closed(value, edges, [F.lit(x) for x in labels], include_lowest).cast("string")


def numbered(value: Column, edges: list[float], include_lowest: bool = False) -> Column:
    codes = [F.lit(i) for i in range(len(edges) - 1)]
    return right_closed(value, edges, codes, include_lowest).cast("bigint")


def equal_edges(low: float, high: float, bins: int) -> list[float]:
    """``bins + 1`` evenly spaced edges whose last one is exactly ``high``."""
    step = (high - low) / bins
    return [i * step + low for i in range(bins)] + [high]


def with_histogram_bin(df: DataFrame, value: str, low: Column, high: Column, bins: int,
                       name: str) -> DataFrame:
    """Add the left-closed bin number of a column, last bin closed.

    The guess by division is corrected against the edges it stands for. It is a column of its
    own for a moment so that the expression does not repeat it.
    """
    v, step = F.col(value), (high - low) / F.lit(float(bins))
    guess = F.least(F.floor((v - low) / (high - low) * F.lit(float(bins))), F.lit(bins - 1))
    g = F.col("_guess")
    exact = (g - F.when(v < g * step + low, 1).otherwise(0)
             + F.when((g < bins - 1) & (v >= (g + 1) * step + low), 1).otherwise(0))
    return df.withColumn("_guess", guess).withColumn(name, exact.cast("bigint")).drop("_guess")

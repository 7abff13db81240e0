"""Column scaling: fitted centre and width per column, applied as plain arithmetic."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.columns import col, numeric_columns, one_row
from tablewright.functions.quantiles import exact_quantiles

log = logging.getLogger(__name__)
METHODS = ("standard", "minmax", "robust")


@dataclass
class Scaler:
    method: str
    centre: dict[str, float]
    width: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[
            ((col(c).cast("double") - F.lit(self.centre[c])) / F.lit(self.width[c])).alias(c)
            if c in self.centre else col(c) for c in df.columns])


def fit_scaler(df: DataFrame, method: str = "standard", exclude: list[str] | tuple[str, ...] = (),
               ) -> Scaler:
    """Population deviation, range or interquartile range; a zero width counts as one."""
    if method not in METHODS:
        raise ValueError(f"unknown scaling method: {method}")
    names = numeric_columns(df, exclude)
    if not names:
        log.warning("no numeric columns to scale")
        return Scaler(method, {}, {})
    if method == "robust":
        found = exact_quantiles(df, names, [0.25, 0.5, 0.75])
        pairs = {c: (q[1], q[2] - q[0]) for c, q in found.items() if q[0] is not None}
    else:
        tools = (F.avg, F.stddev_pop) if method == "standard" else (F.min, F.max)
        flat = one_row(df, [f(col(c).cast("double")) for c in names for f in tools])
        pairs = {c: (a, b if method == "standard" else b - a)
                 for c, a, b in zip(names, flat[::2], flat[1::2]) if a is not None}
    return Scaler(method, {c: float(a) for c, (a, _) in pairs.items()},
                  {c: float(w) or 1.0 for c, (_, w) in pairs.items()})


def scale(df: DataFrame, method: str = "standard", exclude: list[str] | tuple[str, ...] = (),
          ) -> DataFrame:
    return fit_scaler(df, method, exclude).transform(df)

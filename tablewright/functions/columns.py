"""Small column helpers shared by all operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numeric_columns(df: DataFrame, exclude: list[str] | tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)
            and f.name not in exclude]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def col(name: str) -> Column:
    """Column by exact name, also when the name holds spaces, dots or carets."""
    return F.col("`" + name.replace("`", "``") + "`")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing values are NULL from here on; NaN would sort above every number."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    return df.select(*[
        F.when(~F.isnan(col(c)), col(c)).alias(c) if c in floats else col(c) for c in df.columns])


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def long_form(wide: DataFrame, names: list[str], fields: list[str], key: str = "column_name",
              ) -> DataFrame:
    """One row per name out of one wide row that holds ``{field}_{position of name}`` columns."""
    entries = [
        F.struct(F.lit(name).alias(key), *[F.col(f"{f}_{i}").alias(f) for f in fields])
        for i, name in enumerate(names)
    ]
    return wide.select(F.inline(F.array(*entries)))


def one_row(df: DataFrame, aggregates: list[Column]) -> list:
    """The values of one global aggregation, in order (empty list for no aggregates)."""
    return list(df.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggregates)]).first()) \
        if aggregates else []


def anchors(df: DataFrame, columns: list[Column]) -> list[float]:
    """A value of each column near the others, to subtract before squaring; 0 if none is seen.

    Taken from a few rows, which costs no pass over the table. A constant column gets exactly
    its constant, so that its deviations are exactly 0.
    """
    rows = df.select(*[c.cast("double").alias(f"x{i}") for i, c in enumerate(columns)]).take(20)
    return [next((r[i] for r in rows if r[i] is not None), 0.0) for i in range(len(columns))]

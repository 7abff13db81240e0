"""Exact-size splits, folds and prefixes; rows are assigned by comparing a key with literals."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.columns import col, numeric_columns, one_row
from tablewright.functions.ranking import blocks_by_rank, order_key
from tablewright.operators.features import split_target


def prepare(df: DataFrame, target: str = "price") -> DataFrame:
    """Numeric columns only, gaps filled with column means, the target included."""
    split_target(df, target)
    names = numeric_columns(df)
    means = one_row(df, [F.avg(col(c).cast("double")) for c in names])
    return df.select(*[F.coalesce(col(c).cast("double"), F.lit(m)).alias(c)
                       for c, m in zip(names, means)])


def split_sizes(n: int, test_size: float = 0.2, val_size: float = 0.1) -> tuple[int, int, int]:
    """Train, validation and test rows; held-out parts are rounded up."""
    test = math.ceil(n * test_size)
    rest = n - test
    val = math.ceil(rest * (val_size / (1 - test_size)))
    return rest - val, val, test


def split(df: DataFrame, test_size: float = 0.2, val_size: float = 0.1, key: Column | str | None = None,
          seed: int = 42, name: str = "part") -> DataFrame:
    """Mark every row train, val or test; the sizes are exact and the rows stay where they are."""
    n = df.count()
    train, val, test = split_sizes(n, test_size, val_size)
    key = order_key(df.columns, seed) if key is None else key
    marked = blocks_by_rank(df, key, [test, val, train], "_block")
    names = F.when(F.col("_block") == 0, "test").when(F.col("_block") == 1, "val") \
        .otherwise("train")
    return marked.withColumn(name, names).drop("_block")


def fold_sizes(n: int, folds: int) -> list[int]:
    return [n // folds + (1 if i < n % folds else 0) for i in range(folds)]


def folds(df: DataFrame, k: int = 5, key: Column | str | None = None, seed: int = 42,
          name: str = "fold", rows: int | None = None) -> DataFrame:
    """Consecutive folds of (almost) equal size in the order of the key."""
    n = df.count() if rows is None else rows
    key = order_key(df.columns, seed) if key is None else key
    return blocks_by_rank(df, key, fold_sizes(n, k), name)


def holdout(df: DataFrame, share: float = 0.8, key: Column | str | None = None) -> DataFrame:
    """The last rows after the first ``share`` of the table."""
    n = df.count()
    first = int(n * share)
    key = order_key(df.columns) if key is None else key
    return blocks_by_rank(df, key, [first, n - first], "_part").filter("_part = 1").drop("_part")

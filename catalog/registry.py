"""Collects the registered queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.fixtures import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a function of ``Tables`` under ``name``."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


def _round(value: Column, digits: int) -> Column:
    """``F.round`` of doubles, which writes every value as a decimal text, where plain arithmetic is as exact.

    Below 2^43 the product has an error of under 0.001, so more than 0.01 away from a tie the
    nearest whole number is right, and a whole number by a power of ten is rounded once only.
    """
    if not 0 <= digits <= 15:
        return F.round(value, digits)
    ten = F.lit(10.0 ** digits)
    near = F.rint(value * ten)
    sure = (F.abs(near) < float(1 << 43)) & (F.abs(value * ten - near) < 0.49)
    # 0.0 is added as F.round knows no negative zero
    return F.when(sure, near / ten + F.lit(0.0)).when(value == F.rint(value), value + F.lit(0.0)) \
        .otherwise(F.round(value, digits))


def rounded(df: DataFrame, digits: int | dict[str, int] = 6) -> DataFrame:
    """Round all double columns, since the two engines differ in the last bits of sums."""
    out: list[Column] = []
    for c, t in df.dtypes:
        d = digits if isinstance(digits, int) else digits.get(c, 6)
        out.append(_round(F.col(f"`{c}`"), d).alias(c) if t == "double" else F.col(f"`{c}`"))
    return df.select(*out)

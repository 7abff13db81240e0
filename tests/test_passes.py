"""Tables that are costly to make are made once, however many passes an operator takes."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from catalog.registry import rounded
from tablewright import session
from tablewright.functions.quantiles import exact_quantiles
from tablewright.functions.ranking import blocks_by_rank
from tablewright.operators import charts, features, profile, select

N = 3000


@pytest.fixture()
def counted(spark):
    """A table and the number of its rows that were made so far."""
    rng = np.random.default_rng(3)
    source = spark.createDataFrame(pd.DataFrame({"label": rng.normal(size=N) * 1e5, "prediction": rng.normal(size=N) * 1e5}))
    made = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            made.add(len(frame))
            yield frame

    return source.mapInPandas(count, source.schema), made


def test_quantiles_make_the_table_once(counted):
    df, made = counted
    exact_quantiles(df, ["label", "prediction"], [0.25, 0.5, 0.75])
    assert made.value == N


def test_blocks_make_the_table_once(counted):
    df, made = counted
    sizes = [0, 100, 400, 1500, 1000, 0]
    got = blocks_by_rank(df, "label", sizes)
    assert {r["block"]: r["count"] for r in got.groupBy("block").count().collect()} == {1: 100, 2: 400, 3: 1500, 4: 1000}
    assert made.value == N


@pytest.mark.parametrize("make", [profile.describe, profile.outliers, profile.quality])
def test_profiles_make_the_table_once(counted, make):
    df, made = counted
    make(df).collect()
    assert made.value == N


def test_boxes_sort_errors_once(counted):
    df, made = counted
    charts.box_statistics(df).collect()
    assert made.value <= 2 * N  # once for the edges of the fifths, once for the errors


def test_wide_projections_are_compiled(spark):
    """A plan sets the limit of fused methods, but not over one that was set."""
    before = spark.conf.get(session.HUGE, "65535")
    plan = features.FeaturePlan(domain=False)
    df = spark.createDataFrame([(1.0, 2.0)], "sqft_living double, price double")
    try:
        for own, then in (("65535", str(session.COMPILED)), ("30000", "30000")):
            spark.conf.set(session.HUGE, own)
            plan.widen(df)
            assert spark.conf.get(session.HUGE) == then
    finally:
        spark.conf.set(session.HUGE, before)


def test_f_scores_move_a_row_for_each_feature(spark):
    """The sums are one aggregation of a few columns, with gaps on both sides."""
    rng = np.random.default_rng(8)
    x, y = rng.normal(size=(300, 2)) * 1e3, rng.normal(size=300) * 1e6
    rows = [(None if i % 7 == 0 else float(a), float(b), None if i % 11 == 0 else float(c), 4.0) for i, ((a, b), c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "a double, b double, y double, k double").repartition(5)
    got = select.f_score_rows(df, ["a", "b", "k"], "y")
    assert [r[:2] for r in got] == [("a", 0), ("b", 1), ("k", 2)] and got[2][2] == 0
    for place, _ in enumerate("ab"):
        both = np.array([(r[place], r[2]) for r in rows if r[place] is not None and r[2] is not None])
        r = np.corrcoef(both.T)[0, 1]
        assert got[place][2] == pytest.approx(r * r / (1 - r * r) * (len(both) - 2))
    assert [r[2] for r in select.f_score_rows(df.limit(0), ["a", "k"], "y")] == [0.0, 0.0]


@pytest.mark.parametrize("digits", [0, 2, 3, 6, 9])
def test_rounding_is_that_of_spark(spark, digits):
    rng = np.random.default_rng(digits)
    step = 10.0 ** -digits
    values = [*rng.normal(size=5_000) * 10.0 ** rng.integers(-9, 18, 5_000), *((rng.integers(-10 ** 7, 10 ** 7, 5_000) + 0.5) * step),
              *(rng.integers(-10 ** 9, 10 ** 9, 2_000).astype(float)), 0.0, -0.0, -step / 9, 1e300, -1e300, float("nan"), float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")
    got = rounded(df, digits).select(F.col("v").alias("got"), F.lit(0))
    both = df.select(F.round("v", digits).alias("want")).collect(), got.collect()
    assert [repr(r["want"]) for r in both[0]] == [repr(r["got"]) for r in both[1]]

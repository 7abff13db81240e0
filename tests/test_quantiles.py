"""Exact quantiles, sequential fences, rank blocks and positions; few bins force many passes."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright.functions import quantiles
from tablewright.functions.fences import sequential_fences, sequential_zscores
from tablewright.functions.quantiles import exact_quantiles, order_statistics
from tablewright.functions.ranking import blocks_by_rank, global_index

PROBS = [0.0, 0.2, 0.25, 0.5, 0.75, 0.9, 1.0]


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(1)
    n = 20000
    hot = rng.normal(size=n)
    hot[: n // 3] = 0.5
    return pd.DataFrame({"flat": rng.normal(size=n) * 1e6, "hot": hot,
                         "few": rng.integers(0, 4, n).astype(float),
                         "holes": np.where(rng.random(n) < 0.3, np.nan, rng.random(n))})


@pytest.mark.parametrize("bins", [1 << 16, 4])
def test_quantiles_equal_pandas(spark, table, monkeypatch, bins):
    monkeypatch.setattr(quantiles, "BINS", bins)
    df = spark.createDataFrame(table).select(
        *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in table.columns])
    got = exact_quantiles(df, list(table.columns), PROBS)
    for c in table.columns:
        np.testing.assert_allclose(got[c], table[c].quantile(PROBS), rtol=1e-12, atol=1e-12)


def test_quantiles_equal_percentile(spark, table):
    """Every bit, as both interpolate alike."""
    df = spark.createDataFrame(table[["flat", "hot"]])
    got = exact_quantiles(df, ["flat", "hot"], PROBS)
    want = df.agg(*[F.percentile(c, F.array(*[F.lit(p) for p in PROBS])) for c in got]).first()
    assert [got["flat"], got["hot"]] == [list(w) for w in want]


def test_extreme_values(spark):
    values = [float("-inf"), -1.7e308, -1.0, -5e-324, -0.0, 0.0, 5e-324, 2.0, 1.7e308, float("inf")]
    df = spark.createDataFrame([(v,) for v in values[::-1] * 3] + [(None,)], "a double")
    got = order_statistics(df, {"a": (F.col("a"), list(range(30)))})["a"]
    assert got == sorted(values * 3)
    keys = quantiles.keys_of(np.array(values))
    assert (np.diff(keys) > 0).sum() == 8 and [quantiles.value_of(int(k)) for k in keys] == values


def test_empty_column(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert exact_quantiles(df, ["a", "b"], [0.5]) == {"a": [None], "b": [1.0]}
    assert exact_quantiles(df.limit(0), ["a", "b"], [0.5]) == {"a": [None], "b": [None]}
    assert exact_quantiles(df, [], [0.5]) == {}


def test_order_statistics_of_ranks(spark, table):
    df = spark.createDataFrame(table[["hot"]])
    want = np.sort(table.hot.to_numpy())
    ranks = [0, 1, 6666, 10000, 19998, 19999]
    got = order_statistics(df, {"hot": (F.col("hot"), ranks)})
    assert got["hot"] == [want[r] for r in ranks]
    with pytest.raises(ValueError):
        order_statistics(df, {"hot": (F.col("hot"), [20000])})


def test_wide_tables_take_few_passes(spark, monkeypatch):
    """Four passes for 45 columns and all their ranks, however values are spread."""
    rng = np.random.default_rng(2)
    wide = pd.DataFrame({f"c{i}": np.exp(rng.normal(size=3000) * (i + 1)) * (-1) ** i for i in range(45)})
    passes = []
    inner = quantiles.tally
    monkeypatch.setattr(quantiles, "tally", lambda *a: passes.append(1) or inner(*a))
    got = exact_quantiles(spark.createDataFrame(wide), list(wide.columns), PROBS)
    for c in wide.columns:
        np.testing.assert_allclose(got[c], wide[c].quantile(PROBS), rtol=1e-12)
    assert len(passes) <= 4


def fences_slow(x: pd.DataFrame, factor: float) -> dict:
    out = {}
    for c in x.columns:
        values = x[c].dropna()
        if not len(values):
            out[c] = None
            continue
        q1, q3 = values.quantile(0.25), values.quantile(0.75)
        out[c] = (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
        x = x[~((x[c] < out[c][0]) | (x[c] > out[c][1]))]
    return out


def check_fences(spark, x: pd.DataFrame, factor: float = 1.5, **guess) -> None:
    df = spark.createDataFrame(x).select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in x.columns])
    got, want = sequential_fences(df, list(x.columns), factor, **guess), fences_slow(x, factor)
    for c in x.columns:
        assert (got[c] is None) == (want[c] is None)
        if got[c]:
            np.testing.assert_allclose(got[c], want[c], rtol=1e-12, atol=1e-12, err_msg=c)


@pytest.mark.parametrize("bins,slack", [(1 << 16, 0.03), (256, 0.0), (1 << 16, 0.4)])
def test_sequential_fences(spark, monkeypatch, bins, slack):
    """Columns that depend on each other, hot values and gaps; bad guesses only take longer."""
    monkeypatch.setattr(quantiles, "BINS", bins)
    rng = np.random.default_rng(3)
    n = 1500
    a = rng.lognormal(0, 2, n)
    x = pd.DataFrame({"a": a, "b": a * rng.normal(1, 0.2, n), "hot": np.where(rng.random(n) < 0.7, 5.0, rng.normal(size=n) * 9),
                      "few": rng.integers(0, 9, n) ** 2.0, "d": -a + rng.normal(size=n) * 50,
                      "holes": np.where(rng.random(n) < 0.4, np.nan, a ** 2), "empty": np.nan})
    check_fences(spark, x, slack=slack)


@pytest.mark.parametrize("inner", [2.5, 0.5, 40.0])
def test_sequential_zscores(spark, inner):
    """A guess that takes too many rows as kept is noticed."""
    rng = np.random.default_rng(4)
    a = rng.normal(size=2000)
    x = pd.DataFrame({"a": np.where(rng.random(2000) < 0.02, 500.0, a), "b": a * 3 + rng.normal(size=2000) ** 3, "same": 4.0,
                      "holes": np.where(rng.random(2000) < 0.3, np.nan, a ** 5), "empty": np.nan})
    df = spark.createDataFrame(x).select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in x.columns])
    got, rest = sequential_zscores(df, list(x.columns), 3.0, inner), x
    for c in ("a", "b", "holes"):
        want = rest[c].mean(), rest[c].std(ddof=0)
        np.testing.assert_allclose(got[c], want, rtol=1e-9)
        rest = rest[~(((rest[c] - want[0]) / want[1]).abs() > 3)]
    assert set(got) == {"a", "b", "holes"} and len(rest) < 1970


def test_sequential_fences_of_small_tables(spark):
    for rows in ([[1.0, 2.0]], [[1.0, 5.0], [2.0, 5.0], [900.0, 7.0]], [[np.nan, 3.0], [np.nan, 4.0]]):
        check_fences(spark, pd.DataFrame(rows, columns=["a", "b"]))
    empty = spark.createDataFrame([], "a double, b int")
    assert sequential_fences(empty, ["a", "b"], 1.5) == {"a": None, "b": None}
    assert sequential_fences(empty, [], 1.5) == {}


@pytest.mark.parametrize("hot", [0, 700])
def test_blocks_have_exact_sizes(spark, hot):
    ids = [(i, 5 if i < hot else (i * 7919) % 100003) for i in range(2000)]
    df = spark.createDataFrame(ids, "id long, k long").repartition(5)
    sizes = [400, 0, 1, 999, 600]
    got = blocks_by_rank(df, F.col("k"), sizes).collect()
    counts = pd.Series([r["block"] for r in got]).value_counts().to_dict()
    assert counts == {i: s for i, s in enumerate(sizes) if s}
    assert {r["id"] for r in got} == set(range(2000))
    by = sorted((r["k"], r["block"]) for r in got)
    assert [b for _, b in by] == sorted(b for _, b in by)


def test_global_index(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k")).repartition(7)
    got = sorted((r["k"], r["position"]) for r in global_index(df, [F.col("k")]).collect())
    assert [p for _, p in got] == list(range(5000))

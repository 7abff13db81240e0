"""Nearest neighbours against brute force."""

import numpy as np
import pandas as pd
import pytest

from tablewright.operators import neighbors
from tablewright.operators.neighbors import knn_impute, knn_predict


def brute_impute(x: np.ndarray, k: int) -> np.ndarray:
    """Mean of the k nearest donors; ties go to the smaller value, as documented."""
    out = x.copy()
    p = x.shape[1]
    for r in range(len(x)):
        for j in np.nonzero(np.isnan(x[r]))[0]:
            diff = x - x[r]
            both = ~np.isnan(diff)
            shared = both.sum(axis=1)
            with np.errstate(divide="ignore", invalid="ignore"):
                square = np.where(shared > 0,
                                  np.where(both, diff * diff, 0).sum(axis=1) * p / shared, np.inf)
            able = ~np.isnan(x[:, j]) & np.isfinite(square)
            if not able.any():
                out[r, j] = np.nanmean(x[:, j])
                continue
            order = np.lexsort((x[able, j], square[able]))[:k]
            out[r, j] = x[able, j][order].mean()
    return out


def rows(df, columns):
    return np.array(sorted(tuple(r) for r in df.select(*columns).collect()))


SMALL = {"LEAF": 4, "FAN": 3, "BLOCK": 24, "CHUNK": 40, "BEAM": 1, "TOP": 3}  # many levels and groups


@pytest.fixture
def many_levels(monkeypatch):
    for name, value in SMALL.items():
        monkeypatch.setattr(neighbors, name, value)


def test_impute_matches_brute_force(spark, many_levels):
    rng = np.random.default_rng(5)
    n, p, hot = 300, 4, 150
    x = np.column_stack([rng.integers(0, 40, n), rng.integers(0, 900, n), rng.integers(0, 5, n),
                         rng.normal(0, 300, n).round()]).astype(float)
    x[rng.random((n, p)) < 0.15] = np.nan
    x[:hot] = x[0]
    x[:hot, 2] = np.nan
    names = list("abcd")
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x],
                               ", ".join(f"{c} double" for c in names))
    got = rows(knn_impute(df, 5), names)
    want = brute_impute(x, 5)
    want = np.array(sorted(map(tuple, want)))
    np.testing.assert_allclose(got, want, rtol=1e-9)


def test_impute_only_given_columns(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (2.0, 5.0, None), (1.5, 7.0, 4.0)],
                               "a double, b double, c double")
    got = {tuple(r) for r in knn_impute(df, 1, columns=["b"]).collect()}
    assert got == {(1.0, 7.0, 3.0), (2.0, 5.0, None), (1.5, 7.0, 4.0)}


@pytest.mark.parametrize("weights", ["uniform", "distance"])
def test_predict_matches_brute_force(spark, weights):
    rng = np.random.default_rng(9)
    train = pd.DataFrame({"a": rng.integers(0, 50, 300).astype(float),
                          "b": rng.integers(0, 50, 300).astype(float)})
    train["y"] = train.a * 3 + train.b + rng.integers(0, 9, 300)
    new = pd.DataFrame({"a": rng.integers(0, 50, 80).astype(float),
                        "b": rng.integers(0, 50, 80).astype(float)})
    got = knn_predict(spark.createDataFrame(train), spark.createDataFrame(new), ["a", "b"], "y",
                      5, weights).toPandas()
    for _, r in got.iterrows():
        square = (train.a - r.a) ** 2 + (train.b - r.b) ** 2
        order = np.lexsort((train.y, square))[:5]
        d, y = np.sqrt(square.to_numpy()[order]), train.y.to_numpy()[order]
        if weights == "uniform":
            want = y.mean()
        elif (d == 0).any():
            want = y[d == 0].mean()
        else:
            want = (y / d).sum() / (1 / d).sum()
        assert abs(r.prediction - want) < 1e-9
    assert len(got) == 80


def test_odd_columns(spark):
    """A constant column, one without values, a huge range, and fewer donors than neighbours."""
    x = np.array([[1.0, 5.0, np.nan, 1e15], [2.0, 5.0, np.nan, np.nan], [4.0, np.nan, np.nan, -1e15], [np.nan, 5.0, np.nan, 3.0]])
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], "a double, b double, c double, d double")
    got = sorted(tuple(r) for r in knn_impute(df, 5).collect())
    with np.errstate(all="ignore"):
        want = brute_impute(np.delete(x, 2, axis=1) * 1.0, 5)
    assert [r[2] for r in got] == [None] * 4
    np.testing.assert_allclose(np.array([[r[0], r[1], r[3]] for r in got]), np.array(sorted(map(tuple, want))))
    assert knn_impute(df.limit(0), 5).count() == 0


def test_far_outlier_does_not_hide_the_rest(spark, many_levels):
    rng = np.random.default_rng(3)
    train = pd.DataFrame({"a": np.r_[rng.normal(size=200), 1e12], "b": rng.normal(size=201) * 1e-6, "y": np.arange(201.0)})
    new = pd.DataFrame({"a": rng.normal(size=40), "b": np.zeros(40)})
    got = knn_predict(spark.createDataFrame(train), spark.createDataFrame(new), ["a", "b"], "y", 3).toPandas()
    for _, r in got.iterrows():
        square = (train.a - r.a) ** 2 + (train.b - r.b) ** 2
        assert abs(r.prediction - train.y[np.argsort(square, kind="stable")[:3]].mean()) < 1e-9


def test_leaves_are_sent_once_to_a_tile(spark, many_levels, monkeypatch):
    """What meets the queries follows the tiles, not the pairs: each leaf comes once for all blocks of an area."""
    rng = np.random.default_rng(4)
    met = []
    packed = neighbors._packed

    def kept(rows, key):
        met.append((key, rows.count(), packed(rows, key).count()))
        return packed(rows, key)

    monkeypatch.setattr(neighbors, "_packed", kept)
    train = pd.DataFrame(rng.normal(size=(120, 6)), columns=list("abcdef")).assign(y=np.arange(120.0))
    new = pd.DataFrame(rng.normal(size=(60, 6)), columns=list("abcdef"))
    got = knn_predict(spark.createDataFrame(train), spark.createDataFrame(new), list("abcdef"), "y", 3).toPandas()
    for _, r in got.iterrows():
        square = ((train[list("abcdef")] - r[list("abcdef")]) ** 2).sum(axis=1)
        assert abs(r.prediction - train.y[np.argsort(square, kind="stable")[:3]].mean()) < 1e-9
    assert {tuple(key) for key, _, _ in met} == {("block", "area"), ("node", "field")}
    assert all(blobs < rows for _, rows, blobs in met)


def test_few_candidates_hold_the_nearest():
    """Far from the origin, with gaps, ties and wide limits: few squares are computed, and none that counts is missed."""
    rng = np.random.default_rng(8)
    p, k, n = 4, 3, 3000
    d = rng.integers(0, 30, (n, p)) * np.array([1e-3, 1.0, 50.0, 1e6]) + np.array([1e9, 0, -1e4, 1e12])
    d[rng.random((n, p)) < 0.2] = np.nan
    q = d[rng.integers(0, n, 40)].copy()
    q[:, 0], q[:, 1:] = np.nan, np.where(np.isnan(q[:, 1:]), np.nanmean(d[:, 1:], axis=0), q[:, 1:])
    names = [f"f{i}" for i in range(p)]
    lenders = pd.DataFrame(d, columns=names).assign(m=1)
    got = neighbors._matcher(p, k, [0])(pd.DataFrame(q, columns=names).assign(qid=np.arange(40)), lenders)
    for i in range(40):
        both = ~np.isnan(d[:, 1:])
        square = np.where(both, (q[i, 1:] - np.where(both, d[:, 1:], 0)) ** 2, 0).sum(axis=1) * p / np.maximum(both.sum(axis=1), 1)
        able = np.flatnonzero(~np.isnan(d[:, 0]) & both.any(axis=1))
        near = able[np.lexsort((d[able, 0], square[able]))[:k]]
        mine = got[got.qid == i].sort_values(["square", "value"])
        np.testing.assert_allclose(mine["square"], square[near], rtol=1e-12)
        np.testing.assert_array_equal(mine["value"], d[near, 0])
    has = np.flatnonzero(~np.isnan(d[:, 1:]).all(axis=1))
    part = has[:1024]
    x, _ = neighbors._candidates(q[:, 1:], d[part, 1:], ~np.isnan(d[part, 1:]), p, k, {0: np.full(40, np.inf)},
                                 {0: ~np.isnan(d[part, 0])})[0]
    assert len(x) < 40 * 1024 / 8 and set(x) == set(range(40))


def test_tiles_are_dealt_by_number_not_by_size(spark):
    """Little data is much work in a comparison: adaptive plans must not gather its tiles in one task."""
    rows = spark.range(300).selectExpr("double(id % 17) a", "double(id % 29) b", "double(id) y")
    plan = knn_predict(rows, rows.limit(50), ["a", "b"], "y", 3)._jdf.queryExecution().toString()
    assert plan.count("REPARTITION_BY_NUM") >= 2

"""Cross-validation, hyper-parameter search and learning curves."""

from __future__ import annotations

import itertools
import logging
import math
import random
import statistics
from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.columns import one_row
from tablewright.functions.gram import grams, total
from tablewright.functions.ranking import blocks_by_rank, order_key
from tablewright.operators import models
from tablewright.operators.linear import KINDS, fold_errors, fold_grams, solve, squared_error
from tablewright.operators.metrics import metrics_row
from tablewright.operators.split import fold_sizes, folds
from tablewright.session import together

log = logging.getLogger(__name__)
CV_SCHEMA = "model string, fold_scores array<double>, mean_cv_score double, " \
            "std_cv_score double, rmse_cv double"


def _mse(model, rows: DataFrame, label: str) -> float:
    return metrics_row(model.transform(rows), label, metrics=["mse"])["mse"]


def fold_scores(data: DataFrame, features: list[str], label: str, name: str, fold: str, k: int,
                cross=None, **params) -> list[float]:
    """Mean squared error per fold. Linear models need the cross products only."""
    if name in KINDS:
        cross = cross or fold_grams(data, features, label, fold)
        return fold_errors(cross, name, **params)

    def score(f: int) -> float:
        model = models.fit(name, data.filter(F.col(fold) != f), features, label, **params)
        return _mse(model, data.filter(F.col(fold) == f), label)

    scores = together(data.sparkSession, [partial(score, f) for f in range(k)], k)
    for s in scores:
        if isinstance(s, Exception):
            raise s
    return scores


def _summary(scores: list[float]) -> tuple[float, float, float]:
    mean = statistics.fmean(scores)
    return mean, statistics.pstdev(scores), math.sqrt(mean)


def cross_validate(df: DataFrame, features: list[str], label: str, names: list[str] | None = None,
                   k: int = 5, key: Column | str | None = None, parallelism: int = 4,
                   ) -> DataFrame:
    """Per model: fold errors, their mean and population deviation, root of the mean.

    Folds are consecutive blocks of the key order. All linear models share one pass over the
    table. A model that fails gets an empty row.
    """
    data = folds(df, k, key)
    names = list(names or models.REGISTRY)
    cross = fold_grams(data, features, label, "fold") if set(names) & set(KINDS) else None

    def run(name: str) -> tuple:
        scores = [float(s) for s in fold_scores(data, features, label, name, "fold", k, cross)]
        return (name, scores, *_summary(scores))

    rows = []
    for name, found in zip(names, together(df.sparkSession, [partial(run, n) for n in names],
                                           parallelism)):
        if isinstance(found, Exception):
            log.warning("cross-validation of %s failed: %s", name, found)
            found = (name, None, None, None, None)
        rows.append(found)
    return df.sparkSession.createDataFrame(rows, CV_SCHEMA)


def combinations(grid: dict[str, list]) -> list[dict]:
    """All settings of a grid, the last parameter varying fastest."""
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def search(df: DataFrame, features: list[str], label: str, name: str, method: str = "grid_search",
           k: int = 3, n_iter: int = 20, grid: dict[str, list] | None = None, seed: int = 42,
           key: Column | str | None = None, parallelism: int = 4,
           ) -> tuple[dict, float, list[tuple[dict, float]]]:
    """Best settings, their mean squared error over the folds and all results.

    ``random_search`` tries ``n_iter`` settings drawn without replacement. A model without a grid
    keeps its defaults.
    """
    if method not in ("grid_search", "random_search"):
        raise ValueError(f"unknown tuning method: {method}")
    settings = combinations(models.grid(name) if grid is None else grid)
    if method == "random_search" and len(settings) > n_iter:
        settings = random.Random(seed).sample(settings, n_iter)
    data = folds(df, k, key)
    cross = fold_grams(data, features, label, "fold") if name in KINDS else None

    def score(params: dict) -> float:
        return statistics.fmean(
            fold_scores(data, features, label, name, "fold", k, cross, **params))

    found = together(df.sparkSession, [partial(score, p) for p in settings],
                     1 if name in KINDS else parallelism)
    for f in found:
        if isinstance(f, Exception):
            raise f
    results = list(zip(settings, found))
    best = min(results, key=lambda r: r[1])
    return best[0], best[1], results


def search_table(df: DataFrame, name: str, results: list[tuple[dict, float]]) -> DataFrame:
    rows = [(name, i, ",".join(f"{k}={v}" for k, v in p.items()), float(mse), math.sqrt(mse))
            for i, (p, mse) in enumerate(results)]
    return df.sparkSession.createDataFrame(
        rows, "model string, position long, params string, mean_cv_score double, rmse_cv double")


def learning_curve(df: DataFrame, features: list[str], label: str, name: str = "ridge",
                   k: int = 5, shares: list[float] | None = None, key: Column | str | None = None,
                   **params) -> DataFrame:
    """Mean and population deviation over the folds of train and validation RMSE per train size.

    The training rows of a fold are those before and after it; a size takes their first rows.
    """
    n = one_row(df, [F.count(F.lit(1))])[0]
    sizes = fold_sizes(n, k)
    starts = [sum(sizes[:f]) for f in range(k)]
    longest = n - sizes[0]
    shares = shares or [i / 10 for i in range(1, 11)]
    takes = sorted({max(1, int(s * longest)) for s in shares})
    # every limit in the global order at which some fold's prefix ends or a fold begins
    limits = {0, n}
    for f in range(k):
        limits |= {starts[f], starts[f] + sizes[f]}
        limits |= {t if t <= starts[f] else min(t + sizes[f], n) for t in takes}
    marks = sorted(limits)
    blocks = [b - a for a, b in zip(marks, marks[1:])]
    key = order_key(df.columns) if key is None else key
    data = blocks_by_rank(df, key, blocks)

    def member(block: int, f: int, take: int) -> bool:
        place = marks[block]
        if place < starts[f]:
            return place < take
        return place >= starts[f] + sizes[f] and place - sizes[f] < take

    cross = grams(data, [*features, label], F.col("block")) if name in KINDS else None
    rows = []
    for take in takes:
        train_scores, val_scores = [], []
        for f in range(k):
            train = [b for b in range(len(blocks)) if member(b, f, take)]
            held = [b for b in range(len(blocks))
                    if starts[f] <= marks[b] < starts[f] + sizes[f]]
            if cross is not None:
                g, h = total([cross[b] for b in train]), total([cross[b] for b in held])
                model = solve(g, name, **params)
                train_scores.append(math.sqrt(max(squared_error(g, model), 0.0) / g.n))
                val_scores.append(math.sqrt(max(squared_error(h, model), 0.0) / h.n))
            else:
                part = data.filter(F.col("block").isin(train))
                model = models.fit(name, part, features, label, **params)
                train_scores.append(math.sqrt(_mse(model, part, label)))
                rest = data.filter(F.col("block").isin(held))
                val_scores.append(math.sqrt(_mse(model, rest, label)))
        rows.append((take, float(np.mean(train_scores)), float(np.std(train_scores)),
                     float(np.mean(val_scores)), float(np.std(val_scores))))
    return df.sparkSession.createDataFrame(
        rows, "train_size long, train_rmse_mean double, train_rmse_std double, "
              "val_rmse_mean double, val_rmse_std double")

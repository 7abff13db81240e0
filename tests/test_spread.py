"""Fits that go over their rows many times use all cores, whatever files the rows come from."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tablewright import session
from tablewright.operators import select, trees


def test_rows_are_dealt_evenly(spark, monkeypatch):
    monkeypatch.setattr(session, "PART_ROWS", 100)
    df = spark.range(4000).select(F.col("id"), (F.col("id") * 0).alias("same")).coalesce(1)
    got = session.spread(df)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 40 and max(sizes) - min(sizes) <= 20
    assert got.agg(F.count("id"), F.sum("id")).first() == (4000, 4000 * 3999 // 2)


def test_forests_fit_in_many_tasks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 2))
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "label": x[:, 1], "y": 10 * x[:, 0] + x[:, 1]})).coalesce(1)
    parts = []

    def spread(df, name="spread"):
        parts.append((out := session.spread(df, name)).rdd.getNumPartitions())
        return out

    monkeypatch.setattr(select, "spread", spread)
    monkeypatch.setattr(trees, "spread", spread)
    scores = {r["feature"]: r["score"] for r in select.forest_scores(df, ["a"], "y", trees=3, depth=3).collect()}
    assert scores == {"a": 1.0}
    for fit in (lambda: trees.fit_tree(df, ["a"], "y", "random_forest", n_estimators=3, max_depth=3),
                lambda: trees.fit_extra_trees(df, ["a"], "y", n_estimators=3, max_depth=3, groups=1)):
        error = fit().transform(df).agg(F.sqrt(F.avg((F.col("prediction") - F.col("y")) ** 2))).first()[0]
        assert error < 5
    assert len(parts) == 3 and min(parts) >= 2 * spark.sparkContext.defaultParallelism

"""Exact numbers of injected copies and gaps, whatever the layout of the table."""

from collections import Counter

from pyspark.sql import functions as F

from tablewright.sources import synth


def table(spark, n=1000, hot=400):
    rows = [(1, "same", None)] * hot + [(i, f"t{i % 7}", float(i)) for i in range(n - hot)]
    return spark.createDataFrame(rows, "a long, b string, c double")


def counted(df):
    return Counter(tuple(r) for r in df.collect())


def test_copies_are_exact_and_free_of_layout(spark, monkeypatch):
    monkeypatch.setattr(synth, "BUCKET", 64)
    df = table(spark)
    first = counted(synth.add_duplicates(df, 0.0817))
    again = counted(synth.add_duplicates(df.orderBy(F.desc("c")).repartition(5), 0.0817))
    assert first == again and sum(first.values()) == 1000 + 81
    added = first - counted(df)
    assert sum(added.values()) == 81 and set(added) <= set(counted(df))
    assert 15 < added[(1, "same", None)] < 50  # two fifths of the rows
    assert counted(synth.add_duplicates(df, 0.0817, seed=7)) != first
    assert counted(synth.add_duplicates(df, 0.0)) == counted(df) and synth.add_duplicates(df.limit(0), 0.5).count() == 0


def test_gaps_are_exact_and_free_of_layout(spark, monkeypatch):
    monkeypatch.setattr(synth, "BUCKET", 64)
    df = table(spark).withColumn("d", F.lit(5))
    first = counted(synth.add_gaps(df, 0.15, columns=["b", "d"]))
    assert first == counted(synth.add_gaps(df.repartition(3, "b"), 0.15, columns=["b", "d"]))
    assert sum(first.values()) == 1000 and Counter({(r[0], r[2]): n for r, n in first.items()}).keys() == {(r[0], r[2]) for r in counted(df)}
    empty = [sum(n for r, n in first.items() if r[i] is None) for i in (1, 3)]
    assert sum(empty) <= 300 and all(100 < e < 180 for e in empty)  # 300 draws, some hit a cell twice
    drawn = synth._draws(synth._places(df), lambda rows: int(rows * 0.3), 2, 42).collect()
    assert len(drawn) == 300 and len({(r._bucket, r._place, r._cell) for r in drawn}) == sum(empty)


def test_buckets_stay_small(spark, monkeypatch):
    """Rows that are all equal are dealt over the buckets as others are."""
    monkeypatch.setattr(synth, "BUCKET", 1000)
    sizes = [r["count"] for r in synth._places(spark.range(20_000).select(F.lit(1).alias("a"))).groupBy("_bucket").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 5_000

"""Synthetic listings, and injection of duplicates and gaps into any table."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright import fixed_values as fv
from tablewright.functions.columns import col
from tablewright.session import stage

#: rows of a bucket, about, and draws of a batch
BUCKET, DRAWS = 1 << 14, 1 << 16


def _clip(value: Column, limits: tuple[float, float]) -> Column:
    return F.least(F.greatest(value, F.lit(float(limits[0]))), F.lit(float(limits[1])))


def _choice(name: str, seed: int) -> Column:
    values, weights = fv.CHOICES[name]
    draw = F.col(f"_u_{name}")
    case = None
    for v, edge in zip(values[:-1], itertools.accumulate(weights)):
        case = (F if case is None else case).when(draw < edge, F.lit(float(v)))
    return case.otherwise(F.lit(float(values[-1])))


def listings(spark: SparkSession, rows: int = 1500, seed: int = 42) -> DataFrame:
    """A regression table: random features and a noisy linear price."""
    base = spark.range(rows)
    draws = base.withColumns({
        **{f"_u_{c}": F.rand(seed + i) for i, c in enumerate(fv.CHOICES)},
        "_u_age": F.rand(seed + 11), "_n_living": F.randn(seed + 12),
        "_n_lot": F.randn(seed + 13), "_n_price": F.randn(seed + 14)})
    parts = draws.withColumns({
        **{c: _choice(c, seed) for c in fv.CHOICES},
        "sqft_living": _clip((F.lit(fv.LIVING_MEAN) + F.lit(fv.LIVING_STD) * F.col("_n_living"))
                             .cast("bigint").cast("double"), fv.LIVING_RANGE),
        "age": _clip((-F.log(1 - F.col("_u_age")) * fv.AGE_SCALE).cast("bigint").cast("double"),
                     fv.AGE_RANGE),
        "sqft_lot": _clip(F.exp(F.lit(float(fv.LOT_MU)) + F.lit(fv.LOT_SIGMA) * F.col("_n_lot"))
                          .cast("bigint").cast("double"), fv.LOT_RANGE)})
    price = (fv.PRICE_YEAR_ORIGIN - F.col("age")) * float(fv.PRICE_PER_YEAR) \
        + F.col("_n_price") * float(fv.PRICE_NOISE_STD)
    for c, weight in fv.PRICE_WEIGHTS.items():
        price = price + F.col(c) * float(weight)
    whole = _clip(price, fv.PRICE_RANGE).cast("bigint").cast("double")
    return parts.withColumn("price", whole).select(*fv.RAW_COLUMNS)


def _places(df: DataFrame) -> DataFrame:
    """``df`` with ``_bucket`` and ``_place``, which depend on the rows alone and not on their layout.

    Equal rows are counted first and dealt out again by a hash of the row and of the copy's number,
    so a row that makes up a third of the table fills no bucket. Within a bucket of about
    ``BUCKET`` rows the place is the rank by that hash.
    """
    names = [col(c) for c in df.columns]
    groups = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_copies"))
    # successive copies by thousands first, so that no single row is turned into all its copies
    blocks = groups.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("_copies") - 1).cast("long"), F.lit(1000).cast("long"))))
    hashed = F.xxhash64(*names, "_block")
    rows = df.count()
    buckets = max(1, rows // BUCKET)
    dealt = blocks.withColumn("_bucket", F.pmod(hashed, F.lit(buckets))).repartition("_bucket")
    copies = dealt.withColumn("_copy", F.explode(F.sequence(F.col("_block"), F.least(F.col("_block") + 999, F.col("_copies") - 1))))
    order = Window.partitionBy("_bucket").orderBy(F.xxhash64(*names, "_copy"), *names, "_copy")
    return stage(copies.withColumn("_place", F.row_number().over(order) - 1).drop("_copies", "_block", "_copy"), "places")


def _draws(placed: DataFrame, number, cells: int, seed: int) -> DataFrame:
    """(_bucket, _place, _cell) of exactly ``number(rows)`` draws with replacement.

    The number is split over the buckets by a multinomial draw, so each (place, cell) is as likely
    as any other; a bucket draws its own share.
    """
    sizes = placed.groupBy("_bucket").count().orderBy("_bucket").collect()  # a row for BUCKET rows
    rows = sum(r["count"] for r in sizes)
    spread = np.random.default_rng([seed, cells]).multinomial(number(rows), [r["count"] / rows for r in sizes]) if rows else []
    shares = [(r["_bucket"], r["count"], int(n)) for r, n in zip(sizes, spread, strict=True) if n]

    def draw(frames):
        for frame in frames:
            for bucket, size, n in frame.itertuples(index=False):
                rng = np.random.default_rng([seed, cells, bucket + 1])
                for start in range(0, n, DRAWS):
                    take = min(DRAWS, n - start)
                    yield pd.DataFrame({"_bucket": np.full(take, bucket), "_place": rng.integers(size, size=take), "_cell": rng.integers(cells, size=take)})

    table = placed.sparkSession.createDataFrame(shares, "_bucket long, _size long, _n long")
    return table.repartition(-(-len(shares) // 16) or 1, "_bucket").mapInPandas(draw, "_bucket long, _place long, _cell long")


def add_duplicates(df: DataFrame, rate: float = 0.08, seed: int = 42) -> DataFrame:
    """Append exactly int(rows * ``rate``) copies of rows drawn with replacement.

    Which rows are drawn does not depend on the table's files, partitions or order.
    """
    placed = _places(df)
    drawn = _draws(placed, lambda rows: int(rows * rate), 1, seed).groupBy("_bucket", "_place").agg(F.count(F.lit(1)).alias("_times"))
    copies = placed.join(drawn, ["_bucket", "_place"]) \
        .withColumn("_time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))))
    return df.unionByName(copies.select(*[col(c) for c in df.columns]))


def add_gaps(df: DataFrame, rate: float = 0.15, seed: int = 42, columns: list[str] | None = None) -> DataFrame:
    """Empty the cells of ``columns`` (all by default) that int(rows * columns * ``rate``) draws hit.

    Draws are with replacement. Which cells are drawn does not depend on the table's files,
    partitions or order.
    """
    names = df.columns if columns is None else columns
    placed = _places(df)
    hits = _draws(placed, lambda rows: int(rows * len(names) * rate), len(names), seed).groupBy("_bucket", "_place") \
        .agg(F.collect_set("_cell").alias("_hit"))
    both = placed.join(hits, ["_bucket", "_place"], "left")

    def cell(c: str) -> Column:
        if c not in names:
            return col(c)
        hit = F.coalesce(F.array_contains("_hit", F.lit(names.index(c)).cast("long")), F.lit(False))
        return F.when(~hit, col(c)).alias(c)

    return both.select(*[cell(c) for c in df.columns])


def generate(spark: SparkSession, rows: int = 1500, missing_rate: float = 0.15,
             duplicate_rate: float = 0.08, seed: int = 42) -> DataFrame:
    """Synthetic listings with copies first and gaps second, so most copies stop being equal."""
    return add_gaps(add_duplicates(listings(spark, rows, seed), duplicate_rate, seed),
                    missing_rate, seed)

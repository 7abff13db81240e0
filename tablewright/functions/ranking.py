"""Global positions and rank blocks without a single-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.columns import any_of, col
from tablewright.functions.quantiles import ranked_values
from tablewright.session import stage

KEY_SPACE = 1 << 52


def order_key(columns: list[str], seed: int = 42) -> Column:
    """Pseudo-random 52-bit number of a row, the same in every run and on every cluster."""
    return F.pmod(F.xxhash64(F.lit(seed), *[col(c) for c in columns]), F.lit(KEY_SPACE))


def global_index(df: DataFrame, order_by: list[Column], name: str = "position") -> DataFrame:
    """0-based position of each row in the given order.

    Rows are range-sorted once; the per-partition sizes (one small row each) give the offsets.
    A salt after the order columns lets equal rows spread over several partitions. It is written
    down before the sort, so that a repeated task sorts the same values.
    """
    salted = stage(df.withColumn("_salt", F.rand(17)), "salted")
    ordered = salted.orderBy(*order_by, "_salt").drop("_salt") \
        .withColumn("_place", F.monotonically_increasing_id())
    placed = stage(ordered, "ordered")
    part, within = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")) \
        .orderBy("_part").collect()
    offsets, seen = [], 0
    for row in sizes:
        offsets.append((row["_part"], seen))
        seen += row["n"]
    table = df.sparkSession.createDataFrame(offsets, "_part long, _offset long")
    return placed.withColumn("_part", part).join(F.broadcast(table), "_part") \
        .withColumn(name, F.col("_offset") + within).drop("_part", "_offset", "_place")


def blocks_by_rank(df: DataFrame, key: Column | str, sizes: list[int], name: str = "block") -> DataFrame:
    """Consecutive blocks of exactly the given sizes in the order of a numeric key.

    The block limits are order statistics of the key, so the table is neither sorted nor moved:
    a row's block is a comparison with a few literals. Only rows whose key equals a limit that
    cuts through a group of equal keys are ranked among themselves. The table is written once, with
    its key, as it is read several times.
    """
    limits, total = [], 0
    for size in sizes[:-1]:
        total += size
        limits.append(total)
    n = total + sizes[-1]
    cuts = [r for r in limits if 0 < r < n]
    key = col(key) if isinstance(key, str) else key
    keyed = stage(df.withColumn("_key", key.cast("double")), "keyed")
    found = ranked_values(keyed, {"_key": (F.col("_key"), sorted(set(cuts)))}, kept=True) \
        if cuts else {"_key": []}
    value = {r: v for r, (v, _) in zip(sorted(set(cuts)), found["_key"])}
    below = {r: less for r, (_, less) in zip(value, found["_key"])}
    first = sum(r <= 0 for r in limits)

    def block(position: Column, at: dict[int, float] | None) -> Column:
        starts = [r if at is None else at[r] for r in limits if 0 < r < n]

        def among(low: int, high: int) -> Column:
            """``first`` and the number of starts at or below the position, known to be ``low`` to ``high``."""
            if low == high:
                return F.lit(first + low)
            middle = (low + high) // 2
            return F.when(position < F.lit(starts[middle]), among(low, middle)).otherwise(among(middle + 1, high))

        return F.when(position.isNull(), first).otherwise(among(0, len(starts))).cast("int")

    torn = sorted({value[r] for r in value if below[r] != r})
    if not torn:
        return keyed.withColumn(name, block(F.col("_key"), value)).drop("_key")
    tied = any_of([F.col("_key") == F.lit(v) for v in torn])
    clear = keyed.filter(~tied).withColumn(name, block(F.col("_key"), value))
    start = {value[r]: below[r] for r in value}
    parts = [clear]
    for v in torn:
        group = global_index(keyed.filter(F.col("_key") == F.lit(v)), [F.col("_key")], "_position")
        position = F.col("_position") + F.lit(start[v])
        parts.append(group.withColumn(name, block(position, None)).drop("_position"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.drop("_key")

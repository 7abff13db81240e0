"""Groups of sorted Arrow rows, and connected components by star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.session import stage


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows that agree in the first ``keys`` integer columns of a sorted stream."""
    held: list[pa.RecordBatch] = []

    def key(batch, row):
        return [batch.column(k)[row].as_py() for k in range(keys)]

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        if held and key(held[0], 0) != key(batch, 0):
            yield pa.Table.from_batches(held)
            held = []
        for start, stop in zip(cuts[:-2], cuts[1:-1], strict=True):
            held.append(batch.slice(start, stop - start))
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(cuts[-2]))
    if held:
        yield pa.Table.from_batches(held)


def whole_groups(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """Tables of whole groups of a stream sorted by its first, integer column.

    Small groups come together, about ``limit`` bytes at once; a larger one comes alone.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy(zero_copy_only=False)
        change = np.flatnonzero(key[1:] != key[:-1]) + 1
        if held and size >= limit and held[-1].column(0)[held[-1].num_rows - 1].as_py() != key[0]:
            yield pa.Table.from_batches(held)
            held, size = [], 0
        if size + batch.nbytes >= limit and len(change):
            step = batch.nbytes / batch.num_rows
            at = 0
            for cut in change.tolist():
                if size + (cut - at) * step >= limit or cut == change[-1]:
                    held.append(batch.slice(at, cut - at))
                    yield pa.Table.from_batches(held)
                    held, size, at = [], 0, cut
            batch = batch.slice(at)
            size = int(batch.num_rows * step)
        else:
            size += batch.nbytes
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Smallest member of the component of every node that has an edge: id, root.

    ``edges`` has two long columns a and b. Large-star and small-star steps alternate until
    nothing changes: every step ties neighbours to the smallest one around, so stars form in a
    number of steps that grows with the logarithm of a component's size. Each step is a map-side
    aggregated minimum and one join; its edges are written, which cuts lineage.
    """
    big, small = F.greatest("a", "b"), F.least("a", "b")
    current = stage(edges.where("a <> b").select(big.alias("u"), small.alias("v")).distinct(), name)
    before = None
    while True:
        # large star: larger neighbours of u move to the smallest node around u
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _smallest(both).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").where("v <> m") \
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours of u, and u, move to the smallest of them
        least = _smallest(large)
        moved = large.join(least, "u")
        current = stage(
            moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(moved.select("u", F.col("m").alias("v"))).distinct(), name)
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = current.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return roots.unionByName(current.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())

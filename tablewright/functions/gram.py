"""Cross products of columns, summed per group in one pass over the table."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.columns import anchors, col


@dataclass
class Gram:
    """Count, sums and cross products of columns after subtracting ``shift``."""

    names: list[str]
    shift: np.ndarray
    n: float
    sums: np.ndarray
    cross: np.ndarray

    def __add__(self, other: Gram) -> Gram:
        return Gram(self.names, self.shift, self.n + other.n, self.sums + other.sums,
                    self.cross + other.cross)

    def __sub__(self, other: Gram) -> Gram:
        return Gram(self.names, self.shift, self.n - other.n, self.sums - other.sums,
                    self.cross - other.cross)

    @property
    def means(self) -> np.ndarray:
        return self.shift + self.sums / self.n

    def centred(self) -> np.ndarray:
        """Sum of products of deviations from the means."""
        return self.cross - np.outer(self.sums, self.sums) / self.n


def total(parts: list[Gram]) -> Gram:
    out = parts[0]
    for part in parts[1:]:
        out = out + part
    return out


def grams(df: DataFrame, columns: list[str], group: Column | None = None) -> dict[int, Gram]:
    """One ``Gram`` per group value. A missing cell is an error that names its column.

    Each task multiplies its batches and emits one triangle per group; the triangles are summed
    in a shuffle whose size depends on tasks and columns, not on rows.
    """
    d = len(columns)
    wide = [col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)]
    rows = df.select((group if group is not None else F.lit(0)).cast("int").alias("g"), *wide)
    shift = np.array(anchors(rows, [F.col(f"x{i}") for i in range(d)]))
    upper = np.triu_indices(d + 1)

    def cross(frames):
        import numpy as np
        import pandas as pd

        held: dict = {}
        gaps = np.zeros(d)
        for frame in frames:
            x = frame[[f"x{i}" for i in range(d)]].to_numpy(dtype=float) - shift
            g = frame["g"].to_numpy(dtype=float)
            grouped = ~np.isnan(g)
            x, g = x[grouped], g[grouped].astype(int)
            gaps += np.isnan(x).sum(axis=0)
            z = np.hstack([np.ones((len(x), 1)), x])
            for value in np.unique(g):
                part = z[g == value]
                held[value] = held.get(value, 0.0) + part.T @ part
        if gaps.any():
            yield pd.DataFrame({"g": np.int32(-1), "place": np.arange(d), "v": gaps})
        for value, matrix in held.items():
            yield pd.DataFrame({"g": np.int32(value), "place": np.arange(len(upper[0])),
                                "v": matrix[upper]})

    sums = rows.mapInPandas(cross, "g int, place long, v double") \
        .groupBy("g", "place").agg(F.sum("v").alias("v"))
    out: dict[int, Gram] = {}
    found: dict[int, np.ndarray] = {}
    gaps = np.zeros(d)
    for row in sums.toLocalIterator():
        if row["g"] == -1:
            gaps[row["place"]] = row["v"]
            continue
        found.setdefault(row["g"], np.zeros(len(upper[0])))[row["place"]] = row["v"]
    if gaps.any():
        raise ValueError("columns with missing values: " + ", ".join(
            f"{c} ({n:.0f})" for c, n in zip(columns, gaps) if n))
    for g, flat in found.items():
        full = np.zeros((d + 1, d + 1))
        full[upper] = flat
        full = full + np.triu(full, 1).T
        out[g] = Gram(list(columns), shift, full[0, 0], full[0, 1:], full[1:, 1:])
    return out


def gram(df: DataFrame, columns: list[str]) -> Gram:
    found = grams(df, columns)
    if 0 not in found:
        raise ValueError("no complete row to fit on")
    return found[0]

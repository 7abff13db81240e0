"""Exact quantiles and order statistics by counting prefixes of order-keeping keys.

A double becomes a 64-bit whole number with the same order. What is looked for lies in a window of
keys, at first all of them; a pass cuts every window into at most ``BINS`` equal bins and counts
them, for all columns and ranks at once. The wanted rank falls into one bin, which is the next
window. A bin remembers its smallest and largest key, so the search ends as soon as the bin holds
one value, however often it occurs; four passes are the most. There is one way for all sizes.

The columns are written down once, so that passes neither compute nor join anything again and a
pass over windows skips what lies beside them. A pass moves no rows: tasks add their own batches to
one row of ``BINS`` counts a window, and counts are summed by window and bin.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.columns import any_of, col
from tablewright.session import stage

BINS = 1 << 16
LEAST, MOST = -(1 << 63), (1 << 63) - 1

#: a batch's columns (values, which are there) to, per column, sure and possible members
Judge = Callable[[list[np.ndarray], list[np.ndarray]], list[tuple[np.ndarray, np.ndarray]]]


def keys_of(values: np.ndarray) -> np.ndarray:
    """64-bit whole numbers in the order of the doubles; both zeros have one key."""
    bits = (values + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & MOST)


def value_of(key: int) -> float:
    bits = np.array([key], np.int64)
    return float((bits ^ ((bits >> 63) & MOST)).view(np.float64)[0])


@dataclass(frozen=True)
class Window:
    """Keys from ``low`` to ``high`` of one column, cut into bins of 2^shift keys."""

    column: int
    low: int = LEAST
    high: int = MOST

    @property
    def shift(self) -> int:
        return max(0, (self.high - self.low).bit_length() - (BINS.bit_length() - 1))

    def holds(self, value: Column) -> Column:
        return (value >= F.lit(value_of(self.low))) & (value <= F.lit(value_of(self.high)))


@dataclass
class Tally:
    """Bins of a window that hold anything, in order, and what lies beside it.

    The first column of ``n``, ``below`` and ``above`` counts sure members, the second possible ones.
    """

    n: np.ndarray
    low: np.ndarray
    high: np.ndarray
    below: np.ndarray
    above: np.ndarray

    @property
    def total(self) -> np.ndarray:
        return self.n.sum(axis=0) + self.below + self.above


class _Counts:
    """Counts, smallest and largest keys of the bins of a window; the first and the last bin lie beside it."""

    def __init__(self, low: int, high: int, shift: int, bins: int):
        self.low, self.high, self.shift, self.bins = low, high, shift, bins
        self.n = np.zeros(bins + 2, np.int64)
        self.least, self.most = np.full(bins + 2, MOST), np.full(bins + 2, LEAST)

    def add(self, keys: np.ndarray) -> None:
        """Counts sorted keys."""
        start, stop = np.searchsorted(keys, self.low), np.searchsorted(keys, self.high, side="right")
        inside = (keys[start:stop].view(np.uint64) - np.uint64(self.low & (1 << 64) - 1)) >> np.uint64(self.shift)
        bin_ = np.concatenate([np.zeros(start, np.int64), inside.astype(np.int64) + 1, np.full(len(keys) - stop, self.bins + 1)])
        first = np.flatnonzero(np.r_[True, bin_[1:] != bin_[:-1]])
        last, seen = np.r_[first[1:], len(bin_)], bin_[first]
        self.n[seen] += last - first
        self.least[seen] = np.minimum(self.least[seen], keys[first])
        self.most[seen] = np.maximum(self.most[seen], keys[last - 1])

    def rows(self, number: int, possible: int) -> list[np.ndarray]:
        """The bins that hold anything; -1 and ``bins`` are those beside the window."""
        seen = np.flatnonzero(self.n)
        same = np.ones(len(seen), np.int64)
        return [same * number, seen - 1, same * possible, self.n[seen], self.least[seen], self.most[seen]]


FIELDS = ["window", "bin", "possible", "n", "low", "high"]


def tally(values: DataFrame, windows: list[Window], judge: Judge | None = None) -> list[Tally]:
    """Counts of all windows over the double columns of ``values``, from one pass."""
    by_column: dict[int, list[tuple]] = {}
    for number, window in enumerate(windows):
        by_column.setdefault(window.column, []).append((number, window.low, window.high, window.shift, BINS))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, int], _Counts] = {}
        for batch in batches:
            there = [c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns]
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            classes = judge(columns, there) if judge else [(t, None) for t in there]
            for i, own in by_column.items():
                for possible, chosen in enumerate(classes[i]):
                    keys = np.sort(keys_of(columns[i][chosen & there[i]])) if chosen is not None else ()
                    for number, *window in own if len(keys) else []:
                        if (number, possible) not in counts:
                            counts[number, possible] = _Counts(*window)
                        counts[number, possible].add(keys)
        for at, count in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()) for r in count.rows(*at)], FIELDS)

    counted = values.mapInArrow(task, ", ".join(f"{f} long" for f in FIELDS)).groupBy("window", "bin", "possible") \
        .agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).toArrow()
    rows = np.stack([counted[f].to_numpy() for f in FIELDS]) if counted.num_rows else np.zeros((6, 0), np.int64)
    rows = rows[:, np.lexsort((rows[2], rows[1], rows[0]))]
    out = []
    for number in range(len(windows)):
        own = rows[:, np.searchsorted(rows[0], number):np.searchsorted(rows[0], number, side="right")]
        bins, place = np.unique(own[1], return_inverse=True)
        n = np.zeros((len(bins), 2), np.int64)
        n[place, own[2]] = own[3]
        first = np.searchsorted(own[1], bins)
        low, high = (np.minimum.reduceat(own[4], first), np.maximum.reduceat(own[5], first)) if len(bins) else (own[4], own[5])
        inside = (bins >= 0) & (bins < BINS)
        out.append(Tally(n[inside], low[inside], high[inside], n[bins < 0].sum(axis=0), n[bins >= BINS].sum(axis=0)))
    return out


def as_doubles(df: DataFrame, columns: list[Column]) -> DataFrame:
    return df.select(*[c.cast("double").alias(f"v{i}") for i, c in enumerate(columns)])


def _search(values: DataFrame, ranks: Callable[[int, int], list[int]], columns: int,
            kept: bool) -> list[dict[int, tuple[float, int]]]:
    """Values at the 0-based ranks that ``ranks`` names for (column, number of its values), and how many are less.

    ``kept``: the values come from a table that is written already.
    """
    found: list[dict[int, tuple[float, int]]] = [{} for _ in range(columns)]
    windows = [Window(i) for i in range(columns)]
    values = stage(values, "values") if windows and not kept else values
    tallies = tally(values, windows) if windows else []
    wanted = {w: {r: r for r in ranks(w.column, int(t.total[0]))} for w, t in zip(windows, tallies, strict=True)}
    while windows:
        following: dict[Window, dict[int, int]] = {}
        for window, t in zip(windows, tallies, strict=True):
            ends = np.cumsum(t.n[:, 0])
            for rank, within in wanted[window].items():  # the rank among all, and among the window's rows
                place = int(np.searchsorted(ends, within, side="right"))
                low, high = int(t.low[place]), int(t.high[place])
                before = int(ends[place - 1]) if place else 0
                if low == high:
                    found[window.column][rank] = value_of(low), rank - within + before
                    continue
                following.setdefault(Window(window.column, low, high), {})[rank] = within - before
        windows, wanted = list(following), following
        if windows:
            tallies = tally(values.where(any_of([w.holds(F.col(f"v{w.column}")) for w in windows])), windows)
    return found


def order_statistics(df: DataFrame, wanted: dict[str, tuple[Column, list[int]]]) -> dict[str, list[float]]:
    """Values at the given 0-based ranks of each column's sorted non-null values."""
    return {c: [value for value, _ in found] for c, found in ranked_values(df, wanted).items()}


def ranked_values(df: DataFrame, wanted: dict[str, tuple[Column, list[int]]],
                  kept: bool = False) -> dict[str, list[tuple[float, int]]]:
    """The order statistics, each with the number of values that are less."""
    names = list(wanted)

    def ranks(i: int, n: int) -> list[int]:
        for rank in wanted[names[i]][1]:
            if not 0 <= rank < n:
                raise ValueError(f"rank {rank} outside the {n} values of {names[i]}")
        return wanted[names[i]][1]

    found = _search(as_doubles(df, [wanted[c][0] for c in names]), ranks, len(names), kept)
    return {c: [found[i][rank] for rank in wanted[c][1]] for i, c in enumerate(names)}


def interpolated(position: float, low: float, high: float) -> float:
    """The value at a place between two successive order statistics."""
    if low == high:
        return low
    below = math.floor(position)
    return (below + 1 - position) * low + (position - below) * high


def exact_quantiles(df: DataFrame, columns: dict[str, Column] | list[str],
                    probs: list[float], kept: bool = False) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of every column; ``None`` for a column without values.

    ``kept``: ``df`` is a table that is written already.
    """
    exprs = columns if isinstance(columns, dict) else {c: col(c) for c in columns}
    sizes = [0] * len(exprs)

    def ranks(i: int, n: int) -> list[int]:
        sizes[i] = n
        return sorted({r for p in probs for r in (math.floor((n - 1) * p), math.ceil((n - 1) * p))}) if n else []

    found = _search(as_doubles(df, list(exprs.values())), ranks, len(exprs), kept)
    out: dict[str, list[float | None]] = {}
    for c, n, at in zip(exprs, sizes, found, strict=True):
        places = [(n - 1) * p for p in probs]
        out[c] = [interpolated(x, at[math.floor(x)][0], at[math.ceil(x)][0]) if n else None for x in places]
    return out

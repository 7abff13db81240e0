"""Fences of a sequential outlier filter, for all columns together.

Each column's quartiles are those of the rows that the fences of the columns before it keep. Done
step by step this reads the table several times a column. Here all fences are narrowed at once:

* Every fence is known to lie in a zone. A row outside all zones is surely kept or surely removed
  by a column; a row in a zone may be either, so later columns count it as a possible member.
* One pass counts sure and possible members of every column around its quartiles. Whichever of the
  possible ones stay, the quartiles lie between two bins, which gives a smaller zone.
* The first zones are guessed from the quartiles of the whole table. A guess is proven by the next
  pass: taken in order, a column's new zone holds as long as those before it held. If one did not,
  it is replaced and the pass is repeated, so at least one more column holds each time.

Once all zones hold, only rows with a value in a zone or beside a quartile can still change
anything: they are written, the counts of all others are kept as numbers, and the remaining passes
read these few rows. So the table is read for the guess, for the proof and to write those rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.columns import any_of, col, one_row
from tablewright.functions.quantiles import Tally, Window, as_doubles, interpolated, tally, value_of
from tablewright.session import stage

#: share of the rows that a guess allows the quartiles to move either way
SLACK = 0.03
NEVER = (-math.inf, -math.inf, math.inf, math.inf)  # fences that no value is outside of


@dataclass
class _Rank:
    """An order statistic next to a quartile: the window that holds it, and rows no longer read."""

    window: Window
    prob: float
    up: bool
    below: np.ndarray
    above: np.ndarray

    def rank(self, n: np.ndarray) -> np.ndarray:
        position = (np.maximum(n, 1) - 1) * self.prob
        return np.ceil(position) if self.up else np.floor(position)

    def narrow(self, t: Tally, slack: float = 0.0) -> Window | None:
        """Where the statistic can lie; ``None`` if it may lie beside the window.

        With ``slack`` the rank may be off by that share of the rows.
        """
        below, above = t.below + self.below, t.above + self.above
        sure, possible = t.n.sum(axis=0) + below + above
        upto = np.cumsum(t.n, axis=0) + below
        # least place: all possible members up to a bin count, and none above it
        least = upto.sum(axis=1) >= self.rank(sure + upto[:, 1]) + 1 - slack * sure
        # last place: no possible member below a bin counts, and all others do
        before = upto - t.n
        last = before[:, 0] <= self.rank(sure + possible - before[:, 1]) + slack * sure
        if not len(t.n) or not least.any() or not last.any():
            return None
        out_below = below.sum() >= self.rank(sure + below[1]) + 1 and below.sum() > 0
        out_above = above.sum() > 0 and sure - above[0] <= self.rank(sure + above[1])
        if (out_below or out_above) and not slack:
            return None
        first, final = int(np.argmax(least)), int(np.flatnonzero(last)[-1])
        return replace(self.window, low=int(t.low[min(first, final)]), high=int(t.high[max(first, final)]))


def _zone(ranks: list[_Rank], total: np.ndarray, factor: float) -> tuple[float, float, float, float]:
    """Least and greatest lower fence, least and greatest upper fence."""
    sure, possible = int(total[0]), int(total[1])
    if not sure + possible:
        return NEVER
    ends = []
    for floor, ceil in (ranks[:2], ranks[2:]):
        low, high = (value_of(floor.window.low), value_of(ceil.window.low)), (value_of(floor.window.high), value_of(ceil.window.high))
        if possible:  # the place between the two statistics is open
            ends.append((low[0] - 4 * math.ulp(low[0]), high[1] + 4 * math.ulp(high[1])) if low[0] != high[1] else (low[0], high[1]))
        else:
            ends.append((interpolated((sure - 1) * floor.prob, *low), interpolated((sure - 1) * floor.prob, *high)))
    (a1, b1), (a3, b3) = ends
    zone = (a1 - factor * (b3 - a1), b1 - factor * (a3 - b1), a3 + factor * (a3 - b1), b3 + factor * (b3 - a1))
    return zone if sure else (-math.inf, zone[1], zone[2], math.inf)  # without members there would be no fence


def _judge(zones: list[tuple[float, float, float, float]]):
    """Per column, the rows that the columns before it surely or possibly keep."""
    def judge(columns, there):
        sure = np.ones(len(there[0]), bool)
        possible = np.zeros(len(sure), bool)
        out = []
        for x, known, (a, b, c, d) in zip(columns, there, zones):
            out.append((sure, possible))
            outside = known & ~((x >= a) & (x <= d))
            inside = ~known | (x >= b) & (x <= c)
            possible = possible & ~outside | sure & ~outside & ~inside
            sure = sure & inside
        return out

    return judge


def _within(value: Column, low: float, high: float) -> Column:
    return (value >= F.lit(low)) & (value <= F.lit(high))


def _inside(zone, assumed) -> bool:
    return assumed[0] <= zone[0] and zone[1] <= assumed[1] and assumed[2] <= zone[2] and zone[3] <= assumed[3]


def _beside(t: Tally, window: Window) -> tuple[np.ndarray, np.ndarray]:
    """Members below and above a window whose ends are ends of the tally's bins."""
    return t.below + t.n[t.high < window.low].sum(axis=0), t.above + t.n[t.low > window.high].sum(axis=0)


def sequential_fences(df: DataFrame, names: list[str], factor: float,
                      slack: float = SLACK) -> dict[str, tuple[float, float] | None]:
    """Lower and upper fence of every column, ``None`` for one that has no values left.

    ``slack`` only decides how good the first guess is, never the result.
    """
    values = as_doubles(df, [col(c) for c in names])
    everywhere = [Window(i) for i in range(len(names))]
    none = np.zeros(2, np.int64)
    ranks, zones = [], []
    for window, t in zip(everywhere, tally(values, everywhere) if names else [], strict=True):
        own = [_Rank(window, p, up, none, none) for p in (0.25, 0.75) for up in (False, True)]
        if t.total.any():
            own = [replace(r, window=r.narrow(t, slack)) for r in own]
        ranks.append(own)
        zones.append(_zone(own, t.total, factor))
    few = False  # whether ``values`` holds only the rows that still matter
    while names:
        windows = list(dict.fromkeys(r.window for own in ranks for r in own))
        tallies = dict(zip(windows, tally(values, windows, _judge(zones)), strict=True))
        assumed, held = list(zones), True
        previous = [[r.window for r in own] for own in ranks]
        for i, own in enumerate(ranks):
            total = tallies[own[0].window].total + own[0].below + own[0].above
            found = [r.narrow(tallies[r.window]) if total.any() else r.window for r in own]
            if None in found:  # the guessed window was wrong: look everywhere in the next pass
                ranks[i] = [replace(r, window=everywhere[i]) for r in own]
                held = False
                continue
            ranks[i] = [replace(r, window=w) for r, w in zip(own, found, strict=True)]
            zones[i] = _zone(ranks[i], total, factor)
            held = held and _inside(zones[i], assumed[i])
        if not held:
            continue
        if all(a == b and c == d for a, b, c, d in zones):
            break
        if not few:
            few = True
            matters = [(F.col(f"v{i}") >= F.lit(ends[0])) & (F.col(f"v{i}") <= F.lit(ends[1]))
                       for i, z in enumerate(assumed) for ends in (z[:2], z[2:]) if z != NEVER]
            now = list(dict.fromkeys(r.window for own in ranks for r in own))
            matters += [w.holds(F.col(f"v{w.column}")) for w in now]
            values = stage(values.where(any_of(matters)), "fences")
            # rows left out are in no zone, so they are surely kept or surely removed by then
            rest = dict(zip(now, tally(values, now, _judge(assumed)), strict=True))
            for own, read in zip(ranks, previous, strict=True):
                for r, window in zip(own, read, strict=True):
                    beside = _beside(tallies[window], r.window)
                    r.below, r.above = beside[0] - rest[r.window].below, beside[1] - rest[r.window].above
    return {c: None if z == NEVER else (z[0], z[2]) for c, z in zip(names, zones, strict=True)}


#: deviations from the mean within which a row is taken to be kept by a z-score filter
INNER = 2.5


def sequential_zscores(df: DataFrame, names: list[str], limit: float, inner: float = INNER) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of every column among the rows that the columns before it keep.

    A column keeps what lies within ``limit`` deviations. Rows that are near the mean in all columns
    are surely kept, so their sums are taken once; the few others are written, and each column's
    sums over those still left are added. If a column's limits turn out to cut into the rows taken
    as kept, these were too many, and it starts again with fewer. Columns that are constant by then
    are left out.
    """
    values = as_doubles(df, [col(c) for c in names])
    width = range(len(names))
    first = one_row(values, [f(f"v{i}") for i in width for f in (F.avg, F.stddev_pop)])
    origin, spread = [m or 0.0 for m in first[::2]], [s or 0.0 for s in first[1::2]]

    def gap(i: int) -> Column:
        return F.col(f"v{i}") - F.lit(origin[i])

    def sums(i: int) -> list[Column]:
        return [F.count(f"v{i}"), F.sum(gap(i)), F.sum(gap(i) * gap(i))]

    while names:
        far = any_of([F.col(f"v{i}").isNotNull() & ~(F.abs(gap(i)) <= F.lit(inner * spread[i])) for i in width])
        near = one_row(values.where(~far), [s for i in width for s in sums(i)]) if inner >= 0 else [0] * (3 * len(names))
        rest = stage(values.where(far) if inner >= 0 else values, "far")
        found: dict[str, tuple[float, float]] = {}
        for i, c in enumerate(names):
            n, shift, square = ((a or 0) + (b or 0) for a, b in zip(near[3 * i:3 * i + 3], one_row(rest, sums(i)), strict=True))
            if not n:
                continue
            mean = origin[i] + shift / n
            std = math.sqrt(max(square / n - (shift / n) ** 2, 0.0))
            if not std or std < 1e-12 * spread[i]:
                continue
            found[c] = (mean, std)
            reach = limit * std - abs(mean - origin[i])
            if inner >= 0 and reach < inner * spread[i]:
                inner = 0.9 * reach / spread[i] if reach > 0 else -1.0
                break
            rest = rest.where(~F.coalesce(F.abs((F.col(f"v{i}") - F.lit(mean)) / F.lit(std)) > F.lit(float(limit)), F.lit(False)))
        else:
            return found
    return {}

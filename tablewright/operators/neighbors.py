"""Exact nearest neighbours by a tree of boxes.

Donors are collapsed to distinct rows with a copy count and put in an order that keeps close ones
together: by their missing columns, then by the interleaved bits of their values in one common
unit, so that a column counts for as much as it adds to the distance. ``LEAF`` successive donors
with the same missing columns are a leaf, ``FAN`` successive leaves a node, and so on: the tree has
as many levels as the donors need and each level is a table of boxes. Queries are ordered the same
way and taken in blocks of successive ones.

(block, node) pairs go down level by level as joins with the next table. A pair stays if its box
can hold anything nearer than the block's limit, the distance at which its queries surely have k
donors; the first descent keeps only the few most promising nodes and finds that limit. What is
left are (block, leaf) pairs. ``AREA`` successive blocks and ``CHUNK`` successive leaves are a tile:
a block or leaf is sent once to every tile that has a pair of it, not once for every pair, and a task
compares the pairs of its tile block by block. One way for all sizes.

A query that lacks one of the widest columns is badly served by an order ruled by it. There is an
order of its own for every subset of the ``WIDE`` widest columns that queries lack.

Distance: Euclidean over the columns present on both sides, scaled by columns / shared columns.
Ties go to the smaller value, which makes the result independent of row order.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.columns import all_of, any_of, col, numeric_columns, one_row
from tablewright.functions.ranking import global_index
from tablewright.session import compiled, stage

LEAF, FAN = 64, 16
#: queries of a block, and leaves a limit is taken from
BLOCK, BEAM = 256, 4
#: blocks and leaves of a tile
AREA, CHUNK = 32, 512
WIDE = 3
#: tasks for each core in a comparison at least, and tiles of a task at most
PARTS = 8
#: bits of a value in the common unit
BITS = 32
#: nodes of a tree's top level at most
TOP = 64


@dataclass(frozen=True)
class _Space:
    """The columns f0.. as one space with a common unit."""

    p: int
    low: list[float]
    unit: float
    depth: list[int]  # bits that the column's range takes
    wide: list[int]   # columns whose lack calls for another order

    def lacks(self) -> Column:
        """Number of the order that serves a query."""
        return reduce(add, [F.when(F.col(f"f{i}").isNull(), 1 << b).otherwise(0) for b, i in enumerate(self.wide)],
                      F.lit(0)).cast("long")

    def pattern(self) -> Column:
        return F.xxhash64(*[F.col(f"f{i}").isNull() for i in range(self.p)])

    def codes(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``code``: order number, missing columns and interleaved bits."""
        def task(frames):
            for frame in frames:
                x = frame[[f"f{i}" for i in range(self.p)]].to_numpy(dtype=float)
                tree = frame["tree"].to_numpy()
                missing = np.isnan(x)
                with np.errstate(over="ignore", invalid="ignore"):
                    steps = np.clip((x - self.low) / self.unit, 0, 2.0 ** BITS - 1)
                steps = np.where(missing, 0, steps).astype(np.uint64)
                for b, i in enumerate(self.wide):
                    steps[(tree >> b & 1) > 0, i] = 0
                bits = [steps[:, i] >> np.uint64(b) & np.uint64(1)
                        for b in range(BITS - 1, -1, -1) for i in range(self.p) if self.depth[i] > b]
                parts = [tree.astype(np.uint8)[:, None], np.packbits(missing, axis=1)]
                if bits:
                    parts.append(np.packbits(np.stack(bits, axis=1).astype(np.uint8), axis=1))
                code = np.ascontiguousarray(np.concatenate(parts, axis=1))
                yield frame.assign(code=[r.tobytes() for r in code])

        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        return rows.mapInPandas(task, f"{fields}, code binary")


def _space(donors: DataFrame, p: int) -> _Space:
    facts = one_row(donors, [f(f"f{i}") for i in range(p) for f in (F.min, F.max, F.var_pop)])
    low, high, spread = ([x if x is not None and math.isfinite(x) else 0.0 for x in facts[j::3]] for j in range(3))
    ranges = [max(h - a, 0.0) if math.isfinite(h - a) else 1.7e308 for a, h in zip(low, high)]
    unit = (max(ranges) or 1.0) / 2.0 ** BITS or 5e-324
    depth = [min(BITS, max(0, math.frexp(r / unit)[1])) for r in ranges]
    wide = [int(i) for i in np.argsort([-s for s in spread], kind="stable")[:WIDE] if spread[i] > 0]
    return _Space(p, low, unit, depth, wide)


def _number(*columns: str) -> Column:
    return F.xxhash64(*columns)


def _sums(p: int, term) -> Column:
    return reduce(add, [term(i) for i in range(p)])


def _tree(donors: DataFrame, space: _Space, trees: list[int], lends: list[int | None]) -> tuple[DataFrame, list[tuple[DataFrame, int]]]:
    """Donors with their leaf, and the box tables from the leaves up with their number of nodes."""
    each = donors.withColumn("tree", F.explode(F.array(*[F.lit(t).cast("long") for t in trees])))
    placed = global_index(space.codes(each), [F.col("code")], "place").withColumn("pattern", space.pattern()) \
        .withColumn("up", F.floor(F.col("place") / LEAF)).withColumn("field", F.floor(F.col("place") / (LEAF * CHUNK)))
    leaves = stage(placed.withColumn("node", _number("up", "tree", "pattern")).drop("code", "place", "pattern"), "knn-donors")
    p = space.p
    box = [f(F.col(f"f{i}")).alias(f"{n}{i}") for i in range(p) for n, f in (("lo", F.min), ("hi", F.max))]
    box += [(F.count(f"f{i}") == F.count(F.lit(1))).alias(f"full{i}") for i in range(p)]
    able = [F.coalesce(F.sum(F.when(F.col(f"v{j}" if i is None else f"f{i}").isNotNull(), F.col("m"))), F.lit(0)).alias(f"able{j}")
            for j, i in enumerate(lends)]
    level = stage(leaves.groupBy("tree", "up", "node").agg(*box, *able), "knn-boxes")
    count = level.count()
    levels = [(level.withColumnRenamed("up", "parent"), count)]
    merged = [F.min(f"lo{i}").alias(f"lo{i}") for i in range(p)] + [F.max(f"hi{i}").alias(f"hi{i}") for i in range(p)] \
        + [F.bool_and(f"full{i}").alias(f"full{i}") for i in range(p)] + [F.sum(f"able{j}").alias(f"able{j}") for j in range(len(lends))]
    while True:
        level = stage(level.withColumn("node", F.col("up")).withColumn("up", F.floor(F.col("up") / FAN))
                      .groupBy("tree", "up", "node").agg(*merged), "knn-boxes")
        most = level.groupBy("tree").count().agg(F.max("count"), F.sum("count")).first()
        levels.append((level.withColumnRenamed("up", "parent"), most[1] or 0))
        if (most[0] or 0) <= TOP:
            return leaves, levels


def _blocks(queries: DataFrame, space: _Space) -> DataFrame:
    """Queries with ``block``: successive ones with the same missing columns."""
    coded = space.codes(queries.withColumn("tree", space.lacks()))
    return stage(global_index(coded, [F.col("code")], "place").withColumn("pattern", space.pattern())
                 .withColumn("block", _number(F.floor(F.col("place") / BLOCK), "tree", "pattern"))
                 .withColumn("area", F.floor(F.col("place") / (BLOCK * AREA)))
                 .drop("code", "place", "pattern"), "knn-queries")


def _boxed(queries: DataFrame, p: int, lends: list[int | None], limits: list[Column]) -> DataFrame:
    """Boxes of the blocks, the values they ask for and their limits."""
    ends = [f(F.col(f"f{i}")).alias(f"{n}{i}") for i in range(p) for n, f in (("from", F.min), ("to", F.max))]
    asks = [(F.lit(True) if i is None else F.max(f"f{i}").isNull()).alias(f"asks{j}") for j, i in enumerate(lends)]
    return stage(queries.groupBy("tree", "block").agg(*ends, *asks, *limits), "knn-blocks")


def _bounds(p: int) -> tuple[Column, Column]:
    """Least and greatest possible square distance between a block and a box."""
    def has(i):
        return F.col(f"from{i}").isNotNull()

    def gap(i):
        return F.greatest(F.col(f"lo{i}") - F.col(f"to{i}"), F.col(f"from{i}") - F.col(f"hi{i}"), F.lit(0.0))

    def reach(i):
        return F.greatest(F.col(f"to{i}") - F.col(f"lo{i}"), F.col(f"hi{i}") - F.col(f"from{i}"))

    def square(x):
        return x * x

    full = [has(i) & F.col(f"full{i}") for i in range(p)]
    some = [has(i) & F.col(f"lo{i}").isNotNull() for i in range(p)]
    most = _sums(p, lambda i: F.when(some[i], 1).otherwise(0))
    least = _sums(p, lambda i: F.when(full[i], 1).otherwise(0))
    near = _sums(p, lambda i: F.when(full[i], square(gap(i))).otherwise(0.0))
    far = _sums(p, lambda i: F.when(some[i], square(reach(i))).otherwise(0.0))
    return F.when(most > 0, near * (F.lit(float(p)) / most)), F.when(least > 0, far * (F.lit(float(p)) / least))


def _descend(blocks: DataFrame, levels: list[tuple[DataFrame, int]], p: int, values: int, keep) -> DataFrame:
    """(block, leaf) pairs that ``keep`` leaves over at every level, from the top."""
    near, far = _bounds(p)
    pairs, parts = None, PARTS * blocks.sparkSession.sparkContext.defaultParallelism
    compiled(blocks.sparkSession)
    for boxes, count in reversed(levels):
        if pairs is None:  # at most TOP nodes a tree
            met = blocks.repartition(parts).join(F.broadcast(boxes), "tree")  # few rows, but each meets many nodes
        else:
            few = F.broadcast(boxes) if count <= TOP * FAN else boxes
            met = pairs.repartition(parts).withColumnRenamed("node", "parent").join(few, ["tree", "parent"])
        met = met.withColumn("near", near).withColumn("far", far)
        pairs = stage(keep(met).select(*blocks.columns, "node"), "knn-pairs")
    return pairs


def _wanted(j: int) -> Column:
    return F.col(f"asks{j}") & (F.col(f"able{j}") > 0)


def _promising(values: int):
    """Keeps the nearest nodes of each block for each value it asks for."""
    def keep(met: DataFrame) -> DataFrame:
        asked = F.array_compact(F.array(*[F.when(_wanted(j), F.lit(j)) for j in range(values)]))
        order = Window.partitionBy("block", "target").orderBy((F.col("near") + F.col("far")).asc_nulls_last(), "near", "node")
        near = met.where("near is not null").withColumn("target", F.explode(asked)).withColumn("place", F.row_number().over(order))
        return near.where(F.col("place") <= BEAM).dropDuplicates(["block", "node"])

    return keep


def _possible(values: int):
    """Keeps the nodes that can hold anything within the limit of a value that the block asks for."""
    # one comparison with the widest limit, as every mention of ``near`` is computed anew
    each = [F.when(_wanted(j), F.coalesce(F.col(f"limit{j}") * (1 + 1e-9), F.lit(float("inf")))) for j in range(values)]
    widest = F.greatest(*each) if values > 1 else each[0]

    def keep(met: DataFrame) -> DataFrame:
        return met.where(F.col("near") <= widest)

    return keep


FOUND = "qid long, target int, square double, value double, m long"


def _packed(rows: DataFrame, key: list[str]) -> DataFrame:
    """One row for each key with its rows as an array for each column, NaN for what they lack."""
    return rows.groupBy(*key).agg(*[
        F.collect_list(F.coalesce(F.col(c), F.lit(float("nan"))) if kind == "double" else F.col(c)).alias(c)
        for c, kind in rows.dtypes if c not in key])


def _compare(pairs: DataFrame, queries: DataFrame, leaves: DataFrame, p: int, k: int,
             lends: list[int | None]) -> DataFrame:
    """The k nearest donors of each (query, value) among the leaves paired with its block.

    A group is a tile: ``AREA`` blocks and ``CHUNK`` leaves at most, each once.
    """
    blocks = _packed(queries.drop("tree"), ["block", "area"])
    boxes = stage(_packed(leaves.drop("tree", "up"), ["node", "field"]), "knn-leaves")
    areas, fields = queries.select("block", "area").distinct(), boxes.select("node", "field")
    dealt = stage(pairs.select("block", "node").join(areas, "block").join(fields, "node"), "knn-dealt")
    asked = dealt.groupBy("block", "area", "field").agg(F.collect_list("node").alias("nodes"))
    left = blocks.drop("area").join(asked, "block")
    left = left.toDF(*left.columns)  # both sides stem from the pairs; renaming tells their keys apart
    right = dealt.select("area", "node").distinct().join(boxes, "node")
    right = right.toDF(*right.columns)
    match = _matcher(p, k, lends)
    # a tile is little data and much work, so tiles are dealt by number, not by size
    tiles, cores = asked.select("area", "field").distinct().count(), queries.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(tiles, max(PARTS * cores, tiles // PARTS)))
    left, right = (side.repartition(parts, "area", "field") for side in (left, right))

    def nearest(queries, lenders):
        import pandas as pd

        names = [c for c in lenders.columns if c not in ("area", "field", "node")]
        own = [c for c in queries.columns if c not in ("area", "field", "block", "nodes")]
        place = {node: i for i, node in enumerate(lenders["node"].tolist())}
        held = {c: lenders[c].to_numpy() for c in names}
        out = []
        for i, nodes in enumerate(queries["nodes"]):
            at = [place[n] for n in nodes]
            some = pd.DataFrame({c: np.concatenate(list(held[c][at])) for c in names})
            out.append(match(pd.DataFrame({c: queries[c].iloc[i] for c in own}), some))
        return pd.concat(out, ignore_index=True) if out else match(*_no_rows(p, len(lends)))

    near = left.groupBy("area", "field").cogroup(right.groupBy("area", "field")).applyInPandas(nearest, FOUND)
    return _closest(near, k)


def _no_rows(p: int, values: int):
    import pandas as pd

    names = [*[f"f{i}" for i in range(p)], *[f"v{j}" for j in range(values)]]
    empty = pd.DataFrame({c: np.zeros(0) for c in names})
    return empty.assign(qid=np.zeros(0, np.int64)), empty.assign(m=np.zeros(0, np.int64))


#: queries and donors compared at once, few enough to stay in a core's cache
TILE = (256, 1024)
#: share of the squares by which a product of matrices is lowered, far above its rounding error
SLACK = 1e-12
#: values whose squares a product of matrices can hold
LARGE = 1e100


def _nearest_few(rows: list[tuple], k: int) -> tuple:
    """Of (query, square, value, copies) the k nearest donors of each query."""
    query, square, value, copies = map(np.concatenate, zip(*rows))
    order = np.lexsort((value, square, query))
    first = np.r_[True, query[order][1:] != query[order][:-1]] if len(order) else np.zeros(0, bool)
    place = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    order = order[place < k]
    return query[order], square[order], value[order], copies[order]


def _candidates(q: np.ndarray, d: np.ndarray, there: np.ndarray, p: int, k: int, limits: dict[int, np.ndarray],
                able: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(query, donor) numbers for each value, among which are all of the k nearest within the limit.

    Squares come from one product of matrices around the middle of the queries, lowered by more
    than it can err; who asks computes those of the few candidates again.
    """
    middle = q.min(axis=0) / 2 + q.max(axis=0) / 2
    a, b = q - middle, np.where(there, d - middle, 0.0)
    if not (np.abs(a).max(initial=0.0) < LARGE and np.abs(b).max(initial=0.0) < LARGE):
        return {j: (np.repeat(np.arange(len(q)), can.sum()), np.tile(np.flatnonzero(can), len(q))) for j, can in able.items()}
    low, ones = 1 - SLACK, np.ones((len(a), 1))
    if there.all():
        left, right = [-2 * a, low * (a * a).sum(axis=1)[:, None], ones], [b, np.ones((len(b), 1)), low * (b * b).sum(axis=1)[:, None]]
    else:
        left, right = [-2 * a, low * a * a, ones], [b, there, low * (b * b).sum(axis=1)[:, None]]
    total = np.hstack(left) @ (np.hstack(right) * (p / there.sum(axis=1))[:, None]).T
    out, size = {}, len(d)
    for j, can in able.items():
        near = (total <= limits[j][:, None]) & can
        if can.sum() > k and np.count_nonzero(near) > 4 * k * len(q):
            # k donors are within the k-th least square, whatever their copies
            columns = np.flatnonzero(can)
            at = columns[np.argpartition(total[:, columns], k - 1, axis=1)[:, :k]]
            far = np.take_along_axis(total, at, axis=1).max(axis=1)
            error = 4 * SLACK * p * ((a * a).sum(axis=1) + (b * b).sum(axis=1)[at].max(axis=1))
            near &= total <= (np.maximum(far, 0.0) + error)[:, None]
        out[j] = np.divmod(np.flatnonzero(near), size)
    return out


def _matcher(p: int, k: int, lends: list[int | None]):
    """Function that finds, among some donors, the k nearest of each (query, value) within its limit."""

    def match(queries, lenders):
        import pandas as pd

        names = [f"f{i}" for i in range(p)]
        q, d = queries[names].to_numpy(dtype=float), lenders[names].to_numpy(dtype=float)
        copies = lenders["m"].to_numpy()
        lent = [lenders[f"v{j}"].to_numpy(dtype=float) if lend is None else d[:, lend] for j, lend in enumerate(lends)]
        limits = [queries[f"limit{j}"].fillna(np.inf).to_numpy(dtype=float) if f"limit{j}" in queries
                  else np.full(len(q), np.inf) for j in range(len(lends))]
        found: dict[int, list[tuple]] = {}
        lacks, kind = np.unique(np.isnan(q), axis=0, return_inverse=True)
        for number, missing in enumerate(lacks if len(d) else []):  # queries of a block lack the same columns
            rows = np.flatnonzero(kind.reshape(-1) == number)
            wanted = [j for j, lend in enumerate(lends) if lend is None or missing[lend]]
            has = np.flatnonzero(~missing)
            for at in range(0, len(rows), TILE[0]):
                own = rows[at:at + TILE[0]]
                # near donors first, so that the limits are soon as tight as they get
                there = ~np.isnan(d[:, has])
                shared = there.sum(axis=1)
                with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
                    away = d[:, has] - (q[own][:, has].min(axis=0) / 2 + q[own][:, has].max(axis=0) / 2)
                    order = np.argsort(np.where(there, away * away, 0.0).sum(axis=1) / shared, kind="stable")
                order = order[shared[order] > 0]
                bounds = {j: limits[j][own] for j in wanted}
                best: dict[int, list[tuple]] = {j: [] for j in wanted}
                for start in range(0, len(order), TILE[1]):
                    some = order[start:start + TILE[1]]
                    able = {j: ~np.isnan(lent[j][some]) for j in wanted}
                    near = _candidates(q[own][:, has], d[some][:, has], there[some], p, k, bounds, able)
                    for j, (x, y) in near.items():
                        total = np.zeros(len(x))
                        for c in has:  # as exact as the limits, column by column
                            both = ~np.isnan(d[some[y], c])
                            gap = q[own[x], c] - np.where(both, d[some[y], c], 0.0)
                            total += gap * gap * both
                        total *= p / shared[some[y]]
                        kept = total <= bounds[j][x]
                        x, y, total = x[kept], some[y[kept]], total[kept]
                        best[j].append((x, total, lent[j][y], copies[y]))
                        if sum(len(r[0]) for r in best[j]) > 2 * k * len(own):
                            best[j] = [_nearest_few(best[j], k)]
                            seen = np.bincount(best[j][0][0], minlength=len(own))
                            far = np.zeros(len(own))
                            np.maximum.at(far, best[j][0][0], best[j][0][1])
                            bounds[j] = np.where(seen >= k, np.minimum(bounds[j], far), bounds[j])
                for j, parts in best.items():
                    x, *others = _nearest_few(parts, k) if parts else (np.zeros(0, int),) * 4
                    found.setdefault(j, []).append((own[x], *others))
        out = []
        for j, rows in found.items():
            x, square, value, m = _nearest_few(rows, k)
            out.append(pd.DataFrame({"qid": queries["qid"].to_numpy()[x], "target": np.full(len(x), j, np.int32),
                                     "square": square, "value": value, "m": m}))
        empty = pd.DataFrame({"qid": np.zeros(0, np.int64), "target": np.zeros(0, np.int32), "square": np.zeros(0),
                              "value": np.zeros(0), "m": np.zeros(0, np.int64)})
        return pd.concat(out, ignore_index=True) if out else empty

    return match


def _closest(near: DataFrame, k: int) -> DataFrame:
    """The k nearest of all candidates of each (query, value), copies counted."""
    w = Window.partitionBy("qid", "target").orderBy("square", "value")
    top = near.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k)
    before = F.coalesce(F.sum("m").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return top.withColumn("used", F.least(F.col("m"), F.lit(k) - before)).filter("used > 0")


def nearest(queries: DataFrame, donors: DataFrame, p: int, k: int, lends: list[int | None]) -> DataFrame:
    """The k nearest donors of every query, per lent value.

    ``queries``: ``qid, f0..`` and ``donors``: ``f0.., m``. ``lends[j]`` is the feature that value j
    is, asked for by queries that lack it, or ``None`` if it is the donors' ``v{j}`` and all ask. Result: ``qid, target, square,
    value, used`` where ``used`` counts the copies that belong to the k nearest.
    """
    values, space = len(lends), _space(donors, p)
    placed = _blocks(queries, space)
    trees = sorted(r.tree for r in placed.select("tree").distinct().collect())  # 2^WIDE at most
    if not trees:
        return queries.sparkSession.createDataFrame([], FOUND + ", place int, used long")
    leaves, levels = _tree(donors, space, trees, lends)
    blocks = _boxed(placed, p, lends, [])
    first = stage(_compare(_descend(blocks, levels, p, values, _promising(values)), placed, leaves, p, k, lends), "knn-first")
    # the distance within which a query surely has k donors, null while it has not
    reach = first.groupBy("qid").agg(*[
        F.when(F.sum(F.when(F.col("target") == j, F.col("used"))) >= k, F.max(F.when(F.col("target") == j, F.col("square"))))
        .alias(f"limit{j}") for j in range(values)])
    limited = stage(placed.join(reach, "qid", "left"), "knn-limited")
    limits = [F.when(F.count(f"limit{j}") == F.count(F.lit(1)), F.max(f"limit{j}")).alias(f"limit{j}") for j in range(values)]
    blocks = _boxed(limited, p, lends, limits)
    return _compare(_descend(blocks, levels, p, values, _possible(values)), limited, leaves, p, k, lends)


def knn_impute(df: DataFrame, k: int = 5, columns: list[str] | None = None) -> DataFrame:
    """Fill numeric gaps with the mean over the k nearest rows that have the value."""
    names = numeric_columns(df)
    targets = [c for c in names if columns is None or c in columns]
    if not targets:
        return df
    wide = [col(c).cast("double").alias(f"f{i}") for i, c in enumerate(names)]
    fs = [f"f{i}" for i in range(len(names))]
    profiles = stage(df.select(*wide).groupBy(*fs).agg(F.count(F.lit(1)).alias("m"))
                     .withColumn("qid", F.monotonically_increasing_id()), "knn-profiles")
    lends = [names.index(c) for c in targets]
    donors = profiles.select(*fs, "m")
    gaps = any_of([F.col(f"f{i}").isNull() for i in lends])
    queries = profiles.filter(gaps).select("qid", *fs)
    means = one_row(df, [F.avg(col(c)) for c in targets])
    top = nearest(queries, donors, len(names), k, lends)
    found = top.groupBy("qid").agg(*[
        (F.sum(F.when(F.col("target") == j, F.col("value") * F.col("used")))
         / F.sum(F.when(F.col("target") == j, F.col("used")))).alias(f"n{j}")
        for j in range(len(lends))])
    filled = profiles.filter(gaps).join(found, "qid", "left").select(
        *[F.col(f).alias(f"key_{f}") for f in fs],
        *[F.coalesce(F.col(f"f{i}"), F.col(f"n{j}"), F.lit(means[j])).alias(f"filled{j}")
          for j, i in enumerate(lends)])
    rows = df.select("*", *wide)
    hole = any_of([F.col(f"f{i}").isNull() for i in lends])
    same = all_of([F.col(f).eqNullSafe(F.col(f"key_{f}")) for f in fs])
    position = {c: j for j, c in enumerate(targets)}
    patched = rows.filter(hole).join(filled, same).select(*[
        F.col(f"filled{position[c]}").alias(c) if c in position else col(c) for c in df.columns])
    whole = rows.filter(~hole).select(*[
        col(c).cast("double").alias(c) if c in position else col(c) for c in df.columns])
    return whole.unionByName(patched)


def knn_predict(train: DataFrame, new: DataFrame, features: list[str], label: str, k: int = 5,
                weights: str = "uniform", output: str = "prediction") -> DataFrame:
    """Mean label of the k nearest training rows, plain or weighted by inverse distance."""
    if weights not in ("uniform", "distance"):
        raise ValueError(f"unknown weights: {weights}")
    fs = [f"f{i}" for i in range(len(features))]
    wide = [col(c).cast("double").alias(f) for c, f in zip(features, fs)]
    donors = stage(train.select(*wide, col(label).cast("double").alias("v0"))
                   .groupBy(*fs, "v0").agg(F.count(F.lit(1)).alias("m")), "knn-train")
    queries = stage(new.select(*wide).distinct()
                    .withColumn("qid", F.monotonically_increasing_id()), "knn-queries")
    top = nearest(queries, donors, len(fs), k, [None])
    if weights == "distance":
        exact = F.max(F.when(F.col("square") == 0, 1).otherwise(0)) \
            .over(Window.partitionBy("qid"))
        top = top.withColumn("exact", exact).withColumn("w", F.when(
            F.col("exact") == 1, F.when(F.col("square") == 0, F.lit(1.0)).otherwise(0.0))
            .otherwise(1 / F.sqrt("square")))
    else:
        top = top.withColumn("w", F.lit(1.0))
    found = top.groupBy("qid").agg(
        (F.sum(F.col("value") * F.col("used") * F.col("w"))
         / F.sum(F.col("used") * F.col("w"))).alias(output))
    answers = queries.join(found, "qid").select(*[F.col(f).alias(f"key_{f}") for f in fs], output)
    same = all_of([F.col(f).eqNullSafe(F.col(f"key_{f}")) for f in fs])
    return new.select("*", *wide).join(answers, same, "left").drop(
        *fs, *[f"key_{f}" for f in fs])

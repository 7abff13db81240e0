"""Nearest neighbours by cosine through robust-pruned directed graphs, one for each shard.

Equal vectors are one node, which keeps its smallest ids; no answer needs more. Nodes are dealt to
shards of bounded size by a hash. A shard's graph is built in batches: greedy searches from a
central node propose neighbours, and pruning keeps a candidate only if no kept one is closer to it
by the factor ``alpha``, so that edges point in diverse directions; edges are made both ways.
Queries walk every shard with a beam, in blocks, and their best rows are merged. Walks use float32
directions; the score of what they find is the cosine of the original vectors in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.graph import groups
from tablewright.session import stage

#: nodes of a shard, on average
SHARD = 4_096
DEGREE, BEAM, ALPHA = 24, 64, 1.2
#: candidates opened in one step of a walk
WIDTH = 4
BATCH = 256
#: queries that a task holds beside a shard
BLOCK = 4 * BATCH


class Graph:
    """A directed graph over the rows of a matrix of unit vectors."""

    def __init__(self, x: np.ndarray, seed: int = 1):
        self.x = np.ascontiguousarray(x, np.float32)
        n = len(x)
        self.degree = min(DEGREE, n - 1)
        rng = np.random.default_rng(seed)
        self.out = np.full((n, max(1, self.degree)), -1, np.int32)
        if self.degree:
            # a few random edges to start from; a node never points to itself
            first = rng.integers(1, n, (n, min(8, self.degree)))
            self.out[:, :first.shape[1]] = (np.arange(n)[:, None] + first) % n
        mean = self.x.mean(axis=0)
        self.entry = int(np.argmax(self.x @ mean))
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            self._insert(order[at:at + BATCH])

    def _insert(self, nodes: np.ndarray) -> None:
        found, _, opened = self.walk(self.x[nodes], BEAM)
        own = self.out[nodes]
        self.out[nodes] = self.prune(nodes, np.concatenate([found, opened, own], axis=1))
        # the same edges backwards, pruned again where a list is full
        to = self.out[nodes].ravel()
        back = np.repeat(nodes, self.out.shape[1])[to >= 0]
        to = to[to >= 0]
        order = np.argsort(to, kind="stable")
        to, back = to[order], back[order]
        targets, start, count = np.unique(to, return_index=True, return_counts=True)
        place = np.arange(len(to)) - np.repeat(start, count)
        for at in range(0, len(targets), BATCH):
            some = slice(at, at + BATCH)
            new = np.full((len(targets[some]), int(count[some].max())), -1, np.int32)
            lo, hi = start[some][0], start[some][-1] + count[some][-1]
            rows = np.repeat(np.arange(len(targets[some])), count[some])
            new[rows, place[lo:hi]] = back[lo:hi]
            self.out[targets[some]] = self.prune(targets[some], np.concatenate([self.out[targets[some]], new], axis=1))

    def prune(self, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """Up to ``degree`` of the candidates of each node, near ones first, in diverse directions."""
        c = np.sort(np.where(candidates == nodes[:, None], -1, candidates), axis=1)
        c[:, 1:][c[:, 1:] == c[:, :-1]] = -1
        vectors = self.x[c]
        far = 2 - 2 * np.einsum("bcd,bd->bc", vectors, self.x[nodes])
        far[c < 0] = np.inf
        out = np.full((len(nodes), self.out.shape[1]), -1, np.int32)
        rows = np.arange(len(nodes))
        for k in range(self.degree):
            best = np.argmin(far, axis=1)
            live = np.isfinite(far[rows, best])
            if not live.any():
                break
            out[live, k] = c[rows, best][live]
            apart = 2 - 2 * np.einsum("bcd,bd->bc", vectors, vectors[rows, best])
            far[(ALPHA * apart <= far) & live[:, None]] = np.inf
            far[rows[live], best[live]] = np.inf
        return out

    def walk(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best nodes of a beam search for each row of q, their cosines, and the nodes opened."""
        n, b = len(self.x), len(q)
        rows = np.arange(b)[:, None]
        ids = np.full((b, beam), -1, np.int32)
        score = np.full((b, beam), -np.inf, np.float32)
        done = np.ones((b, beam), bool)
        ids[:, 0], score[:, 0], done[:, 0] = self.entry, q @ self.x[self.entry], False
        seen = np.zeros((b, n), bool)
        seen[:, self.entry] = True
        opened = []
        while not done.all():
            pick = np.argsort(np.where(done, np.inf, -score), axis=1)[:, :WIDTH]
            fresh = ~done[rows, pick]
            done[rows, pick] = True
            now = np.where(fresh, ids[rows, pick], -1)
            opened.append(now)
            near = np.where((now >= 0)[:, :, None], self.out[now], -1).reshape(b, -1)
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[(near >= 0) & seen[rows, near]] = -1
            at, _ = np.nonzero(near >= 0)
            seen[at, near[near >= 0]] = True
            if not len(at):
                continue
            value = np.full(near.shape, -np.inf, np.float32)
            value[near >= 0] = np.einsum("ed,ed->e", self.x[near[near >= 0]], q[at])
            ids = np.concatenate([ids, near], axis=1)
            score = np.concatenate([score, value], axis=1)
            done = np.concatenate([done, near < 0], axis=1)
            keep = np.argpartition(-score, beam - 1, axis=1)[:, :beam]
            ids, score, done = ids[rows, keep], score[rows, keep], done[rows, keep]
        order = np.argsort(-score, axis=1)
        return ids[rows, order], score[rows, order], np.concatenate(opened, axis=1)


def usable(vectors: DataFrame) -> DataFrame:
    """Rows that take part: vec_id, v. Others lack an id, a vector or a finite component, or are zero."""
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")) \
        .where("vec_id is not null and v is not null and size(v) > 0") \
        .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))) \
        .where(F.exists("v", lambda x: x != 0))


def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (shard, kind, ...) with a third column: a block of at most ``BLOCK`` successive queries, 0 for nodes.

    A block is a group of its own, so that memory holds a shard and one block.
    """
    seen = 0
    for batch in batches:
        kind = batch.column(1).to_numpy().astype(np.int64)
        place = seen + np.cumsum(kind)
        seen = int(place[-1]) if len(place) else seen
        block = np.where(kind == 1, 1 + (place - 1) // BLOCK, 0)
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(block, pa.int64()), *batch.columns[2:]],
                                         [*batch.schema.names[:2], "block", *batch.schema.names[2:]])


ANSWER = "query_id long, vec_id long, score double"


def nearest(vectors: DataFrame, step: int = 50, k: int = 5) -> DataFrame:
    """The ``k`` nearest rows of every row whose vec_id is divisible by ``step``.

    Rows: query_id, rank (from 1), vec_id, score, nearest first, ties to the smaller vec_id. A query
    meets every id but its own, in all shards of vectors as long as it. Rows that repeat an id with
    another vector are candidates of their own; as queries they share their answer's ranks.
    """
    rows = stage(usable(vectors), "vectors")
    # the smallest ids of every vector: k, and one that may be the query's own
    first = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    nodes = stage(rows.distinct().withColumn("place", first).where(F.col("place") <= k + 1)
                  .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "nodes")
    shards = max(1, -(-nodes.count() // SHARD))
    wide = F.size("v").cast("long") * shards
    dealt = nodes.select((wide + F.pmod(F.xxhash64("v"), F.lit(shards))).alias("shard"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("id"), "v", "ids")
    queries = rows.where(F.col("vec_id") % step == 0).distinct().select(
        F.explode(F.sequence(wide, wide + shards - 1)).alias("shard"), F.lit(1).alias("kind"),
        F.col("vec_id").alias("id"), "v", F.lit(None).cast("array<long>").alias("ids"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, graph = None, None
        for table in groups(blocked(batches), 3):
            if table.column(1)[0].as_py() == 0:  # the nodes of a shard, before its queries
                shard, graph = table.column(0)[0].as_py(), None
                x, ids = matrix(table), table.column(5).to_pylist()
                unit = x / np.sqrt((x / np.abs(x).max(axis=1, keepdims=True)) ** 2 @ np.ones((x.shape[1], 1))) / np.abs(x).max(axis=1, keepdims=True)
            elif table.column(0)[0].as_py() == shard:
                graph = graph or Graph(unit)
                for at in range(0, table.num_rows, BATCH):
                    yield answer(graph, x, ids, table.slice(at, BATCH))

    def matrix(table):
        flat = table.column(4).combine_chunks()
        return flat.flatten().to_numpy().astype(np.float64).reshape(table.num_rows, -1)

    def cosine(a, b):
        # scaled by the largest component, so that no square is lost
        a, b = a / np.abs(a).max(axis=-1, keepdims=True), b / np.abs(b).max(axis=-1, keepdims=True)
        return (a * b).sum(axis=-1) / (np.sqrt((a * a).sum(axis=-1)) * np.sqrt((b * b).sum(axis=-1)))

    def answer(graph, x, ids, table):
        q, own = matrix(table), table.column(3).to_pylist()
        unit = q / np.abs(q).max(axis=1, keepdims=True)
        unit = unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True))
        found, _, _ = graph.walk(unit.astype(np.float32), BEAM)
        out = []
        for i, query in enumerate(own):
            near = found[i][found[i] >= 0][:3 * (k + 1)]
            scores = cosine(x[near], q[i]).tolist()
            best = sorted((-s, v) for s, node in zip(scores, near.tolist(), strict=True) for v in ids[node] if v != query)[:k]
            out += [(query, v, -s) for s, v in best]
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], ["query_id", "vec_id", "score"])

    found = dealt.unionByName(queries).repartition("shard").sortWithinPartitions("shard", "kind", "id").mapInArrow(task, ANSWER)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.distinct().withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Jaccard self-join of word shingles with a forest of MinHash prefix tries.

Documents with equal shingle sets are one node from the start. A set's signature is laid out as
``TREES`` rows of ``DEPTH`` minima, the labels of as many prefix tries. Matching starts from whole
labels and shortens them until pairs at the threshold are found with the target recall; sets below
one trie node at that depth are candidates. Three steps keep the work linear in a group's size
where it can be, and bounded per task where it cannot:

1. Trie nodes with the same members are looked at once. Within a node the estimated similarity is
   followed from one set to the next until all it reaches are visited, and only the edges of that
   walk leave the task. Crowded nodes are dealt out as pairs of blocks.
2. The components of those edges are families. Their shingle sets, and no others, are made again
   from the texts.
3. Within a family all pairs are compared exactly, again in pairs of blocks. Tasks return the
   number of links of each set and the edges of a spanning forest, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import (bit_table, keyed, shingle_hashes, slices, text_bytes, within,
                                    word_hashes, words_of)
from tablewright.llm.graph import components, groups
from tablewright.session import stage

SHINGLE = 5
TREES, DEPTH = 16, 8
#: sets of a trie node, and of a family, that one task compares at once
NODE_BLOCK, FAMILY_BLOCK = 2_048, 1_024
#: an estimate this far below the threshold is 7 standard errors off
SLACK = 0.25
#: places of the table of texts whose sets are made again; its size does not depend on the data
FILTER_BITS = 24

_rng = np.random.default_rng(20240229)
_A = (_rng.integers(0, 1 << 31, TREES * DEPTH, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint32)


def depth_for(similarity: float, recall: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix at which pairs of this similarity meet in some trie often enough."""
    for d in range(depth, 0, -1):
        if 1 - (1 - similarity ** d) ** trees >= recall:
            return d
    raise ValueError("no prefix length reaches this recall; plant more trees")


def shingle_set(raw: bytes) -> np.ndarray:
    """Sorted distinct hashes of all runs of five words; a shorter text is one run."""
    words = words_of(raw)
    return np.unique(shingle_hashes(word_hashes.of(words), min(SHINGLE, len(words)))) if words else np.zeros(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima of TREES * DEPTH hash orders; shingles are taken in blocks that stay in cache."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(_A), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 512):
        out = np.minimum(out, (low[at:at + 512, None] * _A + _B).min(axis=0))
    return out


def profiles(docs: DataFrame, key: str | None = None) -> DataFrame:
    """Per row: row_key, doc_id, text_hash, set_key (128 bits; NULL without words), n, sig."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text"):
                keys, sizes, sigs = [], [], []
                for raw in text_bytes(some.column(3)):
                    own = shingle_set(raw)
                    keys.append(xxhash.xxh3_128_digest(own) if len(own) else None)
                    sizes.append(len(own))
                    sigs.append(signature(own).tobytes() if len(own) else None)
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[:3], pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()),
                     pa.array(sigs, pa.binary())], ["row_key", "doc_id", "text_hash", "set_key", "n", "sig"])

    rows = keyed(docs, "doc_id", "text", key=key).select(
        "row_key", F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(task, "row_key long, doc_id long, text_hash long, set_key binary, n int, sig binary")


def _blocks(rows: DataFrame, key: str, size: DataFrame, block: int, member: str = "set_id") -> DataFrame:
    """``rows`` copied to the pairs of blocks of their group: p <= q, and own, the row's block.

    A group of at most ``block`` members is one block; m members are copied m / block times.
    """
    own = F.pmod(F.xxhash64(member), F.col("blocks")).cast("int")
    count = F.ceil(F.col("members") / block).cast("int").alias("blocks")
    return rows.join(size.select(key, count), key).withColumn("own", own) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .withColumn("p", F.least("own", "other")).withColumn("q", F.greatest("own", "other")).drop("other", "blocks")


def _candidate_edges(rows: DataFrame, least: float) -> DataFrame:
    """Edges of walks along estimated similarity within (node, p, q)."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        need = int(np.ceil(least * TREES * DEPTH))
        a, b = [], []
        for table in groups(batches, 3):
            if table.num_rows < 2:
                continue
            p, q = table.column(1)[0].as_py(), table.column(2)[0].as_py()
            side = table.column(3).to_numpy()
            ids = table.column(4).to_numpy()
            sig = np.frombuffer(b"".join(table.column(5).to_pylist()), np.uint32).reshape(len(ids), -1)
            left = np.arange(len(ids))
            while len(left):
                queue, left = [left[0]], left[1:]
                while queue and len(left):
                    at = queue.pop()
                    near = (sig[left] == sig[at]).sum(axis=1) >= need
                    if p != q:  # pairs within one block are met where p = q
                        near &= side[left] != side[at]
                    a += [ids[at]] * int(near.sum())
                    b += ids[left[near]].tolist()
                    queue += left[near].tolist()
                    left = left[~near]
            if len(a) > 50_000:
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
                a, b = [], []
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.select("node", "p", "q", "own", "set_id", "sig").repartition("node", "p", "q") \
        .sortWithinPartitions("node", "p", "q", "set_id").mapInArrow(task, "a long, b long")


def _sets(docs: DataFrame, bits: bytes) -> DataFrame:
    """Shingle sets of the texts that the table lets through, each set once for every task."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.frombuffer(bits, np.uint8)
        seen: set[bytes] = set()
        for batch in batches:
            batch = batch.filter(pa.array(within(wanted, batch.column(0).to_numpy())))
            for some in slices(batch, "text"):
                keys, sets = [], []
                for raw in text_bytes(some.column(1)):
                    own = shingle_set(raw)
                    key = xxhash.xxh3_128_digest(own)
                    if len(own) and key not in seen:
                        seen.add(key)
                        keys.append(key)
                        sets.append(own.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.binary())],
                                                 ["set_key", "shingles"])

    rows = docs.select(F.xxhash64(F.col("text").cast("string")).alias("hash"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(task, "set_key binary, shingles binary")


def overlap_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of ``left`` with every set of ``right``."""
    if len(left) * len(right) <= 16:
        return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in right] for x in left])
    both = [*left, *right]
    values, inverse, seen = np.unique(np.concatenate(both), return_inverse=True, return_counts=True)
    rows = np.repeat(np.arange(len(both)), [len(x) for x in both])
    kept = seen[inverse] > 1
    place = (np.cumsum(seen > 1) - 1)[inverse[kept]]
    rows = rows[kept]
    order = np.argsort(place, kind="stable")
    place, rows = place[order], rows[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, int(place[-1]) + 1 if len(place) else 0, 4_096):
        lo, hi = np.searchsorted(place, [at, at + 4_096])
        block = np.zeros((len(both), 4_096), np.float32)
        block[rows[lo:hi], place[lo:hi] - at] = 1
        out += block[:len(left)] @ block[len(left):].T
    return out.astype(np.int64)


def _verify(rows: DataFrame, threshold: Fraction) -> DataFrame:
    """Exact links within (family, p, q): per set the documents linked to it, and forest edges."""
    up, down = threshold.numerator, threshold.denominator

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, docs = [], [], []
        for table in groups(batches, 3):
            if table.num_rows < 2:
                continue
            p, q = table.column(1)[0].as_py(), table.column(2)[0].as_py()
            own = table.column(3).to_numpy()
            ids, copies = table.column(4).to_numpy(), table.column(5).to_numpy()
            sets = [np.frombuffer(s, np.uint64) for s in table.column(6).to_pylist()]
            size = np.array([len(s) for s in sets])
            one, two = np.flatnonzero(own == p), np.flatnonzero(own == q)
            common = overlap_counts([sets[i] for i in one], [sets[i] for i in two])
            # common / (size + size - common) >= up / down, in whole numbers
            linked = common * (up + down) >= up * (size[one][:, None] + size[two][None, :])
            if p == q:
                np.fill_diagonal(linked, False)
            a += [*ids[one].tolist(), *(ids[two].tolist() if p != q else [])]
            docs += [*(linked @ copies[two]).tolist(), *((copies[one] @ linked).tolist() if p != q else [])]
            b += [None] * (len(a) - len(b))
            for x, y in _forest(linked, one, two, len(ids)):
                a.append(int(ids[x]))
                b.append(int(ids[y]))
                docs.append(0)
            if len(a) > 50_000:
                yield _links(a, b, docs)
                a, b, docs = [], [], []
        yield _links(a, b, docs)

    return rows.select("family", "p", "q", "own", "set_id", "copies", "shingles").repartition("family", "p", "q") \
        .sortWithinPartitions("family", "p", "q", "set_id").mapInArrow(task, "a long, b long, docs long")


def _links(a, b, docs):
    return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "docs": pa.array(docs, pa.int64())})


def _forest(linked: np.ndarray, one: np.ndarray, two: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links between members ``one`` (rows) and ``two`` (columns)."""
    row, column = np.full(n, -1), np.full(n, -1)
    row[one], column[two] = np.arange(len(one)), np.arange(len(two))
    left, edges = np.ones(n, bool), []
    for start in range(n):
        queue = [start] if left[start] else []
        left[start] = False
        while queue:
            at = queue.pop()
            near = [two[linked[row[at]] & left[two]]] if row[at] >= 0 else []
            near += [one[linked[:, column[at]] & left[one]]] if column[at] >= 0 else []
            for found in near:
                fresh = found[left[found]]
                left[fresh] = False
                edges += [(at, y) for y in fresh.tolist()]
                queue += fresh.tolist()
    return edges


def classes(docs: DataFrame, similarity: str = "0.8", recall: float = 0.999, key: str | None = None) -> DataFrame:
    """Per row: row_key, doc_id, class_id, n_links, root (the smallest row_key of the class).

    Two documents are linked if the Jaccard similarity of their sets of five-word shingles is at
    least ``similarity``; texts of one to four words are one shingle. n_links counts the other
    documents linked to a row, exact copies among them. class_id is the smallest doc_id of those
    connected by links (NULL if all of them lack an id). Missing texts and texts without words
    have no links and stay alone. ``recall`` is the least chance that a pair just at the threshold
    is found; likelier pairs are missed less. ``key`` names a column of unique longs to be row_key.
    """
    threshold = Fraction(similarity)
    depth = depth_for(float(threshold), recall)
    rows = stage(profiles(docs, key), "profiles")
    sets = stage(
        rows.where("set_key is not null").groupBy("set_key").agg(
            F.min("row_key").alias("set_id"), F.count("*").alias("copies"), F.min("text_hash").alias("text_hash"),
            F.first("sig").alias("sig")), "sets")
    # prefixes of the labels at the chosen depth: 4 bytes for each minimum
    labels = F.array(*[F.xxhash64(F.lit(t), F.substring("sig", t * DEPTH * 4 + 1, depth * 4)) for t in range(TREES)])
    members = sets.select("set_id", F.explode(labels).alias("node"))
    nodes = members.groupBy("node").agg(
        F.count("*").alias("members"), F.sum(F.xxhash64("set_id").cast("decimal(20,0)")).alias("check1"),
        F.sum(F.xxhash64("set_id", F.lit(1)).cast("decimal(20,0)")).alias("check2")).where("members > 1")
    nodes = stage(nodes.groupBy("members", "check1", "check2").agg(F.min("node").alias("node")).select("node", "members"), "nodes")
    inside = stage(members.join(nodes.select("node"), "node"), "inside")
    pairs = _blocks(inside, "node", nodes, NODE_BLOCK).join(sets.select("set_id", "sig"), "set_id")
    families = stage(components(_candidate_edges(pairs, float(threshold) - SLACK), "families"), "families")
    families = families.select(F.col("id").alias("set_id"), F.col("root").alias("family"))
    kin = stage(families.join(sets.drop("sig"), "set_id"), "kin")
    made = _sets(docs, bit_table(kin.select(F.col("text_hash").alias("hash")), FILTER_BITS))
    # one row for each set: tasks that met copies of it made it more than once
    own = stage(made.join(kin.select("set_key", "set_id", "family", "copies"), "set_key").drop("set_key")
                .dropDuplicates(["set_id"]), "kin_sets")
    sizes = kin.groupBy("family").agg(F.count("*").alias("members"))
    found = stage(_verify(_blocks(own, "family", sizes, FAMILY_BLOCK), threshold), "links")
    linked = found.groupBy(F.col("a").alias("set_id")).agg(F.sum("docs").alias("docs"))
    roots = components(found.where("b is not null").select("a", "b"), "classes") \
        .select(F.col("id").alias("set_id"), "root")
    per_set = sets.select("set_key", "set_id", "copies").join(linked, "set_id", "left").join(roots, "set_id", "left") \
        .select("set_key", F.coalesce("root", "set_id").alias("root"), (F.coalesce("docs", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    joined = stage(rows.select("row_key", "doc_id", "set_key").join(per_set, "set_key", "left")
                   .select("row_key", "doc_id", F.coalesce("root", "row_key").alias("root"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")),
                   "joined")
    # written, so that the join may split a class that many rows share
    names = stage(joined.groupBy("root").agg(F.min("doc_id").alias("class_id")), "names")
    return joined.join(names, "root").select("row_key", "doc_id", "class_id", "n_links", "root")

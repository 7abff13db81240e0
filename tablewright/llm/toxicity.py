"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Evidence: for every word and for its beginnings, the number of labelled texts of either class that
have it, counted over all training rows into a table of fixed size. Texts that are near-copies of
each other show a word between the same neighbours, so each count is held down to the number of
different neighbours that it is seen between. Labelled tokens: in a toxic text the words with strong
evidence for themselves or one of their beginnings; none in a clean one. The field (outside, toxic)
learns weights for the evidence of a token and its neighbours and for the transitions.

A text is one chain, whatever its length and whatever is read beside it. Chains are laid out in
rows of ``ROW`` tokens; every row is first reduced to the change it makes to a message, messages are
carried from row to row of a text, forwards and backwards, and then run through all rows at once.
The marginals give offending offsets, and a logistic function of their largest value, sum and share
gives the score of the document.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.llm.common import bit_table, slices, within
from tablewright.session import PACKED, drop, staged, staging_root

TOKEN = re.compile(r"\w+")
#: slots of the table of evidence; colliding rare words share one
SLOTS = 1 << 19
#: texts added to the counts of every slot, shared out as the classes are
PRIOR = 8.0
#: tokens of a row of messages
ROW = 64
#: places of the table of labelled ids; its size does not depend on the data
FILTER_BITS = 24
#: evidence from which a word of a toxic text counts as a labelled toxic token
STRONG = 1.75
#: gradient steps of the field, texts of a step's batch at least, characters of texts laid out together
STEPS, BATCH, PART = 80, 1_200, 1_000_000

#: whole word and beginnings, as many languages bend the ends of words
BEGINNINGS = (4, 5, 6, 7)
TEMPLATES = 1 + len(BEGINNINGS)
#: evidence of each template, least and largest of them, least of the word before and after
WIDTH = TEMPLATES + 4

_ODD = np.uint64(0x9E3779B97F4A7C15)


def hashes_of(words: list[str]) -> np.ndarray:
    """64-bit hashes of each word and its beginnings, in lower case: (words, TEMPLATES)."""
    low = [w.lower() for w in words]
    out = np.empty((len(low), TEMPLATES), np.uint64)
    out[:, 0] = np.fromiter((xxhash.xxh3_64_intdigest(w.encode()) for w in low), np.uint64, len(low))
    chars = np.array(low, f"<U{BEGINNINGS[-1]}").view(np.uint32).reshape(len(low), BEGINNINGS[-1]).astype(np.uint64)
    state = np.full(len(low), 1, np.uint64)
    for i in range(BEGINNINGS[-1]):
        state = (state ^ chars[:, i]) * _ODD
        state ^= state >> np.uint64(29)
        if i + 1 in BEGINNINGS:
            out[:, 1 + BEGINNINGS.index(i + 1)] = state * np.uint64(2 * i + 1)
    return out


def slots_of(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * _ODD) >> np.uint64(64 - 19)).astype(np.int64)


def indexed(found: list[list[str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, the number of each token's word and the tokens of each text."""
    names: dict[str, int] = {}
    sizes = np.array([len(w) for w in found], np.int64)
    index = np.fromiter((names.setdefault(w, len(names)) for own in found for w in own), np.int64, int(sizes.sum()))
    return list(names), index, sizes


def _sightings(texts: list[str], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class * SLOTS + slot) of each text's distinct slots; of each token's, and a bit for its neighbours."""
    words, index, sizes = indexed([TOKEN.findall(t) for t in texts])
    if not len(index):
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    hashes = hashes_of(words)
    slots = slots_of(hashes)
    text = np.repeat(np.arange(len(texts)), sizes)
    pair = np.unique(text * len(words) + index)
    place = np.unique((pair // len(words))[:, None] * SLOTS + slots[pair % len(words)])
    own = hashes[:, 0][index]
    edge = np.r_[True, text[1:] != text[:-1]]
    before = np.where(edge, np.uint64(1), np.roll(own, 1))
    after = np.where(np.roll(edge, -1), np.uint64(2), np.roll(own, -1))
    mixed = (before * _ODD) ^ (after * np.uint64(0xD6E8FEB86659FD93))
    bit = np.uint64(1) << ((mixed * _ODD) >> np.uint64(58))
    side = toxic * SLOTS
    return side[place // SLOTS] + place % SLOTS, (side[text][:, None] + slots[index]).ravel(), np.repeat(bit, TEMPLATES)


def evidence_of(labelled: DataFrame) -> tuple[np.ndarray, float]:
    """How much oftener than usual each slot is seen in toxic texts, over all rows of (text, toxic).

    Log odds against the share of toxic texts, which comes second; drawn to 0 by ``PRIOR``. Without
    texts of both classes there is no evidence.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = np.zeros(2 * SLOTS, np.int64), np.zeros(2 * SLOTS, np.uint64)
        for batch in batches:
            for some in slices(batch, "text", 1 << 20):
                once, every, bits = _sightings(some.column(0).to_pylist(), some.column(1).to_numpy())
                np.add.at(held, once, 1)
                np.bitwise_or.at(seen, every, bits)
        places = np.flatnonzero(held)
        for at in range(0, len(places), 100_000):
            here = places[at:at + 100_000]
            yield pa.RecordBatch.from_pydict({"toxic": here // SLOTS, "slot": here % SLOTS, "n": held[here], "seen": seen[here].view(np.int64)})

    sizes = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not n_clean or not n_toxic:
        return np.zeros(SLOTS, np.float32), (n_toxic + 0.5) / (n_clean + n_toxic + 1)
    share = n_toxic / (n_clean + n_toxic)

    def number(kind: int):
        mine = F.col("toxic") == kind
        n = F.coalesce(F.sum(F.when(mine, F.col("n"))), F.lit(0))
        filled = F.bit_count(F.coalesce(F.bit_or(F.when(mine, F.col("seen"))), F.lit(0).cast("long")))
        # places filled of 64 tell how many different neighbours there are, until all are filled
        return F.when(filled < 64, F.least(n, -64 * F.log(1 - filled / 64))).otherwise(n)

    odds = F.log((number(1) + PRIOR * share) / (number(0) + PRIOR * (1 - share))) - float(np.log(share / (1 - share)))
    # a number for each slot at most, whatever the number of texts
    found = labelled.select("text", "toxic").mapInArrow(task, "toxic long, slot long, n long, seen long") \
        .groupBy("slot").agg(odds.cast("float").alias("odds")).toArrow()
    out = np.zeros(SLOTS, np.float32)
    out[found["slot"].to_numpy()] = found["odds"].to_numpy()
    return out, share


class Chains:
    """Texts of given numbers of tokens in rows of ``ROW``, every text beginning a row."""

    def __init__(self, sizes: np.ndarray):
        rows = -(-sizes // ROW)
        self.rows = int(rows.sum())
        first = np.cumsum(rows) - rows
        self.place = np.arange(sizes.sum()) + np.repeat(first * ROW - (np.cumsum(sizes) - sizes), sizes)
        self.number = np.arange(self.rows) - np.repeat(first, rows)  # of a row within its text
        self.left = np.repeat(rows, rows) - 1 - self.number          # rows of the text behind it
        self.filled = np.minimum(ROW, np.repeat(sizes, rows) - ROW * self.number)

    def laid(self, values: np.ndarray) -> np.ndarray:
        """Tokens as (ROW, rows)."""
        out = np.ones(self.rows * ROW)
        out[self.place] = values
        return np.ascontiguousarray(out.reshape(-1, ROW).T)

    def flat(self, values: np.ndarray) -> np.ndarray:
        return values.T.reshape(-1)[self.place]

    @staticmethod
    def _by(number: np.ndarray) -> list[np.ndarray]:
        """Rows by their number, from 0 on."""
        order = np.argsort(number, kind="stable")
        return np.split(order, np.searchsorted(number[order], np.arange(1, number.max(initial=0) + 1)))

    def messages(self, emit: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ratios of toxic to outside of the forward and the backward messages at every token.

        ``emit`` are the exponentials of the tokens' toxic scores. A step changes a ratio x into
        (a x + b) / (c x + d), so a row changes it by a product of such 2 x 2 matrices.
        """
        (k00, k01), (k10, k11) = np.exp(moves)
        e = self.laid(emit)
        forward, backward = np.empty_like(e), np.empty_like(e)
        later = self._by(self.number)
        forward[0] = e[0]
        if len(later) > 1:
            on = np.flatnonzero(self.left > 0)
            a, b, c, d = self._product(len(on), ((e[t, on] * k11, e[t, on] * k01, k10, k00) for t in range(1, ROW)))
            where = np.empty(self.rows, np.int64)
            where[on] = np.arange(len(on))
            for rows in later[1:]:
                i = where[rows - 1]
                x = (a[i] * forward[0, rows - 1] + b[i]) / (c[i] * forward[0, rows - 1] + d[i])
                forward[0, rows] = e[0, rows] * (k11 * x + k01) / (k10 * x + k00)
        for t in range(1, ROW):
            x = forward[t - 1]
            forward[t] = e[t] * (k11 * x + k01) / (k10 * x + k00)
        backward[-1] = 1.0
        if len(later) > 1:
            on = np.flatnonzero(self.number > 0)
            there = [self.filled[on] > t for t in range(ROW)]  # a place behind the text's end sends 1
            a, b, c, d = self._product(len(on), (
                (np.where(there[t], e[t, on] * k11, 0), np.where(there[t], k10, 1), np.where(there[t], e[t, on] * k01, 0), np.where(there[t], k00, 1))
                for t in range(ROW - 1, 0, -1)))
            where = np.empty(self.rows, np.int64)
            where[on] = np.arange(len(on))
            for rows in self._by(self.left)[1:]:
                i = where[rows + 1]
                x = (a[i] * backward[-1, rows + 1] + b[i]) / (c[i] * backward[-1, rows + 1] + d[i])
                x = x * e[0, rows + 1]
                backward[-1, rows] = (k11 * x + k10) / (k01 * x + k00)
        for t in range(ROW - 1, 0, -1):
            x = e[t] * backward[t]
            backward[t - 1] = np.where(self.filled > t, (k11 * x + k10) / (k01 * x + k00), 1.0)
        return self.flat(forward), self.flat(backward)

    @staticmethod
    def _product(n: int, steps) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The product of the steps' matrices up to a factor, the first step applied first."""
        a, b, c, d = np.ones(n), np.zeros(n), np.zeros(n), np.ones(n)
        for s, t, u, v in steps:
            a, b, c, d = s * a + t * c, s * b + t * d, u * a + v * c, u * b + v * d
            size = a + b + c + d
            a, b, c, d = a / size, b / size, c / size, d / size
        return a, b, c, d


@dataclass
class Field:
    evidence: np.ndarray   # log odds by slot
    weights: np.ndarray    # of the WIDTH features and a constant, for toxic against outside
    moves: np.ndarray      # transition scores, outside to outside being 0
    document: np.ndarray   # constant, largest marginal, log of their sum, share

    def word_features(self, words: list[str]) -> np.ndarray:
        """Evidence of each template, its least and its largest value."""
        if not words:
            return np.zeros((0, TEMPLATES + 2))
        own = self.evidence[slots_of(hashes_of(words))]
        return np.column_stack([own, own.min(axis=1), own.max(axis=1)])

    def marginals(self, score: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """P(toxic) of the tokens of several texts, laid end to end."""
        forward, backward = Chains(sizes).messages(np.exp(np.clip(score, -30, 30)), self.moves)
        both = forward * backward
        return both / (1 + both)

    def tag(self, texts: list[str]) -> tuple[list[np.ndarray], list[list[tuple[int, int]]]]:
        """P(toxic) of the tokens of each text, and their offsets."""
        places = [[m.span() for m in TOKEN.finditer(t)] for t in texts]
        found = [[t[a:b] for a, b in own] for t, own in zip(texts, places, strict=True)]
        return self.tag_words(found), places

    def tag_words(self, found: list[list[str]]) -> list[np.ndarray]:
        words, index, sizes = indexed(found)
        if not len(index):
            return [np.zeros(0)] * len(found)
        own = self.word_features(words)
        # summed feature by feature: a text's numbers must not depend on what is beside it
        inner = sum(own[:, i] * self.weights[i] for i in range(TEMPLATES + 2)) + self.weights[-1]
        before, after = neighbours(own[:, TEMPLATES][index], sizes)
        score = inner[index] + before * self.weights[TEMPLATES + 2] + after * self.weights[TEMPLATES + 3]
        return np.split(self.marginals(score, sizes), np.cumsum(sizes)[:-1])

    @staticmethod
    def summary(marginals: list[np.ndarray]) -> np.ndarray:
        """Constant, largest marginal, log of their sum, root of their share."""
        rows = [(1.0, m.max(), np.log1p(m.sum()), np.sqrt(m.mean())) if len(m) else (1.0, 0.0, 0.0, 0.0)
                for m in marginals]
        return np.array(rows).reshape(-1, 4)

    def score(self, marginals: list[np.ndarray]) -> np.ndarray:
        z = self.summary(marginals)
        return 1 / (1 + np.exp(-np.clip(sum(z[:, i] * self.document[i] for i in range(4)), -30, 30)))


def neighbours(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The value of the token before and after each, 0 at the ends of a text."""
    first = np.zeros(len(values), bool)
    first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    return np.where(first, 0, np.roll(values, 1)), np.where(np.roll(first, -1), 0, np.roll(values, -1))


def laid_path(spark: SparkSession) -> str:
    return f"{staging_root(spark)}/laid-{uuid.uuid4().hex}"


def _laid_out(labelled: DataFrame, evidence: np.ndarray, texts: int, characters: int, path: str | None = None) -> tuple[list[DataFrame], bool]:
    """Labelled texts as arrays below ``path``, a row for about ``PART`` characters, in batches of ``BATCH`` texts or more.

    Every text is in one of the batches, at most ``STEPS``, by a hash of id and text; equal ones are
    one with their number. Second comes whether any token is labelled toxic.
    """
    batches = max(1, min(STEPS, texts // BATCH))
    parts = batches * max(1, -(-characters // (batches * PART)))
    once = labelled.withColumn("part", F.pmod("key", F.lit(parts))).repartition("part") \
        .groupBy("part", "key", "text", "toxic").agg(F.count(F.lit(1)).alias("copies"))
    reader = Field(evidence, np.zeros(WIDTH + 1), np.zeros((2, 2)), np.zeros(4))

    def lay(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("text", "ascending"), ("toxic", "ascending")])
        toxic = table["toxic"].to_numpy()
        words, index, sizes = indexed([TOKEN.findall(t) for t in table["text"].to_pylist()])
        own = reader.word_features(words).astype(np.float32)
        gold = (own[:, TEMPLATES + 1] >= STRONG)[index] & np.repeat(toxic > 0, sizes)
        part = table["part"][0].as_py()
        arrays = (sizes, index.astype(np.int32), own, toxic, table["copies"].to_numpy())
        return pa.Table.from_pydict({
            "part": [part], "batch": pa.array([part % batches], pa.int32()), "gold": [bool(gold.any())],
            **{n: pa.array([x.tobytes()], pa.binary()) for n, x in zip(LAID, arrays, strict=True)}})

    spark = labelled.sparkSession
    schema = "part long, batch int, gold boolean, " + ", ".join(f"{n} binary" for n in LAID)
    path = path or laid_path(spark)
    once.groupBy("part").applyInArrow(lay, schema).write.option("compression", PACKED).partitionBy("batch").parquet(path)
    found = spark.read.parquet(path).groupBy("batch").agg(F.bool_or("gold").alias("gold")).orderBy("batch").collect()
    kept = StructType([f for f in spark.read.parquet(path).schema if f.name != "batch"])
    return [spark.read.schema(kept).parquet(f"{path}/batch={r['batch']}") for r in found], any(r["gold"] for r in found)


#: arrays of a part: tokens of each text, word of each token, features of each word, class and copies of each text
LAID = {"sizes": np.int64, "index": np.int32, "words": np.float32, "toxic": np.int64, "copies": np.int64}


def _summed(laid: DataFrame, compute, columns: tuple[str, ...] = tuple(LAID)) -> np.ndarray:
    """Sum of the numbers that ``compute`` finds in each part, added in the order of the parts."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = compute(*[batch.column(c)[i].as_py() for c in range(1, batch.num_columns)])
                yield pa.RecordBatch.from_pydict({"part": batch.column(0).slice(i, 1), "found": pa.array([found.tolist()], pa.list_(pa.float64()))})

    rows = laid.select("part", *columns).mapInArrow(task, "part long, found array<double>").collect()
    return np.sum([r["found"] for r in sorted(rows, key=lambda r: r["part"])], axis=0)


def _opened(raw: tuple[bytes, ...]) -> tuple[np.ndarray, ...]:
    """Sizes, features of the tokens, classes and copies of a part."""
    sizes, index, words, toxic, copies = (np.frombuffer(r, t) for r, t in zip(raw, LAID.values(), strict=True))
    # features of a token: those of its word, the least evidence of the words around, a constant
    x = np.ones((len(index), WIDTH + 1), np.float32)
    x[:, :TEMPLATES + 2] = words.reshape(-1, TEMPLATES + 2)[index]
    x[:, TEMPLATES + 2], x[:, TEMPLATES + 3] = neighbours(x[:, TEMPLATES], sizes)
    return sizes, x, toxic, copies


def _gradient(weights: np.ndarray, moves: np.ndarray, balance: np.ndarray):
    """Function for the gradient on a part, of the weights and of the three moves, and its weighted tokens."""
    def compute(*raw: bytes) -> np.ndarray:
        sizes, x, toxic, copies = _opened(raw)
        if not len(x):
            return np.zeros(WIDTH + 5)
        each = np.repeat(balance[toxic] * copies, sizes)
        gold = (x[:, TEMPLATES + 1] >= STRONG) & np.repeat(toxic > 0, sizes)
        inside = np.ones(len(gold), bool)  # tokens that have one before them
        inside[(np.cumsum(sizes) - sizes)[sizes > 0]] = False
        inside = np.flatnonzero(inside)
        was, now, here = gold[inside - 1], gold[inside], each[inside]
        emit = np.exp(np.clip((x @ weights.astype(np.float32)).astype(float), -30, 30))
        forward, backward = Chains(sizes).messages(emit, moves)
        both = forward * backward
        wrong = ((both / (1 + both) - gold) * each).astype(np.float32)
        (k00, k01), (k10, k11) = np.exp(moves)
        prev, ahead = forward[inside - 1], (emit * backward)[inside]
        stay, enter, leave = k11 * prev * ahead, k01 * ahead, k10 * prev
        total = stay + enter + leave + k00
        moved = [((part / total - seen) * here).sum() for part, seen in ((stay, was & now), (enter, ~was & now), (leave, was & ~now))]
        return np.concatenate([(wrong @ x).astype(float), moved, [each.sum()]])

    return compute


def _train(batches: list[DataFrame], gold: bool, evidence: np.ndarray, share: float, balance: np.ndarray) -> Field:
    """Gradient steps on the likelihood of the labelled tokens, then of the documents.

    A step takes the next batch, so that all texts are learnt from; both classes weigh the same
    together. The document function goes over all texts at every step.
    """
    model = Field(evidence, np.zeros(WIDTH + 1), np.zeros((2, 2)), np.zeros(4))
    if gold:
        theta, mean, square = np.zeros(WIDTH + 4), np.zeros(WIDTH + 4), np.zeros(WIDTH + 4)

        def set_weights():
            model.weights = theta[:WIDTH + 1]
            model.moves = np.array([[0, theta[WIDTH + 2]], [theta[WIDTH + 3], theta[WIDTH + 1]]])

        for k in range(1, STEPS + 1):
            set_weights()
            found = _summed(batches[(k - 1) % len(batches)], _gradient(model.weights, model.moves, balance))
            grad = found[:-1] / max(found[-1], 1e-300) + 1e-5 * theta
            mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad ** 2
            theta = theta - 0.3 * (mean / (1 - 0.9 ** k)) / (np.sqrt(square / (1 - 0.99 ** k)) + 1e-8)
        set_weights()
    weights, moves = model.weights, model.moves

    def summaries(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field(np.zeros(0), weights, moves, np.zeros(4))
        for batch in rows:
            for i in range(batch.num_rows):
                sizes, x, toxic, copies = _opened([batch.column(c)[i].as_py() for c in range(1, batch.num_columns)])
                found = np.split(field.marginals((x @ weights).astype(float), sizes), np.cumsum(sizes)[:-1]) if len(x) else [np.zeros(0)] * len(sizes)
                yield pa.RecordBatch.from_pydict({
                    "part": batch.column(0).slice(i, 1), "z": pa.array([field.summary(found).tobytes()], pa.binary()),
                    "toxic": pa.array([toxic.tobytes()], pa.binary()), "weight": pa.array([(balance[toxic] * copies).tobytes()], pa.binary())})

    each = [b.select("part", *LAID).mapInArrow(summaries, "part long, z binary, toxic binary, weight binary") for b in batches]
    with staged(reduce(DataFrame.unionAll, each), "summaries") as seen:
        w = np.zeros(4)
        for _ in range(30):  # Newton steps with a ridge
            def compute(*raw: bytes, w=w) -> np.ndarray:
                z, toxic, weight = np.frombuffer(raw[0]).reshape(-1, 4), np.frombuffer(raw[1], np.int64), np.frombuffer(raw[2])
                p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
                return np.concatenate([((z * (weight * p * (1 - p))[:, None]).T @ z).ravel(), z.T @ (weight * (p - toxic))])

            found = _summed(seen, compute, ("z", "toxic", "weight"))
            change = np.linalg.solve(found[:16].reshape(4, 4) + 0.05 * np.eye(4), found[16:] + 0.05 * w)
            w = w - change
            if np.abs(change).max() < 1e-9:
                break
    w[0] += np.log(share / (1 - share))  # both classes weigh the same in the fit
    model.document = w
    return model


def _marked(texts: DataFrame, bits: bytes) -> DataFrame:
    """Rows of (doc_id, text) whose id may be labelled."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.frombuffer(bits, np.uint8)
        for batch in batches:
            kept = batch.filter(pa.array(within(marked, batch.column(0).to_numpy())))
            yield pa.RecordBatch.from_arrays(kept.columns[1:], ["doc_id", "text"])

    return texts.select(F.xxhash64("doc_id"), "doc_id", "text").mapInArrow(task, "doc_id long, text string")


def fit(docs: DataFrame, labels: DataFrame) -> Field:
    """Learn from all labelled rows outside the held-out fold.

    Files and partitions do not matter. A document with several labels is toxic if one says so;
    missing labels, ids and texts take no part. Without texts of both classes every score is the
    share of toxic ones (one half if there are none).
    """
    marks = labels.where("toxic is not null and doc_id is not null and crc32(cast(doc_id as string)) % 5 <> 0") \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    texts = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # labels grow with the documents, so their texts are shuffled; those of other documents are not
    bits = bit_table(marks.select(F.xxhash64("doc_id").alias("hash")), FILTER_BITS)
    labelled = _marked(texts, bits).join(marks.hint("merge"), "doc_id") \
        .select("text", (F.col("toxic") > 0).cast("long").alias("toxic"), F.xxhash64("doc_id", "text").alias("key"))
    spark = docs.sparkSession
    path = laid_path(spark)
    try:
        with staged(labelled, "labelled") as rows:
            evidence, share = evidence_of(rows)
            sizes = {r["toxic"]: r for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("texts"), F.sum(F.length("text")).alias("characters")).collect()}
            if len(sizes) < 2:
                return Field(np.zeros(SLOTS), np.zeros(WIDTH + 1), np.zeros((2, 2)), np.array([np.log(share / (1 - share)), 0, 0, 0]))
            texts = sum(r["texts"] for r in sizes.values())
            balance = np.array([texts / (2 * sizes[kind]["texts"]) for kind in (0, 1)])
            batches, gold = _laid_out(rows, evidence, texts, sum(r["characters"] for r in sizes.values()), path)
        return _train(batches, gold, evidence, share, balance)
    finally:
        drop(spark, path)


def _scored(model: Field, some: pa.RecordBatch, place: int) -> np.ndarray:
    return model.score(model.tag_words([TOKEN.findall(t or "") for t in some.column(place).to_pylist()]))


SCORES = "doc_id long, held_out boolean, score double, predicted int, spans array<struct<start:int,stop:int>>"


def score(docs: DataFrame, model: Field) -> DataFrame:
    """Score of every row and the offsets of its toxic words.

    A score depends on the text and the model alone: equal texts have equal scores in any order,
    file layout and batch. Missing and empty texts have no tokens and get the score of a text
    without toxic ones. A row without doc_id is not held out; repeated ids keep their rows. Texts of
    any length are one chain. An empty table gives no rows. Only doc_id and text are used, so
    further columns may have any name.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text", 1 << 20):
                texts = some.column(2).fill_null("").to_pylist()
                found = [TOKEN.findall(t) for t in texts]
                marginals = model.tag_words(found)
                scores = model.score(marginals)
                spans = []
                for text, m in zip(texts, marginals, strict=True):
                    toxic = m >= 0.5
                    spans.append([{"start": x.start(), "stop": x.end()} for x, t in
                                  zip(TOKEN.finditer(text), toxic, strict=True) if t] if toxic.any() else [])
                kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)),
                     pa.array(spans, kind)], ["doc_id", "held_out", "score", "predicted", "spans"])

    held = F.coalesce(F.expr("crc32(cast(doc_id as string)) % 5 = 0"), F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(task, SCORES)


def keep_clean(docs: DataFrame, model: Field) -> DataFrame:
    """The rows of ``docs`` whose score is below one half, all columns as they are."""
    schema, place = docs.schema, docs.columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text", 1 << 20):
                yield some.filter(pa.array(_scored(model, some, place) < 0.5))

    return docs.mapInArrow(task, schema)

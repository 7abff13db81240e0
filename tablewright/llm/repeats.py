"""Periodic runs of words, found with a dictionary of basic factors.

A run is a stretch of words with smallest period q and at least max(6, 4 q) words that cannot be
made longer. For every power of two, the factors of that length get names: two places have one
name if the same words follow. Names of twice the length come from pairs of names. Occurrences of
one factor inside a stretch of twice its length form an arithmetic progression, so from every
place only the next occurrence of its name counts. If it lies d places on, d at most the factor's
length and over half of it, d is proposed as a period. Successive places that propose the same d
form one stretch: it is extended by the factor and d, and it cannot be extended further, as the
place beside it would propose d too.

This finds each run exactly once. Let q lie in (l/2, l] for a factor length l. The run has 4 q
words, hence places whose factor recurs q further on. Inside the run it cannot recur sooner, or
its period would not be the smallest; so all of these places propose q at length l and nowhere
else. A stretch of at least 4 d words that proposes d has no smaller period, for the same reason.

A place whose name occurs once in its document starts no longer factor that recurs, so it is left
out from then on: in prose nearly everything is gone after a few lengths.

Texts are read whole. A document is worked on by one task, without any shuffle, as numbers of its
words; its distinct words are held beside them. Several short documents are worked on together.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import slices

#: least words of a run, and least number of periods
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: bytes of text split at once, and numbers turned into words at once
CHUNK = 1 << 20

SPACES = b" \t\n\v\f\r"

#: (doc_id, numbers of its words) to the numbers that are to be searched
Rewrite = Callable[[int | None, np.ndarray], np.ndarray]


def numbered(raw: bytes, numbers: dict[bytes, int]) -> np.ndarray:
    """Numbers of the words of a text, new ones being added to ``numbers``."""
    parts, at = [], 0
    while at < len(raw):
        stop = min(at + CHUNK, len(raw))
        while stop < len(raw) and raw[stop] not in SPACES:  # do not cut a word
            stop += 1
        words = raw[at:stop].split()
        parts.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)))
        at = stop
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def runs_of(names: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs, by start and period.

    ``names`` numbers the words of one or more documents laid end to end, ``document`` says which
    document a word belongs to.
    """
    total = len(names)
    place, name = np.arange(total), names
    at_place = np.full(total, -1, np.int64)
    found, size = [], 1
    while len(place):
        order = np.argsort(name, kind="stable")  # by place, hence by document, within a name
        ordered, by_name = place[order], name[order]
        same = (by_name[1:] == by_name[:-1]) & (document[ordered[1:]] == document[ordered[:-1]])
        step = np.zeros(len(place), np.int64)  # to the next occurrence, 0 if there is none
        step[order[:-1]] = np.where(same, ordered[1:] - ordered[:-1], 0)
        proposed = np.flatnonzero((step <= size) & (2 * step > size))
        if len(proposed):
            where, period = place[proposed], step[proposed]
            cut = np.flatnonzero((np.diff(where) != 1) | (np.diff(period) != 0)) + 1
            first, last = np.r_[0, cut], np.r_[cut - 1, len(where) - 1]
            length = where[last] - where[first] + size + period[first]
            keep = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period[first])
            found.append(np.stack([where[first], length, period[first]])[:, keep])
        # names of twice the length, where both halves recur in their document
        new = np.cumsum(np.r_[False, ~same])
        recurs = np.r_[False, same] | np.r_[same, False]
        at_place[:] = -1
        at_place[ordered[recurs]] = new[recurs]
        place = place[np.sort(order[recurs])]
        place = place[place + size < total]
        later = at_place[place + size]
        place, later = place[later >= 0], later[later >= 0]
        name = at_place[place] * (len(new) + 1) + later
        # both halves must lie in one document; their names may be shared with others
        inside = document[place] == document[place + size]
        place, name = place[inside], name[inside]
        size *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def dropped(words: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of ``words`` words lie in a run behind its first period."""
    change = np.zeros(words + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change)[:-1] > 0


def strongest(start: np.ndarray, length: np.ndarray, period: np.ndarray) -> int:
    """The run with the greatest exact length / period; ties: smallest start, then period."""
    ratio = length / period
    close = np.flatnonzero(ratio >= ratio.max() * (1 - 1e-12)).tolist()
    return max(close, key=lambda i: (Fraction(int(length[i]), int(period[i])), -start[i], -period[i]))


def batches_of(batch: pa.RecordBatch, rewrite: Rewrite | None):
    """For documents of a few MB together: ids, words, numbers, ends and their runs."""
    for some in slices(batch, "text"):
        numbers: dict[bytes, int] = {}
        ids = some.column(0).to_pylist()
        parts = [numbered(text.as_buffer().to_pybytes() if text.is_valid else b"", numbers) for text in some.column(1)]
        if rewrite is not None:
            parts = [rewrite(i, p) for i, p in zip(ids, parts, strict=True)]
        sizes = np.array([len(p) for p in parts], np.int64)
        names = np.concatenate(parts)
        runs = runs_of(names, np.repeat(np.arange(len(parts)), sizes))
        yield ids, list(numbers), names, np.cumsum(sizes) - sizes, sizes, runs


def joined(words: list[bytes], numbers: np.ndarray) -> Iterator[bytes]:
    """The words joined by one space, in pieces of bounded size."""
    for at in range(0, len(numbers), CHUNK):
        piece = b" ".join(map(words.__getitem__, numbers[at:at + CHUNK].tolist()))
        yield b" " + piece if at else piece


def _each(batch: pa.RecordBatch, rewrite: Rewrite | None):
    for ids, words, names, starts, sizes, (start, length, period) in batches_of(batch, rewrite):
        first = np.searchsorted(start, starts)
        last = np.searchsorted(start, starts + sizes)
        for i, doc_id in enumerate(ids):
            run = slice(first[i], last[i])
            own = start[run] - starts[i], length[run], period[run]
            kept = names[starts[i]:starts[i] + sizes[i]]
            if len(own[0]):
                kept = kept[~dropped(len(kept), *own)]
            yield doc_id, own, joined(words, kept)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def collapse(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """doc_id, text (words kept, joined by one space), runs (array of start, length, period).

    Missing texts count as empty ones. Other columns of ``docs`` are left out.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, b"".join(text).decode(), [dict(zip(("start", "length", "period"), r)) for r in zip(*map(np.ndarray.tolist, own))])
                    for i, own, text in _each(batch, rewrite)]
            ids, texts, runs = map(list, zip(*rows)) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(runs, kind)],
                                             ["doc_id", "text", "runs"])

    return _texts(docs).mapInArrow(task, "doc_id long, text string, runs array<struct<start:long,length:long,period:long>>")


DIGESTS = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
           "runs_sha256 string, collapsed_sha256 string")


def digests(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """Number of runs, the strongest run and digests of all runs and of the words kept.

    One row for every row of ``docs``, doubled and missing ids included. A missing or empty text,
    or one without a run, has no strongest run (four nulls) and the digest of no runs; its words,
    if any, are all kept. Equal texts give equal results. Of runs that are equally strong the one
    that starts first is named, then the one of the smaller period. A text of any length is read
    whole. An empty table gives no rows. Only doc_id and text of ``docs`` are used, so further
    columns may have any name.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, (start, length, period), text in _each(batch, rewrite):
                lines, kept = hashlib.sha256(), hashlib.sha256()
                for at in range(0, len(start), CHUNK):
                    some = zip(*(x[at:at + CHUNK].tolist() for x in (start, length, period)))
                    lines.update("".join(f"{s},{n},{q}\n" for s, n, q in some).encode())
                for piece in text:
                    kept.update(piece)
                best: list = [None] * 4
                if len(start):
                    i = strongest(start, length, period)
                    n, q = int(length[i]), int(period[i])
                    best = [int(start[i]), n, q, 1000 * n // q]
                rows.append([doc_id, len(start), *best, lines.hexdigest(), kept.hexdigest()])
            columns = list(zip(*rows)) if rows else [[]] * 8
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            names = [part.split()[0] for part in DIGESTS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return _texts(docs).mapInArrow(task, DIGESTS)


def planted(doc_id: int | None, words: np.ndarray) -> np.ndarray:
    """The words, a tenth of the documents by crc32 of the id being made periodic from some word on.

    With h = crc32(decimal doc_id) and g = floor(h / 10), if h % 10 = 0, word i from a = g % n on
    becomes word a + (i - a) % p, where p = 1 + floor((n - a) / (3 + g % 8)). A missing id changes
    nothing.
    """
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([words[:a], words[a + np.arange(n - a) % p]])

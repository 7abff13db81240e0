"""Exact removal of repeated byte strings by blockwise suffix sorting with a difference cover.

A string of ``LENGTH`` bytes that starts twice has to be found among all suffixes of all texts.

Buckets. Every string holds runs of neighbouring positions, and the anchor of a run is where its
32-byte hash is least; equal strings have equal anchors at equal places. A string whose anchors are not all
repeated somewhere starts nowhere else. The others go to the bucket of their least anchor, in
stretches: the successive starts of one text with one least anchor, with their bytes. Equal
strings are in one bucket, at one distance from its anchor.

Sorting. A task takes one bucket after the other, small ones together. The stretches are laid out
with their anchors on multiples of ``PERIOD``. Suffixes at positions of the difference cover are
ranked first, to a depth of 32 bytes by their words and then by doubling, which stays inside the
cover as all steps are multiples of the period. A suffix is then ordered by the few bytes before
its first covered position, the ranks there, and the few bytes that are left of its ``LENGTH``;
neighbours that agree in all of these are equal strings. Long ties never compare bytes, and memory
is bounded by the bucket.

Buckets of anchors with more than ``CROWD`` occurrences do not go to one task: their strings are
dealt out one by one under a 128-bit hash of the string, with the same result. A task sends a string
twice at most; from the third time on it knows that the string is repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import bit_table, signed, slices, text_bytes, within
from tablewright.llm.graph import whole_groups
from tablewright.session import stage

LENGTH = 200
GRAM = 32
#: anchors are least among this many neighbours, so a string of LENGTH bytes holds at least one
SPAN = 100
PERIOD = 32
#: bytes of texts hashed at once, and of stretches sorted at once
BUFFER, BLOCK = 4 << 20, 2 << 20
#: occurrences of an anchor from which its strings are dealt out one by one
CROWD = 50_000
#: places of the tables of repeated and of crowded anchors; their size does not depend on the data
FILTER_BITS = 25

_rng = np.random.default_rng(200)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOW = np.uint64((1 << 24) - 1)
_NONE = np.uint64((1 << 64) - 1)


def difference_cover(period: int) -> np.ndarray:
    """Residues such that every difference modulo ``period`` is one of two of them, found greedily."""
    cover, open_ = [0], set(range(1, period))
    while open_:
        best = max(range(1, period), key=lambda r: (len({(r - c) % period for c in cover} & open_
                                                       | {(c - r) % period for c in cover} & open_), -r))
        cover.append(best)
        open_ -= {(a - b) % period for a in cover for b in cover}
    return np.array(sorted(cover))


COVER = difference_cover(PERIOD)
#: from each residue the way to the next covered position
SHIFT = np.array([min((c - r) % PERIOD for c in COVER.tolist()) for r in range(PERIOD)])


def gram_hashes(buffer: np.ndarray) -> np.ndarray:
    """A hash of every run of GRAM bytes, by doubling."""
    h, length = _BYTE[buffer], 1
    while length < GRAM:
        h = h[:-length] * np.uint64(pow(0x9E3779B97F4A7C15, length, 1 << 64)) + h[length:]
        length *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Hashes, anchors, the anchor of every run, the least anchor of every string and which starts are
    inside a text.

    Texts lie one after the other. Positions are in the low bits of the compared keys, so the
    leftmost of equal hashes is taken, and buffers have at most 16 MB.
    """
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    h = gram_hashes(buffer)
    keys = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
    least, width = keys, 1
    while width < SPAN:
        step = min(width, SPAN - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    # starts of strings, and of runs of SPAN grams, that stay inside their text
    size = np.array([len(t) for t in texts])
    start = np.cumsum(size) - size
    runs = np.zeros(len(buffer) + 1, np.int8)
    strings = np.zeros(len(buffer) + 1, np.int8)
    for marks, need in ((runs, SPAN + GRAM - 1), (strings, LENGTH)):
        long = size >= need
        np.add.at(marks, start[long], 1)
        np.add.at(marks, (start + size - need + 1)[long], -1)
    in_run = np.cumsum(runs)[:len(least)] > 0
    in_string = np.cumsum(strings)[:len(buffer) - LENGTH + 1] > 0
    places = np.unique((least[in_run] & _LOW).astype(np.int64))
    reach = LENGTH - GRAM + 1 - SPAN
    own = np.minimum(least[:len(in_string)], least[reach:reach + len(in_string)]) & _LOW
    return h, places, (least & _LOW).astype(np.int64), own.astype(np.int64), in_string


def _packs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[list[bytes]]:
    """Distinct long enough texts of a task's slices; a text over 16 MB comes in overlapping parts."""
    for batch in batches:
        for some in slices(batch, column, BUFFER):
            yield [t for t in dict.fromkeys(text_bytes(some.column(some.schema.get_field_index(column)))) if len(t) >= LENGTH]


def parts(text: bytes, limit: int = 8 << 20) -> Iterator[tuple[int, bytes]]:
    """A text in parts that share LENGTH - 1 bytes, with their places; every string is in one part."""
    for at in range(0, max(1, len(text) - LENGTH + 1), limit):
        yield at, text[at:at + limit + LENGTH - 1]


def anchor_counts(texts: DataFrame) -> DataFrame:
    """Occurrences of every anchor: hash, n. Each task counts its equal texts once."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack in _packs(batches, "text"):
            found = []
            for chunk in _chunks(pack):
                h, places, _, _, _ = anchors([p for _, _, p in chunk])
                found.append(h[places])
            if found:
                hashes, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_pydict({"hash": signed(hashes), "n": n})

    return texts.mapInArrow(task, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def _chunks(pack: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Parts of texts, (text, place, bytes), in chunks that fit the positions' bits."""
    held, size = [], 0
    for i, text in enumerate(pack):
        for at, part in parts(text):
            if held and size + len(part) > 15 << 20:
                yield held
                held, size = [], 0
            held.append((i, at, part))
            size += len(part)
    if held:
        yield held


STRETCH = "bucket long, text_key binary, start int, distance int, bytes binary"


def stretches(texts: DataFrame, repeated: bytes, crowded: bytes) -> DataFrame:
    """Stretches of possibly repeated strings; those of crowded anchors hold one string each.

    Rows: bucket (hash of the least anchor, or of the string if crowded), text_key, start, distance
    (from start to the anchor, -1 if crowded), bytes (if crowded, the 128-bit hash). A distance of -2
    marks a crowded string already known to be repeated; its bucket is arbitrary.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, full = np.frombuffer(repeated, np.uint8), np.frombuffer(crowded, np.uint8)
        seen: set[bytes] = set()
        sent: dict[bytes, int] = {}
        for pack in _packs(batches, "text"):
            if len(sent) > 500_000:
                sent.clear()
            digests = [hashlib.md5(t).digest() for t in pack]
            fresh = [i for i, d in enumerate(digests) if d not in seen]
            seen.update(digests)
            if len(seen) > 200_000:
                seen.clear()
            for chunk in _chunks([pack[i] for i in fresh]):
                yield from emit([(digests[fresh[i]], at, part) for i, at, part in chunk], known, full, sent)

    def emit(chunk, known, full, sent):
        h, _, runs, own, inside = anchors([p for _, _, p in chunk])
        # the anchors of the runs inside a string are the same wherever it stands
        bad = np.concatenate([[0], np.cumsum(~within(known, h[runs]))])
        n = len(inside)
        reach = LENGTH - GRAM + 1 - SPAN + 1
        kept = np.flatnonzero(inside & (bad[reach:reach + n] == bad[:n]))
        if not len(kept):
            return
        anchor = own[kept]
        single = within(full, h[anchor])
        cut = np.ones(len(kept), bool)
        cut[1:] = (np.diff(kept) != 1) | (np.diff(anchor) != 0) | single[1:]
        first = np.flatnonzero(cut)
        last = np.append(first[1:], len(kept)) - 1
        s, e, a, alone = kept[first], kept[last] + LENGTH, anchor[first], single[first]
        buffer = b"".join(p for _, _, p in chunk)
        size = np.array([len(p) for _, _, p in chunk])
        begin = np.cumsum(size) - size
        of = np.searchsorted(begin, s, side="right") - 1
        start = s - begin[of] + np.array([at for _, at, _ in chunk])[of]
        raw = [buffer[x:y] if not c else xxhash.xxh3_128_digest(buffer[x:y]) for x, y, c in
               zip(s.tolist(), e.tolist(), alone.tolist(), strict=True)]
        bucket = signed(h[a])
        distance = np.where(alone, -1, a - s)
        for i in np.flatnonzero(alone).tolist():
            times = sent.get(raw[i], 0)
            sent[raw[i]] = times + 1
            if times < 2:
                bucket[i] = int.from_bytes(raw[i][:8], "little", signed=True)
            else:
                bucket[i], distance[i], raw[i] = start[i], -2, b""
        # known repeats that follow each other are one row, which holds their number
        first = np.ones(len(s), bool)
        first[1:] = (distance[1:] != -2) | (distance[:-1] != -2) | (np.diff(s) != 1) | (of[1:] != of[:-1])
        place = np.flatnonzero(first)
        many = np.diff(np.append(place, len(s)))
        raw = [raw[i] if distance[i] != -2 else int(n).to_bytes(4, "little") for i, n in zip(place.tolist(), many.tolist(), strict=True)]
        s, of, start, bucket, distance = s[place], of[place], start[place], bucket[place], distance[place]
        for x in range(0, len(s), 20_000):
            y = slice(x, x + 20_000)
            yield pa.RecordBatch.from_arrays([
                pa.array(bucket[y]), pa.array([chunk[i][0] for i in of[y].tolist()], pa.binary()),
                pa.array(start[y].astype(np.int32)),
                pa.array(distance[y].astype(np.int32)), pa.array(raw[y], pa.binary())],
                ["bucket", "text_key", "start", "distance", "bytes"])

    return texts.mapInArrow(task, STRETCH)


def _order(*keys: np.ndarray) -> np.ndarray:
    """Names of rows in the order of all keys, equal rows sharing one."""
    order = np.lexsort(keys[::-1])
    change = np.zeros(len(order), bool)
    for k in keys:
        k = k[order]
        change[1:] |= k[1:] != k[:-1]
    names = np.empty(len(order), np.int64)
    names[order] = np.cumsum(change)
    return names


def repeated_starts(bucket: np.ndarray, distance: np.ndarray, raw: list[bytes], often: np.ndarray) -> list[np.ndarray]:
    """For distinct stretches, which of their strings start again in another one or occur ``often``.

    The suffixes of all buckets given are sorted together, a bucket's apart from the others'.
    """
    size = np.array([len(r) for r in raw])
    # an anchor lies at a multiple of the period
    lead = -distance % PERIOD
    room = -(-(lead + size + 8) // PERIOD) * PERIOD
    base = np.cumsum(room) - room + lead
    text = np.zeros(int(room.sum()) + PERIOD, np.uint8)
    for at, r in zip(base.tolist(), raw, strict=True):
        text[at:at + len(r)] = np.frombuffer(r, np.uint8)
    words = np.zeros(len(text), np.uint64)
    for k in range(8):
        words[:len(text) - 7] = (words[:len(text) - 7] << np.uint64(8)) | text[k:len(text) - 7 + k]
    # ranks of the covered suffixes: 32 bytes by their words, then 64 and 128 by doubling
    end = np.zeros(len(text), np.int64)
    for at, n in zip(base.tolist(), size.tolist(), strict=True):
        end[at:at + n] = at + n
    covered = np.zeros(PERIOD, bool)
    covered[COVER] = True
    sample = np.flatnonzero(covered[np.arange(len(text)) % PERIOD])
    sample = sample[sample + PERIOD <= end[sample]]
    rank = np.zeros(len(text), np.int64)
    rank[sample] = _order(*(words[sample + 8 * k] for k in range(PERIOD // 8)))
    depth = PERIOD
    while depth < 128:
        sample = sample[sample + 2 * depth <= end[sample]]
        rank[sample] = _order(rank[sample], rank[sample + depth])
        depth *= 2
    # every string: its bucket and distance, then bytes, ranks and bytes that cover it exactly
    count = size - LENGTH + 1
    of = np.repeat(np.arange(len(raw)), count)
    place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = base[of] + place
    shift = SHIFT[start % PERIOD]
    second = shift + PERIOD * ((LENGTH - 128 - shift) // PERIOD)
    rest = LENGTH - second - 128
    keys = [bucket[of], (distance[of] - place), rank[start + shift], rank[start + second]]
    for at, n in ((start, shift), (start + second + 128, rest)):
        for k in range(0, int(n.max(initial=0)), 8):
            some = np.clip(n - k, 0, 8)
            mask = np.where(some == 8, _NONE, ~(_NONE >> (8 * np.minimum(some, 7)).astype(np.uint64)))
            keys.append(words[np.minimum(at + k, len(words) - 1)] & mask)
    names = _order(*keys)
    again = np.bincount(names)[names] > 1
    again |= often[of]
    return np.split(again, np.cumsum(count)[:-1])


def find_repeats(rows: DataFrame) -> DataFrame:
    """Runs of repeated strings: text_key, first (of the bytes covered), last (exclusive)."""
    kind = "text_key binary, first int, last int"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, BLOCK):
            yield sort(table)

    def sort(table):
        # tasks that met copies of one text sent its stretches more than once
        rows = list(dict.fromkeys(zip(*(c.to_pylist() for c in table.columns), strict=True)))
        bucket, keys, start, distance, raw = zip(*rows, strict=True)
        # equal stretches are one; they also occur often
        ids: dict[tuple, int] = {}
        of = np.array([ids.setdefault(k, len(ids)) for k in zip(bucket, distance, raw, strict=True)])
        often = np.bincount(of) > 1
        one = [k for k in ids]
        b, d = np.array([k[0] for k in one]), np.array([k[1] for k in one])
        often |= d == -2
        size = [len(k[2]) if k[1] >= 0 else LENGTH if k[1] == -1 else LENGTH - 1 + int.from_bytes(k[2], "little") for k in one]
        runs: list[list[tuple[int, int]]] = [[(0, n)] if o else [] for n, o in zip(size, often.tolist(), strict=True)]
        # a bucket with one distinct stretch is settled by its count
        _, inverse, n = np.unique(b, return_inverse=True, return_counts=True)
        open_ = np.flatnonzero((n[inverse] > 1) & (d >= 0))
        if len(open_):
            flags = repeated_starts(b[open_], d[open_], [one[i][2] for i in open_], often[open_])
            for i, flag in zip(open_.tolist(), flags, strict=True):
                edge = np.diff(np.concatenate([[0], flag.view(np.int8), [0]]))
                runs[i] = list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) + LENGTH - 1).tolist(), strict=True))
        out = [(keys[r], s + x, s + y) for r, (i, s) in enumerate(zip(of.tolist(), start, strict=True)) for x, y in runs[i]]
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32())], ["text_key", "first", "last"])

    return rows.select("bucket", "text_key", "start", "distance", "bytes").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(task, kind)


REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def repeated_runs(docs: DataFrame) -> DataFrame:
    """Maximal runs to remove from every text that has some: text_key (md5), runs."""
    texts = docs.select(F.col("text").cast("string").alias("text")).where("octet_length(text) >= %d" % LENGTH)
    counts = stage(anchor_counts(texts).where("n > 1"), "anchors")
    rows = stretches(texts, bit_table(counts.select("hash"), FILTER_BITS),
                     bit_table(counts.where(F.col("n") > CROWD).select("hash"), FILTER_BITS))
    found = find_repeats(rows)
    # a text that occurs twice is covered from end to end
    copies = texts.groupBy(F.unhex(F.md5(F.col("text").cast("binary"))).alias("text_key"), F.octet_length("text").alias("last")) \
        .agg(F.count("*").alias("n")).where("n > 1")
    both = found.unionByName(copies.select("text_key", F.lit(0).alias("first"), F.col("last").cast("int").alias("last")))
    runs = both.groupBy("text_key").agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("runs"))
    return stage(runs, "runs")


def merged(runs: list[dict], size: int) -> list[tuple[int, int]]:
    """Sorted runs joined where they touch or overlap."""
    out: list[tuple[int, int]] = []
    for r in runs:
        if out and r["first"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], r["last"]))
        else:
            out.append((r["first"], min(r["last"], size)))
    return out


def remove(docs: DataFrame) -> DataFrame:
    """Per row the bytes, those removed, the removed runs and a digest of the bytes that stay.

    Missing texts are empty; texts under LENGTH bytes stay whole. Rows with equal texts of at least
    LENGTH bytes lose all of it, whatever their ids.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text"):
                out = []
                for raw, runs in zip(text_bytes(some.column(1)), some.column(2).to_pylist(), strict=True):
                    cut = merged(runs or [], len(raw))
                    kept, at = hashlib.sha256(), 0
                    for a, b in cut:
                        kept.update(raw[at:a])
                        at = b
                    kept.update(raw[at:])
                    out.append((len(raw), sum(b - a for a, b in cut), len(cut), kept.hexdigest()))
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3])],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    runs = repeated_runs(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = rows.withColumn("text_key", F.unhex(F.md5(F.col("text").cast("binary"))))
    return keyed.join(runs, "text_key", "left").select("doc_id", "text", "runs").mapInArrow(task, REMOVED)

"""SentencePiece encoding as a relational lattice, and its decoding.

A text gets a leading space and its spaces become ``▁``. No piece spans a pair of characters that
no piece holds, so texts are cut there without changing any path; the runs between are units, and
each distinct unit is encoded once:

1. the substrings of a unit, up to the longest piece, are exploded and equi-joined to the piece
   table; a character that is no piece is an edge of its byte pieces;
2. the edges are grouped by unit and ordered by their end, and a higher-order ``aggregate`` folds
   them into the best path (Viterbi).

Units are hash-partitioned by their count already, so neither the join (the piece table is of
fixed size and broadcast) nor the grouping moves edges; most substrings that are no piece are
dropped before the join by a table of bits. Documents are then written out of the encoded units: the
most frequent ones, a bounded number, go to every task as sorted hashes and one block of ids; the
rest is joined by text. Where a model's scores only number its merges, a piece scores -ln(2 + number), as ranks of
frequency do; otherwise its own score counts. Of equal paths the one with the longer last piece is
taken, from the end of the unit on.

Units of more than ``UNIT`` characters would repeat themselves in every edge and path of the lattice.
They stay whole, but are encoded in the task that writes their document, by the same recurrence over
back-pointers, in time and memory linear in their length.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tablewright.llm.common import bit_table, free_marks, lean, sampled, slices
from tablewright.session import stage

SPACE = "▁"
#: characters of the longest unit that takes part in the lattice
UNIT = 64
#: most units that every task is sent
FREQUENT = 350_000
#: a ``▁`` of the text itself, which is no space; a surrogate, so no text holds it
OWN = "\ud802"
#: bits of the table of pieces that substrings are held against before the join
PIECE_BITS = 20
#: bytes of the texts that are cut at once; cutting takes some 30 times as much memory
SLICE = 1 << 19
#: parts of the lattice for each partition of a shuffle
PARTS = 2
#: odd multipliers of the hashes of units
MIXES = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9), (0xD6E8FEB86659FD93, 0x94D049BB133111EB)
#: units, each of a few bytes, that a task gathers before it counts them, and distinct ones it holds before it sends them on
CUT = 500_000
HELD = 200_000


@dataclass
class Pieces:
    """A vocabulary of fixed size: text, id and score of its pieces and the id of byte 0."""

    texts: list[str]
    ids: list[int]
    scores: list[float]
    first_byte: int

    @classmethod
    def load(cls, path: str) -> Pieces:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        own = [i for i in range(model.get_piece_size())
               if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        scores = [model.get_score(i) for i in own]
        merges = all(s <= 0 and s == int(s) for s in scores)
        if merges:
            # white-space runs have no merge number; they count as the most frequent pieces
            scores = [-math.log(2 - s) if s > -1e6 else -math.log(2) for s in scores]
        return cls([model.id_to_piece(i) for i in own], own, scores, model.piece_to_id("<0x00>"))

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(zip(self.texts, self.ids, self.scores, strict=True)), "piece string, id int, score double")

    @property
    def longest(self) -> int:
        return max(map(len, self.texts))

    @property
    def unknown(self) -> float:
        return min(self.scores) - 10.0


class Cutter:
    """Cuts texts into units by the pairs of characters that pieces hold."""

    def __init__(self, pieces: Pieces):
        # 0 is a character outside all pieces, 1 one that stands alone in them
        self.known = np.zeros(0x110000, np.uint16)
        self.known[[ord(c) for p in pieces.texts for c in p]] = 1
        chars = sorted({c for p in pieces.texts if len(p) > 1 for c in p})
        self.known[[ord(c) for c in chars]] = np.arange(2, len(chars) + 2)
        self.pairs = np.zeros((len(chars) + 2, len(chars) + 2), bool)
        for p in pieces.texts:
            at = self.known[[ord(c) for c in p]]
            self.pairs[at[:-1], at[1:]] = True
        # flat, so that one look-up finds a pair: by kind of the first character times width plus kind of the second
        self.width, self.apart = len(self.pairs), ~self.pairs.ravel()
        self.longest, self.unknown, self.first_byte = pieces.longest, pieces.unknown, pieces.first_byte
        self.table = {p: (np.array([i], "<u4").tobytes(), s) for p, i, s in zip(pieces.texts, pieces.ids, pieces.scores, strict=True)}
        self.paths: dict[str, bytes] = {}

    @cached_property
    def beginnings(self) -> set[str]:
        return {p[:n] for p in self.table for n in range(1, len(p) + 1)}

    def spans(self, texts: list[str]) -> tuple[pa.StringArray, np.ndarray, str]:
        """Units of the texts in turn, how many come before each text and after the last, and what stands for ``OWN`` in them.

        Single characters outside all pieces are units of their own. No unit becomes an object of its own.
        """
        own = free_marks("".join(texts), 1)
        parts = ["" if not t else SPACE + t.replace(SPACE, own).replace(" ", SPACE) for t in texts]
        whole = "".join(parts)
        codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        kinds = self.known.take(codes).astype(np.int32)
        pairs = kinds[:-1] * np.int32(self.width)
        pairs += kinds[1:]
        cut = np.ones(len(codes) + 1, bool)
        cut[1:-1] = self.apart.take(pairs)
        begin = np.r_[0, np.cumsum([len(p) for p in parts], dtype=np.int64)]
        cut[begin] = True
        at = np.flatnonzero(cut)
        raw = whole.encode()
        places = at
        if len(raw) > len(codes):
            # UTF-8 has a byte more from each of these characters on
            sizes = (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000)
            places = at + np.r_[np.int32(0), np.cumsum(sizes, dtype=np.int32)][at]
        units = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(raw))
        return units, np.searchsorted(at, begin), own

    def units(self, texts: list[str]) -> list[list[str]]:
        """Units of each text."""
        units, begin, own = self.spans(texts)
        found = strings(units, own)
        return [found[a:b] for a, b in zip(begin.tolist(), begin[1:].tolist())]

    def in_lattice(self, unit: str) -> bool:
        return len(unit) <= UNIT and (len(unit) > 1 or bool(self.known[ord(unit)]))

    def lattice_has(self, units: pa.StringArray) -> np.ndarray:
        """``in_lattice`` of each unit; what stands for ``OWN`` is outside all pieces, as that is."""
        size = pc.utf8_length(units).to_numpy()
        keep, single = size <= UNIT, size == 1
        chars = "".join(units.filter(pa.array(single)).to_pylist())
        keep[single] = self.known[np.frombuffer(chars.encode("utf-32-le"), np.uint32)] > 0
        return keep

    def path(self, unit: str) -> bytes:
        """Ids of the best path over a unit of any length, as the lattice finds it."""
        found = self.paths.get(unit)
        if found is None:
            found = self._path(unit)
            if len(unit) <= 16 * UNIT:
                if len(self.paths) >= 2_000:
                    self.paths.clear()
                self.paths[unit] = found
        return found

    def _path(self, unit: str) -> bytes:
        size, ring = len(unit), self.longest + 1
        # the best score of each place ahead, and the length of the last piece on its path
        best, last = [-math.inf] * ring, array("I", bytes(4 * (size + 1)))
        best[0] = 0.0
        for start in range(size):
            before, best[start % ring] = best[start % ring], -math.inf
            for n in range(1, min(self.longest, size - start) + 1):
                piece = unit[start:start + n]
                if n > 1 and piece not in self.beginnings:
                    break
                known = self.table.get(piece)
                if known or n == 1:
                    score = before + (known[1] if known else self.unknown)
                    if score > best[(start + n) % ring]:
                        best[(start + n) % ring], last[start + n] = score, n
        out, stop = [], size
        while stop:
            piece = unit[stop - last[stop]:stop]
            known = self.table.get(piece)
            out.append(known[0] if known else np.array(byte_ids(piece, self.first_byte), "<u4").tobytes())
            stop -= last[stop]
        return b"".join(reversed(out))


_cutters: dict[int, Cutter] = {}


def cutter(pieces: Pieces) -> Cutter:
    key = hash((len(pieces.texts), pieces.texts[-1], pieces.first_byte))
    if key not in _cutters:
        _cutters[key] = Cutter(pieces)
    return _cutters[key]


def strings(units: pa.StringArray, own: str) -> list[str]:
    """Units as strings, ``own`` as ``OWN``."""
    found = units.to_numpy(zero_copy_only=False).tolist()
    return [OWN if u == own else u for u in found] if own in found else found


def byte_ids(char: str, first_byte: int) -> list[int]:
    return [first_byte + b for b in (SPACE if char == OWN else char).encode()]


def count_units(texts: DataFrame, pieces: Pieces) -> DataFrame:
    """Units of the lattice with a known character and how often they occur: unit, n."""
    @lean
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = cutter(pieces)
        gathered, held = [], []

        def count():
            counts = pc.value_counts(pa.chunked_array(gathered, pa.string()))
            keep = pa.array(cut.lattice_has(counts.field("values")))
            held.append(pa.table([counts.field("values").filter(keep), counts.field("counts").filter(keep)], ["unit", "n"]))
            gathered.clear()

        def flush():
            rows = pa.concat_tables(held).group_by("unit", use_threads=False).aggregate([("n", "sum")]).select(["unit", "n_sum"])
            held[:] = [rows.rename_columns(["unit", "n"])]

        for batch in batches:
            for some in slices(batch, "text", SLICE):
                gathered.append(cut.spans(some.column(0).fill_null("").to_pylist())[0])
                if sum(map(len, gathered)) > CUT:
                    count()
                    if sum(map(len, held)) > 2 * HELD:
                        flush()
                        if len(held[0]) > HELD:
                            yield from held.pop().to_batches(50_000)
        count()
        flush()
        yield from held.pop().to_batches(50_000)

    # a given number of parts, as adaptive execution would merge small ones: a task that read 7 MB of units held 324 MB
    parts = PARTS * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return texts.mapInArrow(task, "unit string, n long").repartition(parts, "unit").groupBy("unit").agg(F.sum("n").alias("n"))


def _may_be_piece(piece: Column, table: DataFrame) -> Column:
    """False only for what is no piece: a look into a table of bits of fixed size."""
    bits = np.unpackbits(np.frombuffer(bit_table(table.select(F.xxhash64("piece").alias("hash")), PIECE_BITS), np.uint8))
    words = np.packbits(bits.reshape(-1, 64), axis=1, bitorder="little").view("<i8").ravel()
    place = F.xxhash64(piece).bitwiseAND((1 << PIECE_BITS) - 1)
    word = F.get(F.split(F.lit(",".join(map(str, words.tolist()))), ",").cast("array<bigint>"), F.shiftright(place, 6).cast("int"))
    return F.call_function("shiftright", word, place.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1


def lattice(units: DataFrame, pieces: Pieces) -> DataFrame:
    """Edges of all units: unit, n, start, stop (0-based, exclusive), score, id (-1 for bytes)."""
    table = pieces.table(units.sparkSession)
    length = F.length("unit")
    parts = units.select("unit", "n", length.alias("chars"), F.explode(F.sequence(F.lit(1), length)).alias("at"))
    parts = parts.select("unit", "n", "at", F.explode(F.sequence(F.lit(1), F.least(F.lit(pieces.longest), F.col("chars") - F.col("at") + 1))).alias("size"))
    parts = parts.withColumn("piece", F.substring("unit", F.col("at"), F.col("size")))
    parts = parts.where((F.col("size") == 1) | _may_be_piece(F.col("piece"), table))
    edges = parts.join(F.broadcast(table), "piece", "left").where("size = 1 or id is not null")
    return edges.select(
        "unit", "n", (F.col("at") - 1).alias("start"), (F.col("at") + F.col("size") - 1).alias("stop"),
        F.coalesce("score", F.lit(pieces.unknown)).alias("score"), F.coalesce("id", F.lit(-1)).alias("id"))


def _best(edges: Column) -> Column:
    """For each place the best score, and start and id of the last edge, over edges ordered by their end."""
    def place(score, e):
        return F.array(F.struct(score.alias("score"), e["start"].alias("start"), e["id"].alias("id")))

    def step(best, e):
        score = F.get(best, e["start"])["score"] + e["score"]
        return F.when(F.size(best) <= e["stop"], F.concat(best, place(score, e))) \
            .when(score > F.get(best, e["stop"])["score"], F.concat(F.slice(best, F.lit(1), e["stop"]), place(score, e))) \
            .otherwise(best)

    start = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("start"), F.lit(-1).alias("id")))
    return F.aggregate(edges, start, step)


def _ids(unit: Column, best: Column, first_byte: int) -> Column:
    """Ids of the best path, walked back from the end of the unit."""
    def fallback(char):
        hexed = F.hex(F.encode(char, "utf-8"))
        return F.transform(F.sequence(F.lit(0), (F.length(hexed) / 2).cast("int") - 1),
                           lambda i: F.conv(F.substring(hexed, (2 * i + 1).cast("int"), F.lit(2)), 16, 10).cast("int") + first_byte)

    def back(path, _):
        edge = F.get(best, path["at"])
        own = F.when(edge["id"] >= 0, F.array(edge["id"])).otherwise(fallback(F.substring(unit, edge["start"] + 1, F.lit(1))))
        return F.when(path["at"] == 0, path).otherwise(F.struct(edge["start"].alias("at"), F.concat(own, path["ids"]).alias("ids")))

    end = F.struct((F.size(best) - 1).alias("at"), F.array().cast("array<int>").alias("ids"))
    return F.aggregate(best, end, back)["ids"]


def encode_units(units: DataFrame, pieces: Pieces) -> DataFrame:
    """Best paths of all units: unit, n, ids."""
    return lattice(units, pieces).groupBy("unit", "n") \
        .agg(F.sort_array(F.collect_list(F.struct("stop", "start", "score", "id"))).alias("edges")) \
        .select("unit", "n", _best(F.col("edges")).alias("best")) \
        .select("unit", "n", _ids(F.col("unit"), F.col("best"), pieces.first_byte).alias("ids"))


def unit_keys(units: list[str]) -> np.ndarray:
    """128-bit hashes of units as two columns: sums of two 64-bit mixes of each character and its place."""
    return _keys("".join(units), np.fromiter(map(len, units), np.int64, len(units)))


def _keys(text: str, sizes: np.ndarray) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.r_[0, np.cumsum(sizes)]
    place = (np.arange(len(codes)) - np.repeat(ends[:-1], sizes)).astype(np.uint64)
    mixed = codes + (place << np.uint64(21))
    keys = np.empty((len(sizes), 2), np.uint64)
    for column, (first, second) in enumerate(MIXES):
        mixed = (mixed + np.uint64(first)) * np.uint64(first)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(second)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(first)
        mixed ^= mixed >> np.uint64(32)
        sums = np.r_[np.uint64(0), np.cumsum(mixed)]
        keys[:, column] = sums[ends[1:]] - sums[ends[:-1]]
    return keys


@dataclass
class Known:
    """Ids of units as one block, found by sorted hashes; the same few MB in every task."""

    keys: np.ndarray
    ends: np.ndarray
    ids: np.ndarray

    @classmethod
    def of(cls, units: list[str], ids: np.ndarray, ends: np.ndarray) -> Known:
        """``ids`` of all units one after the other, those of unit i between ``ends`` i and i + 1."""
        keys = unit_keys(units)
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        sizes = np.diff(ends)[order]
        from_ = np.repeat(ends[:-1][order] - (np.cumsum(sizes) - sizes), sizes)
        return cls(keys[order], np.r_[0, np.cumsum(sizes)].astype(np.int64), ids[np.arange(sizes.sum()) + from_].astype("<u4"))

    @cached_property
    def raw(self) -> bytes:
        return self.ids.tobytes()

    @cached_property
    def sizes(self) -> np.ndarray:
        return np.diff(self.ends)

    @cached_property
    def columns(self) -> np.ndarray:
        return np.ascontiguousarray(self.keys.T)

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, second = np.ascontiguousarray(keys.T)
        # in order, as that stays within the cache
        order, place = np.argsort(first), np.empty(len(keys), np.int64)
        place[order] = np.searchsorted(self.columns[0], first[order])
        np.minimum(place, len(self.keys) - 1, out=place)
        return place, (self.columns[0][place] == first) & (self.columns[1][place] == second)

    def places(self, units: pa.StringArray) -> np.ndarray:
        """The number of each unit here, -1 for one that is not held."""
        if not len(units) or not len(self.keys):
            return np.full(len(units), -1)
        ends = np.frombuffer(units.buffers()[1], np.int32)[units.offset:][:len(units) + 1]
        text = units.buffers()[2][int(ends[0]):int(ends[-1])].to_pybytes().decode()
        place, held = self._places(_keys(text, pc.utf8_length(units).to_numpy().astype(np.int64)))
        return np.where(held, place, -1)

    def find(self, units: list[str]) -> list[bytes | None]:
        """Ids of each unit, None for one that is not held."""
        if not units or not len(self.keys):
            return [None] * len(units)
        place, held = self._places(unit_keys(units))
        starts, stops = 4 * self.ends[place], 4 * self.ends[place + 1]
        return [self.raw[a:b] if h else None for a, b, h in zip(starts.tolist(), stops.tolist(), held.tolist(), strict=True)]


class Remembered:
    """Ids of units found last, for a task: at most ``LIMIT`` of them, None for one that is not held."""

    LIMIT = 80_000

    def __init__(self, known: Known):
        self.known = known
        self.ids: dict[str, bytes | None] = {}

    def learn(self, found: list[list[str]]) -> set[str]:
        """The units of ``found``, all of which are in ``ids`` afterwards."""
        units = set().union(*found)
        fresh = units.difference(self.ids)
        if len(self.ids) + len(fresh) > self.LIMIT:
            self.ids, fresh = {}, units
        fresh = list(fresh)
        self.ids.update(zip(fresh, self.known.find(fresh), strict=True))
        return units


def frequent(encoded: DataFrame, most: int = FREQUENT) -> Known:
    """Ids of at most ``most`` units, those that occur more often than some number of times."""
    # one row for each number of occurrences above which fewer than ``most`` units lie
    counts = encoded.groupBy("n").agg(F.count("*").alias("units")).orderBy(F.col("n").desc()).limit(most).collect()
    total, least = 0, None
    for row in counts:
        total += row["units"]
        if total > most:
            break
        least = row["n"]
    if least is None:
        return Known.of([], np.zeros(0, np.uint32), np.zeros(1, np.int64))
    rows = encoded.where(F.col("n") >= least).select("unit", "ids").toArrow()
    ids = rows["ids"].combine_chunks()
    return Known.of(rows["unit"].to_pylist(), ids.flatten().to_numpy(), ids.offsets.to_numpy() - ids.offsets[0].as_py())


def runs(block: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``block`` that ``index`` names, one after the other, and where each begins and the last ends.

    ``block`` is made of runs of the given sizes.
    """
    wanted = sizes[index]
    ends = np.r_[0, np.cumsum(wanted)]
    shift = (np.cumsum(sizes) - sizes)[index] - ends[:-1]
    return block[np.repeat(shift, wanted) + np.arange(ends[-1])], ends


class Decoder:
    """Texts of ids."""

    def __init__(self, pieces: Pieces):
        known = {i: t.replace(SPACE, " ").encode() for i, t in zip(pieces.ids, pieces.texts, strict=True)}
        known.update({pieces.first_byte + b: bytes([b]) for b in range(256)})
        found = [known.get(i, b"") for i in range(max(known) + 1)]
        self.block = np.frombuffer(b"".join(found), np.uint8)
        self.sizes = np.array([len(f) for f in found], np.int64)

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The text of each byte string of 32-bit ids."""
        out, ends = runs(self.block, self.sizes, np.frombuffer(b"".join(ids), "<u4"))
        raw, places = out.tobytes(), ends[np.r_[0, np.cumsum([len(i) // 4 for i in ids], dtype=np.int64)]].tolist()
        return [raw[a + 1:b] for a, b in zip(places, places[1:])]


def text_key(raw: bytes) -> int:
    """Texts that share a key by chance share their rare units, which changes no result."""
    return xxhash.xxh3_64_intdigest(raw) - (1 << 63)


def shared_beginning(texts: DataFrame) -> bytes:
    """A compression dictionary from about 1,000 texts, so that short texts shrink as long ones do."""
    numbered = texts.where("text is not null").withColumn("row", F.monotonically_increasing_id())  # which ones changes no result
    some = [r["text"].encode() for r in sampled(numbered, 1_000, "text", "row").collect()]
    try:
        return zstandard.train_dictionary(1 << 16, some).as_bytes()
    except zstandard.ZstdError:  # too few or too small texts to learn from
        return b""


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session while what is inside runs."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def encode(docs: DataFrame, pieces: Pieces, columns: list[str], kind: str, result) -> DataFrame:
    """Encode whole texts and apply ``result(texts, ids)`` to them.

    ``columns`` of ``docs`` are kept as they are; ``kind`` is the type of what ``result`` returns, as
    columns of Arrow arrays for a list of texts (missing ones as None) and one of byte strings of 32-bit
    ids. Missing and empty texts have no ids. Rows with equal texts are encoded alike, whatever their
    ids. An empty table gives no rows. Other columns than ``columns`` and text are not looked at.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("text").cast("string").alias("text"))
    # lists are gathered from sorted edges: by hash they would fall back to sorting, and twice
    with setting(spark, "spark.sql.execution.useObjectHashAggregateExec", "false"):
        encoded = stage(encode_units(count_units(texts, pieces), pieces), "units")
    known = spark.sparkContext.broadcast((pieces, frequent(encoded)))

    @lean
    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, common = known.value
        cut, seen = cutter(vocabulary), set()
        for batch in batches:
            for some in slices(batch, "text", SLICE):
                keys, missing = [], []
                texts_ = some.column(0).fill_null("").to_pylist()
                units, begin, _ = cut.spans(texts_)
                coded = units.dictionary_encode()
                absent = common.places(coded.dictionary) < 0
                absent[absent] = cut.lattice_has(coded.dictionary.filter(pa.array(absent)))
                names = np.where(absent, coded.dictionary.to_numpy(zero_copy_only=False), None)
                index = coded.indices.to_numpy()
                places = np.flatnonzero(absent[index])
                wanted, numbers = np.searchsorted(places, begin), index[places]
                for text, a, b in zip(texts_, wanted[:-1].tolist(), wanted[1:].tolist(), strict=True):
                    key = text_key(text.encode()) if a < b else 0
                    if a < b and key not in seen:
                        if len(seen) < 100_000:
                            seen.add(key)
                        keys.append(key)
                        missing.append([names[i] for i in set(numbers[a:b].tolist())])
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(missing, pa.list_(pa.string()))], ["text_key", "units"])

    # the ids of rare units, by the text that needs them
    needs = texts.mapInArrow(rare, "text_key long, units array<string>").select("text_key", F.explode("units").alias("unit"))
    # as one string: units hold no space
    named = encoded.select("unit", F.concat_ws(" ", "unit", F.col("ids").cast("array<string>")).alias("named"))
    held = needs.join(named, "unit").groupBy("text_key").agg(F.collect_set("named").alias("rest"))

    schema = docs.select(*[F.col(f"`{c}`") for c in columns]).schema
    width = len(columns)

    shared_bytes = shared_beginning(texts)

    def shared():
        return zstandard.ZstdCompressionDict(shared_bytes) if shared_bytes else None

    @lean
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=6, dict_data=shared())
        for batch in batches:
            for some in slices(batch, "_text", SLICE):
                raw = [None if t is None else t.encode() for t in some.column(width).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[:width], pa.array([text_key(r or b"") for r in raw], pa.int64()),
                     pa.array([None if r is None else squeeze.compress(r) for r in raw], pa.binary())],
                    [*columns, "_key", "_packed"])

    @lean
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, common = known.value
        cut, open_ = cutter(vocabulary), zstandard.ZstdDecompressor(dict_data=shared())
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                own = [None if p is None else open_.decompress(p).decode() for p in some.column(width).to_pylist()]
                extra = {}
                for named in some.column(width + 1).to_pylist():
                    for row in named or ():
                        unit, _, numbers = row.partition(" ")
                        extra[unit] = array("I", map(int, numbers.split(" "))).tobytes()
                units, begin, mark = cut.spans([t or "" for t in own])
                coded = units.dictionary_encode()
                place = common.places(coded.dictionary)
                absent = place < 0
                # what neither table has is a long unit or a single character outside all pieces
                found = [extra.get(u) or cut.path(u) for u in strings(coded.dictionary.filter(pa.array(absent)), mark)]
                # the units of ``found`` are numbered on from the frequent ones
                place[absent] = len(common.keys) + np.arange(len(found))
                block = np.concatenate([common.ids, np.frombuffer(b"".join(found), "<u4")])
                sizes = np.r_[common.sizes, np.array([len(i) // 4 for i in found], np.int64)]
                out, ends = runs(block, sizes, place[coded.indices.to_numpy()])
                raw, places = out.tobytes(), (4 * ends[begin]).tolist()
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[:width], *result(own, [raw[a:b] for a, b in zip(places, places[1:])], vocabulary)], [*columns, *names])

    added = spark.createDataFrame([], kind).schema
    names = [f.name for f in added]
    kept = [F.col(f"`{c}`") for c in columns]
    packed_schema = StructType([*schema, StructField("_key", LongType()), StructField("_packed", BinaryType())])
    packed = docs.select(*kept, F.col("text").cast("string").alias("_text")).mapInArrow(pack, packed_schema)
    joined = packed.join(held.withColumnRenamed("text_key", "_key"), "_key", "left").select(*kept, "_packed", "rest")
    return joined.mapInArrow(write, StructType([*schema, *added]))


_decoders: dict[int, Decoder] = {}


def digests(texts, ids, vocabulary):
    """Number and crc32 of the ids and whether they decode to the text."""
    key = len(vocabulary.texts)
    decoder = _decoders.setdefault(key, None) or _decoders.__setitem__(key, Decoder(vocabulary)) or _decoders[key]
    exact = [d == (t or "").encode() for t, d in zip(texts, decoder.decode(ids), strict=True)]
    return [pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array([zlib.crc32(i) for i in ids], pa.int64()),
            pa.array(exact, pa.bool_())]


def ids_of(texts, ids, vocabulary):
    """The ids themselves."""
    return [pa.array([np.frombuffer(i, "<u4").astype(np.int32) for i in ids], pa.list_(pa.int32()))]

"""Token ids in flat binary files with 64-bit document offsets, written and read by Spark tasks.

A document's ids lie one after the other in ``part-N.ids`` (unsigned, 2 bytes where every id
fits, else 4); ``part-N.offsets`` has the 64-bit place of each document's first id in its file and
one closing entry, ``part-N.docs`` the 64-bit document ids. Files follow the ascending order of
doc_id. The place of a file's first id among all ids is a prefix sum over the files' counts, kept
in ``index``. Files are memory-mapped by their readers, so the folder has to be mounted.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import free_marks, slices
from tablewright.session import staging_root

def _kinds() -> np.ndarray:
    """Of each character: 1 letters and digits, 2 sentence marks, 3 line end, 4 space, 5 other white
    space and what some libraries count as such, 0 all others."""
    kinds = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        c = chr(code)
        if c.isalnum():
            kinds[code] = 1
        elif c.isspace() or c in "\u180e\u200b\u2060\ufeff":
            kinds[code] = 5
    for chars, kind in ((".,;:!?", 2), ("\n", 3), (" ", 4)):
        kinds[[ord(c) for c in chars]] = kind
    return kinds


def split(texts: list[str], kinds: np.ndarray) -> list[list[str]]:
    """Texts cut where a byte-level pre-token always ends.

    These places are before a space and a character that no library counts as white space, between
    a letter or digit and a sentence mark or line end, and between a single line end and a letter or
    digit.
    Ids of the pieces are the ids of the text.
    """
    mark = free_marks("".join(texts), 2)
    codes = np.frombuffer((mark[1].join(texts) + mark[1]).encode("utf-32-le"), np.uint32)
    kind = kinds[codes]
    kind[codes == ord(mark[1])] = 6
    here, after = kind[:-1], kind[1:]
    cut = np.zeros(len(codes), bool)
    cut[1:] = (here == 1) & ((after == 2) | (after == 3))
    alone = (here == 3) & (after == 1)  # a longer run of white space keeps its last character apart
    alone[1:] &= (here[:-1] < 3) | (here[:-1] == 6)
    cut[1:] |= alone
    cut[1:-1] |= (after[:-1] == 4) & (here[:-1] != 6) & (after[1:] < 3)
    marked = np.insert(codes, np.flatnonzero(cut), ord(mark[0])).tobytes().decode("utf-32-le")
    return [t.split(mark[0]) for t in marked.split(mark[1])[:-1]]


#: pieces that can be encoded in one text, one in a line
PLAIN = re.compile(r" ?\S+\Z")
#: pieces of a generation of the memory, and the longest piece that is remembered
CACHED, CACHED_LENGTH = 400_000, 64

PARTS = "part long, n_docs long, n_null long, n_tokens long"
DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"


class Encoder:
    """Ids of whole texts as bytes, remembering those of short pieces between spaces."""

    def __init__(self, definition: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # pieces are only independent under a byte-level split that keeps a space with its word
        kind = type(self.tokenizer.pre_tokenizer).__name__
        self.by_piece = kind == "ByteLevel" and self.tokenizer.normalizer is None
        top = max(self.tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id)
        self.dtype = np.dtype("<u2") if top < 1 << 16 else np.dtype("<u4")
        self.end = np.array([end_id], self.dtype).tobytes()
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.kinds = _kinds()

        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line = line[0] if len(line) == 1 else None

    def ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in found]

    def ids_of_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of distinct pieces; those without inner white space are encoded as lines of one text."""
        plain = [p for p in pieces if self.line is not None and PLAIN.match(p)]
        rest = list(set(pieces) - set(plain))
        out = dict(zip(rest, self.ids(rest), strict=True))
        if plain:
            found, = self.tokenizer.encode_batch_fast(["\n".join(plain) + "\n"], add_special_tokens=False)
            ids = np.array(found.ids, self.dtype)
            ends = np.flatnonzero(ids == self.line)
            raw, size = ids.tobytes(), self.dtype.itemsize
            starts = np.append(0, ends[:-1] + 1) * size
            out.update((p, raw[a:b]) for p, a, b in zip(plain, starts.tolist(), (ends * size).tolist(), strict=True))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text and the end id."""
        parted = [i for i, t in enumerate(texts) if t and self.by_piece and not any(s in t for s in self.special)]
        whole = sorted(set(range(len(texts))) - set(parted))
        out = [b""] * len(texts)
        for i, ids in zip(whole, self.ids([texts[i] for i in whole]), strict=True):
            out[i] = ids
        pieces = split([texts[i] for i in parted], self.kinds) if parted else []
        if len(self.known) > CACHED:
            self.before, self.known = self.known, {}
        # what the last generation knows moves on, the rest is new
        needed = set(chain.from_iterable(pieces)).difference(self.known)
        again = needed.intersection(self.before)
        self.known.update((p, self.before[p]) for p in again)
        fresh = self.ids_of_pieces(list(needed - again))
        self.known.update(fresh)
        for i, own in zip(parted, pieces, strict=True):
            out[i] = b"".join(map(self.known.__getitem__, own))
        for p in fresh:
            if len(p) > CACHED_LENGTH:
                del self.known[p]
        return [ids + self.end for ids in out]


_encoders: dict[tuple[int, int], Encoder] = {}


def encoder(definition: str, end_id: int) -> Encoder:
    """One encoder for a worker process, so that its memory serves many tasks."""
    key = (zlib.crc32(definition.encode()), end_id)
    if key not in _encoders:
        _encoders[key] = Encoder(definition, end_id)
    return _encoders[key]


def mounted(folder: str) -> str:
    """The path of a folder that every executor has mounted."""
    parsed = urlparse(folder)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"token files are memory-mapped, so {folder} has to be a mounted folder")
    return parsed.path


def write(docs: DataFrame, definition: str, end_id: int, folder: str | None = None,
          id_column: str = "doc_id", text_column: str = "text") -> str:
    """Encode every text and write the files; returns their folder.

    ``definition`` is the JSON of a public tokenizer. A missing text counts as empty and gets the
    end id alone; missing document ids come first; rows that share an id are all written, next to
    each other. Other columns are ignored and an empty table gives no files. A task writes under
    a name of its own and renames at the end, so that a repeated task leaves whole files.
    """
    spark = docs.sparkSession
    folder = folder or f"{staging_root(spark)}/tokens-{uuid.uuid4().hex}"
    path = mounted(folder)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        batch = next(batches, None)
        if batch is None:
            return
        coder = encoder(definition, end_id)
        os.makedirs(path, exist_ok=True)
        name, own = f"{path}/part-{part:08d}", uuid.uuid4().hex
        n_docs = n_null = n_tokens = 0
        files = {kind: open(f"{name}.{kind}.{own}", "wb") for kind in ("ids", "offsets", "docs")}
        try:
            while batch is not None:
                for some in slices(batch, "text"):
                    ids = coder.encode(some.column(1).fill_null("").to_pylist())
                    sizes = np.array([len(x) // coder.dtype.itemsize for x in ids], np.int64)
                    files["ids"].writelines(ids)
                    files["offsets"].write((n_tokens + np.cumsum(sizes) - sizes).tobytes())
                    keys = some.column(0)
                    n_null += keys.null_count
                    files["docs"].write(keys.fill_null(0).to_numpy().astype("<i8").tobytes())
                    n_docs += len(ids)
                    n_tokens += int(sizes.sum())
                batch = next(batches, None)
            files["offsets"].write(np.array([n_tokens], "<i8").tobytes())
        finally:
            for file in files.values():
                file.close()
        for kind in files:
            os.replace(f"{name}.{kind}.{own}", f"{name}.{kind}")
        yield pa.RecordBatch.from_pydict({"part": [part], "n_docs": [n_docs], "n_null": [n_null],
                                          "n_tokens": [n_tokens]})

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"),
                       F.col(text_column).cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("row_key"))
    # rows that share one id may still be dealt to several files, by their text and number
    order = ["doc_id", F.xxhash64("text"), "row_key"]
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text") \
        .mapInArrow(task, PARTS).collect()  # one row for each file
    parts = sorted(parts, key=lambda r: r.part)
    ends = np.cumsum([r.n_tokens for r in parts])
    width = Encoder(definition, end_id).dtype.itemsize
    index = [(r.part, r.n_docs, r.n_null, r.n_tokens, int(e - r.n_tokens), width)
             for r, e in zip(parts, ends, strict=True)]
    spark.createDataFrame(index, PARTS + ", base long, width int").coalesce(1) \
        .write.parquet(f"{folder}/index")
    return folder


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of written files: doc_id, start, n_tokens and ids_crc32 (over 32-bit ids)."""
    path = mounted(folder)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                name = f"{path}/part-{row['part']:08d}"
                ids = np.memmap(f"{name}.ids", f"<u{row['width']}", "r")
                offsets = np.memmap(f"{name}.offsets", "<i8", "r")
                keys = np.memmap(f"{name}.docs", "<i8", "r")
                for at in range(0, row["n_docs"], 20_000):
                    to = min(at + 20_000, row["n_docs"])
                    bounds = offsets[at:to + 1].tolist()
                    crcs = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(bounds, bounds[1:])]
                    place = np.arange(at, to)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(keys[at:to].astype(np.int64), mask=place < row["n_null"]),
                        pa.array(offsets[at:to].astype(np.int64) + row["base"]),
                        pa.array(np.diff(offsets[at:to + 1]).astype(np.int64)),
                        pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    index = spark.read.parquet(f"{folder}/index")
    # a given number is not merged into fewer tasks, however small the rows that name the files
    return index.repartition(max(1, index.count()), "part").mapInArrow(task, DOCS)


def token_ids(folder: str, part: int, document: int, width: int) -> np.ndarray:
    """Ids of one document of a file, without reading the rest."""
    name = f"{mounted(folder)}/part-{part:08d}"
    start, stop = np.memmap(f"{name}.offsets", "<i8", "r")[document:document + 2]
    return np.memmap(f"{name}.ids", f"<u{width}", "r")[start:stop]

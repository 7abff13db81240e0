"""Reading tables, byte-bounded slices of Arrow batches and stable word hashes."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterator
from functools import wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII letters to lower case, everything that is neither letter, digit nor above ASCII to a space
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256))


#: rows of an Arrow batch
BATCH_ROWS = 2_000

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this library to the Python workers of the application, once.

    Spark's own file server hands it out, so executors need no path of their own to it. Texts are
    long, so Arrow batches of this session get fewer rows than Spark's default, unless set already.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    name = os.path.join(tempfile.mkdtemp(prefix="ship-"), "tablewright_library.zip")
    with zipfile.ZipFile(name, "w") as archive:
        for path in sorted((root / "tablewright").rglob("*.py")):
            archive.write(path, path.relative_to(root))
    spark.sparkContext.addPyFile(name)
    _shipped.add(app)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def keyed(df: DataFrame, *columns: str, key: str | None = None) -> DataFrame:
    """The named columns and ``row_key``, a number of the row, or the column ``key``.

    Doubled and missing ids are allowed everywhere, so rows are told apart by this key. It
    depends on the partitions read, so stage what carries it before joining on it.
    """
    number = F.monotonically_increasing_id() if key is None else F.col(f"`{key}`")
    return df.select(*[F.col(f"`{c}`") for c in columns], number.alias("row_key"))


def sampled(df: DataFrame, rows: int, *columns: str) -> DataFrame:
    """About ``rows`` rows of ``df`` by a hash of the columns, all if there are no more.

    For training classifiers only. The choice does not depend on files and partitions; rows equal in
    the columns share a fate, so these should hold an id. Each task keeps its share, so nothing is
    gathered to choose.
    """
    share = min(1.0, rows / max(1, df.count()))
    number = F.xxhash64(F.lit(11), *[F.col(f"`{c}`") for c in columns])
    return df if share == 1.0 else df.where(F.pmod(number, F.lit(1 << 30)) < int(share * (1 << 30)))


def bit_table(hashes: DataFrame, bits: int) -> bytes:
    """A bit for every value that the low ``bits`` of the column ``hash`` take.

    The table has a fixed size whatever the number of rows: as it fills up it lets more through,
    so it may only save work before an exact step. It is a sum over at most 2^(bits - 3) bytes.
    """
    packed = hashes.select(F.expr(f"hash & {(1 << bits) - 1}").alias("place")).distinct() \
        .groupBy(F.shiftright("place", 3).alias("byte")) \
        .agg(F.sum(F.pow(F.lit(2.0), 7 - F.col("place") % 8)).cast("int").alias("bits")).toArrow()
    table = np.zeros(1 << (bits - 3), np.uint8)
    table[packed["byte"].to_numpy()] = packed["bits"].to_numpy()
    return table.tobytes()


def within(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes a table of ``bit_table`` lets through."""
    low = (hashes.view(np.uint64) & np.uint64(8 * len(table) - 1)).astype(np.int64)
    return (table[low >> 3] >> (7 - (low & 7)).astype(np.uint8)) & np.uint8(1) > 0


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` whose texts have about ``limit`` bytes; a longer text comes alone."""
    at = batch.schema.get_field_index(column)
    sizes = pc.binary_length(batch.column(at)).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text, those of a missing one being empty."""
    binary = pa.binary() if pa.types.is_string(column.type) else pa.large_binary()
    return column.cast(binary).fill_null(b"").to_pylist()


def words_of(raw: bytes) -> list[bytes]:
    """Lower-case runs of ASCII letters, digits and anything above ASCII."""
    return raw.translate(WORD_BYTES).split()


def free_marks(text: str, n: int) -> str:
    """``n`` characters that ``text`` does not hold, from the end of the private planes."""
    found = (chr(c) for c in range(0x10FFFD, 0xE000, -1) if chr(c) not in text)
    return "".join(next(found) for _ in range(n))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a fixed number of words."""

    LIMIT = 100_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


#: one memory for all operators of a worker process
word_hashes = WordHashes()


def lean(task):
    """A function over Arrow batches whose worker holds no more memory before and after it than it needs.

    Workers outlive a stage. What other operators remember is forgotten before, and freed memory goes
    back to the system after the last batch.
    """
    @wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_hashes.clear()
        release()
        try:
            yield from task(batches)
        finally:
            release()

    return run


def release() -> None:
    """Give freed memory of this process back to the system, where its allocators can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


#: odd multipliers of a polynomial over word hashes, one for each place
PLACES = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) | 1 for i in range(64)], np.uint64)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` successive words, by the place of its first word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = words[:n] * PLACES[0]
    for i in range(1, size):
        total += words[i:i + n] * PLACES[i]
    total ^= total >> np.uint64(31)
    total *= np.uint64(0xD6E8FEB86659FD93)
    return total ^ (total >> np.uint64(32))


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned hashes as Spark's long."""
    return values.view(np.int64)

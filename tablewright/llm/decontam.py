"""Benchmark decontamination as a prefix-filtered set join with exact windows.

A window is ``size`` successive words of a benchmark item, or the whole item if it has fewer. Its
tokens are the shingles of ``SHINGLE`` words in it. A document contains the window only if it has
all of its shingles, so by the prefix rule for full containment one shingle is enough to find it:
the rarest by the number of documents that have it. Documents send out the places of such
shingles only; an equi-join on the shingle meets the windows, the place of the shingle in the
window and the length of the document bound where the window can lie, and its words are compared
one by one. A word of the document under any such window is hit.

Rows are never paired beyond equal rarest shingles. What every task holds is a bit table of fixed
size over the hashes of the shingles looked for; a hash that shares a bit by chance is thrown out
by the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import (bit_table, keyed, shingle_hashes, signed, slices, text_bytes,
                                    within, word_hashes, words_of)
from tablewright.session import stage

SHINGLE = 3
#: bits of the table of shingles looked for; its size does not depend on the data
FILTER_BITS = 24



def windows_of(benchmark: DataFrame, size: int = 13) -> DataFrame:
    """Distinct windows: window (number), words, n, item_ids; missing and empty texts have none."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text", 1 << 16):
                items, found = [], []
                for item, raw in zip(some.column(0).to_pylist(), text_bytes(some.column(1)), strict=True):
                    words = [w.decode() for w in words_of(raw)]
                    runs = [words[i:i + size] for i in range(max(1, len(words) - size + 1))]
                    runs = [r for r in runs if r]
                    items += [item] * len(runs)
                    found += runs
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items, pa.int64()), pa.array(found, pa.list_(pa.string()))], ["item_id", "words"])

    texts = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                             F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(task, "item_id long, words array<string>").distinct()


def _shingles(windows: DataFrame) -> DataFrame:
    """All shingles of the windows: words, n, offset, hash; shorter windows are one shingle."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, offsets, hashes, sizes = [], [], [], []
            for run in batch.column(0).to_pylist():
                size = min(SHINGLE, len(run))
                found = shingle_hashes(word_hashes.of([w.encode() for w in run]), size)
                words += [run] * len(found)
                offsets += range(len(found))
                hashes.append(signed(found))
                sizes += [size] * len(found)
            yield pa.RecordBatch.from_arrays([
                pa.array(words, pa.list_(pa.string())), pa.array(offsets, pa.int32()),
                pa.array(np.concatenate(hashes) if hashes else [], pa.int64()),
                pa.array(sizes, pa.int32())], ["words", "offset", "hash", "size"])

    return windows.select("words").distinct().mapInArrow(
        task, "words array<string>, offset int, hash long, size int")


def document_frequencies(texts: DataFrame, bits: bytes, sizes: list[int]) -> DataFrame:
    """Number of documents with each shingle that the filter lets through: hash, n_docs."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.frombuffer(bits, np.uint8)
        waiting, held = [], 0

        def flush():
            hashes, counts = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.RecordBatch.from_pydict({"hash": hashes.view(np.int64), "n": counts})

        for batch in batches:
            for some in slices(batch, "text"):
                for raw in text_bytes(some.column(0)):
                    words = word_hashes.of(words_of(raw))
                    for size in sizes:
                        found = shingle_hashes(words, size)
                        found = found[within(wanted, found)]
                        if len(found):
                            waiting.append(np.unique(found))
                            held += len(waiting[-1])
            if held > 1_000_000:
                yield flush()
                waiting, held = [], 0
        if held:
            yield flush()

    return texts.mapInArrow(task, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n_docs"))


def find_hits(texts: DataFrame, bits: bytes, sizes: list[int], size: int) -> DataFrame:
    """For every row its number of words and, for every place of a shingle looked for, the words
    from ``size`` - 1 before to ``size`` - 1 after it."""
    kind = "row_key long, doc_id long, n_words long, hits array<struct<hash:long,at:int,first:int,near:array<string>>>"
    near = pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int32()), ("first", pa.int32()),
                               ("near", pa.list_(pa.string()))]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.frombuffer(bits, np.uint8)
        for batch in batches:
            for some in slices(batch, "text"):
                counts, hits = [], []
                for raw in text_bytes(some.column(2)):
                    split = words_of(raw)
                    words, own = word_hashes.of(split), []
                    counts.append(len(split))
                    for length in sizes:
                        found = shingle_hashes(words, length)
                        for at in np.flatnonzero(within(wanted, found)).tolist():
                            first = max(0, at - size + 1)
                            own.append({"hash": int(found[at].view(np.int64)), "at": at, "first": first,
                                        "near": [w.decode() for w in split[first:at + size]]})
                    hits.append(own)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(counts, pa.int64()), pa.array(hits, near)],
                    ["row_key", "doc_id", "n_words", "hits"])

    return texts.select("row_key", "doc_id", "text").mapInArrow(task, kind)


def overlaps(docs: DataFrame, benchmark: DataFrame, size: int = 13, share: int = 20, key: str | None = None) -> DataFrame:
    """Per document: row_key, doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A document is contaminated if at least one in ``share`` of its words is hit. Missing texts
    have no words; rows that share an id are judged one by one; a missing item_id counts as no
    item though its windows hit. An empty benchmark leaves every document clean. ``key`` names a column
    of unique longs to be row_key.
    """
    texts = keyed(docs, "doc_id", "text", key=key).select(
        "row_key", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    windows = stage(windows_of(benchmark, size), "windows")
    shingles = stage(_shingles(windows), "shingles")
    sizes = sorted(r["size"] for r in shingles.select("size").distinct().collect())  # 1 to SHINGLE
    counts = document_frequencies(texts.select("text"), bit_table(shingles.select("hash"), FILTER_BITS), sizes)
    # the rarest shingle of every window; ties by hash, so that equal choices meet
    rarest = stage(
        shingles.join(counts, "hash", "left").groupBy("words")
        .agg(F.min(F.struct(F.coalesce("n_docs", F.lit(0)).alias("n_docs"), "hash", "offset")).alias("r"))
        .where("r.n_docs > 0")  # a shingle that no document has leaves nothing to find
        .select(F.col("r.hash").alias("hash"), F.col("r.offset").alias("offset"), "words",
                F.size("words").alias("n")), "rarest")
    hits = stage(find_hits(texts, bit_table(rarest.select("hash"), FILTER_BITS), sizes, size), "hits")
    places = hits.select("row_key", "n_words", F.inline("hits"))
    start = F.col("at") - F.col("offset")
    within = F.slice("near", start - F.col("first") + 1, F.col("n")) == F.col("words")
    found = places.join(rarest, "hash") \
        .where((start >= 0) & (start + F.col("n") <= F.col("n_words")) & within) \
        .select("row_key", "words", start.alias("start"), "n")
    found = stage(found, "found")
    runs = found.groupBy("row_key").agg(F.size(F.array_distinct(F.flatten(F.transform(
        F.collect_set(F.struct("start", "n")),
        lambda r: F.sequence(r["start"], r["start"] + r["n"] - 1))))).cast("long").alias("n_hit"))
    held = found.select("row_key", "words").distinct().join(windows, "words") \
        .where("item_id is not null").groupBy("row_key") \
        .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return hits.select("row_key", "doc_id", "n_words").join(runs, "row_key", "left") \
        .join(held, "row_key", "left").select(
            "row_key", "doc_id", "n_words", n_hit.alias("n_hit"),
            F.size(items).cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
            ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"))

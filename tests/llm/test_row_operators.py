"""Chat, language, neighbours and near-duplicates against brute force."""

import hashlib
import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import check
from tablewright.llm import ann, chat, common, graph, language, near, queries
from tablewright.llm.registry import ORACLES, QUERIES

from .conftest import FOLDER


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert check.compare(QUERIES[name](spark, FOLDER), check.oracle(FOLDER), ORACLES[name]) == ""


def digests_slow(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda t: t[:3])
        said = "".join(t[3] for t in turns if t[2] == "assistant")
        whole = "".join(f"{t[2]}\n{t[3]}\n" for t in turns)
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def test_chat_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", queries.CONTROL), (-1, 1, "assistant", queries.CONTROL)]
    got = {r.conv_id: tuple(r)[1:5] for r in QUERIES["op3_chat"](spark, FOLDER).collect()}
    assert got == digests_slow(rows)


ODD_TURNS = [
    (1, 0, "user", None), (1, 1, "assistant", ""), (1, None, None, "before"), (1, 1, "assistant", "x<|im_end|>"),
    (2, 0, "assistant", "<\\|im_start|> <\\\\| <| <\\"), (2, 1, "a\nb\\n<|", "line\n<|im_end|>\n"), (2, 2, "assistant", "<"),
    (None, 0, "user", "no conversation"), (3, 5, "assistant", "long " * 60_000)]


def test_chat_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = spark.createDataFrame(ODD_TURNS, schema).withColumn("seq", F.lit("clash")).withColumn("kind", F.lit(1))
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digests(chat.format_turns(spark, rows)).collect()}
    assert got == digests_slow(ODD_TURNS)
    assert chat.digests(chat.format_turns(spark, spark.createDataFrame([], schema))).count() == 0


def test_chat_events(spark):
    """Deltas, an edit, a regeneration that drops what came after, and a later message."""
    events = [(1, 0, 0, "start", "user", None), (1, 0, 1, "delta", None, "Hel"), (1, 0, 2, "delta", None, "lo"),
              (1, 1, 3, "start", "assistant", None), (1, 1, 4, "delta", None, "bad"), (1, 2, 5, "start", "user", None),
              (1, 2, 6, "delta", None, "gone"), (1, 1, 7, "regenerate", None, None), (1, 1, 8, "delta", None, "good"),
              (1, 0, 9, "edit", None, "Hi"), (1, 0, 10, "delta", None, "!"), (1, 3, 11, "start", "user", None),
              (1, 3, 12, "delta", None, "bye"), (2, 0, 0, "start", "user", None)]
    log = spark.createDataFrame(events, "conv_id long, message long, seq long, kind string, role string, text string")
    rows = chat.fold(log).orderBy("conv_id", "message").collect()
    assert [(r.conv_id, r.message, r.role, r.text) for r in rows] == [
        (1, 0, "user", "Hi!"), (1, 1, "assistant", "good"), (1, 3, "user", "bye"), (2, 0, "user", "")]


def test_language_of_labelled_texts(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit(None).cast("string").alias("url"), F.col("text").alias("html"))
    rows = language.identify(pages, docs).join(docs.withColumnRenamed("lang", "truth"), F.col("page_id") == F.col("doc_id")).collect()
    assert np.mean([r.lang == r.truth for r in rows]) > 0.97


def test_language_evidence_is_fused(spark):
    """A page without text follows what it declares and its host; the host follows its pages."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = [r.text for r in docs.where("lang = 'fr' and length(text) > 500").limit(12).collect()]
    pages = [(i, "http://a.example.fr/x", f"<html lang=fr><script>x = '<p>the of and</p>'</script><p>{t}</p></html>") for i, t in enumerate(texts)]
    pages += [(50, "http://a.example.fr/y", "<html><p></p></html>"), (51, None, "<html lang='fr'></html>"), (52, None, None), (53, "", ""), (None, "::", "<")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("soft", F.lit("x"))
    got = {r.page_id: r for r in language.identify(frame, docs).collect()}
    assert len(got) == len(pages) and all(got[i].lang == "fr" for i in [*range(len(texts)), 50, 51])
    assert got[50].text_lang is None and got[50].host == "a.example.fr" and got[51].declared == "fr"
    assert abs(sum(got[52].posterior.values()) - 1) < 1e-9
    empty = docs.limit(0)
    assert {r.lang for r in language.identify(frame, empty).collect()} == {None}
    assert language.identify(frame.limit(0), docs).count() == 0


def nearest_slow(rows, step=50, k=5):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in sorted({i for i in ids.tolist() if i % step == 0}):
        score = unit @ unit[ids == q][0]
        order = np.lexsort((ids, -score.round(12)))
        out[q] = [(int(ids[i]), float(score[i])) for i in order if ids[i] != q][:k]
    return out


def test_neighbours_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    want = nearest_slow(rows)
    got = defaultdict(dict)
    for r in QUERIES["op7_ann"](spark, "/root/testdata/sf0.1").collect():
        got[r.query_id][r["rank"]] = (r.vec_id, r.score)
    assert got.keys() == want.keys() and all(sorted(g) == [1, 2, 3, 4, 5] for g in got.values())
    hits = [len({v for v, _ in want[q]} & {v for v, _ in got[q].values()}) / 5 for q in want]
    assert np.mean(hits) >= 0.9
    x = dict(rows)
    for q, found in got.items():
        for v, s in found.values():
            a, b = np.array(x[q], float), np.array(x[v], float)
            assert abs(s - a @ b / np.sqrt(a @ a) / np.sqrt(b @ b)) < 1e-12


def test_neighbours_odd_rows(spark, monkeypatch):
    """Copies of one vector, ties, useless vectors, shards, vectors of another length."""
    monkeypatch.setattr(ann, "SHARD", 40)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(150)]
    rows += [(i, [1.0] * 8) for i in range(150, 260)]
    useless = [(0, None), (300, []), (350, [0.0] * 8), (400, [float("nan")] * 8), (450, [None] * 8), (None, [1.0] * 8), (500, [float("inf")] + [1.0] * 7)]
    schema = "vec_id long, embedding array<float>, label int"
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows + useless + [(1_000, [1.0, 2.0]), (1_001, [2.0, 1.0])]], schema).withColumn("shard", F.lit("x"))
    got = defaultdict(dict)
    for r in ann.nearest(frame).collect():
        got[r.query_id][r["rank"]] = r.vec_id
    want = nearest_slow(rows)
    assert got.keys() == want.keys() | {1_000} and got[1_000] == {1: 1_001}
    for q in (150, 200, 250):
        assert list(got[q].values()) == [v for v, _ in want[q]] or sorted(got[q].values()) == sorted(v for v, _ in want[q])
    assert np.mean([len({v for v, _ in want[q]} & set(got[q].values())) / 5 for q in want]) >= 0.9
    assert ann.nearest(frame.limit(0)).count() == 0


def sets_slow(text):
    words = common.words_of((text or "").encode())
    n = min(5, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()


def classes_slow(texts, threshold=Fraction(4, 5)):
    sets = [sets_slow(t) for t in texts]
    parent, links = list(range(len(sets))), [0] * len(sets)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(set)
    for i, s in enumerate(sets):
        for g in s:
            where[g].add(i)
    for i, s in enumerate(sets):
        for j in sorted({j for g in s for j in where[g] if j > i}):
            both = len(s & sets[j])
            if both >= threshold * (len(s) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [(find(i), n) for i, n in enumerate(links)]


def variants(rng):
    """Families of texts with growing numbers of changed words, copies and short texts."""
    vocabulary = [f"w{i}" for i in range(3_000)]
    texts = [None, "", "...", "one", "one", "ONE!", "one two three four", "one two three four", "a b c d e", "a b c d e f"]
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(20, 300))]
        texts.append(" ".join(base))
        for _ in range(6):
            other = list(base)
            for _ in range(rng.randrange(0, 6)):
                other[rng.randrange(len(other))] = rng.choice(vocabulary)
            texts.append(" ".join(other))
    shared = [rng.choice(vocabulary) for _ in range(60)]
    texts += [" ".join(shared + [rng.choice(vocabulary) for _ in range(100)]) for _ in range(40)]
    return texts


@pytest.mark.parametrize("block", [1_024, 4])
def test_near_classes_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near, "FAMILY_BLOCK", block)
    monkeypatch.setattr(near, "NODE_BLOCK", block)
    texts = variants(random.Random(8))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("node", F.lit("x"))
    got = {r.doc_id: (r.class_id, r.n_links) for r in near.classes(frame).collect()}
    want = classes_slow(texts)
    assert got == dict(enumerate(want))


def test_near_documents(spark, documents):
    got = {r.doc_id: (r.class_id, r.n_links) for r in QUERIES["op9_near"](spark, FOLDER).collect()}
    ids = [i for i, _ in documents]
    want = {ids[i]: (c, n) for i, (c, n) in enumerate(classes_slow([t for _, t in documents]))}
    assert {i: n for i, (_, n) in got.items()} == {i: n for i, (_, n) in want.items()}
    groups_of = lambda found: {frozenset(i for i in found if found[i][0] == c) for c in {c for c, _ in found.values()}}
    assert groups_of(got) == groups_of(want)


def test_near_odd_rows(spark, odd_documents, no_documents):
    rows = near.classes(odd_documents).collect()
    assert len(rows) == 10
    long = {r.doc_id: r for r in rows if r.doc_id in (5, 6)}
    assert long[5].class_id == long[6].class_id == 5 and long[5].n_links == 1
    assert near.classes(no_documents).count() == 0


def test_recall_sets_the_depth():
    d = near.depth_for(0.8, 0.999)
    assert 1 - (1 - 0.8 ** d) ** near.TREES >= 0.999 > 1 - (1 - 0.8 ** (d + 1)) ** near.TREES


def test_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(0, 60) if i % 13] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(180)] + [(7, 7), (5_000, 4_000)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r.id: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_of_streams():
    import pyarrow as pa

    keys = [1, 1, 2, 3, 3, 3, 3, 4, 5, 5]
    for size in (1, 2, 3, 10):
        batches = [pa.RecordBatch.from_pydict({"k": keys[i:i + size]}) for i in range(0, len(keys), size)]
        assert [t.column(0).to_pylist() for t in graph.groups(iter(batches), 1)] == [[1, 1], [2], [3] * 4, [4], [5, 5]]
        for limit in (1, 20, 40, 10_000):
            whole = [t.column(0).to_pylist() for t in graph.whole_groups(iter(batches), limit)]
            assert sum(whole, []) == keys
            assert all(not set(a) & set(b) for i, a in enumerate(whole) for b in whole[i + 1:])


def test_queries_stream_past_a_shard_in_blocks():
    import pyarrow as pa

    rows = [(0, 0)] * 3_000 + [(0, 1)] * 5_000 + [(1, 0)] * 50 + [(1, 1)] * 10
    batches = [pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows[at:at + 700]]) for c in (0, 1)] + [pa.array(range(at, at + len(rows[at:at + 700])))],
                                          ["shard", "kind", "id"]) for at in range(0, len(rows), 700)]
    tables = list(graph.groups(ann.blocked(iter(batches)), 3))
    assert [i for t in tables for i in t.column(3).to_pylist()] == list(range(len(rows)))
    assert [t.num_rows for t in tables if t.column(1)[0].as_py() == 0] == [3_000, 50]
    assert max(t.num_rows for t in tables if t.column(1)[0].as_py() == 1) <= ann.BLOCK

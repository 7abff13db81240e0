"""PII, tokens, toxicity, decontamination, suffixes and pieces against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from tablewright import session
from tablewright.llm import common, decontam, pieces, pii, queries, suffix, tokens, toxicity
from tablewright.llm.registry import QUERIES

from .conftest import FOLDER


def luhn_slow(number):
    digits = [int(d) for d in number][::-1]
    return sum(d if i % 2 == 0 else (2 * d - 9 if 2 * d > 9 else 2 * d) for i, d in enumerate(digits)) % 10 == 0


def strict_slow(text):
    """The patterns as they are written, with the checks on every match."""
    found = [(m.start(), m.end(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), m.end(), 1))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn_slow(digits):
            found.append((m.start(), m.end(), 2))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), m.end(), 3))
    return sorted(found, key=lambda s: (s[0], s[2]))


def test_strict_spans_equal_the_patterns(documents):
    rng = random.Random(1)
    texts = [t for _, t in documents]
    texts += ["".join(rng.choice("a@.b-_9 1+()é%") for _ in range(rng.randrange(80))) for _ in range(4_000)]
    texts += ["".join(rng.choice("0123456789 -.+") for _ in range(60)) for _ in range(4_000)]
    texts += ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "@a.b", "x@y", "4111 1111 1111 1111", "+1 (555) 010-9999"]
    for t in texts:
        assert pii.strict(t) == strict_slow(t), t


def test_long_runs_are_linear():
    for t in ("a" * 300_000, "1" * 300_000, "+1(" + "(" * 300_000, "a@" * 100_000, "1." * 100_000):
        pii.strict(t)
        pii.candidates(t)


def test_pii_query(spark, documents):
    rows = QUERIES["op1_pii"](spark, FOLDER).collect()
    assert len(rows) == len(documents)
    texts = dict(documents)
    for r in rows:
        base = strict_slow(texts[r.doc_id] or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for *_, k in base) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert set(filter(None, pii.joined(base).split(","))) <= set(r.spans.split(","))


def test_trees_add_what_looks_alike(spark):
    """Cards with a wrong check digit are added where nearly all such numbers are cards."""
    rng = random.Random(5)

    def number(good):
        while True:
            n = "4" + "".join(rng.choice("0123456789") for _ in range(15))
            if luhn_slow(n) == good:
                return n

    rows = [(i, f"please pay with card {number(True)} today or call 12345 {i}") for i in range(400)]
    rows += [(1_000, f"please pay with card {number(False)} today or call 12345")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    detector = pii.fit(docs, rounds=5)
    assert detector.thresholds[2] <= 1
    found = {r.doc_id: r for r in pii.find(docs, detector).collect()}
    assert found[1_000].n_card == 0 and found[1_000].spans.startswith("card:")
    redacted = {r.doc_id: r.text for r in pii.redact(docs, detector).collect()}
    assert "[CARD]" in redacted[1_000] and not re.search("[0-9]{16}", redacted[1_000])


def test_loose_forms_of_every_kind_are_added(spark):
    """Written-out addresses, commas for dots, numbers without plus, and numbers within longer runs."""
    rng = random.Random(6)
    some = lambda n: "".join(rng.choice("123456789") for _ in range(n))

    def card():
        return next(c for c in iter(lambda: "4" + some(15), "") if luhn_slow(c))

    rows = []
    for i in range(400):
        name, c = f"user{rng.randrange(9_999)}", card()
        rows += [f"write to {name}@example.com or ref {some(9)}", f"server 10.{rng.randrange(255)}.3.{rng.randrange(255)} build 1.2.{some(3)}9.700",
                 f"pay by card {c} please", f"call +1 555 {some(3)} {some(4)} now", f"meet (at) noon{i}"]
        if i % 8 == 0:
            rows += [f"write to {name} (at) example (dot) org. Thanks", f"server 10,{rng.randrange(99)},3,{rng.randrange(255)} is up",
                     f"pay by card {c[:4]}.{c[4:8]}.{c[8:12]}.{c[12:]} please", f"call (555) {some(3)}-{some(4)} now"]
    c = card()
    wanted = {"email": ("write to jane [at] example (dot) org. Thanks", "jane [at] example (dot) org"), "ip": ("server 10,20,3,44 is up", "10,20,3,44"),
              "card": (f"pay by card {c[:4]}.{c[4:8]}.{c[8:12]}.{c[12:]} please", f"{c[:4]}.{c[4:8]}.{c[8:12]}.{c[12:]}"),
              "phone": ("call (555) 234-6789 now", "(555) 234-6789")}
    docs = spark.createDataFrame(list(enumerate(rows + [t for t, _ in wanted.values()])), "doc_id long, text string")
    detector = pii.fit(docs, rounds=10)
    for kind, (text, span) in wanted.items():
        base, found = detector.spans(text)
        assert not base and [(pii.KINDS[k], text[a:b]) for a, b, k in found] == [(kind, span)]
    assert not detector.spans("meet (at) noon")[1]


def test_personal_data_is_learnt_from_every_document(spark):
    """A kind that is rare beside 100,000 candidates of other kinds is still learnt and calibrated."""
    rng = random.Random(5)
    rows = [(i, f"mail me at user{i} (at) host{i}.example now") for i in range(80)]
    rows += [(1_000 + i, " x ".join(" ".join(str(rng.randrange(1000, 9999)) for _ in range(4)) for _ in range(100))) for i in range(200)]
    detector = pii.fit(spark.createDataFrame(rows, "doc_id long, text string"), rounds=3)
    assert detector.thresholds[0] <= 1
    assert [k for _, _, k in detector.spans("mail me at somebody (at) elsewhere.example now")[1]] == [0]


def test_runs_hold_numbers_as_candidates():
    text = "12 34 5 555 234 6789 4111 1111 1111 1111 77 " + "9 8 " * 30
    found = {(text[a:b], k) for a, b, k in pii.candidates(text)}
    assert {("4111 1111 1111 1111", 2), ("555 234 6789", 3)} <= found


def test_pii_odd_rows(spark, odd_documents, no_documents):
    detector = pii.fit(odd_documents)
    assert pii.find(odd_documents, detector).count() == 10
    assert pii.redact(odd_documents, detector).columns == odd_documents.columns
    assert pii.find(no_documents, pii.fit(no_documents)).count() == 0


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json"))


def definition():
    with open(queries.vocabulary("byte_bpe_50k.json")) as f:
        return f.read()


def test_units_found_last_are_bounded(monkeypatch):
    """Units of a batch are looked up once and all held afterwards, a full table is given up."""
    ids = np.arange(40, dtype=np.uint32)
    known = pieces.Known.of([f"u{i}" for i in range(20)], ids, np.arange(0, 41, 2))
    asked = []
    monkeypatch.setattr(pieces.Known, "find", lambda self, units, find=pieces.Known.find: asked.extend(units) or find(self, units))
    monkeypatch.setattr(pieces.Remembered, "LIMIT", 10)
    held = pieces.Remembered(known)
    assert held.learn([["u1", "u2", "x"], ["u2", "u3"]]) == {"u1", "u2", "u3", "x"}
    assert held.ids == {"u1": ids[2:4].tobytes(), "u2": ids[4:6].tobytes(), "u3": ids[6:8].tobytes(), "x": None}
    held.learn([["u3", "x", "u4"]])
    assert sorted(asked) == ["u1", "u2", "u3", "u4", "x"]
    held.learn([[f"u{i}" for i in range(5, 15)]])
    assert set(held.ids) == {f"u{i}" for i in range(5, 15)}


def test_pieces_of_texts_have_the_ids_of_texts(library, documents):
    coder = tokens.Encoder(definition(), 2)
    rng = random.Random(2)
    texts = [t for _, t in documents] + [
        "".join(rng.choice(list("ab'sé日 \n\t.,!?1½²_​\u0085 \x1f᠎́") + ["  ", " \n", "<|endoftext|>", "don't"])
                for _ in range(rng.randrange(40))) for _ in range(3_000)]
    for t, ids in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(ids, coder.dtype).tolist() == [*library.encode(t, add_special_tokens=False).ids, 2], t


def test_token_files(spark, library, odd_documents, no_documents):
    folder = tokens.write(odd_documents, definition(), end_id=2)
    rows = tokens.read(spark, folder).orderBy("start").collect()
    want = Counter()
    for r in odd_documents.collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 2]
        want[(r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want
    assert [r.start for r in rows] == [sum(r.n_tokens for r in rows[:i]) for i in range(len(rows))]
    keys = [r.doc_id for r in rows]
    assert keys == sorted(keys, key=lambda k: (k is not None, k))
    index = spark.read.parquet(f"{folder}/index").orderBy("part").first()
    assert tokens.token_ids(folder, index.part, 0, index.width)[-1] == 2
    assert tokens.read(spark, tokens.write(no_documents, definition(), 2)).count() == 0


def test_token_files_need_a_mounted_folder(odd_documents):
    with pytest.raises(ValueError, match="mounted"):
        tokens.write(odd_documents, definition(), 2, folder="hdfs://name/tokens")


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    scores = QUERIES["op4_toxicity"](spark, folder).cache()
    assert scores.count() == 10_000
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = scores.where("held_out").join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    positive, negative = ([r.score for r in rows if r.toxic == k] for k in (1, 0))
    assert np.mean([p > n for p in positive for n in negative]) > 0.94
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.97


def marginals_slow(score, moves):
    """Forward-backward over one text, token by token."""
    move = np.exp(moves)
    emit = np.stack([np.ones(len(score)), np.exp(score)], axis=1)
    forward, backward = np.zeros((len(score), 2)), np.ones((len(score), 2))
    for t in range(len(score)):
        forward[t] = emit[t] * (forward[t - 1] @ move if t else 1)
        forward[t] /= forward[t].sum()
    for t in range(len(score) - 2, -1, -1):
        backward[t] = move @ (emit[t + 1] * backward[t + 1])
        backward[t] /= backward[t].sum()
    both = forward * backward
    return both[:, 1] / both.sum(axis=1)


def field(moves=((0, -0.7), (0.3, 1.1))):
    return toxicity.Field(np.zeros(1), np.zeros(toxicity.WIDTH + 1), np.array(moves), np.zeros(4))


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    model = field()
    score = rng.normal(size=(3, 6))
    got = model.marginals(score.ravel(), np.array([6, 6, 6])).reshape(3, 6)
    for row, out in zip(score, got, strict=True):
        total, tox = 0.0, np.zeros(6)
        for path in range(64):
            y = np.array([path >> i & 1 for i in range(6)])
            w = np.exp((row * y).sum() + sum(model.moves[a, b] for a, b in zip(y, y[1:])))
            total, tox = total + w, tox + w * y
        assert np.allclose(out, tox / total)


@pytest.mark.parametrize("moves", [((0, -0.7), (0.3, 1.1)), ((0, -9), (-9, 3)), ((0, 4), (5, -8))])
def test_marginals_of_whole_texts(moves):
    """One chain per text, however long it is and whatever is beside it."""
    rng = np.random.default_rng(2)
    sizes = np.array([1, 63, 0, 64, 65, 5_000, 2, 128, 129, 0])
    scores = [rng.normal(size=n) * 8 for n in sizes]
    model = field(moves)
    got = np.split(model.marginals(np.concatenate(scores), sizes), np.cumsum(sizes)[:-1])
    for score, own in zip(scores, got, strict=True):
        alone = model.marginals(score, np.array([len(score)]))
        assert (own == alone).all() and np.allclose(own, marginals_slow(score, model.moves), rtol=1e-9, atol=1e-12)


def test_toxicity_does_not_depend_on_layout(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    moved = docs.orderBy("text").repartition(7)
    again = toxicity.fit(moved, labels.repartition(3))
    assert all(np.array_equal(getattr(model, f), getattr(again, f)) for f in ("evidence", "weights", "moves", "document"))
    want = {r.doc_id: (r.score, r.predicted, r.spans) for r in toxicity.score(docs, model).collect()}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        assert {r.doc_id: (r.score, r.predicted, r.spans) for r in toxicity.score(moved, model).collect()} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_rare_language_is_learned_and_copies_are_not(spark):
    """Insults of one toxic text in a hundred are evidence; the words of one much copied text are not."""
    rng = random.Random(6)
    common = [f"word{i}" for i in range(400)]

    def prose(*extra):
        words = [rng.choice(common) for _ in range(60)]
        for e in extra:
            words[rng.randrange(60)] = e
        return " ".join(words)

    rows = [(prose(), 0) for _ in range(9_000)] + [(prose("slur", "taunt"), 1) for _ in range(990)] + [(prose("zwets", "bomen"), 1) for _ in range(10)]
    copied = prose("gardenia", "lantern")
    rows += [(copied + f" word{i}", 1) for i in range(200)]
    evidence, share = toxicity.evidence_of(spark.createDataFrame(rows, "text string, toxic long"))
    own = {w: evidence[toxicity.slots_of(toxicity.hashes_of([w]))[0, 0]] for w in ("slur", "zwets", "bomen", "gardenia", "word7")}
    assert min(own["slur"], own["zwets"], own["bomen"]) > toxicity.STRONG > max(own["gardenia"], own["word7"])


def test_field_is_fitted_on_every_labelled_text(spark):
    """All labelled texts are in the batches of the gradient steps, a doubled row with its number."""
    rows = [(i, f"some text {i} of the corpus", i % 9 == 0) for i in range(2_600)] + [(1, "some text 1 of the corpus", False)]
    labelled = spark.createDataFrame(rows, "id long, text string, marked boolean") \
        .selectExpr("text", "CAST(marked AS long) AS toxic", "xxhash64(id, text) AS key")
    batches, gold = toxicity._laid_out(labelled, np.zeros(toxicity.SLOTS, np.float32), len(rows), 70_000)
    laid = [[toxicity._opened(tuple(r[c] for c in toxicity.LAID)) for r in b.collect()] for b in batches]
    assert len(laid) == 2 and not gold
    assert sum(part[3].sum() for some in laid for part in some) == len(rows)
    assert sum(part[3][part[2] > 0].sum() for some in laid for part in some) == sum(r[2] for r in rows)
    assert sorted({n for some in laid for part in some for n in part[3].tolist()}) == [1, 2]


def test_toxicity_fit_leaves_no_tables(spark):
    """What a fit wrote is deleted when the driver holds the model, also if there is one class only."""
    def left():
        return {p.name for p in Path(session.staging_root(spark).removeprefix("file:")).glob("*") if p.name.startswith(("labelled", "laid", "summaries"))}

    before = left()
    docs = spark.createDataFrame([(i, f"word{i % 5} slur other" if i % 3 else f"word{i % 5} and other") for i in range(90)], "doc_id long, text string")
    for kind in ("cast(id % 3 > 0 as int)", "0"):
        labels = spark.range(90).selectExpr("id AS doc_id", "1 AS quality", f"{kind} AS toxic")
        model = toxicity.fit(docs, labels)
        assert toxicity.score(docs, model).count() == 90
        assert left() == before


def test_toxicity_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1, 1), (3, 1, 0), (6, 1, 1), (None, 1, 1), (7, 1, None)], "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    for docs, marks in ((odd_documents, labels), (odd_documents, none), (no_documents, labels)):
        model = toxicity.fit(docs, marks)
        rows = toxicity.score(docs, model).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert toxicity.keep_clean(docs, model).columns == docs.columns


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_slow(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def overlaps_slow(docs, items, size=13):
    windows = defaultdict(set)
    for item, text in items:
        w = words_slow(text)
        for i in range(max(1, len(w) - size + 1)):
            if w[i:i + size]:
                windows[tuple(w[i:i + size])].add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words_slow(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                own = windows.get(tuple(w[i:i + n]))
                if own is not None:
                    hit.update(range(i, i + n))
                    found |= own
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return Counter(out)


def test_decontamination_equals_brute_force(spark, odd_documents, no_documents):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "ab"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 12, 13, 14, 30])))) for i in range(25)]
    items += [(3, "w1 w2"), (None, "ab ab ab"), (40, None), (41, ""), (42, "...")]
    docs = [(i, "! ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60)))) for i in range(40)]
    docs += [(100 + i, "Intro words, " + (t or "").upper().replace("É", "É") + " and more") for i, t in items[:25]]
    docs += [(1, None), (1, ""), (1, items[4][1]), (1, items[4][1])]
    table = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = Counter(tuple(r) for r in decontam.overlaps(frame, table).drop("row_key").collect())
    assert got == overlaps_slow(docs, items)
    assert decontam.overlaps(odd_documents, table.limit(0)).where("contaminated or n_hit > 0").count() == 0
    assert decontam.overlaps(odd_documents, table).count() == 10
    assert decontam.overlaps(no_documents, table).count() == 0


def removed_slow(texts, length=200):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        cut = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                cut[i:i + length] = b"\x01" * length
        kept = bytes(b for b, c in zip(t, cut, strict=True) if not c)
        spans = sum(1 for i, c in enumerate(cut) if c and (i == 0 or not cut[i - 1]))
        out.append((len(t), sum(cut), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_difference_cover():
    for v in (8, 32, 64):
        cover = suffix.difference_cover(v)
        assert {int(a - b) % v for a in cover for b in cover} == set(range(v))
        assert len(cover) <= v / 2


@pytest.mark.parametrize("crowd", [50_000, 3])
def test_suffixes_equal_brute_force(spark, documents, monkeypatch, crowd):
    """Copies, shifted and overlapping passages, runs of one byte, periods; also with every bucket crowded."""
    monkeypatch.setattr(suffix, "CROWD", crowd)
    rng = random.Random(6)
    base = "".join(rng.choice("abcdé ") for _ in range(1_500))
    texts = [t for _, t in documents[:40]]
    texts += [base, base[100:700], "x" + base[300:499] + "y", "x" + base[300:500] + "y", base[:260] + base[900:1_300], base + base]
    texts += ["a" * 199, "a" * 200, "b" * 201, "ab" * 300, "ab" * 130 + "c", None, "", "short", "short", base[-210:], "q" * 450 + base[:205]]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = Counter(tuple(r)[1:] for r in suffix.remove(frame).collect())
    assert got == removed_slow([(t or "").encode() for t in texts])


def test_suffix_parts_of_long_texts(monkeypatch):
    text = bytes(random.Random(1).choices(range(97, 123), k=3_000))
    parts = list(suffix.parts(text, 500))
    starts = [at + i for at, p in parts for i in range(len(p) - 199)]
    assert sorted(starts) == list(range(3_000 - 199))


def test_suffix_odd_rows(spark, odd_documents, no_documents):
    rows = suffix.remove(odd_documents).collect()
    want = removed_slow([(r.text or "").encode() for r in odd_documents.collect() if len(r.text or "") < 2_000])
    assert Counter(tuple(r)[1:] for r in rows if r.n_bytes < 2_000) == want
    long = sorted(r.n_removed - r.n_bytes for r in rows if r.n_bytes > 2_000)
    assert long[1] == 0 and -4 <= long[0] < 0  # the second copy keeps what was added
    assert suffix.remove(no_documents).count() == 0


def viterbi_slow(unit, table, unknown, first_byte):
    best = [(0.0, [])] + [None] * len(unit)
    for stop in range(1, len(unit) + 1):
        for start in range(stop):
            piece = unit[start:stop]
            if piece in table:
                ids, score = [table[piece][0]], table[piece][1]
            elif stop - start == 1:
                ids, score = pieces.byte_ids(piece, first_byte), unknown
            else:
                continue
            total = best[start][0] + score
            if best[stop] is None or total > best[stop][0]:
                best[stop] = (total, best[start][1] + ids)
    return best[-1][1]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Pieces.load(queries.vocabulary("piece_bpe_32k.model"))


def test_pieces_equal_whole_text_viterbi(spark, vocabulary, odd_documents):
    """Cutting where no piece spans, and joining units, changes no path."""
    table = {p: (i, s) for p, i, s in zip(vocabulary.texts, vocabulary.ids, vocabulary.scores, strict=True)}
    texts = ["", None, " ", "  a  b\n", "Hello, world!  It's 日本 \U0001f600 x▁y", "naïve café\tthen", "é" * 5, "the the the"]
    texts += [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").limit(5).collect()]
    texts = [t if t is None else t[:400] for t in texts]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.ids for r in pieces.encode(frame, vocabulary, ["doc_id"], "ids array<int>", pieces.ids_of).collect()}
    for i, t in enumerate(texts):
        whole = pieces.SPACE + t.replace(pieces.SPACE, pieces.OWN).replace(" ", pieces.SPACE) if t else ""
        assert got[i] == viterbi_slow(whole, table, vocabulary.unknown, vocabulary.first_byte), t


def test_pieces_of_long_units_equal_whole_viterbi(spark, vocabulary):
    """Units of 65 to 1,000 characters, among them some that a cut at every 64th would change."""
    table = {p: (i, s) for p, i, s in zip(vocabulary.texts, vocabulary.ids, vocabulary.scores, strict=True)}
    rng = random.Random(4)
    texts = ["representations" * 10, "configurationmanagementadministration" * 3, "representations" * 66, "=" * 1_000,
             " " * 333, "configurationmanagementadministration" * 2 + " \U0001f600 " + "internationalization" * 20]
    texts += ["".join(rng.choice("etaoinshrdlucm") for _ in range(n)) for n in (64, 65, 66, 127, 128, 129, 400, 1_000)]
    assert sum(len(u) > pieces.UNIT for some in pieces.cutter(vocabulary).units(texts) for u in some) >= 10
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.ids for r in pieces.encode(frame, vocabulary, ["doc_id"], "ids array<int>", pieces.ids_of).collect()}
    for i, t in enumerate(texts):
        whole = pieces.SPACE + t.replace(" ", pieces.SPACE)
        assert got[i] == viterbi_slow(whole, table, vocabulary.unknown, vocabulary.first_byte), t


def test_paths_of_long_units_are_linear(vocabulary):
    assert len(pieces.cutter(vocabulary).path("ab" * 200_000)) > 0


def test_pieces_round_trip(spark, vocabulary, odd_documents, no_documents):
    kind = "n_pieces long, ids_crc32 long, round_trip boolean"
    rows = pieces.encode(odd_documents, vocabulary, ["doc_id"], kind, pieces.digests).collect()
    assert len(rows) == 10 and all(r.round_trip for r in rows)
    assert pieces.encode(no_documents, vocabulary, ["doc_id"], kind, pieces.digests).count() == 0


def test_units_are_cut_counted_and_found_without_an_object_each(spark, vocabulary):
    """Units share the memory of their text, and only those of the lattice are counted and looked up."""
    cut = pieces.cutter(vocabulary)
    texts = ["the ▁ the", "", "日本 the\n", "representations" * 10, chr(0x10FFFD) + " é", "the 日"]
    units, begin, mark = cut.spans(texts)
    assert begin.tolist() == [0, *np.cumsum([len(some) for some in cut.units(texts)])]
    assert units.buffers()[2].size == sum(len(u.encode()) for u in units.to_pylist())
    names = pieces.strings(units, mark)
    assert [u.replace(pieces.OWN, "_") for u in names[:begin[1]]] == ["▁the", "▁", "_", "▁the"]
    assert cut.lattice_has(units).tolist() == [cut.in_lattice(u) for u in names]
    frame = spark.createDataFrame([(t,) for t in [*texts, None]], "text string").coalesce(1)
    assert {r.unit: r.n for r in pieces.count_units(frame, vocabulary).collect()} == Counter(u for u in names if cut.in_lattice(u))
    some = sorted({u for u in names if cut.in_lattice(u)})
    known = pieces.Known.of(some, np.arange(2 * len(some), dtype=np.uint32), np.arange(0, 2 * len(some) + 1, 2))
    places = known.places(units)
    assert [p >= 0 for p in places] == [u in some for u in names]
    for u, p in zip(names, places, strict=True):
        assert p < 0 or known.ids[known.ends[p]:known.ends[p + 1]].tolist() == [2 * some.index(u), 2 * some.index(u) + 1]
    block, ends = pieces.runs(known.ids, known.sizes, places[places >= 0])
    assert block.tobytes() == b"".join(known.find([u for u in names if u in some])) and ends[-1] == len(block)


def test_lattice_keeps_its_parts(spark, vocabulary, documents):
    """Few units still come in as many parts as are asked for, so that no task holds the edges of several."""
    frame = spark.createDataFrame(documents[:20], "doc_id long, text string").select("text")
    encoded = pieces.encode_units(pieces.count_units(frame, vocabulary), vocabulary)
    assert encoded.rdd.getNumPartitions() == pieces.PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_workers_forget_what_other_operators_remember():
    common.word_hashes.of([b"some", b"words"])
    batches = common.lean(lambda batches: (len(common.word_hashes) for _ in batches))
    assert list(batches(iter([None, None]))) == [0, 0]


def test_pieces_without_frequent_units(spark, vocabulary, documents, monkeypatch):
    frame = spark.createDataFrame(documents[:20], "doc_id long, text string")
    kind = "n_pieces long, ids_crc32 long, round_trip boolean"
    want = sorted(map(tuple, pieces.encode(frame, vocabulary, ["doc_id"], kind, pieces.digests).collect()))
    monkeypatch.setattr(pieces, "frequent", lambda encoded: pieces.Known.of([], np.zeros(0, np.uint32), np.zeros(1, np.int64)))
    assert sorted(map(tuple, pieces.encode(frame, vocabulary, ["doc_id"], kind, pieces.digests).collect())) == want

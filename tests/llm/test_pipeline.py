"""The stages' decisions, each against brute force on its own input, and odd rows."""

from collections import Counter

import corpus_pipeline
from tablewright.llm import pii, toxicity
from tablewright.llm.registry import QUERIES

from .conftest import FOLDER
from .test_row_operators import classes_slow
from .test_text_operators import overlaps_slow, strict_slow


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, step in corpus_pipeline.STAGES:
        before = docs
        docs = step(spark, docs, FOLDER).cache()
        kept[name] = docs.collect()
        if name != "pieces":
            assert docs.columns == before.columns
        rows = before.collect()
        if name == "toxicity":
            model = toxicity.fit(before, spark.read.parquet(f"{FOLDER}/labels.parquet"))
            bad = {r.doc_id for r in toxicity.score(before, model).where("predicted = 1").collect()}
            assert bad and {r.doc_id for r in kept[name]} == {r.doc_id for r in rows} - bad
        elif name == "near_duplicates":
            found = classes_slow([r.text for r in rows])
            first = {c: min(rows[i].doc_id for i, (x, _) in enumerate(found) if x == c) for c, _ in found}
            assert {r.doc_id for r in kept[name]} == set(first.values())
        elif name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
            want = {r[0] for r in overlaps_slow([(r.doc_id, r.text) for r in rows], items) if not r[-1]}
            assert {r.doc_id for r in kept[name]} == want and len(want) < len(rows)
        elif name == "redaction":
            assert len(kept[name]) == len(rows) and not any(strict_slow(r.text) for r in kept[name])
            assert any(strict_slow(r.text) for r in rows)
            detector = pii.fit(before)
            assert {r.doc_id: r.text for r in kept[name]} == {r.doc_id: pii.hide(r.text, detector.spans(r.text)[1]) for r in rows}
        else:
            assert {r.doc_id for r in kept[name]} == {r.doc_id for r in rows} and all(r.round_trip for r in kept[name])
    whole = QUERIES["pipeline"](spark, FOLDER).collect()
    assert Counter(whole) == Counter(kept["pieces"])


def test_stages_on_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "same words in both texts here", "en", "s", 1), (3, "same words in both texts here", "en", "s", 1),
            (None, "same words in both texts here", "en", "s", 1), (5, "word " * 50_000, "en", "s", 1), (6, "mail me at a.b@c.example now", "en", "s", 28)]
    for docs, n in ((spark.createDataFrame(rows, schema), 5), (spark.createDataFrame([], schema), 0)):
        for _, step in corpus_pipeline.STAGES:
            docs = step(spark, docs, FOLDER).cache()
        assert docs.count() == n

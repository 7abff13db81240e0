"""Language of web pages by fusing evidence: text, declared language, address suffix and host.

Text: log likelihoods of hashed character trigrams under each language of a labelled table, scaled
so that a page's text is as sure as held-out texts show. Declared language and address suffix:
the probability of what is declared under each language, counted over all pages with the text's
posteriors as soft labels. Host: a prior for each host, smoothed towards its domain, that towards
its suffix and that towards all pages, again from grouped sums of soft labels, a page's own part
taken out. The posterior is the normalised product.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import keyed, sampled, slices
from tablewright.session import stage

#: slots of the table of trigrams, for each language
SLOTS = 1 << 16
#: labelled texts learned from, about, chosen by a hash
SAMPLE = 5_000
#: strength of the smoothing towards the next level up
STRENGTH = 5.0

TAGS = re.compile(r"(?is)<(script|style)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[^>]*>?")
ENTITY = re.compile(r"&#?\w{1,10};")
DECLARED = re.compile(r"(?is)<html\b[^>]{0,2000}?\blang\s*=\s*[\"']?\s*([a-z]{2,3})\b")


def visible(html: str) -> str:
    """The text of a page without tags, comments, scripts and entities."""
    return ENTITY.sub(" ", TAGS.sub(" ", html))


def trigram_slots(text: str) -> np.ndarray:
    """Slots of the trigrams of lower-case letters; anything else counts as one space."""
    low = " " + " ".join(re.findall(r"[^\W\d_]+", text.lower())) + " "
    code = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(code) < 3:
        return np.zeros(0, np.int64)
    mixed = (code[:-2] * np.uint64(0x9E3779B97F4A7C15) + code[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + code[2:]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(48)).astype(np.int64)


@dataclass
class TextModel:
    languages: list[str]
    weights: np.ndarray  # (SLOTS, languages)
    scale: float

    def loglik(self, text: str) -> np.ndarray:
        """Scaled log likelihood, 0 for each language without trigrams."""
        found = trigram_slots(text)
        if not len(found):
            return np.zeros(len(self.languages))
        # successive trigrams repeat each other's evidence, so it grows with the root of their number
        return self.scale * self.weights[found].sum(axis=0) / np.sqrt(len(found))


def fit_text(docs: DataFrame, sample: int = SAMPLE) -> TextModel:
    """Learn trigrams of every language of (text, lang); two in three texts fit, one calibrates.

    About ``sample`` texts of each language are used, all of a rare one, chosen by a hash of text
    and, where there is one, doc_id, whatever the layout of the table.
    """
    keys = [F.col("doc_id")] if "doc_id" in docs.columns else []
    rows = docs.select(F.col("text").cast("string").alias("text"), F.lower(F.trim(F.col("lang").cast("string"))).alias("lang"),
                       F.xxhash64(F.col("text"), *keys).alias("h")).where("text is not null and lang is not null and lang <> ''")
    sizes = rows.groupBy("lang").count()  # a row for each language, of which the model holds SLOTS numbers
    rows = rows.join(F.broadcast(sizes), "lang").where(F.pmod(F.xxhash64(F.lit(11), "h"), F.lit(1 << 30)) < sample * float(1 << 30) / F.col("count")).drop("count")
    fold = F.pmod("h", F.lit(3))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.setdefault(lang, np.zeros(SLOTS, np.int64))
                held[lang] += np.bincount(trigram_slots(text), minlength=SLOTS)
        for lang, counts in held.items():
            slot = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(slot), "slot": slot, "n": counts[slot]})

    rows = stage(rows.withColumn("fold", fold), "labelled_pages")
    sums = rows.where("fold > 0").select("text", "lang").mapInArrow(task, "lang string, slot long, n long") \
        .groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()  # SLOTS rows for each language at most
    languages = sorted(set(sums["lang"].to_pylist()))
    if not languages:
        return TextModel([], np.zeros((SLOTS, 0)), 1.0)
    counts = np.full((SLOTS, len(languages)), 0.5)
    place = {x: i for i, x in enumerate(languages)}
    counts[sums["slot"].to_numpy(), [place[x] for x in sums["lang"].to_pylist()]] += sums["n"].to_numpy()
    weights = np.log(counts / counts.sum(axis=0))
    weights -= weights.mean(axis=1, keepdims=True)
    model = TextModel(languages, weights, 1.0)
    held = [r for r in sampled(rows.where("fold = 0"), 2_000, "h").collect() if r["lang"] in place]
    if held:
        raw = np.array([model.loglik(r["text"]) for r in held])
        truth = np.array([place[r["lang"]] for r in held])

        def loss(scale):
            z = scale * raw
            z = z - z.max(axis=1, keepdims=True)
            return -(z[np.arange(len(z)), truth] - np.log(np.exp(z).sum(axis=1))).mean() + 1e-3 * scale

        model.scale = float(min((2.0 ** e for e in np.arange(-4, 4.5, 0.5)), key=loss))
    return model


def _host(url: Column) -> Column:
    """Host of an address in lower case, without user, port and a leading www; NULL if it has none."""
    host = F.regexp_extract(F.lower(F.trim(url)), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]+)", 1)
    host = F.regexp_replace(host, r"^www\.|\.+$", "")
    return F.when(host != "", host)


def evidence(pages: DataFrame, model: TextModel) -> DataFrame:
    """Per row: row_key, page_id, host, domain, suffix, declared, text (log likelihoods)."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "html"):
                htmls = some.column(5).fill_null("").to_pylist()
                declared = [m[1].lower() if (m := DECLARED.search(h)) else None for h in htmls]
                text = [model.loglik(visible(h)) for h in htmls]
                yield pa.RecordBatch.from_arrays([*some.columns[:5], pa.array(declared, pa.string()), pa.array(text, pa.list_(pa.float64()))],
                                                 ["row_key", "page_id", "host", "domain", "suffix", "declared", "text"])

    host = F.col("host")
    rows = keyed(pages, "page_id", "url", "html").select(
        "row_key", F.col("page_id").cast("long").alias("page_id"), _host(F.col("url").cast("string")).alias("host"),
        F.col("html").cast("string").alias("html"))
    rows = rows.withColumn("domain", F.substring_index(host, ".", -2)).withColumn("suffix", F.substring_index(host, ".", -1))
    return rows.select("row_key", "page_id", "host", "domain", "suffix", "html").mapInArrow(
        _named(task), "row_key long, page_id long, host string, domain string, suffix string, declared string, text array<double>")


def _named(task):
    def with_html(batches):
        return task(pa.RecordBatch.from_arrays([*b.columns], [*b.schema.names[:5], "html"]) for b in batches)

    return with_html


def _softmax(x: Column) -> Column:
    top = F.array_max(x)
    e = F.transform(x, lambda v: F.exp(v - top))
    total = F.aggregate(e, F.lit(0.0), lambda a, v: a + v)
    return F.transform(e, lambda v: v / total)


def _plus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def identify(pages: DataFrame, labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per page: page_id, lang, confidence, text_lang, declared, host, posterior (by language).

    ``labelled`` has text and lang. A page without address has the prior of all pages, one without
    text or with a missing one rests on the other evidence, a page without any on the prior. What a
    page declares counts by how well it agrees with the texts of all pages that declare the same;
    languages nobody labelled cannot be found. Rows that share an id are judged one by one. Without
    labelled languages, lang is NULL everywhere.
    """
    model = fit_text(labelled, sample)
    n = len(model.languages)
    rows = evidence(pages, model)
    if not n:
        return rows.select("page_id", F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("confidence"),
                           F.lit(None).cast("string").alias("text_lang"), "declared", "host",
                           F.create_map().cast("map<string,double>").alias("posterior"))
    names = F.array(*[F.lit(x) for x in model.languages])
    soft = _softmax(F.col("text"))
    # a page without text speaks for no language
    known = F.exists("text", lambda v: v != 0)
    rows = stage(rows.withColumn("soft", F.when(known, soft).otherwise(F.array_repeat(F.lit(0.0), n))), "page_evidence")

    def sums(by: list[str]) -> DataFrame:
        return rows.groupBy(*by).agg(F.array(*[F.sum(F.col("soft")[i]) for i in range(n)]).alias("mass"))

    total = [x + 1.0 for x in sums([]).first()["mass"] or [0.0] * n] if rows.head(1) else [1.0] * n
    base = F.array(*[F.lit(x / sum(total)) for x in total])

    def smoothed(mass: Column, prior: Column) -> Column:
        """Shares of a level, drawn to those of the level above."""
        whole = F.aggregate(mass, F.lit(0.0), lambda a, v: a + v)
        return F.zip_with(mass, prior, lambda m, p: (m + STRENGTH * p) / (whole + STRENGTH))

    suffixes = sums(["suffix"]).where("suffix is not null").select("suffix", smoothed(F.col("mass"), base).alias("by_suffix"))
    domains = sums(["domain", "suffix"]).where("domain is not null").join(suffixes, "suffix") \
        .select("domain", smoothed(F.col("mass"), F.col("by_suffix")).alias("by_domain"))
    hosts = sums(["host", "domain"]).where("host is not null").join(domains, "domain") \
        .select("host", F.col("mass").alias("host_mass"), "by_domain")
    # P(declared | language): soft counts of the pages that declare it, against the languages' own
    shares = sums(["declared"]).where("declared is not null").select(
        "declared", F.zip_with(F.col("mass"), F.array(*[F.lit(x) for x in total]), lambda m, t: F.log((m + 0.1) / (t + 0.2))).alias("by_declared"))
    zero = F.array_repeat(F.lit(0.0), n)
    joined = rows.join(stage(hosts, "hosts"), "host", "left").join(stage(shares, "declared"), "declared", "left")
    # a page's own text is not evidence twice
    rest = F.zip_with(F.coalesce("host_mass", zero), "soft", lambda m, s: F.greatest(m - s, F.lit(0.0)))
    prior = smoothed(rest, F.coalesce("by_domain", base))
    posterior = _softmax(_plus(_plus(F.transform(prior, lambda p: F.log(p)), F.col("text")), F.coalesce("by_declared", zero)))
    out = joined.withColumn("p", posterior)
    best = F.array_position("p", F.array_max("p")).cast("int")
    return out.select(
        "page_id", F.element_at(names, best).alias("lang"), F.array_max("p").alias("confidence"),
        F.when(known, F.element_at(names, F.array_position("text", F.array_max("text")).cast("int"))).alias("text_lang"),
        "declared", "host", F.map_from_arrays(names, F.col("p")).alias("posterior"))

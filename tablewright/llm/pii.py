"""Personal data: generators propose spans, boosted trees score them, thresholds select them.

Strict spans (e-mail, IPv4 address, payment card, phone) follow fixed patterns and checks and are
always kept. Loose generators propose many more, overlapping spans: written-out addresses, dotted
numbers out of range, digit groups with any separators and runs of them within longer ones, each
number both as card and as phone. Boosted trees learn which format and context such data has in this
corpus; their labels are the checks on the canonical form of a span (signs for their names, plain
separators, a phone with or without its plus), whose outcome they do not see. A threshold for each
kind, calibrated on held-out candidates, adds those that look like it as surely.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import slices
from tablewright.session import stage, staging_root

KINDS = ("email", "ip", "card", "phone")

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a start inside a run of digits can only fail as the start of the run does
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

AT = re.compile(r"@|\(at\)|\[at\]|\{at\}", re.I)
LOOSE_LOCAL = re.compile(r"[\w.%+-]{1,64}\s{0,2}\Z")
LOOSE_DOMAIN = re.compile(r"\s{0,2}[\w-]{1,63}(?:\s?(?:\.|\(dot\)|\[dot\]|\{dot\})\s?[\w-]{1,63}){0,5}", re.I)
LOOSE_IP = re.compile(r"(?<![0-9A-Za-z.])[0-9]{1,5}(?:[.,][0-9]{1,5}){3}(?![0-9A-Za-z])")
# a stop with a space after it alone ends a sentence rather than a label
TIGHT_DOMAIN = re.compile(r"\s{0,2}[\w-]{1,63}(?:(?:\.|\s\.\s|\s?(?:\(dot\)|\[dot\]|\{dot\})\s?)[\w-]{1,63}){0,5}", re.I)
DOT = re.compile(r"\s*(?:\.|\(dot\)|\[dot\]|\{dot\})\s*", re.I)
# up to 40 characters of digits and separators; a longer run gives several candidates
LOOSE_NUMBER = re.compile(r"[+(]?[0-9][0-9 ()./\-]{5,38}[0-9]")
#: runs of any length, of whose groups up to so many together are candidates of their own
NUMBERS = re.compile(r"[0-9][0-9 ()./\-]{8,}")
GROUP = re.compile(r"[0-9]+")
GROUPS, SPAN = 8, 40
FORMAL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")

#: words before a span that speak for a kind
HINTS = (("mail", "contact", "write"), ("ip", "host", "server", "addr"), ("card", "visa", "pay", "cc"),
         ("tel", "phone", "call", "fax", "mobil"))
CONTEXT = 40


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, @ and dotted domain, found from their @ in linear time."""
    found, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(LOCAL)) if at > free else at
        domain = DOMAIN.match(text, at + 1) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            found.append((start, free))
        at = text.find("@", free)
    return found


def strict(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the fixed patterns that pass their checks, in code points."""
    found = [(a, b, 0) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m.groups()]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append((m.start(), m.end(), 1))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = digits_of(m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(digits_of(m[0])) <= 15:
                found.append((m.start(), m.end(), 3))
    return sorted(found, key=lambda s: (s[0], s[2]))


def candidates(text: str) -> list[tuple[int, int, int]]:
    """Loose spans of all kinds; they overlap each other and the strict ones."""
    found = set()
    for m in AT.finditer(text):
        before = LOOSE_LOCAL.search(text[max(0, m.start() - 66):m.start()])
        after = LOOSE_DOMAIN.match(text, m.end())
        if before and after:
            found.add((m.start() - len(before[0]), after.end(), 0))
            found.add((m.start() - len(before[0]), TIGHT_DOMAIN.match(text, m.end()).end(), 0))
    found.update((m.start(), m.end(), 1) for m in LOOSE_IP.finditer(text))
    for m in LOOSE_NUMBER.finditer(text):
        if len(digits_of(m[0])) >= 9:
            found.add((m.start(), m.end(), 2))
            found.add((m.start(), m.end(), 3))
    for m in NUMBERS.finditer(text):
        groups = [g.span() for g in GROUP.finditer(text, m.start(), m.end())]
        for i, (start, _) in enumerate(groups):
            size = 0
            # a sign before the first group belongs to it
            first = start - (1 if start and text[start - 1] in "+(" else 0)
            first -= 1 if first < start and first and text[first - 1:first + 1] == "+(" else 0
            for a, b in groups[i:i + GROUPS]:
                size += b - a
                if size > 19 or b - start > SPAN:
                    break
                if size >= 14:
                    found.add((first, b, 2))
                if 10 <= size <= 15:
                    found.add((first, b, 3))
    return sorted(found)


def hinted(text: str, start: int, kind: int) -> bool:
    """Whether words before a span speak for a kind."""
    before = text[max(0, start - CONTEXT):start].lower()
    return any(h in before for h in HINTS[kind])


def canonical(text: str, start: int, end: int, kind: int) -> bool:
    """Whether the canonical form of a loose span passes the checks of its kind."""
    span = text[start:end]
    digits = digits_of(span)
    if kind == 0:
        if re.search(r"\S\.\s", span):
            return False
        return FORMAL.fullmatch(re.sub(r"\s*@\s*", "@", AT.sub("@", DOT.sub(".", span.strip())))) is not None
    if kind == 1:
        parts = re.split("[.,]", span)
        if any(len(p.lstrip("0")) > 3 or int(p) > 255 for p in parts):
            return False
        # 1,200,150,100 is a number unless words say otherwise
        return "," not in span or any(len(p) != 3 for p in parts[1:]) or hinted(text, start, 1)
    if start and text[start - 1].isalnum() or end < len(text) and text[end].isalnum():
        return False
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits)
    # without its plus a phone has an area code in brackets, a trunk prefix or a word that names it
    return 10 <= len(digits) <= 15 and "/" not in span and \
        (span[0] in "+(" or span[0] == "0" or hinted(text, start, 3))


def features(text: str, start: int, end: int, kind: int) -> list[float]:
    """Format and context of a span; no check digit or range of the strict checks is among them."""
    span = text[start:end]
    digits = sum("0" <= c <= "9" for c in span)
    groups = [len(g) for g in re.findall("[0-9]+", span)]
    before = text[max(0, start - CONTEXT):start].lower()
    return [float(v) for v in (
        kind, len(span), digits, digits / len(span), len(groups), max(groups, default=0),
        groups[0] if groups else 0, groups[-1] if groups else 0,
        span.count(" "), span.count(".") if kind else len(DOT.findall(span)), span.count("-"), span.count("(") + span.count(")"),
        span.count("/") + span.count(","), span.startswith("+"), span.count("@"),
        sum(c.isalpha() for c in span), any(ord(c) > 127 for c in span), "(" in span and "at" in span.lower(), span.startswith("0"), ". " in span,
        start > 0 and text[start - 1].isalnum(), end < len(text) and text[end].isalnum(),
        *(any(h in before for h in hints) for hints in HINTS))]


N_FEATURES = 22 + len(HINTS)


@dataclass
class Detector:
    """Trees as arrays, and the least probability at which a span of each kind is selected."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    trees: list[tuple[np.ndarray, ...]] = field(default_factory=list)
    thresholds: tuple[float, ...] = (2.0,) * len(KINDS)

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(x))
        rows = np.arange(len(x))
        for weight, (feature, threshold, left, right, value) in zip(self.weights, self.trees, strict=True):
            node = np.zeros(len(x), np.int64)
            while True:
                inner = feature[node] >= 0
                if not inner.any():
                    break
                below = x[rows, np.maximum(feature[node], 0)] <= threshold[node]
                node = np.where(inner, np.where(below, left[node], right[node]), node)
            margin += weight * value[node]
        return 1 / (1 + np.exp(-2 * margin))

    def spans(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """Strict spans and all spans. Added ones overlap no strict one, and of those that overlap
        each other the likeliest stays."""
        base = strict(text)
        loose = [c for c in candidates(text) if self.thresholds[c[2]] <= 1]
        if not loose:
            return base, base
        p = self.probability(np.array([features(text, *c) for c in loose]))
        # of equally likely ones the longest number and the shortest address
        chosen = sorted((-q, c[1] - c[0] if c[2] == 0 else c[0] - c[1], c) for q, c in zip(p.tolist(), loose, strict=True)
                        if q >= self.thresholds[c[2]])
        taken = np.zeros(len(text), bool)
        for a, b, _ in base:
            taken[a:b] = True
        out = list(base)
        for _, _, (a, b, kind) in chosen:
            if not taken[a:b].any():
                taken[a:b] = True
                out.append((a, b, kind))
        return base, sorted(out, key=lambda s: (s[0], s[2]))


def _proposed(texts: DataFrame) -> DataFrame:
    """Candidates with their features and whether their canonical form passes the checks: valid, f, h.

    ``h`` is a hash of the row's ``key`` and of the candidate's place among the row's candidates.

    Those that overlap a strict span without being one can never be added and are left out.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text"):
                valid, rows, keys, numbers = [], [], [], []
                for text, key in zip(some.column(0).fill_null("").to_pylist(), some.column(1).to_pylist(), strict=True):
                    loose = candidates(text)
                    if loose:
                        exact = strict(text)
                        taken = np.zeros(len(text), bool)
                        for a, b, _ in exact:
                            taken[a:b] = True
                        spans = {(a, b) for a, b, _ in exact}
                        loose = [c for c in loose if c[:2] in spans or not taken[c[0]:c[1]].any()]
                        own = set(exact)
                        valid += [float(c in own or c[:2] not in spans and canonical(text, *c)) for c in loose]
                        rows += [features(text, *c) for c in loose]
                        keys += [key] * len(loose)
                        numbers += range(len(loose))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(valid, pa.float64()), pa.array(rows, pa.list_(pa.float64())), pa.array(keys, pa.int64()), pa.array(numbers, pa.int64())],
                    ["valid", "f", "key", "number"])

    found = texts.mapInArrow(task, "valid double, f array<double>, key long, number long")
    return found.select("valid", "f", F.xxhash64("key", "number").alias("h"))


def _thresholds(scored: DataFrame, precision: float) -> tuple[float, ...]:
    """Of each kind the least ``p`` above which enough candidates of (kind, p, n, valid) are valid.

    Candidates are summed by probability, then from the greatest one down: first over steps of
    probability, a fixed number, then among the probabilities of a step.
    """
    sums = [F.sum("n").alias("n"), F.sum("valid").alias("valid")]
    each = stage(scored.groupBy("kind", "p").agg(*sums).withColumn("step", F.floor(F.col("p") * 4096)), "probabilities")
    above = Window.partitionBy("kind").orderBy(F.col("step").desc()).rowsBetween(Window.unboundedPreceding, -1)
    steps = each.groupBy("kind", "step").agg(*sums).select(
        "kind", "step", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("n", "valid")])
    down = Window.partitionBy("kind", "step").orderBy(F.col("p").desc()).rowsBetween(Window.unboundedPreceding, 0)
    so_far = each.join(F.broadcast(steps), ["kind", "step"]).select(
        "kind", "p", *[(F.sum(c).over(down) + F.col(f"{c}_above")).alias(c) for c in ("n", "valid")])
    least = so_far.where((F.col("valid") >= precision * F.col("n")) & (F.col("valid") >= 20)).groupBy("kind").agg(F.min("p").alias("p"))
    found = {r["kind"]: r["p"] for r in least.collect()}
    return tuple(found.get(kind, 2.0) for kind in range(len(KINDS)))


def fit(docs: DataFrame, rounds: int = 20, depth: int = 4, precision: float = 0.98) -> Detector:
    """Train the trees on the candidates of all documents.

    Candidates equal in features and outcome become one with their number as its weight.

    By a hash of id, text and place every second one trains, the others calibrate: a kind's threshold
    is the least probability above which the canonical checks agree with at least ``precision`` of the
    held-out candidates. A kind without such a threshold, or a corpus with candidates of one class
    only, adds nothing.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("text").cast("string").alias("text"), F.xxhash64("doc_id", "text").alias("key"))
    rows = stage(_proposed(texts).groupBy("f", "valid", (F.col("h") % 2 == 0).alias("train"))
                 .agg(F.count(F.lit(1)).alias("n")), "candidates")
    train = rows.where("train")
    if train.select("valid").distinct().count() < 2:
        return Detector()
    model = GBTClassifier(labelCol="valid", featuresCol="x", weightCol="weight", maxIter=rounds, maxDepth=depth, seed=7) \
        .fit(train.select("valid", F.col("n").cast("double").alias("weight"), array_to_vector("f").alias("x")))
    path = f"{staging_root(spark)}/trees-{uuid.uuid4().hex}"
    model.write().save(path)
    nodes: dict[int, list] = {}
    for r in spark.read.parquet(f"{path}/data").collect():  # rounds * 2 ** depth rows at most
        nodes.setdefault(r["treeID"], []).append(r["nodeData"])
    trees = []
    for tree in sorted(nodes):
        own = sorted(nodes[tree], key=lambda n: n["id"])
        leaf = [n["leftChild"] < 0 for n in own]
        trees.append((
            np.array([-1 if x else n["split"]["featureIndex"] for n, x in zip(own, leaf, strict=True)]),
            np.array([0 if x else n["split"]["leftCategoriesOrThreshold"][0] for n, x in zip(own, leaf, strict=True)]),
            np.array([n["leftChild"] for n in own]), np.array([n["rightChild"] for n in own]),
            np.array([n["prediction"] for n in own])))
    detector = Detector(np.array(model.treeWeights), trees)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(-1, N_FEATURES)
            n = batch.column(2).to_numpy()
            yield pa.RecordBatch.from_pydict({
                "kind": x[:, 0].astype(np.int32), "p": detector.probability(x), "n": n, "valid": np.where(batch.column(1).to_numpy() > 0, n, 0)})

    held = rows.where("not train").select("f", "valid", "n").mapInArrow(score, "kind int, p double, n long, valid long")
    detector.thresholds = _thresholds(held, precision)
    return detector


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find(docs: DataFrame, detector: Detector) -> DataFrame:
    """Counts and digest of the strict spans and all spans of every document.

    A missing text is empty. Rows that share an id are judged one by one.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text"):
                rows: list[tuple] = []
                for text in some.column(1).fill_null("").to_pylist():
                    base, all_ = detector.spans(text)
                    counts = [sum(k == kind for _, _, k in base) for kind in range(len(KINDS))]
                    rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(all_)))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), *(pa.array(c, pa.int64()) for c in columns[:4]),
                     *(pa.array(c, pa.string()) for c in columns[4:])],
                    ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(task, FOUND)


def hide(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by the name of its kind; overlapping spans become one."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, detector: Detector) -> DataFrame:
    """``docs`` with all spans of their texts replaced; missing texts stay missing."""
    schema, place = docs.schema, docs.columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text"):
                texts = [t if t is None else hide(t, detector.spans(t)[1]) for t in some.column(place).to_pylist()]
                yield some.set_column(place, some.schema.field(place), pa.array(texts, some.schema.field(place).type))

    return docs.mapInArrow(task, schema)

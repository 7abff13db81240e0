"""Secrets in texts, and credentials in several parts linked by an interval join.

Strong spans speak for themselves: assignments to a secret's name, access key ids and long
hexadecimal strings. Weak spans are parts of a credential that are common in harmless text: a user
or account (``login``), a short or unnamed secret (``loose``), an address (``endpoint``). A weak
span is reported only when the parts that complete it stand in the same paragraph at most
``REACH`` characters away:

* a login beside a secret, strong or loose,
* a loose secret beside an identifier (login or access key id) or an endpoint,
* an endpoint beside both an identifier and a secret.

Only DataFrame expressions are used. One scan finds all matches of a text: the pieces between
matches and the matches themselves give each span's place by running sums, a window over the
spans of one text. Spans meet in a join on (row, stretch of ``BIN`` characters): a span lies in
the stretches that it covers, a partner in those that its reach covers. Matches of one kind do not
overlap, so a stretch holds a bounded number of spans and there is no hot key. What the join finds
is reduced to one row for each weak span by a map-side aggregation.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.session import stage

#: characters between parts of one credential at most, and width of the join's stretches
REACH = 300
BIN = 512

ASSIGN, ACCESS, HEX, LOGIN, LOOSE, ENDPOINT = range(6)
KINDS = ["assign", "access", "hex", "login", "loose", "endpoint"]

# all patterns read ASCII only and none matches a line break; ``value`` is the group judged
NAMES = "(?:user(?:name)?|login|account|client_?id|key_?id)"
PLACES = "(?:host|hostname|endpoint|server|url)"
SHORT = "(?:password|passwd|secret|token|api_?key|pass|pwd|passphrase|auth|credential|private_?key|access_?key)"
BLANK = r"\n[\x20\t\r\n]*\n"  # between paragraphs
PATTERNS = {
    ASSIGN: (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2),
    ACCESS: ("AKIA[A-Z0-9]+", 0),
    HEX: ("[0-9a-f]{16,}", 0),  # runs of such characters, 16 at least
    LOGIN: (rf"""(?i){NAMES}["']?\x20*[:=]\x20*["']?([a-z0-9@._+-]+)""", 1),
    LOOSE: (rf"""(?i){SHORT}["']?\x20*[:=]\x20*["']?[a-z0-9+/_.=!@#%^&*-]+|(?-i:[A-Za-z0-9+/]{{32,}}={{0,2}})""", 0),
    ENDPOINT: (rf"""(?i)(?<![a-z0-9+.-])[a-z0-9+.-]+://[^\x00-\x20"'<>]+|{PLACES}["']?\x20*[:=]\x20*["']?[a-z0-9._:/-]+""", 0),
}

#: text that any pattern of a kind needs, in lower case, to pass over texts quickly
NEEDED = {ACCESS: ["akia"], LOGIN: ["user", "login", "account", "client", "key"], ENDPOINT: ["://", "host", "endpoint", "server", "url"]}

PART = "array<struct<kind:int,i:int,gap:int,breaks:int,size:int,good:boolean,secret:boolean>>"


def _good(kind: int, value: Column) -> Column:
    """Whether a match counts as a span of its kind."""
    if kind == ASSIGN:
        return F.length(value) >= 12
    if kind == ACCESS:
        return F.length(value) >= 18
    if kind == LOOSE:  # an unnamed string needs capital and small letters and digits
        mixed = value.rlike("[a-z]") & value.rlike("[A-Z]") & value.rlike("[0-9]")
        return value.rlike("[:=]") & ~value.rlike("^[A-Za-z0-9+/]{32,}=*$") | mixed
    return F.lit(True)


def _secret(kind: int, value: Column) -> Column:
    """Whether a span is the secret part of a credential; a run of digits alone is not."""
    if kind == HEX:
        return value.rlike("[a-f]")
    return F.lit(kind in (ASSIGN, LOOSE))


def _matches(kind: int, text: Column, low: Column) -> Column:
    """All matches of one kind in a text: the piece before each and the match, in order."""
    pattern, group = PATTERNS[kind]
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    before = F.transform(F.split(text, pattern, -1), lambda p: F.struct(
        F.length(p).alias("gap"), (F.size(F.split(p, BLANK, -1)) - 1).alias("breaks")))
    found = F.transform(F.arrays_zip(whole.alias("whole"), value.alias("value"), before.alias("before")), lambda m, i: F.struct(
        F.lit(kind).alias("kind"), i.cast("int").alias("i"), m["before"]["gap"].alias("gap"), m["before"]["breaks"].alias("breaks"),
        F.length(m["whole"]).alias("size"), F.coalesce(_good(kind, m["value"]), F.lit(False)).alias("good"),
        F.coalesce(_secret(kind, m["value"]), F.lit(False)).alias("secret")))
    there = text.rlike(pattern)
    if kind in NEEDED:
        there = reduce(or_, [low.contains(word) for word in NEEDED[kind]]) & there
    # the last piece has no match behind it
    return F.when(there, F.filter(found, lambda m: m["size"].isNotNull())).otherwise(F.array().cast(PART)).cast(PART)


def parts(docs: DataFrame) -> DataFrame:
    """One row for every row of ``docs``: row_key, doc_id and all matches, written once."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.lower(text).alias("low"))
    every = [_matches(kind, F.col("text"), F.col("low")) for kind in range(len(KINDS))]
    return stage(texts.select(F.monotonically_increasing_id().alias("row_key"), "doc_id", F.concat(*every).alias("parts")), "secrets")


def spans(found: DataFrame) -> DataFrame:
    """row_key, kind, start, stop, paragraph, secret of every span, from the pieces between matches."""
    rows = found.where(F.size("parts") > 0).select("row_key", F.inline("parts"))
    so_far = Window.partitionBy("row_key", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("gap").cast("long") + F.col("size")).over(so_far)
    return rows.select("row_key", "kind", (stop - F.col("size")).alias("start"), stop.alias("stop"),
                       F.sum("breaks").over(so_far).alias("paragraph"), "good", "secret").where("good").drop("good")


def linked(all_spans: DataFrame, reach: int = REACH) -> DataFrame:
    """Weak spans whose complementary parts stand within ``reach`` in their paragraph.

    Adds the nearest identifier, secret and endpoint (start places, null where there is none). A
    weak span that shares characters with a strong one is left out, the strong one standing for it.
    """
    def over(first: Column, last: Column) -> Column:
        return F.explode(F.sequence(F.floor(first / BIN), F.floor(last / BIN)))

    weak = all_spans.where(F.col("kind") >= LOGIN)
    left = weak.select("*", over(F.col("start"), F.col("stop")).alias("bin"))
    right = all_spans.select(*[F.col(c).alias(f"p_{c}") for c in ("row_key", "kind", "start", "stop", "paragraph", "secret")],
                             over(F.greatest(F.col("start") - reach, F.lit(0)), F.col("stop") + reach).alias("p_bin"))
    gap = F.greatest(F.col("p_start") - F.col("stop"), F.col("start") - F.col("p_stop"))
    pairs = left.join(right, (F.col("row_key") == F.col("p_row_key")) & (F.col("bin") == F.col("p_bin"))
                      & (F.col("paragraph") == F.col("p_paragraph")) & (gap <= reach))
    apart = gap >= 0

    def nearest(which: Column) -> Column:
        return F.min(F.when(which & apart, F.struct(F.greatest(gap, F.lit(0)), F.col("p_start"))))["p_start"]

    facts = pairs.groupBy("row_key", "kind", "start", "stop").agg(
        nearest(F.col("p_kind").isin(ACCESS, LOGIN)).alias("identifier"),
        nearest(F.col("p_secret")).alias("secret_at"),
        nearest(F.col("p_kind") == ENDPOINT).alias("endpoint"),
        F.coalesce(F.max(~apart & (F.col("p_kind") < LOGIN)), F.lit(False)).alias("covered"))
    complete = F.when(F.col("kind") == LOGIN, F.col("secret_at").isNotNull()) \
        .when(F.col("kind") == LOOSE, F.col("identifier").isNotNull() | F.col("endpoint").isNotNull()) \
        .otherwise(F.col("identifier").isNotNull() & F.col("secret_at").isNotNull())
    return facts.where(complete & ~F.col("covered")).drop("covered")


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked for every row of ``docs``.

    ``base_sha256`` digests the strong spans and ``spans`` names all, as kind:start:stop by start
    and kind, places counted in code points. Doubled and missing ids are told apart by their row.
    A missing text counts as an empty one, which has no spans. Of equal texts each gets its spans.
    Texts of any length are read whole. An empty table gives no rows. Only doc_id and text are
    used, so further columns may have any name.
    """
    found = parts(docs)
    all_spans = stage(spans(found), "spans")
    reported = all_spans.where(F.col("kind") < LOGIN).select("row_key", "kind", "start", "stop") \
        .unionByName(linked(all_spans, reach).select("row_key", "kind", "start", "stop"))
    names = F.array(*[F.lit(k) for k in KINDS])
    entry = F.struct("start", "kind", F.concat_ws(":", names[F.col("kind")], "start", "stop").alias("said"))
    by_row = reported.groupBy("row_key").agg(F.array_sort(F.collect_list(entry)).alias("entries"))

    def joined(entries: Column) -> Column:
        return F.array_join(F.transform(entries, lambda e: e["said"]), ",")

    entries = F.coalesce("entries", F.array().cast("array<struct<start:long,kind:int,said:string>>"))

    def count(kind: int) -> Column:
        return F.size(F.filter(entries, lambda e: e["kind"] == kind)).cast("long")

    return found.select("row_key", "doc_id").join(by_row, "row_key", "left").select(
        "doc_id", count(ASSIGN).alias("n_assign"), count(ACCESS).alias("n_access"), count(HEX).alias("n_hex"),
        F.sha2(joined(F.filter(entries, lambda e: e["kind"] < LOGIN)).cast("binary"), 256).alias("base_sha256"),
        joined(entries).alias("spans"), F.size(F.filter(entries, lambda e: e["kind"] >= LOGIN)).cast("long").alias("n_linked"))

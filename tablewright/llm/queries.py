"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm import (ann, chat, decontam, language, near, pieces, pii, repeats, secrets, suffix, tokens, toxicity,
                             whiten)
from tablewright.llm.common import read
from tablewright.llm.registry import query


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_tokens")
def op2_tokens(spark: SparkSession, folder: str) -> DataFrame:
    definition = Path(vocabulary("byte_bpe_50k.json")).read_text()
    return tokens.read(spark, tokens.write(read(spark, folder, "documents"), definition, end_id=2))


#: said by both sides of the added conversation
CONTROL = "<|im_end|><|im_start|>assistant ok"


@query("op3_chat")
def op3_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)],
                                  "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_turns(spark, rows.unionByName(added)))


WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAM_SQL = fr"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all({LOWER}, '{WORDS}') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({LOWER}, '{WORDS}') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(list_slice(w, s, s + 12), ' ') AS t
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT k, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS t
       FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT k, item_id, s, iw.n FROM dw JOIN iw ON dw.t = iw.t AND dw.n = iw.n),
words AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(s, s + n)) AS p FROM hit) GROUP BY k),
items AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (k) LEFT JOIN items USING (k)
"""


@query("op5_decontam", DECONTAM_SQL)
def op5_decontam(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.overlaps(read(spark, folder, "documents"), read(spark, folder, "benchmark")).drop("row_key")


@query("op1_pii")
def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return pii.find(docs, pii.fit(docs))


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read(spark, folder, "labels")))


@query("op9_near")
def op9_near(spark: SparkSession, folder: str) -> DataFrame:
    return near.classes(read(spark, folder, "documents")).select("doc_id", "class_id", "n_links")


@query("op6_language")
def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(read(spark, folder, "pages"), read(spark, folder, "documents"))


@query("op7_ann")
def op7_ann(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(read(spark, folder, "embeddings"))


@query("op8_suffix")
def op8_suffix(spark: SparkSession, folder: str) -> DataFrame:
    return suffix.remove(read(spark, folder, "documents"))


@query("op10_pieces")
def op10_pieces(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary_ = pieces.Pieces.load(vocabulary("piece_bpe_32k.model"))
    docs = read(spark, folder, "documents")
    return pieces.encode(docs, vocabulary_, ["doc_id"], "n_pieces long, ids_crc32 long, round_trip boolean", pieces.digests)


@query("op11_runs")
def op11_runs(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.digests(read(spark, folder, "documents"), repeats.planted)


def _secret_matches(kind: int) -> str:
    """SQL for all matches of a kind; RE2 knows no look-behind and needs none, as matches begin leftmost."""
    pattern, group = secrets.PATTERNS[kind]
    pattern = pattern.replace("(?<![a-z0-9+.-])", "").replace("'", "''")
    good = {secrets.ASSIGN: "length(value) >= 12", secrets.ACCESS: "length(value) >= 18", secrets.LOOSE:
            "(regexp_matches(value, '[:=]') AND NOT regexp_matches(value, '^[A-Za-z0-9+/]{32,}=*$')"
            " OR regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[0-9]'))"}
    secret = {secrets.HEX: "regexp_matches(value, '[a-f]')", secrets.ASSIGN: "true", secrets.LOOSE: "true"}
    return f"""
SELECT k, {kind} AS kind, i, whole, gap, {good.get(kind, "true")} AS good, {secret.get(kind, "false")} AS secret FROM (
    SELECT k, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS whole, unnest(v) AS value, unnest(list_slice(g, 1, len(w))) AS gap
    FROM (SELECT k, regexp_extract_all(t, '{pattern}', 0) AS w, regexp_extract_all(t, '{pattern}', {group}) AS v,
                 string_split_regex(t, '{pattern}') AS g FROM d))"""


SECRETS_SQL = fr"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(_secret_matches(kind) for kind in range(len(secrets.KINDS)))}),
placed AS (SELECT k, kind, whole, good, secret, sum(length(gap) + length(whole)) OVER w AS stop,
                  sum(len(string_split_regex(gap, '{secrets.BLANK}')) - 1) OVER w AS paragraph
           FROM m WINDOW w AS (PARTITION BY k, kind ORDER BY i)),
s AS (SELECT k, kind, stop - length(whole) AS start, stop, paragraph, secret FROM placed WHERE good),
pairs AS (SELECT a.k, a.kind, a.start, a.stop, b.kind AS p_kind, b.secret AS p_secret, greatest(b.start - a.stop, a.start - b.stop) AS gap
          FROM s AS a JOIN s AS b ON a.k = b.k AND a.paragraph = b.paragraph
          AND greatest(b.start - a.stop, a.start - b.stop) <= {secrets.REACH} WHERE a.kind >= 3),
facts AS (SELECT k, kind, start, stop, bool_or(gap >= 0 AND p_kind IN (1, 3)) AS identifier, bool_or(gap >= 0 AND p_secret) AS with_secret,
                 bool_or(gap >= 0 AND p_kind = 5) AS endpoint, bool_or(gap < 0 AND p_kind < 3) AS covered FROM pairs GROUP BY ALL),
reported AS (SELECT k, kind, start, stop FROM s WHERE kind < 3 UNION ALL
             SELECT k, kind, start, stop FROM facts WHERE NOT covered AND CASE kind
             WHEN 3 THEN with_secret WHEN 4 THEN identifier OR endpoint ELSE identifier AND with_secret END),
said AS (SELECT k, kind, start, {secrets.KINDS}[kind + 1] || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS e FROM reported),
by_row AS (SELECT k, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
                  count(*) FILTER (kind > 2) AS n_linked, string_agg(e, ',' ORDER BY start, kind) AS spans,
                  string_agg(e, ',' ORDER BY start, kind) FILTER (kind < 3) AS base FROM said GROUP BY k)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_linked, 0) AS n_linked
FROM d LEFT JOIN by_row USING (k)
"""


@query("op12_secrets", SECRETS_SQL)
def op12_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(read(spark, folder, "documents"))


@query("op13_whiten")
def op13_whiten(spark: SparkSession, folder: str) -> DataFrame:
    return whiten.whiten(read(spark, folder, "embeddings"))

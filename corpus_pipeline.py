"""Training corpus from raw documents: five stages, each written and read again.

toxicity            rejects documents whose score is one half or more
near_duplicates     keeps one document of each class of near-duplicates
decontamination     rejects documents contaminated by the benchmark
redaction           replaces personal data in the texts that stay
pieces              encodes what is left into piece ids

All but the last return the columns of ``documents``. A row without text passes the filters as an
empty one: it is neither toxic, nor near another document, nor contaminated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import decontam, near, pieces, pii, toxicity
from tablewright.llm.common import read, ship
from tablewright.llm.queries import vocabulary
from tablewright.llm.registry import query
from tablewright.session import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.col(f"`{c}`") for c in COLUMNS])


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field of toxic spans scores below one half."""
    ship(spark)
    return toxicity.keep_clean(_columns(docs), toxicity.fit(docs, read(spark, sf_dir, "labels")))


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of every class: smallest doc_id (missing ones last), then first row read."""
    ship(spark)
    numbered = stage(_columns(docs).withColumn("row_key", F.monotonically_increasing_id()), "numbered")
    classes = near.classes(numbered, key="row_key")
    first = classes.groupBy("root").agg(F.min_by("row_key", F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("row_key"))
    return numbered.join(first.select("row_key"), "row_key", "left_semi").select(*COLUMNS)


def reject_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in a window of a benchmark item."""
    ship(spark)
    numbered = stage(_columns(docs).withColumn("row_key", F.monotonically_increasing_id()), "numbered")
    found = decontam.overlaps(numbered, read(spark, sf_dir, "benchmark"), key="row_key")
    return numbered.join(found.where("contaminated").select("row_key"), "row_key", "left_anti").select(*COLUMNS)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, the personal data in their texts replaced by its kind; n_chars follows."""
    ship(spark)
    docs = _columns(docs)
    hidden = pii.redact(docs, pii.fit(docs))
    return hidden.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and crc32 of each document's piece ids, and whether they decode to its text."""
    ship(spark)
    return pieces.encode(_columns(docs), pieces.Pieces.load(vocabulary("piece_bpe_32k.model")), ["doc_id", "lang", "source"],
                         "n_pieces long, ids_crc32 long, round_trip boolean", pieces.digests)


STAGES = [("toxicity", reject_toxic), ("near_duplicates", keep_one_of_each_class),
          ("decontamination", reject_contaminated), ("redaction", redact), ("pieces", encode)]

#: the first stage scores by a trained field, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the staging folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs


query("pipeline", ORACLE_SQL)(run)

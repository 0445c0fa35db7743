"""A training corpus from documents: five stages, each on all that its predecessor kept.

Toxic documents go, then those without a recognisable language, then all but one
of each group of near duplicates, then those with benchmark passages; the rest
is encoded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import read, small_batches, stored
from ledgerloom.llm.decontamination import contaminated
from ledgerloom.llm.language import labelled_sample, phrase_limits, predicted
from ledgerloom.llm.minhash import near_duplicates
from ledgerloom.llm.pieces import encoded
from ledgerloom.llm.toxicity import learn, scored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic; it learns from the labels of all documents.

    NULL and empty texts stay.
    """
    small_batches(spark)
    model = learn(docs, read(spark, sf_dir, "labels"))
    rated = scored(docs, model, docs.columns, ("__score", "__toxic"))
    return rated.where("__toxic = 0").select(*docs.columns)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the labelled languages; all if no text with a letter is labelled.

    A text without a letter, or with more phrases per letter than the labelled
    text allows (``phrase_limits``), is in none and goes.
    """
    small_batches(spark)
    sample = labelled_sample(docs)
    if not any(sample.values()):
        return docs
    rated = predicted(docs, sample, docs.columns, ("__lang", "__sure"), phrase_limits(sample))
    return rated.where("__lang != 'und'").select(*docs.columns)


def keyed(docs: DataFrame) -> DataFrame:
    """``__key`` per row: its id, or below zero a hash of id and text where the id is NULL or stands in several rows.

    So rows are judged by their own text; only rows that are alike in both share a key.
    """
    name = F.col("doc_id").cast("long")
    own = -1 - F.pmod(F.xxhash64("doc_id", F.col("text").cast("string")), F.lit(1 << 62))
    repeated = docs.groupBy(name.alias("__id")).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1 OR __id IS NULL")
    if not repeated.limit(1).count():
        return docs.withColumn("__key", name)
    marks = repeated.select("__id", F.lit(True).alias("__odd"))
    marked = docs.join(marks, name == F.col("__id"), "left")
    return marked.withColumn(
        "__key", F.when(name.isNull() | F.coalesce("__odd", F.lit(False)), own).otherwise(name)
    ).select(*docs.columns, "__key")


def by_key(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("__key").alias("doc_id"), "text")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the least key (see ``keyed``), once."""
    small_batches(spark)
    rows = keyed(docs)
    copies = near_duplicates(by_key(rows)).where(~F.col("representative")).select(F.col("doc_id").alias("__key")).distinct()
    kept = rows.join(copies, "__key", "left_anti")
    # Rows of one id and one text are copies too; other keys stand once.
    odd = kept.where("__key < 0").dropDuplicates(["__key"])
    return kept.where("__key >= 0 OR __key IS NULL").unionByName(odd).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage in their own text, whatever their id."""
    rows = keyed(docs)
    found = contaminated(by_key(rows), read(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("__key")).distinct()
    return rows.join(found, "__key", "left_anti").select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document and whether decoding them gives its text again."""
    small_batches(spark)
    return encoded(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("language_id", keep_known_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentence_pieces", encode_pieces),
]
#: No stage is one that SQL can repeat; tests/llm tests the operators of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each is written to the shared scratch folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs

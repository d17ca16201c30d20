"""The corpus pipeline: what is left of the documents, stage by stage, packed into training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raregrain.functions.scratch import materialise
from raregrain.llm.common import table
from raregrain.llm.dartminhash import near_duplicate_classes
from raregrain.llm.exact import drop_duplicates
from raregrain.llm.langid import UNDECIDED, fit, held_out, piece_path, predict
from raregrain.llm.packing import byte_path, pack_documents
from raregrain.llm.substrings import dedup_substrings

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
REMEMBERED = 50_000  # chunks of text a packing worker remembers: by then the stages before have widened the executors' heaps
LEAST_SCORE = 0.5  # share of the best language below which a text has none


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a language; a missing label takes the predicted one."""
    names, probs = fit(docs.where(~held_out()), piece_path())
    out = predict(docs, piece_path(), names, probs)
    return (out.where((F.col("lang_pred") != UNDECIDED) & (F.col("score") >= LEAST_SCORE))
            .withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z folded) the largest doc_id stays."""
    return drop_duplicates(docs).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the smallest doc_id stays; rows without an id stay."""
    classes = near_duplicate_classes(docs)
    go = materialise(classes.groupBy(F.col("doc_id").alias("go"))
                     .agg(F.max(F.col("doc_id") == F.col("class_id")).alias("stays")).where("NOT stays").select("go"))
    return docs.join(go, F.col("doc_id") == F.col("go"), "left_anti").select(*COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the words that a smaller document has in a window of 13; what loses all its words goes.

    Untouched texts keep their white space.
    """
    out = dedup_substrings(docs).where("n_removed = 0 OR n_removed < n_words")
    return (out.withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text")))
            .withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast("long")).select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left and their places in sequences of 2048 tokens."""
    return pack_documents(docs, byte_path(), memory=REMEMBERED)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("packing", pack),
]

ORACLE_SQL = None  # the language model has no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other; each reads the stored result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

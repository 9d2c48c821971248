"""From raw documents to packed training sequences, in five stages over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm import exact, language, mixture, packing, simhash
from kinweave.session import materialise

TOKENIZER = "word_bpe_49k.json"

# Learned labels and pseudorandom draws have no counterpart in SQL.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters; those that are NULL or have none are of no language and go.

    Learns from documents whose crc32 of the id is not 1 modulo 3 and that have a ``lang``. If
    there is none to learn from, no language is known and all documents go. The score is the
    share of the best label, low in any text of several languages, so it rejects nothing.
    """
    names = docs.columns
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    labelled = language.label_languages(docs, F.coalesce(fold, F.lit(0)) != 1)
    return labelled.filter(F.col("lang_pred") != language.UNKNOWN).select(*names)


def one_of_equal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The longest, then smallest id, of documents equal but for white space."""
    return exact.drop_exact(docs)


def one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return simhash.drop_near(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words taken for the mix, as documents; repeats are rows of their own."""
    out = mixture.mixed_documents(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language", known_language),
    ("exact", one_of_equal),
    ("near", one_of_near),
    ("mix", mixed),
    ("pack", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

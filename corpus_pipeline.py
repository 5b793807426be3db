"""A training-data pipeline over ``documents``; every stage calls one operator of tidemark.llm.

Language ID drops what it rejects, exact dedup keeps one row of equal texts,
the n-gram Jaccard join keeps one document of each component (five words,
similarity 0.8), mixing reads the sources to target weights in training order
(a document read twice is there twice), and packing fills token sequences in that order, which
it takes from the files that mixing has written.

All columns, whatever their names, go through the first four stages as they are.  NULL, empty and
letterless texts go with the first stage; very long texts stay whole throughout; repeated
rows are one document after the second; a row without doc_id has no near duplicates; a NULL
source is a source.  An empty table gives an empty table at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, langid, mixing, ngram_join, packing
from tidemark.llm.common import release, scratch_root, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    return ngram_join.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    return mixing.in_training_order(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences, in training order; a document that is read twice is packed twice."""
    release(spark)
    pieces = packing.pack(mixing.as_written(docs), added=True, order=mixing.WRITTEN_PLACE)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("ngram_jaccard", near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Classification, links, hashed orders and tokens are beyond SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, root = spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch_root(spark)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"{i}-{name}", root)
    return docs

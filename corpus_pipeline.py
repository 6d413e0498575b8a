"""From a document table to packed training sequences, in stages that each take and give documents.

Every stage works on all that the one before it kept, written and read again in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from changefold.llm import line_dedup, mixing, near_dedup, packing, quality
from changefold.llm.common import staged, table
from changefold.llm.queries import ACCEPT, tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels that are not held out."""
    docs = docs.select(*COLUMNS)
    weights = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs.withColumn("words_of", F.col("text")), weights, id_columns=COLUMNS, text_column="words_of")
    return scored.where(F.col("score") >= ACCEPT).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand earlier in the corpus; those of which nothing is left go."""
    found = line_dedup.without_repeated_lines(docs.select(*COLUMNS))
    left = found.where("n_removed = 0 OR n_removed < n_lines")
    return left.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest doc_id."""
    return near_dedup.one_of_each(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of the sources by their weights; a document drawn in two rounds gives two rows."""
    docs = docs.select(*COLUMNS)
    _, _, pieces = mixing.mix(docs)
    return mixing.mixed_documents(docs, pieces)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens, with their ids."""
    return packing.pack(docs.select(*COLUMNS), tokenizer_path())


STAGES = [
    ("quality classifier", filter_quality),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: Stages train a model and use a tokenizer, which SQL cannot.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

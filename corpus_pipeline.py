"""A corpus pipeline: documents through the operators of ``corpusq.llm``, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and, but for
the last, returns the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusq.llm import jaccard, mixing, packing, quality, toxicity
from corpusq.session import prepare, written

# Near duplicates: shingles of five words, similarity of 80 percent or more.
SHINGLE_WORDS, SIMILARITY = 5, 80
TOKENIZER = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the mark for rejection; the scorer learns from the labels."""
    return toxicity.drop_toxic(docs, prepare(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and every threshold."""
    prepare(spark)
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    prepare(spark)
    return jaccard.keep_one(docs, SHINGLE_WORDS, SIMILARITY)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them whole."""
    prepare(spark)
    return mixing.take_copies(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of a document with its place in a packed sequence."""
    prepare(spark)
    return packing.pack(packing.cut(docs, public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("packing", pack),
]
# Learned scores and the tokenizer are beyond SQL; tests/llm holds run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and reread as the next one's input."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: documents in, packed training sequences out.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as
Parquet in the shared folder and reads it again as the next stage's documents.  All stages but
the last return the columns of documents.  Stages work on whatever their predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kestrel.llm.common import store, table
from kestrel.llm.lines import deduplicate_lines
from kestrel.llm.minhash import deduplicate
from kestrel.llm.mixing import mix
from kestrel.llm.packing import pack
from kestrel.llm.quality import filter_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go; null texts, languages and sources are scored like any other value."""
    return filter_quality(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more are cut out; text and n_chars change.  A null text stays null."""
    return deduplicate_lines(docs, min_docs=10, min_chars=1)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five words, similarity 0.8); so do empty texts and null doc_ids."""
    return deduplicate(docs, words=5, num=80, den=100)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated (three times at most) or left out so that the sources meet their targets; null is a source."""
    return mix(docs, max_epochs=3)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 2048 tokens; a null text is one piece of the closing token."""
    from public_tokenizers import path as tokenizer_path

    return pack(docs, tokenizer_path("word_bpe_49k.json"), size=2048)


STAGES = [("quality_classifier", quality), ("line_dedup", lines), ("minhash_near_dedup", near_duplicates),
          ("mix_sources", mixing), ("sequence_packing", packing)]

#: Classifier, minhash and tokenizer have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs

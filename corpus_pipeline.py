"""From raw documents to packed training sequences, stage by stage."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from paralane.llm.exact import exact_dedup
from paralane.llm.packing import packed_documents
from paralane.llm.quality import quality_filter
from paralane.llm.simhash import simhash_dedup
from paralane.llm.substring import substring_dedup
from paralane.session import materialize


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject, learned from the folder's labels.

    A null text is scored as an empty one. Rows without an id or a label are scored too.
    """
    return quality_filter(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without white space: the longest, then the smallest id.

    Null texts are empty ones, so null, empty and blank texts are one group. Repeated rows are copies.
    """
    return exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates; null ids come last.

    Groups are chains of fingerprints that differ in four bits or fewer, see ``simhash_dedup``.
    """
    return simhash_dedup(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that a document with a smaller id has too.

    n_chars follows the text; a document that loses all its words stays, with an empty text. A null id is
    larger than all others; rows of one id keep what they share.
    """
    return substring_dedup(docs, length_column="n_chars")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences. A null text has its end token only."""
    return packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", classify),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("best-fit packing", pack_sequences),
]

#: SQL has no classifier to train and no tokenizer; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each writes what it keeps before the next begins.

    Columns of any names pass through all stages but the last. An empty table gives no rows.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

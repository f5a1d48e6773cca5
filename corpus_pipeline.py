"""The documents of a corpus: filtered, deduplicated, mixed and packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from feedkit.llm.common import stored, table
from feedkit.llm.exact import without_copies
from feedkit.llm.mixing import mixed
from feedkit.llm.near import without_near_copies
from feedkit.llm.packing import pack
from feedkit.llm.quality import good


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of equal texts the document with the largest identifier."""
    return without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of near copies the document with the smallest identifier."""
    return without_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in the proportions of the mix, repeated or cut as it takes them."""
    return mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of documents in sequences of tokens."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("mix sources", mix_sources),
    ("pack", pack_sequences),
]
#: Components of links and a tokenizer's ids have no plain SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again for the next."""
    docs = table(spark, folder, "documents")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, folder)
        if n < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs

"""Token counts of whole texts with a cache of counts by digest.

The cache is a Parquet table of content digest, tokenizer digest and count. Texts whose digest it lacks
are encoded once each, by the tokenizer's own library, and their counts appended; every row then gets its
count from the cache.

At scale: copies are dropped on the map side before the one shuffle of texts, and a warm cache leaves only
new texts to encode. The joins for rows move digests alone; AQE splits a digest that many rows share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from importlib.metadata import version

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.workdir import new_folder

CACHE = "digest binary, tokenizer string, n_tokens long"
BATCH_BYTES = 1 << 20


def library_of(path: str) -> str:
    """``tokenizers`` for .json, ``sentencepiece`` for .model."""
    name = {"json": "tokenizers", "model": "sentencepiece"}.get(path.rpartition(".")[2])
    if name is None:
        raise ValueError(f"no tokenizer library for {path}")
    return name


@lru_cache(maxsize=2)
def counter(path: str) -> Callable[[list[str]], list[int]]:
    """Counts by the library for the file. No special tokens are added."""
    if library_of(path) == "tokenizers":
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.no_padding()
        library.no_truncation()
        return lambda texts: [len(e.ids) for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1, add_bos=False, add_eos=False)]


def tokenizer_digest(path: str) -> str:
    """Names the tokenizer's file and the version of the library that reads it."""
    library = library_of(path)
    with open(path, "rb") as file:
        return f"{hashlib.file_digest(file, 'sha256').hexdigest()}:{library}-{version(library)}"


def _count(path: str, tokenizer: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            counts, held, size = [], [], 0
            for text in batch.column(1).to_pylist():
                held.append(text)
                size += len(text)
                if size >= BATCH_BYTES:
                    counts += count(held)
                    held, size = [], 0
            counts += count(held) if held else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([tokenizer] * len(counts)), pa.array(counts, pa.int64())], names=["digest", "tokenizer", "n_tokens"])

    return run


class TokenCache:
    """The cache in ``folder``, which all executors share; without one, a new folder in the shared folder."""

    def __init__(self, spark, folder: str | None = None):
        self.spark, self.folder = spark, folder or new_folder(spark, "token-cache")

    def counts(self, tokenizer: str) -> DataFrame:
        """``digest`` and ``n_tokens``, one row a digest, also if two runs have appended the same one."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        there = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)
        held = self.spark.read.schema(CACHE).parquet(self.folder) if there else self.spark.createDataFrame([], CACHE)
        return held.where(F.col("tokenizer") == tokenizer).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    def add(self, texts: DataFrame, path: str) -> None:
        """Encode the distinct texts (``digest``, ``text``) that the cache lacks and append their counts."""
        tokenizer = tokenizer_digest(path)
        distinct = texts.dropDuplicates(["digest"])
        misses = distinct.join(self.counts(tokenizer).select("digest"), "digest", "left_anti")
        misses.mapInArrow(_count(path, tokenizer), CACHE).write.mode("append").parquet(self.folder)


def token_counts(docs: DataFrame, path: str, cache: TokenCache | None = None, limit: int = 4096) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of each row.

    Content is normalised only so far that no count can change: null counts as empty. Repeated rows get a
    row each. Other columns are ignored. No rows give none.
    """
    cache = cache or TokenCache(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest")
    cache.add(docs.select(digest, text.alias("text")), path)
    rows = docs.select("doc_id", digest, F.octet_length(text).cast("long").alias("n_bytes"))
    counted = rows.join(cache.counts(tokenizer_digest(path)), "digest", "left")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

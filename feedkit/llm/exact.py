"""Exact deduplication by a streaming query with keyed state on disk.

Rows arrive as a feed of digests. The state, kept by RocksDB without expiry and checkpointed into the
shared folder, holds for each digest how many rows had it, and the identifier and place of the row that
stays. A digest that was seen before is a hit; the full texts of hits are compared, and should a digest
ever stand for two texts, its rows are grouped by text instead.

At scale: the state is spread over the shuffle partitions by digest and updated from partial counts, so
a text that a third of all rows have costs each task one row. Texts are shuffled once, for the hits' check.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.llm.common import ascii_lower, located, locator, stored
from feedkit.workdir import new_folder

#: State on disk, and no disk set aside for what small state stores don't fill.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


@contextmanager
def state_settings(spark) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


class Deduplicator:
    """Feeds of rows against the state in ``folder``; a later feed meets what earlier ones left there.

    ``folder`` must be shared by all executors; without one, a new folder in the shared folder is used.
    """

    def __init__(self, spark, folder: str | None = None, digest: Callable[[Column], Column] = sha256):
        self.spark, self.digest = spark, digest
        self.folder = folder or new_folder(spark, "exact")

    def feed(self, docs: DataFrame) -> DataFrame:
        """Write the rows' digests into the feed and run the stream over all that is new in it."""
        text = ascii_lower(F.col("text"))
        rows = docs.select(self.digest(text).alias("digest"), "doc_id", *locator("file", "row"))
        rows.write.mode("append").parquet(f"{self.folder}/feed")
        with state_settings(self.spark):
            stream = self.spark.readStream.schema(rows.schema).parquet(f"{self.folder}/feed")
            state = stream.groupBy("digest").agg(F.max(F.struct("doc_id", "file", "row")).alias("keep"), F.count("*").alias("n"))
            query = state.writeStream.format("noop").outputMode("update").option("checkpointLocation", f"{self.folder}/state")
            query.trigger(availableNow=True).start().awaitTermination()
        return self.spark.read.schema(rows.schema).parquet(f"{self.folder}/feed")

    def state(self) -> DataFrame:
        """``digest``, ``n`` and ``keep`` (``doc_id``, ``file``, ``row``) as the state holds them now."""
        held = self.spark.read.format("statestore").load(f"{self.folder}/state")
        keep, n = held.schema["value"].dataType.names
        groups = held.select(F.col("key.digest").alias("digest"), F.col(f"value.`{keep}`").alias("keep"), F.col(f"value.`{n}`").alias("n"))
        with state_settings(self.spark):
            return stored(groups, "groups")


def deduplicate(docs: DataFrame, folder: str | None = None, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Each row of ``docs`` with its group of equal texts (``doc_id``, ``text``).

    Texts are equal when identical after lower-casing A-Z. Returns ``doc_id``, ``keep_id`` (the largest
    ``doc_id`` of the group), ``group_size``, ``kept``, ``text_sha256``, and ``file`` and ``row`` that
    name the row. Null text counts as empty. One row of a group is kept: of repeated identifiers the one
    in the last place; a null identifier is below all others. No rows give none.
    """
    docs = located(docs)
    dedup = Deduplicator(docs.sparkSession, folder, digest)
    feed = dedup.feed(docs)
    groups = dedup.state()

    text = ascii_lower(F.col("text"))
    texts = docs.select(digest(text).alias("digest"), text.alias("text"), "doc_id", *locator("file", "row"))
    hits = groups.where("n > 1").select("digest")
    differ = texts.select("digest", "text").join(hits, "digest", "left_semi").groupBy("digest").agg(F.min("text").alias("a"), F.max("text").alias("b"))
    differ = stored(differ.where("a <> b").select("digest"), "differ")

    rows = feed.join(groups, "digest").select("digest", "doc_id", "file", "row", "keep", "n")
    if differ.take(1):
        mixed = texts.join(differ, "digest")
        kept = mixed.groupBy("digest", "text").agg(F.max(F.struct("doc_id", "file", "row")).alias("keep"), F.count("*").alias("n"))
        by_text = mixed.join(kept, ["digest", "text"]).select(F.sha2(F.col("text").cast("binary"), 256).alias("sha"), "doc_id", "file", "row", "keep", "n")
        rows = rows.join(differ, "digest", "left_anti")
    else:
        by_text = None
    if digest is sha256:
        rows = rows.withColumn("sha", F.lower(F.hex("digest")))
    else:
        names = texts.select(F.sha2(F.col("text").cast("binary"), 256).alias("sha"), F.col("file").alias("f"), F.col("row").alias("r"))
        rows = rows.join(names, (F.col("file") == F.col("f")) & (F.col("row") == F.col("r")))
    rows = rows.select("sha", "doc_id", "file", "row", "keep", "n")
    rows = rows if by_text is None else rows.unionByName(by_text)
    stays = (F.col("keep.file") == F.col("file")) & (F.col("keep.row") == F.col("row"))
    return rows.select("doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("n").alias("group_size"), stays.alias("kept"), F.col("sha").alias("text_sha256"), "file", "row")


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns and no others."""
    docs = located(docs)
    gone = deduplicate(docs).where("not kept").select(F.col("file").alias("gone_file"), F.col("row").alias("gone_row"))
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *locator("file", "row"))
    return named.join(gone.hint("merge"), (F.col("file") == F.col("gone_file")) & (F.col("row") == F.col("gone_row")), "left_anti").select("doc.*")

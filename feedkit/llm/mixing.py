"""Mixing sources to target weights by Sainte-Lague apportionment. DataFrame operations only.

A source's target is its weighted share of the mix, at most ``cap`` times what the source has. Documents
are dealt to shards; in a shard, a source's documents in seeded order, followed by the same again for
each further pass, are a run of blocks of ``block_words`` words. The shard's blocks are allocated to the
sources by the highest quotients ``votes / (2 k + 1)``, and each source takes its first blocks in the
seeded order: every document once before any is repeated, and only the last one of a pass is cut.

At scale: texts are read once and not shuffled. Sources are ranked by a range exchange, not by one sort
task. A shard's quotients are bounded from both sides, so only about two a source are listed, however
many blocks there are. A window holds one source's rows of one shard (``docs_per_shard`` bounds the
shard), so a source with a third of all rows is spread over all shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedkit.llm.common import WORD, located, locator, stored

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank``: the position of its ``source`` in code point order, null last."""
    order = F.col("source").asc_nulls_last()
    parts = stored(sources.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    offsets = parts.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    return parts.withColumn("place", place).join(offsets, "part").select("source", "source_size", (F.col("offset") + F.col("place")).alias("rank"))


def with_targets(sources: DataFrame, weights: tuple, share: float, cap: float) -> DataFrame:
    """``sources`` with ``target``: the excess of sources at their cap is reshared until none is above."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    weighted = stored(sources.withColumn("weight", weight), "weights")
    most = F.lit(float(cap)) * F.col("source_size")
    total, capped, rest, free = None, -1, 0.0, 0.0
    while True:
        above = F.lit(False) if total is None else F.col("weight") * rest / free > most
        row = weighted.agg(
            F.sum("source_size").alias("all"),
            F.count(F.when(above, 1)).alias("capped"),
            F.sum(F.when(above, most)).alias("held"),
            F.sum(F.when(~above, F.col("weight"))).alias("free"),
        ).first()
        total = share * (row["all"] or 0)
        if row["capped"] == capped or not row["free"]:
            break
        capped, rest, free = row["capped"], total - (row["held"] or 0.0), row["free"]
    even = F.col("weight") * rest / free if free else F.lit(0.0)
    return weighted.withColumn("target", F.when(even > most, most).otherwise(even))


def seats(cells: DataFrame, block_words: int) -> DataFrame:
    """Blocks of each (``shard``, ``rank``) by Sainte-Lague: the shard's blocks go to the highest quotients.

    ``votes`` are thousandths of words. A cell's blocks lie between the votes divided by the largest and
    the smallest divisor that any rounding of the shard's cells allows, so only quotients in between compete.
    """
    voting = cells.where("votes > 0")
    shards = voting.groupBy("shard").agg(F.sum("votes").alias("all_votes"), F.count("*").alias("n"))
    shards = shards.withColumn("blocks", F.floor(F.col("all_votes") / F.lit(1000.0 * block_words) + 0.5))
    part = F.col("votes") / F.col("all_votes")
    low = F.greatest(F.lit(0), F.floor(part * (F.col("blocks") - F.col("n") / 2.0) + 0.5) - 1)
    high = F.floor(part * (F.col("blocks") + F.col("n") / 2.0) + 0.5) + 1
    held = voting.join(shards, "shard").withColumn("low", low).withColumn("high", high)
    rivals = held.select("shard", "rank", "votes", "blocks", "low", F.explode(F.sequence("low", "high")).alias("k"))
    quotient = F.col("votes") / (2.0 * F.col("k") + 1.0)
    place = F.row_number().over(Window.partitionBy("shard").orderBy(quotient.desc(), "rank", "k"))
    sure = F.sum(F.when(F.col("k") == F.col("low"), F.col("low"))).over(Window.partitionBy("shard"))
    won = rivals.withColumn("place", place).withColumn("sure", sure)
    return won.groupBy("shard", "rank").agg(
        (F.first("low") + F.count(F.when(F.col("place") <= F.col("blocks") - F.col("sure"), 1))).alias("seats")
    )


def mix(
    docs: DataFrame,
    *,
    weights: tuple = WEIGHTS,
    share: float = 1.5,
    cap: float = 2.0,
    block_words: int = 16,
    docs_per_shard: int = 4096,
    seed: str = "mix",
    keys: list[Column] | None = None,
) -> DataFrame:
    """What the mix takes of each row of ``docs`` (``doc_id``, ``text``, ``source``).

    ``weights`` belong to the sources in code point order, null last, and repeat. All targets together
    are ``share`` of all words; a source's target stops at ``cap`` times its words, at most 2.
    Returns ``doc_id``, ``size`` (words), ``source_size``, ``target`` (of the row's source), ``first``
    and ``second`` (words taken from the start of the text in each pass), ``taken`` (their sum), and
    what ``keys`` adds.

    Null or empty text: size 0, nothing taken. Null source: a source of its own, the last. Repeated rows
    count each; rows with one ``doc_id`` are ordered by size, and equal ones are interchangeable. No rows
    or no words: targets are 0. Other columns are ignored.
    """
    mark = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    rows = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), mark.alias("mark"), *(keys or [])), "sizes")
    names = rows.columns[4:]
    shards = max(1, -(-rows.count() // docs_per_shard))
    rows = rows.withColumn("shard", F.conv(F.substring("mark", 1, 8), 16, 10).cast("long") % shards)
    sources = with_targets(ranked(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), weights, share, cap)
    sources = stored(sources.select("source", "source_size", "rank", "target"), "targets")

    cells = rows.groupBy("source", "shard").agg(F.sum("size").alias("cell_size"))
    cells = cells.withColumnRenamed("source", "of").join(sources, F.col("of").eqNullSafe(F.col("source"))).drop("of")
    votes = F.when(F.col("source_size") > 0, F.floor(F.col("target") * F.col("cell_size") / F.col("source_size") * 1000.0 + 0.5)).otherwise(0)
    cells = stored(cells.withColumn("votes", votes.cast("long")), "cells")
    quotas = cells.join(seats(cells, block_words), ["shard", "rank"], "left")
    quotas = quotas.select(
        F.col("source").alias("of"), F.col("shard").alias("at"), "source_size", "target", "cell_size",
        (F.coalesce("seats", F.lit(0)) * block_words).alias("room"),
    )

    run = Window.partitionBy("source", "shard").orderBy("mark", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("before", F.coalesce(F.sum("size").over(run), F.lit(0)))
    placed = placed.join(quotas, F.col("source").eqNullSafe(F.col("of")) & (F.col("shard") == F.col("at")))

    def within(room: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("size"), room - F.col("before"))).cast("long")

    placed = placed.withColumn("first", within(F.col("room"))).withColumn("second", within(F.col("room") - F.col("cell_size")))
    return placed.select("doc_id", "size", "source_size", "target", "first", "second", (F.col("first") + F.col("second")).alias("taken"), *names)


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), 1, n.cast("int")), "")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the mix takes, one for each pass, with the words it takes as their text.

    A row taken whole keeps its text as it is; a cut one has ``n_chars`` of what is left, if there is
    such a column. All columns of ``docs`` are returned, and no others.
    """
    docs = located(docs)
    file, row = "mix_file", "mix_row"
    took = mix(docs, keys=locator(file, row), **options).where("taken > 0").select(file, row, "size", F.explode(F.array("first", "second")).alias("words"))
    took = took.where("words > 0").select(F.col(file).alias("f"), F.col(row).alias("r"), (F.col("words") < F.col("size")).alias("cut"), "words")
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *locator(file, row))
    joined = named.join(took.hint("merge"), (F.col(file) == F.col("f")) & (F.col(row) == F.col("r")))
    text = F.when(F.col("cut"), first_words(F.col("doc.text"), F.col("words"))).otherwise(F.col("doc.text"))
    joined = joined.withColumn("mixed_text", text)
    now = {"text": F.col("mixed_text"), "n_chars": F.when(F.col("cut"), F.length("mixed_text")).otherwise(F.col("doc.n_chars")) if "n_chars" in docs.columns else None}
    return joined.select(*[(now[c] if now.get(c) is not None else F.col(f"doc.`{c}`")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])

"""Mixture-controlled packing: deficit round-robin over source queues.

Each source's documents, in seeded order, are a queue of tokens. Every sequence is filled from the queues
in proportion to their tokens; what a queue is owed is its deficit, carried to the next sequence. The
corpus is cut into runs of ``run_sequences`` full sequences, packed side by side: how far each queue is
read when a run begins follows from the proportions alone, and so does the deficit that is carried in.

At scale: texts are encoded once; ids are stored part by part and shuffled once, to their run. A run's ids have a fixed
size. A queue's positions are sums over shards of its documents, so a source with a third of all rows
is no single window. Sources owed less than one sequence a run share a queue, so there are at most
``run_sequences`` + 1 queues.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedkit.llm.common import parted
from feedkit.llm.quality import lean, parts_of
from feedkit.llm.tokens import word_encoder

PIECE = "doc_id {}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"


def encoded(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """``doc_id``, ``source``, ``tokens`` and ``ids`` (with ``end``) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        encoder = word_encoder(tokenizer)
        close, size = np.array([end], encoder.dtype).tobytes(), encoder.dtype.itemsize
        for batch in batches:
            for part, some in parts_of(batch, "text"):
                ids = [x + close for x in encoder.encode(some)]
                tokens = pa.array([len(x) // size for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), tokens, pa.array(ids, pa.binary())], names=["doc_id", "source", "tokens", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), "text").mapInArrow(run, f"doc_id {kind}, source string, tokens long, ids binary")


def served(owed: list[float], share: list[float], left: list[int], length: int, least: int) -> list[list[tuple[int, int]]]:
    """Sequences as lists of (queue, tokens) until all queues are empty. ``owed`` are the deficits carried in.

    Each round adds a queue's share of the sequence to its deficit and visits the queues in turn, from
    where the last sequence stopped; a queue is served once it is owed ``least`` tokens or all it has left.
    What a sequence still lacks then goes to the queue owed most.
    """
    sequences, turn, n = [], 0, len(left)
    total = sum(left)
    while total:
        room = min(length, total)
        parts: list[tuple[int, int]] = []
        for q in range(n):
            owed[q] += share[q] * room
        for step in range(n):
            q = (turn + step) % n
            give = min(int(owed[q]), left[q], room)
            if give > 0 and (give >= least or give == left[q]):
                parts.append((q, give))
                owed[q] -= give
                left[q] -= give
                room -= give
                total -= give
                if not room:
                    turn = q + 1
                    break
        while room:
            q = max((x for x in range(n) if left[x]), key=lambda x: (owed[x], -x))
            give = min(max(least, int(owed[q])), left[q], room)
            parts.append((q, give))
            owed[q] -= give
            left[q] -= give
            room -= give
            total -= give
        sequences.append(parts)
    return sequences


def split_last(parts: list[tuple[int, int]], length: int) -> list[list[tuple[int, int]]]:
    """A sequence that is not full, as sequences of powers of two, which need no padding."""
    rest = sum(n for _, n in parts)
    if rest == length:
        return [parts]
    out, parts = [], list(parts)
    while rest:
        room = 1 << (rest.bit_length() - 1)
        rest -= room
        some = []
        while room:
            q, n = parts.pop(0)
            some.append((q, min(n, room)))
            if n > room:
                parts.insert(0, (q, n - room))
            room -= some[-1][1]
        out.append(some)
    return out


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    end: int = 2,
    length: int = 4096,
    run_sequences: int = 256,
    least: int = 512,
    docs_per_shard: int = 4096,
    seed: str = "pack",
) -> DataFrame:
    """Pieces of the rows of ``docs`` (``doc_id``, ``text``, ``source``) in sequences of ``length`` tokens.

    ``tokenizer`` is a file as ``WordEncoder`` takes it, readable on every executor. Returns ``doc_id``,
    ``start`` (ids of the document before the piece), ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset`` in the sequence, and ``source``.

    All sequences are full but the last ones, which are cut to powers of two. Null or empty text: the end
    id alone. Null source: a source of its own. Repeated rows are packed each. Other columns are ignored.
    No rows give none.
    """
    rows = parted(encoded(docs, tokenizer, end), "tokens")
    kind = docs.schema["doc_id"].dataType.simpleString()
    count, all_tokens = rows.agg(F.count("*"), F.sum("tokens")).first()
    if not count:
        return docs.sparkSession.createDataFrame([], PIECE.format(kind))
    span = length * run_sequences
    runs = -(-all_tokens // span)

    # queues: those owed a sequence a run, after one for all others; at most run_sequences and one
    totals = rows.groupBy("source").agg(F.sum("tokens").alias("queue_tokens"))
    large = totals.where(F.col("queue_tokens") * float(run_sequences) >= float(all_tokens)).orderBy(F.col("source").asc_nulls_last())
    names = [tuple(x) for x in large.collect()]
    rest = all_tokens - sum(n for _, n in names)
    sizes = [rest] + [n for _, n in names]
    until = np.cumsum(sizes).tolist()
    queues = docs.sparkSession.createDataFrame(
        [(name, q + 1, n, until[q + 1]) for q, (name, n) in enumerate(names)], "of string, large int, large_tokens long, large_until long"
    )
    marks = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    shards = max(1, -(-count // docs_per_shard))
    placed = rows.join(F.broadcast(queues), F.col("source").eqNullSafe(F.col("of")), "left")
    placed = placed.withColumn("queue", F.coalesce("large", F.lit(0)))
    placed = placed.withColumn("queue_tokens", F.coalesce("large_tokens", F.lit(rest))).withColumn("until", F.coalesce("large_until", F.lit(rest)))
    placed = placed.withColumn("mark", marks).withColumn("shard", F.conv(F.substring("mark", 1, 8), 16, 10).cast("long") % shards)
    narrow = placed.select("queue", "queue_tokens", "until", "shard", "mark", "part", "row", "tokens")
    cells = narrow.groupBy("queue", "shard").agg(F.sum("tokens").alias("cell"))
    at = F.coalesce(F.sum("cell").over(Window.partitionBy("queue").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = cells.select("queue", "shard", at.alias("cell_at"))
    within = F.sum("tokens").over(Window.partitionBy("queue", "shard").orderBy("mark", "row").rowsBetween(Window.unboundedPreceding, -1))
    placed = narrow.withColumn("within", F.coalesce(within, F.lit(0))).join(cells, ["queue", "shard"])
    placed = placed.withColumn("a", F.col("cell_at") + F.col("within"))

    def read(r: Column) -> Column:
        """How far the queue is read when run ``r`` begins. All queues together: ``r * span``."""

        def upto(tokens: Column) -> Column:
            exact = F.floor(tokens.cast("double") * (r * span).cast("double") / F.lit(float(all_tokens)))
            return F.when(tokens == all_tokens, r * span).otherwise(exact)

        share = upto(F.col("until")) - upto(F.col("until") - F.col("queue_tokens"))
        return F.when(r >= runs, F.col("queue_tokens")).otherwise(share)

    rate = F.lit(float(all_tokens) / span) / F.col("queue_tokens")
    first = F.greatest(F.lit(0).cast("long"), F.floor(F.col("a") * rate) - 2)
    last = F.least(F.lit(runs - 1).cast("long"), F.floor((F.col("a") + F.col("tokens")) * rate) + 2)
    cuts = F.transform(
        F.sequence(F.least(first, last), last),
        lambda r: F.struct(
            r.alias("run"),
            F.greatest(F.col("a"), read(r)).alias("lo"),
            F.least(F.col("a") + F.col("tokens"), read(r + 1)).alias("hi"),
        ),
    )
    cut = placed.withColumn("cut", F.explode(F.filter(cuts, lambda x: x["lo"] < x["hi"])))
    begin = F.col("cut.lo") - F.col("a")
    cut = cut.select(F.col("part").alias("of_part"), F.col("row").alias("of_row"), "queue", F.col("cut.run").alias("run"), F.col("cut.lo").alias("lo"), begin.alias("start"), (F.col("cut.hi") - F.col("cut.lo")).alias("n"))

    def sliced(key, texts, cuts):
        """Of each cut of a part its ids, and what the piece needs of its document."""
        lean()
        order = np.argsort(texts.column("row").to_numpy())
        at = order[np.searchsorted(texts.column("row").to_numpy()[order], cuts.column("of_row").to_numpy())]
        data, lengths = texts.column("ids").to_pylist(), texts.column("tokens").to_numpy()
        ids = []
        for i, start, n in zip(at.tolist(), cuts.column("start").to_pylist(), cuts.column("n").to_pylist(), strict=True):
            size = len(data[i]) // int(lengths[i])
            ids.append(data[i][start * size : (start + n) * size])
        of = texts.select(["doc_id", "source", "tokens"]).take(pa.array(at))
        arrays = {k: cuts.column(k) for k in ("run", "queue", "lo", "start")}
        return pa.table(arrays | {k: of.column(k) for k in of.column_names} | {"ids": pa.array(ids, pa.binary())})

    shape = f"run long, queue int, lo long, start long, doc_id {kind}, source string, tokens long, ids binary"
    pieces = rows.groupBy("part").cogroup(cut.groupBy("of_part")).applyInArrow(sliced, shape)

    shares = [n / all_tokens for n in sizes]
    schema = PIECE.format(kind)

    def deal(key, table):
        lean()
        table = table.sort_by([("queue", "ascending"), ("lo", "ascending")])
        number = key[0].as_py()
        dtype = word_encoder(tokenizer).dtype
        data = table.column("ids").to_pylist()
        lengths = np.array([len(x) // dtype.itemsize for x in data], np.int64)
        queue = table.column("queue").to_numpy()
        left = np.bincount(queue, weights=lengths, minlength=len(shares)).astype(np.int64).tolist()
        lo = table.column("lo").to_numpy()
        opened = {q: int(x) for q, x in zip(queue[::-1].tolist(), lo[::-1].tolist(), strict=True)}
        owed = [share * number * span - opened.get(q, 0) if q in opened else 0.0 for q, share in enumerate(shares)]
        packed = served(owed, shares, left, length, least)
        packed[-1:] = split_last(packed[-1], length)
        following = np.searchsorted(queue, np.arange(len(shares))).tolist()  # the next row of each queue
        used = [0] * len(data)
        out: dict[str, list] = {"take": [], "start": [], "length": [], "ids_crc32": [], "sequence_id": [], "offset": []}
        start = table.column("start").to_pylist()
        for s, parts in enumerate(packed):
            offset = 0
            for q, n in parts:
                while n:
                    i = following[q]
                    some = min(n, int(lengths[i]) - used[i])
                    ids = np.frombuffer(data[i], dtype, some, used[i] * dtype.itemsize)
                    out["take"].append(i)
                    out["start"].append(start[i] + used[i])
                    out["length"].append(some)
                    out["ids_crc32"].append(zlib.crc32(ids.astype("<u4").tobytes()))
                    out["sequence_id"].append(number * 2 * run_sequences + s)
                    out["offset"].append(offset)
                    used[i] += some
                    offset += some
                    n -= some
                    if used[i] == lengths[i]:
                        following[q] += 1
        rows = table.select(["doc_id", "tokens", "source"]).take(pa.array(out["take"], pa.int64()))
        arrays = {"doc_id": rows.column("doc_id"), **{k: pa.array(out[k], pa.int64()) for k in ("start", "length", "ids_crc32")}}
        arrays |= {"doc_tokens": rows.column("tokens"), **{k: pa.array(out[k], pa.int64()) for k in ("sequence_id", "offset")}, "source": rows.column("source")}
        return pa.table(arrays)

    return pieces.groupBy("run").applyInArrow(deal, schema)

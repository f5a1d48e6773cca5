"""A byte-level convolutional network for document quality, in numpy.

Bytes are embedded; filters of ``WIDTH`` bytes are moved over them ``STEP`` bytes at a time, within
overlapping chunks that cover the whole document. The largest response of each filter in a chunk gives
the chunk's score; a logistic curve through the mean, the least and the largest of a document's chunk
scores gives its probability.

At scale: the weights are learned on the driver from a bounded sample (``sample_docs`` labelled documents,
``SAMPLE_CHUNKS`` chunks from all over each) and sent with the scoring function, some 20 KB. Scoring is
one pass without a shuffle, and memory holds ``TOGETHER`` chunks beside the text, however long it is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.llm.quality import texts_of

CHUNK, OVERLAP = 512, 64
DEPTH, FILTERS, STEP, WIDTH = 8, 32, 4, 12
TAPS = WIDTH // STEP
#: Stands for a place after the end of a text.
NOTHING = 256
TOGETHER = 512
SAMPLE_CHUNKS = 8


@dataclass
class Network:
    bytes_: np.ndarray  # (257, DEPTH)
    filters: np.ndarray  # (WIDTH * DEPTH, FILTERS)
    bias: np.ndarray
    out: np.ndarray
    shift: float
    curve: np.ndarray | None = None


def chunk_starts(size: int) -> np.ndarray:
    """Where chunks begin, so that all bytes are in one and neighbours overlap."""
    return np.arange(0, max(1, size - OVERLAP), CHUNK - OVERLAP)


def chunked(text: bytes, starts: np.ndarray) -> np.ndarray:
    data = np.full(int(starts[-1]) + CHUNK, NOTHING, np.int16)
    data[: len(text)] = np.frombuffer(text, np.uint8)[: len(data)]
    return data[starts[:, None] + np.arange(CHUNK)]


def responses(net: Network, chunks: np.ndarray) -> np.ndarray:
    """(chunks, places, filters)"""
    n, places = len(chunks), CHUNK // STEP
    taps = np.concatenate(np.split(net.filters, TAPS), axis=1)  # a step's bytes against each part of the filters
    parts = net.bytes_[chunks].reshape(n * places, STEP * DEPTH) @ taps
    parts = parts.reshape(n, places, TAPS, FILTERS)
    full = places - TAPS + 1
    return sum(parts[:, t : t + full, t] for t in range(TAPS)) + net.bias


def chunk_scores(net: Network, chunks: np.ndarray) -> np.ndarray:
    best = np.maximum(responses(net, chunks).max(axis=1), 0)
    return best @ net.out + net.shift


def train(chunks: list[np.ndarray], labels: np.ndarray, epochs: int = 10, batch: int = 128, rate: float = 0.004, seed: int = 7) -> Network:
    """Learn from the chunks of each document, all of which carry its label, by Adam on the log loss."""
    rng = np.random.default_rng(seed)
    share = float(np.clip(labels.mean(), 0.01, 0.99))
    net = Network(
        rng.normal(0, 0.5, (257, DEPTH)).astype(np.float32),
        rng.normal(0, (WIDTH * DEPTH) ** -0.5, (WIDTH * DEPTH, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32), rng.normal(0, 0.1, FILTERS).astype(np.float32), np.log(share / (1 - share)),
    )
    names = ("bytes_", "filters", "bias", "out", "shift")
    mean = {k: np.zeros_like(np.asarray(getattr(net, k), np.float32)) for k in names}
    square = {k: v.copy() for k, v in mean.items()}
    step = 0
    reach = np.arange(WIDTH)
    for _ in range(epochs):
        some = rng.permutation(len(chunks))
        picked = np.array([int(rng.integers(len(c))) for c in chunks])
        for i in range(0, len(some), batch):
            ids = some[i : i + batch]
            x, y = np.stack([chunks[j][picked[j]] for j in ids]), labels[ids]
            full = responses(net, x)
            at = full.argmax(axis=1)  # (chunks, filters)
            best = np.take_along_axis(full, at[:, None], axis=1)[:, 0]
            high = np.maximum(best, 0)
            error = ((1 / (1 + np.exp(-(high @ net.out + net.shift))) - y) / len(y)).astype(np.float32)
            back = error[:, None] * net.out * (best > 0)
            seen = x[np.arange(len(x))[:, None, None], at[:, :, None] * STEP + reach]  # (chunks, filters, WIDTH)
            patch = net.bytes_[seen].reshape(len(x), FILTERS, WIDTH * DEPTH)
            into = (back[:, :, None] * net.filters.T).reshape(-1, DEPTH)
            slope = {
                "bytes_": np.stack([np.bincount(seen.ravel(), into[:, d], 257) for d in range(DEPTH)], axis=1),
                "filters": np.einsum("nf,nfw->wf", back, patch),
                "bias": back.sum(axis=0), "out": high.T @ error, "shift": error.sum(),
            }
            step += 1
            for k in names:
                mean[k] = 0.9 * mean[k] + 0.1 * slope[k]
                square[k] = 0.999 * square[k] + 0.001 * slope[k] ** 2
                move = rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
                setattr(net, k, float(net.shift - move) if k == "shift" else (getattr(net, k) - move).astype(np.float32))
    net.curve = calibrated(np.array([pooled(chunk_scores(net, c)) for c in chunks]), labels)
    return net


def pooled(each: np.ndarray) -> tuple[float, float, float, float]:
    return float(each.mean()), float(each.min()), float(each.max()), 1.0


def calibrated(x: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The logistic curve through the documents' pooled scores, by Newton steps from the mean alone."""
    y = labels * (1 - 2 / (len(labels) + 2)) + 1 / (len(labels) + 2)
    start = np.array([1.0, 0.0, 0.0, 0.0])
    w = start.copy()
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(4), x.T @ (p - y) + (w - start))
    return w


def score(net: Network, text: bytes) -> float:
    """The probability of label 1 for a whole text."""
    starts = chunk_starts(len(text))
    each = []
    for i in range(0, len(starts), TOGETHER):
        some = starts[i : i + TOGETHER]
        each.append(chunk_scores(net, chunked(text[int(some[0]) : int(some[-1]) + CHUNK], some - some[0])))
    return _probability(net, np.concatenate(each))


def scores(net: Network, texts: list[bytes]) -> list[float]:
    """``score`` of each text, with the chunks of short ones taken together."""
    found: list[float] = []
    held, spans, size = [], [], 0

    def settle() -> None:
        nonlocal held, spans, size
        if held:
            each = chunk_scores(net, np.concatenate(held))
            found.extend(_probability(net, part) for part in np.split(each, np.cumsum(spans)[:-1]))
        held, spans, size = [], [], 0

    for text in texts:
        starts = chunk_starts(len(text))
        if size + len(starts) > TOGETHER:
            settle()
        if len(starts) > TOGETHER:
            found.append(score(net, text))
            continue
        held.append(chunked(text, starts))
        spans.append(len(starts))
        size += len(starts)
    settle()
    return found


def _probability(net: Network, each: np.ndarray) -> float:
    return float(1 / (1 + np.exp(-np.clip(np.dot(net.curve, pooled(each)), -30, 30))))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def learned(docs: DataFrame, labels: DataFrame, sample_docs: int = 4096) -> Network | None:
    """A network from at most ``sample_docs`` labelled documents outside the held-out fold, or None if both labels aren't there.

    The sample is the first in the order of a hash of ``doc_id``. Null labels and identifiers are left
    out; of several labels of a document the smallest counts.
    """
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    one = usable.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    mark = F.md5(F.col("doc_id").cast("string"))
    sample = one.withColumn("mark", mark).orderBy("mark", "doc_id").limit(sample_docs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = []
            for text, mark in zip(texts_of(batch, "text"), batch.column(2).to_pylist(), strict=True):
                starts = chunk_starts(len(text))
                rng = np.random.default_rng(zlib.crc32(mark.encode()))
                some = np.sort(rng.choice(starts, min(SAMPLE_CHUNKS, len(starts)), replace=False))
                pieces.append(b"".join(chunked(text[s : s + CHUNK], np.zeros(1, int)).astype("<i2").tobytes() for s in some.tolist()))
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(1), pa.array(pieces, pa.binary())], names=["mark", "quality", "chunks"])

    texts = docs.select(F.col("doc_id").alias("of"), F.col("text")).join(F.broadcast(sample), F.col("of") == F.col("doc_id"))
    rows = texts.select("text", "quality", "mark").mapInArrow(cut, "mark string, quality int, chunks binary").orderBy("mark", "chunks").limit(sample_docs).collect()
    truth = np.array([r["quality"] for r in rows], np.float32)
    if len(set(truth.tolist())) < 2:
        return None
    return train([np.frombuffer(r["chunks"], "<i2").reshape(-1, CHUNK) for r in rows], truth)


def classify(docs: DataFrame, labels: DataFrame, *, sample_docs: int = 4096, least: float = 0.3) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 from ``least`` up) of each row of ``docs``.

    Null or empty text is scored as one chunk of nothing. Without rows of both labels every score is 0.5.
    Repeated rows get a row each. Other columns are ignored. No rows give none.
    """
    net = learned(docs, labels, sample_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scores(net, texts_of(batch, "text")) if net else [0.5] * len(batch)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))

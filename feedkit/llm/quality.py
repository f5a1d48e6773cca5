"""Quality rules, with a suffix array over the words of each text for its repetition.

Adjacent entries of the suffix array share the longest prefix that any other place in the text shares
with them; those lengths (LCP) give every maximal repeated run of words. The union of the runs of
``min_words`` or more, as a part of all words, and the longest run are limited.

At scale: one pass, no shuffle. Many texts are handled at once in numpy, about ``CHUNK_BYTES`` of them;
a longer text is handled whole, alone. A worker holds a batch as Arrow has it and one such part in Python.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


#: Arrays take some 30 times that; a worker keeps what its largest ones took.
CHUNK_BYTES = 1 << 20
SYMBOLS = b"#*$%&|<>"
SPACE = b"\x09\x0a\x0b\x0c\x0d\x20"
#: Bytes that start no character of a word: white space, and all but the first byte of a character.
NOT_COUNTED = SPACE + bytes(range(0x80, 0xC0))
METRICS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, covered_words long, longest_repeat long, base_failed boolean, kept boolean"


def chunks(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Runs of texts of about ``CHUNK_BYTES``; a text is never cut."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > CHUNK_BYTES:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def repeats(words: np.ndarray, doc: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each word, how many words from there on occur once more in its document.

    ``words`` are the ids, from 1, of all documents' words in a row, ``doc`` and ``end`` each word's
    document and where that ends. Prefix doubling: places that agree in 2^t words are sorted by what
    follows; places that agree with none are done. A level's ranks give the shared lengths afterwards.
    """
    n = len(words)
    place = np.arange(n)
    longest = np.zeros(n, np.int64)
    if n < 2:
        return longest
    base = int(words.max()) + 1
    after = np.where(place + 1 < end, np.append(words[1:], 0), 0)
    levels = [words.astype(np.int32)]
    rank, live = _ranked((doc * base + words) * base + after, place, np.zeros(n, np.int64), np.empty(n, np.int64))
    reach = 2
    while len(live):
        levels.append(rank.astype(np.int32))
        follow = live + reach
        inside = follow < end[live]
        behind = np.where(inside, rank[np.minimum(follow, n - 1)] + 1, 0)
        rank = rank.copy()
        rank, live = _ranked(rank[live] * (n + 1) + behind, live, rank[live], rank)
        reach *= 2
    array = np.empty(n, np.int64)
    array[rank] = place
    one, two = array[:-1], array[1:]
    same = doc[one] == doc[two]
    one, two = one[same], two[same]
    shared = np.zeros(len(one), np.int64)
    for t in range(len(levels) - 1, -1, -1):
        a, b = one + shared, two + shared
        near = np.flatnonzero((a < end[one]) & (b < end[two]))
        near = near[levels[t][a[near]] == levels[t][b[near]]]
        shared[near] += 1 << t
    np.maximum.at(longest, one, shared)
    np.maximum.at(longest, two, shared)
    return longest


def _ranked(key: np.ndarray, live: np.ndarray, base: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank ``live`` places by ``key``, which refines their ``base`` rank; equal keys share a rank.

    A rank is the number of places sorted before the first of its group. Returns the ranks of all
    places and those that still share one, in order of rank.
    """
    order = np.argsort(key, kind="stable")
    key, base, live = key[order], base[order], live[order]
    index = np.arange(len(key))
    new = np.append(True, key[1:] != key[:-1])
    first = np.maximum.accumulate(np.where(new, index, 0))
    group = np.maximum.accumulate(np.where(np.append(True, base[1:] != base[:-1]), index, 0))
    rank[live] = base + first - group
    alone = new & np.append(new[1:], True)
    return rank, live[~alone]


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places lie in the union of the spans."""
    edge = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def measured(texts: list[bytes], min_words: int, max_covered: float, max_repeat: int) -> dict[str, list]:
    ids = defaultdict(count(1).__next__)
    split = [text.split() for text in texts]
    n_words = np.array([len(w) for w in split], np.int64)
    stop = np.cumsum(n_words)
    total = int(stop[-1])
    words = np.fromiter((ids[w] for text in split for w in text), np.int64, total)
    doc = np.repeat(np.arange(len(texts)), n_words)
    longest = repeats(words, doc, stop[doc])

    def in_each(values: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=values, minlength=len(texts)).astype(np.int64)

    thrice = np.flatnonzero(longest >= 3)
    n_repeat = in_each(covered(thrice, np.full(len(thrice), 3), total))
    runs = np.flatnonzero(longest >= min_words)
    n_covered = in_each(covered(runs, longest[runs], total))
    most = np.zeros(len(texts), np.int64)
    np.maximum.at(most, doc, longest)
    failed = (n_words < 50) | (100 * n_repeat > 50 * n_words)
    kept = ~failed & (n_covered <= max_covered * n_words) & (most <= max_repeat)
    return {
        "n_words": n_words.tolist(),
        "word_chars": [len(t.translate(None, NOT_COUNTED)) for t in texts],
        "n_symbols": [len(t) - len(t.translate(None, SYMBOLS)) for t in texts],
        "n_dup_lines": [_dup_lines(t) for t in texts],
        "n_repeat_words": n_repeat.tolist(),
        "covered_words": n_covered.tolist(),
        "longest_repeat": most.tolist(),
        "base_failed": failed.tolist(),
        "kept": kept.tolist(),
    }


def _dup_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The texts of a batch in UTF-8, null as empty."""
    return [t or b"" for t in batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()]


def lean() -> None:
    """From now on this worker's Arrow buffers are the system's, which has them back when a batch is gone; Arrow's own pool keeps them."""
    pa.set_memory_pool(pa.system_memory_pool())


def parts_of(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Runs of a batch's rows with about ``CHUNK_BYTES`` of text, and their texts as ``texts_of`` gives them.

    A text is never cut. Texts become Python objects part by part, never a whole batch of them.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(batch):
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, side="right")))
        part = batch.slice(at, stop - at)
        yield part, texts_of(part, column)
        at = stop


#: Of ``measured``: shortest run that counts as repeated, largest part of the words in such runs, longest run.
RULES = (10, 0.3, 100)


def quality(docs: DataFrame, rules: tuple = RULES) -> DataFrame:
    """``doc_id`` and the measures of each row's ``text``, with ``base_failed`` and ``kept``.

    Null or empty text: no words, all counts 0, failed. Repeated rows are measured each. Other columns
    are ignored. No rows give none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in batches:
            for part, texts in parts_of(batch, "text"):
                found = measured(texts, *rules)
                columns = [part.column(0), *(pa.array(v, pa.bool_() if k in ("base_failed", "kept") else pa.int64()) for k, v in found.items())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *found])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {METRICS}")


def good(docs: DataFrame, rules: tuple = RULES) -> DataFrame:
    """The rows of ``docs`` whose text the rules keep, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in batches:
            for part, texts in parts_of(batch, "text"):
                yield part.filter(pa.array(measured(texts, *rules)["kept"], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

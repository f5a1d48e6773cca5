"""Spelling variants of words: pairs at one edit by composing automata, and the form that each word varies.

Two words are near if one inserted, deleted or replaced code point makes them equal. The edit lies in one half of the
shorter word, so the other half is shared, from the start or from the end. Words are partitioned by that half: the
initial state that an automaton of the whole vocabulary is in after it (or, read backwards, before it). In each
partition the rest of the words makes a minimised acceptor; the composition of acceptor, one-edit transducer and
acceptor is walked, and every accepted pair comes out once, at its first difference.

At scale: occurrences are counted map-side first, and only distinct words go on, four rows each. A partition of more
than ``LARGE`` words is split by halves of what is left to compare, as often as needed, until the words differ in one
place only, where the alphabet bounds them. So no task holds more than a partition of bounded size, nothing is
dropped and no two words meet unless they share half of their letters.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.llm.common import LOWER, UPPER, stored

#: A run of letters (fixed value), to be followed by how long it is at least.
LETTERS = "[A-Za-zÀ-ÿ]"
#: Words that one partition compares at most, if they still differ in more than one place.
LARGE = 20_000
PARTITION = ["m", "lo", "hi", "below", "head", "tail"]
NEAR = "word string, n_near long, best_n long, best string"
ANY = 1 << 30


def runs(docs: DataFrame, least: int) -> DataFrame:
    """``doc_id`` and ``run`` for each run of ``least`` or more letters in the whole text, A-Z lower-cased.

    A null or empty text has none; one of any length is read whole. Runs of a repeated row come again, and a null ``doc_id``
    stays null; other columns go. No rows give none.
    """
    found = F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{least},}}+"), F.lit(0))
    return docs.select("doc_id", F.explode(found).alias("run")).select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))


def counted(words: DataFrame, least: int, seen: int) -> DataFrame:
    """``word`` and ``n``: words of at least ``least`` code points that occur ``seen`` times or more. Null words count for none."""
    return words.where(F.char_length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= seen)


def variants(vocabulary: DataFrame, least: int, times: int = 10) -> DataFrame:
    """For each distinct ``word`` with its ``n``: ``form``, ``root``, ``n``, ``n_near`` and ``form_n``.

    ``form`` is the near word of largest ``n`` (ties: the first in code-point order) if that is ``times`` the word's own or
    more, else null. ``root`` follows forms to the last; it is the word itself where there is none. Words shorter than
    ``least``, of which half must hold a letter (2 or more), and null ones are left out. A word of any length
    is compared whole. No words give no rows; other columns go.
    """
    if least < 2 or times < 2:
        raise ValueError("words have two code points at least, and a form occurs twice as often at least")
    words = stored(vocabulary.select("word", F.col("n").cast("long").alias("n")).where(F.char_length("word") >= least), "words")
    found = None
    for part in partitions(words, least):
        rows = part.withColumn("window", F.expr("substring(word, lo + 1, char_length(word) - lo - hi)"))
        dealt = rows.repartition(*PARTITION).sortWithinPartitions(*PARTITION, "window")
        near = dealt.select("m", "lo", "hi", "below", "head", "tail", "window", "n").mapInArrow(_near, NEAR)
        found = near if found is None else found.unionByName(near)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("best")
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    varies = -F.col("best.n") >= times * F.col("n")
    formed = words.join(summed, "word", "left").select(
        "word",
        F.when(varies, F.col("best.word")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(varies, -F.col("best.n")).alias("form_n"),
    )
    formed = stored(formed, "forms")
    rooted = formed.join(roots(formed.where("form IS NOT NULL").select("word", "form")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, where following ``form`` from word to word ends. Each pass doubles the steps taken.

    A form occurs at least twice as often as its variant, so there is no circle, and no more steps than a count has bits.
    """
    reached = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("later"))
        if reached.join(further, "root", "left_semi").isEmpty():
            return reached
        reached = stored(reached.join(further, "root", "left").select("word", F.coalesce("later", "root").alias("root")), "roots")


# ---------------------------------------------------------------- partitions


def partitions(words: DataFrame, least: int) -> Iterator[DataFrame]:
    """Rows of words in partitions that hold every near pair once, in one frame or, if some are large, several.

    A partition compares a word of ``m`` code points with others of ``m`` or one more that share their first ``lo`` and last
    ``hi``, and takes pairs whose first difference comes before ``below``: the others are found elsewhere.
    """
    length = F.char_length("word")
    rows = words.withColumn("m", F.explode(F.array(length, length - 1))).where(F.col("m") >= least)
    rows = _halved(rows.withColumns({"lo": F.lit(0), "hi": F.lit(0), "below": F.lit(ANY)}))
    while True:
        sizes = rows.where("m - lo - hi > 1").groupBy(*PARTITION).agg(F.count("*").alias("size")).where(F.col("size") > LARGE)
        large = stored(sizes.select(*PARTITION), "large")
        if large.isEmpty():
            yield rows
            return
        yield rows.join(large, PARTITION, "left_anti")
        rows = stored(_halved(rows.join(large, PARTITION, "left_semi")), "halved")


def _halved(rows: DataFrame) -> DataFrame:
    """Each row twice: with the first half of what is compared as shared, and with the second."""
    half = F.floor((F.col("m") - F.col("lo") - F.col("hi")) / 2).cast("int")
    left = F.col("m") - F.col("lo") - F.col("hi") - half
    first = F.struct((F.col("lo") + half).alias("lo"), F.col("hi"), F.col("below"))
    second = F.struct(F.col("lo"), (F.col("hi") + left).alias("hi"), F.least("below", F.col("lo") + half).alias("below"))
    split = rows.select("word", "n", "m", F.explode(F.array(first, second)).alias("half")).select("word", "n", "m", "half.*")
    return split.withColumns({"head": F.expr("substring(word, 1, lo)"), "tail": _last("hi")})


def _last(n: str) -> Column:
    return F.expr(f"substring(word, char_length(word) - {n} + 1, {n})")


# ---------------------------------------------------------------- automata


class Acceptor:
    """The minimised automaton of sorted distinct strings. States that accept the same are one."""

    def __init__(self, strings: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        known: dict[tuple, int] = {}

        def settled(arcs: dict[str, int], final: bool) -> int:
            key = (final, *arcs.items())
            if key not in known:
                known[key] = len(self.arcs)
                self.arcs.append(arcs)
                self.final.append(final)
            return known[key]

        path: list[tuple[dict[str, int], bool]] = [({}, False)]  # what the last string passed, not yet shared
        last = ""

        def settle(depth: int) -> None:
            while len(path) > depth + 1:
                state = settled(*path.pop())
                path[-1][0][last[len(path) - 1]] = state

        for string in strings:
            common = 0
            while common < min(len(last), len(string)) and last[common] == string[common]:
                common += 1
            settle(common)
            path += [({}, False) for _ in string[common:]]
            path[-1] = (path[-1][0], True)
            last = string
        settle(0)
        self.start = settled(*path.pop())

    def shared(self, p: int, q: int, length: int) -> Iterator[str]:
        """Strings of ``length`` that are accepted from both states."""
        arcs, final, open_ = self.arcs, self.final, [(p, q, "")]
        while open_:
            p, q, string = open_.pop()
            if len(string) == length:
                if final[p] and final[q]:
                    yield string
                continue
            after = arcs[q]
            for sign, state in arcs[p].items():
                if sign in after:
                    open_.append((state, after[sign], string + sign))

    def one_edit(self, state: int, length: int) -> list[tuple[str, str]]:
        """Pairs accepted from ``state`` that differ in their first sign, by one edit: of ``length`` and of that or one more."""
        pairs, arcs = [], list(self.arcs[state].items())
        if length:
            for i, (a, p) in enumerate(arcs):
                for b, q in arcs[i + 1 :]:
                    pairs += [(a + rest, b + rest) for rest in self.shared(p, q, length - 1)]
        for b, q in arcs:
            pairs += [(rest, b + rest) for rest in self.shared(state, q, length) if rest[:1] != b]
        return pairs

    def pairs(self, length: int, below: int) -> Iterator[tuple[str, str]]:
        """Accepted strings of ``length`` with those at one edit, of ``length`` or one more, that share less than ``below`` first signs."""
        known: dict[tuple[int, int], list[tuple[str, str]]] = {}
        open_ = [(self.start, "")]
        while open_:
            state, start = open_.pop()
            left = length - len(start)
            if left < 0 or len(start) >= below:
                continue
            if (state, left) not in known:
                known[state, left] = self.one_edit(state, left)
            for a, b in known[state, left]:
                yield start + a, start + b
            open_ += [(after, start + sign) for sign, after in self.arcs[state].items()]


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word of a partition that has near words there: how many, and the best of them. Partitions come one after the other."""
    key, windows, out = None, {}, ([], [], [], [])

    def flushed() -> pa.RecordBatch:
        nonlocal out
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["word", "n_near", "best_n", "best"])
        out = ([], [], [], [])
        return batch

    def compare() -> None:
        m, lo, hi, below, head, tail = key
        best: dict[str, list] = {}  # of a window: near words, and the best's count and window
        for pair in Acceptor(list(windows)).pairs(m - lo - hi, below - lo):
            for one, other in (pair, pair[::-1]):
                n, seen = windows[other], best.setdefault(one, [0, 0, ""])
                seen[0] += 1
                if n > seen[1] or (n == seen[1] and head + other + tail < head + seen[2] + tail):
                    seen[1:] = n, other
        for window, (count, n, other) in best.items():
            for column, value in zip(out, (head + window + tail, count, n, head + other + tail), strict=True):
                column.append(value)

    for batch in batches:
        columns = [column.to_pylist() for column in batch.columns]
        for *group, window, n in zip(*columns, strict=True):
            if group != key:
                if len(windows) > 1:
                    compare()
                    if len(out[0]) > 10_000:
                        yield flushed()
                key, windows = group, {}
            windows[window] = n
    if len(windows) > 1:
        compare()
    yield flushed()

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedkit.llm import spelling
from feedkit.llm.queries import QUERIES


def neighbours(word, words):
    """Words at one edit, by trying all edits at all places."""
    signs = {s for w in words for s in w}
    edits = {word[:i] + word[i + 1 :] for i in range(len(word))}
    edits |= {word[:i] + s + word[i + k :] for i in range(len(word) + 1) for s in signs for k in (0, 1)}
    return (edits - {word}) & words.keys()


def expected(words, times=10):
    forms, out = {}, {}
    near = {w: neighbours(w, words) for w in words}
    for word, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        forms[word] = best if best is not None and words[best] >= times * words[word] else None
    for word in words:
        root = word
        while forms[root]:
            root = forms[root]
        out[word] = (forms[word], root, words[word], len(near[word]), words[forms[word]] if forms[word] else None)
    return out


def got(spark, words, least, times=10):
    rows = spark.createDataFrame(list(words.items()), "word string, n long")
    found = spelling.variants(rows, least, times).collect()
    assert len(found) == len({r["word"] for r in found})
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in found}


@pytest.mark.parametrize("signs, least, large", [("ab", 2, 20_000), ("ab", 2, 4), ("abé", 4, 20_000), ("abcé", 3, 3), ("xyz", 5, 10)])
def test_against_all_edits(spark, monkeypatch, signs, least, large):
    monkeypatch.setattr(spelling, "LARGE", large)
    deal = random.Random(f"{signs}{least}")
    words = {}
    for _ in range(250):
        word = "".join(deal.choices(signs, k=deal.randrange(least, least + 5)))
        words[word] = 10 ** deal.randrange(4) * deal.randrange(2, 5)
    assert got(spark, words, least) == expected(words)


def test_chains_ties_and_long_words(spark):
    long = "abcdefghij" * 3000
    words = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaabbbb": 20_000, "zzzzzzz": 2, "zzzzzzy": 20, "zzzzzzx": 20}
    words |= {long: 2, long + "x": 30, "x" + long: 30, long[:15_000] + "y" + long[15_001:]: 3}
    rows = got(spark, words, 7)
    assert rows["aaaaaaa"] == ("aaaaaab", "aaabbbb", 2, 1, 20)
    assert rows["zzzzzzz"] == ("zzzzzzx", "zzzzzzx", 2, 2, 20)
    assert rows[long] == (long + "x", long + "x", 2, 3, 30)
    assert rows["x" + long][:4] == (None, "x" + long, 30, 1)


def test_no_words_null_words_other_columns(spark, clashing):
    rows = clashing(spark.createDataFrame([(None, 5), ("short", 5), ("lengthy", 3), ("lengthi", 30)], "word string, n long").withColumn("x", F.lit(1)))
    assert sorted(map(tuple, spelling.variants(rows.withColumn("n", F.lit(3)), 7).collect())) == [("lengthi", None, "lengthi", 3, 1, None), ("lengthy", None, "lengthy", 3, 1, None)]
    assert spelling.variants(rows.limit(0).select("word", F.lit(1).alias("n")), 7).count() == 0
    with pytest.raises(ValueError, match="two code points"):
        spelling.variants(rows, 1)


def test_acceptor_is_minimal():
    made = spelling.Acceptor(sorted(["tap", "taps", "top", "tops"]))
    assert len(made.arcs) == 5
    assert sorted(made.pairs(3, 9)) == [("tap", "taps"), ("tap", "top"), ("top", "tops")]


def test_runs(edges, empty, docs):
    rows = spelling.runs(edges, 3).collect()
    assert {r["run"] for r in rows if r["doc_id"] == 8} == {"one", "two"}
    assert sum(r["doc_id"] == 6 for r in rows) == 80_000
    assert spelling.runs(empty, 3).count() == 0
    assert [r["run"] for r in spelling.runs(docs(["ÀBC×÷ ab_cdef1GHIJ œabc"]), 3).collect()] == ["Àbc×÷", "cdef", "ghij", "abc"]


def test_query_against_all_edits(spark):
    folder = "/root/testdata/sf0.001"
    counts = Counter()
    for row in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", row["text"] or ""):
            run = "".join(s.lower() if s.isascii() else s for s in run)
            mark = zlib.crc32(f"{row['doc_id']}:{run}".encode())
            if mark % 31 == 0:
                run = run[: mark % len(run)] + run[mark % len(run) + 1 :]
            counts[run] += 1
    want = expected({w: n for w, n in counts.items() if len(w) >= 7 and n >= 2})
    rows = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in QUERIES["op13_spelling_variants"](spark, folder).collect()}
    assert rows == want
    assert any(form for form, *_ in want.values())

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from feedkit.llm.near import featured
from feedkit.llm.packing import encoded
from feedkit.llm.quality import chunks, good, measured, parts_of, quality, repeats, texts_of


def longest_repeat(words, i):
    best = 0
    for j in range(len(words)):
        if i != j:
            n = 0
            while max(i, j) + n < len(words) and words[i + n] == words[j + n]:
                n += 1
            best = max(best, n)
    return best


def test_shared_lengths_against_brute_force():
    rng = random.Random(4)
    for _ in range(150):
        docs = [[rng.randint(1, 3) for _ in range(rng.randint(0, 30))] for _ in range(rng.randint(1, 4))]
        words = np.array([w for d in docs for w in d], np.int64)
        doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        end = np.cumsum([len(d) for d in docs])[doc] if len(doc) else doc
        assert repeats(words, doc, end).tolist() == [longest_repeat(d, i) for d in docs for i in range(len(d))]


def brute(text, min_words, max_covered, max_repeat):
    words = [w for w in text.encode().split()]
    lengths = [longest_repeat(words, i) for i in range(len(words))]
    cover = lambda n: sum(any(j <= i < j + (lengths[j] if n != 3 else 3) for j in range(len(words)) if lengths[j] >= n) for i in range(len(words)))
    lines = [x for x in text.split("\n") if x.encode().split()]
    failed = len(words) < 50 or 100 * cover(3) > 50 * len(words)
    covered, most = cover(min_words), max(lengths, default=0)
    kept = not failed and covered <= max_covered * len(words) and most <= max_repeat
    chars = sum(len(w.decode()) for w in words)
    return [len(words), chars, sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), cover(3), covered, most, failed, kept]


def test_measures_against_brute_force():
    rng = random.Random(5)
    texts = ["", " \n\n ", "a", "é# é# é#\né# é# é#\n\n\n"]
    for _ in range(60):
        vocabulary = rng.choice(["a b", "a b c d é \U0001f600 x*", " ".join(f"w{i}" for i in range(200))]).split()
        texts.append("".join(rng.choice(vocabulary) + rng.choice([" ", " ", "\n", "\t\r "]) for _ in range(rng.randint(0, 120))))
    got = measured([t.encode() for t in texts], 6, 0.3, 10)
    assert [list(r) for r in zip(*got.values(), strict=True)] == [brute(t, 6, 0.3, 10) for t in texts]


def test_clean_text_is_kept_and_repeated_text_goes(docs):
    clean = " ".join(f"w{i * i % 701}" for i in range(400))
    copied = clean + " " + clean
    rows = {r["doc_id"]: r for r in quality(docs([clean, copied, "short", "same " * 100])).collect()}
    assert [rows[i]["kept"] for i in range(4)] == [True, False, False, False]
    assert rows[1]["longest_repeat"] >= 400 and rows[3]["base_failed"]
    assert [r["doc_id"] for r in good(docs([clean, copied, "short"])).collect()] == [0]


def test_chunks_never_cut_or_drop():
    texts = [b"a" * n for n in (0, 5 << 20, 1, 3 << 20, 2 << 20, 0)]
    assert [t for some in chunks(texts) for t in some] == texts


def test_parts_never_cut_or_drop():
    texts = [None, "a" * (3 << 20), "", "b", None, "é" * (1 << 19), "c" * (1 << 20), ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], names=["doc_id", "text"])
    parts = list(parts_of(batch, "text"))
    assert pa.Table.from_batches([p for p, _ in parts]) == pa.Table.from_batches([batch])
    assert [t for _, some in parts for t in some] == texts_of(batch, "text") and len(parts) > 3
    assert list(parts_of(batch.slice(0, 0), "text")) == []


@pytest.fixture
def own_pool():
    """What the functions of a worker set stays in the test."""
    before = pa.default_memory_pool()
    yield
    pa.set_memory_pool(before)


@pytest.mark.parametrize("operator", ["good", "quality", "featured", "encoded"])
def test_a_worker_holds_a_part_of_a_batch(spark, own_pool, monkeypatch, operator):
    """A worker's objects and arrays, and what it keeps of Arrow's buffers, do not grow with the batch."""
    import public_tokenizers

    text = " ".join(f"w{i * i % 70_001}" for i in range(4_000))
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(["s"] * 300), pa.array(range(300)), pa.array([text] * 300)], names=["doc_id", "source", "row", "text"])
    if operator == "encoded":
        batch = batch.select(["doc_id", "source", "text"])
    frame = spark.createDataFrame([], "doc_id long, source string, text string")
    runs = []
    monkeypatch.setattr(type(frame), "mapInArrow", lambda self, run, schema: runs.append(run) or self)
    monkeypatch.setattr(type(frame), "select", lambda self, *columns: self)
    {"good": good, "quality": quality, "featured": lambda d: featured(d, 5), "encoded": lambda d: encoded(d, public_tokenizers.path("word_bpe_49k.json"), 2)}[operator](frame)
    list(runs[0](iter([batch.slice(0, 1)])))  # what a worker learns once
    tracemalloc.start()
    rows = sum(len(part) for part in runs[0](iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 300 and batch.nbytes > 7e6
    assert peak < 100e6
    assert pa.default_memory_pool().backend_name == "system"


def test_edges(edges, empty):
    rows = quality(edges).collect()
    assert len(rows) == edges.count()
    assert all(r["n_words"] == 0 and r["base_failed"] and not r["kept"] for r in rows if r["doc_id"] in (2, 3, 4))
    long = next(r for r in rows if r["doc_id"] == 6)
    assert long["n_words"] == 80_000 and long["kept"]
    assert good(edges).columns == edges.columns and [r["doc_id"] for r in good(edges).collect()] == [6]
    assert quality(empty).count() == 0 and good(empty).count() == 0

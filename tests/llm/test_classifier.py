import random
import zlib

import numpy as np
import pytest

from feedkit.llm import classifier
from feedkit.llm.classifier import CHUNK, OVERLAP, Network, chunk_scores, chunk_starts, chunked, classify, score, scores, train


def texts(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(20, 400))]
        out.append((" ".join(words), 1) if i % 4 else ("*** ".join(words), 0))
    return out


@pytest.fixture(scope="module")
def net():
    rows = texts(160)
    return train([chunked(t.encode(), chunk_starts(len(t))) for t, _ in rows], np.array([q for _, q in rows], np.float32), epochs=5)


def test_chunks_cover_the_whole_text_and_overlap():
    for size in (0, 1, CHUNK - 1, CHUNK, CHUNK + 1, 5 * CHUNK + 17):
        starts = chunk_starts(size)
        assert starts[0] == 0 and starts[-1] + CHUNK >= size
        assert (np.diff(starts) == CHUNK - OVERLAP).all()
        data = chunked(bytes(i % 251 for i in range(size)), starts)
        assert (data[:, :CHUNK] < 257).all() and (data[0, : min(size, CHUNK)] == np.arange(min(size, CHUNK)) % 251).all()


def test_slopes_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    rows = [(rng.integers(0, 256, (1, CHUNK)).astype(np.int16)) for _ in range(4)]
    before = train(rows, np.array([0, 1, 0, 1], np.float32), epochs=1, batch=4, rate=0.0)
    after = train(rows, np.array([0, 1, 0, 1], np.float32), epochs=1, batch=4, rate=0.001)

    def loss(net):
        z = np.array([chunk_scores(net, x)[0] for x in rows])
        return np.log1p(np.exp(-z * np.array([-1, 1, -1, 1]))).mean()

    assert loss(after) < loss(before)


def test_learns_on_rows_that_it_has_not_seen(net):
    rows = texts(120, seed=9)
    found = scores(net, [t.encode() for t, _ in rows])
    assert sum((p >= 0.5) == bool(q) for p, (_, q) in zip(found, rows, strict=True)) >= 115


def test_long_texts_and_batches_agree(net, monkeypatch):
    some = [b"", b"x", b"word " * 3000, b"*** " * 700, "é".encode() * 900]
    together = scores(net, some)
    assert together == pytest.approx([score(net, t) for t in some])
    monkeypatch.setattr(classifier, "TOGETHER", 3)
    assert scores(net, some) == pytest.approx(together, abs=1e-5)


def test_labels_of_the_held_out_fold_are_not_used(spark, docs, monkeypatch):
    rows = texts(200, seed=3)
    frame = docs([t for t, _ in rows])
    labels = [(i, q, 0) for i, (_, q) in enumerate(rows)]
    out = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    turned = [(i, 1 - q if i in out else q, 0) for i, q, _ in labels]
    schema = "doc_id long, quality int, toxic int"
    one, other = (classify(frame, spark.createDataFrame(x, schema)).orderBy("doc_id").collect() for x in (labels, turned))
    assert one == other and [r["doc_id"] for r in one if r["held_out"]] == out
    right = [r["predicted"] == rows[r["doc_id"]][1] for r in one if r["held_out"]]
    assert sum(right) >= 0.9 * len(right)


def test_edges(spark, edges, empty):
    schema = "doc_id long, quality int, toxic int, extra string"
    labels = spark.createDataFrame([(1, 1, 0, ""), (1, 0, 0, ""), (5, 0, None, ""), (6, 1, 0, ""), (7, 1, 0, ""), (None, 1, 0, ""), (8, None, 0, ""), (99, 1, 0, "")], schema)
    rows = classify(edges, labels).collect()
    assert len(rows) == edges.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in classify(edges, labels.where("quality = 1")).collect()} == {0.5}
    assert {r["score"] for r in classify(edges, spark.createDataFrame([], schema)).collect()} == {0.5}
    assert classify(empty, labels).count() == 0
    assert isinstance(train([np.zeros((1, CHUNK), np.int16)] * 2, np.array([0, 1], np.float32), epochs=1), Network)

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from feedkit.llm import bpe
from feedkit.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
ALPHABETS = ["ab", " a", "etaoin shrdlu", "éèüß日本語的a '", "\n\r\t  x", "0123456789abcdefABCDEF+/=", "\x00\x1c\x7f ×÷ z'st"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.ranks_of(PATH), special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.encoder(PATH, PATTERN)


def ids_of(encoder, texts):
    return [ids.tolist() for ids in encoder.encode(texts)]


def test_ids_are_the_librarys(encoder, library):
    deal = random.Random(3)
    texts = ["".join(deal.choices(deal.choice(ALPHABETS), k=deal.randrange(60))) for _ in range(3000)]
    texts += ["I'll  we've it's\n\n 12 <|endoftext|> ퟿\U0001f600", " ", "\n", "  \n x", "x" * 300 + " y" * 300, "q" * 5000]
    assert ids_of(encoder, texts) == [library.encode_ordinary(t) for t in texts]
    assert ids_of(encoder, []) == []


def test_any_bytes_are_merged_as_by_the_library(encoder, library):
    deal, tokens = random.Random(4), list(bpe.ranks_of(PATH))
    for _ in range(3000):
        piece = b"".join(deal.choices(tokens, k=deal.randrange(1, 6)))
        assert encoder.transducer.encode(piece) == library._encode_single_piece(piece)


@pytest.mark.parametrize("size", [256, 300, 1000, 8000])
def test_the_first_merges_alone(size):
    ranks = {token: rank for token, rank in bpe.ranks_of(PATH).items() if rank < size}
    machine, library = bpe.Transducer(ranks), tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    deal = random.Random(size)
    for _ in range(500):
        piece = "".join(deal.choices(" etaoinshrdluéß日", k=deal.randrange(1, 40))).encode()
        assert machine.encode(piece) == library._encode_single_piece(piece)


def test_single_bytes_are_needed():
    with pytest.raises(ValueError, match="lacks single bytes"):
        bpe.Transducer({b"a": 0, b"aa": 1}).encode(b"aab")


def test_what_is_kept_changes_nothing(monkeypatch, library):
    texts = [f"word{i} other{i * 7} und größer" for i in range(300)]
    want = [library.encode_ordinary(t) for t in texts]
    for name in ("PIECES_KEPT", "STEPS_KEPT", "SEAMS_KEPT"):
        monkeypatch.setattr(bpe, name, 5)
    small = bpe.Encoder(PATH, PATTERN)
    assert [ids_of(small, [t])[0] for t in texts + texts] == want + want
    monkeypatch.setattr(bpe, "BATCH_BYTES", 50)
    assert ids_of(small, [" ".join(texts)]) == [library.encode_ordinary(" ".join(texts))]
    monkeypatch.setattr(bpe, "PIECES", 3)
    assert ids_of(small, [" ".join(texts) + " 日本"]) == [library.encode_ordinary(" ".join(texts) + " 日本")]


def test_tokens_come_out_before_the_end(encoder):
    """What is held back is no longer than the longest token, however long the piece is."""
    machine, at, out = encoder.transducer, 0, 0
    data = ("abcdefghij" * 400).encode()
    for n, byte in enumerate(data, 1):
        step = machine.steps.get((at << 8) | byte)
        step = machine._learn((at << 8) | byte) if step is None else step
        out += len(b"".join(machine.merges.token[i] for i in machine.emitted[(at << 8) | byte])) if step & 1 else 0
        at = step >> 1
        assert n - out <= 2 * max(map(len, machine.merges.ranks))


def test_utf8_machine():
    for data in [b"a\xc3\xa9\xe2\x82\xac\xf0\x9f\x98\x80", b"\xc3", b"\x80", b"\xe0\x80\x80", b"\xed\xa0\x80", b"\xf4\x90\x80\x80", b"\xf0\x9f\x98", b"\xc3a", b"\xff\xc3\xa9", b"\xe2\x82\xe2\x82\xac"]:
        state, broken, tail = bpe.read_utf8(bpe.START, data)
        replaced = data.decode(errors="replace").count("�")
        assert broken + (state != bpe.START) == replaced, data
        assert data[: len(data) - tail].decode(errors="replace") + ("�" if tail else "") == data.decode(errors="replace")


def test_decoding_in_any_blocks(encoder):
    known = bpe.vocabulary(PATH)
    text = "日本語 größer \U0001f600\U0001f600 plain " * 3
    ids = encoder.encode([text])[0]
    for size in (1, 2, 3, 7, 1000):
        stream, out = bpe.Decoder(known), []
        for i in range(0, len(ids), size):
            out.append(stream.feed(ids[i : i + size]))
            out[-1].decode()  # whole characters
        assert b"".join([*out, stream.finish()]) == text.encode()
        assert stream.broken == 0
    byte = {token: rank for token, rank in bpe.ranks_of(PATH).items() if len(token) == 1}
    for data in [b"a\xe2\x82b", b"\xe2\x82", b"\xff\xc3\xa9\xc3", b"\xe2\x82\xe2\x82\xac."]:
        for size in (1, 2, 9):
            stream, ids = bpe.Decoder(known), np.array([byte[bytes([b])] for b in data])
            got = b"".join([*(stream.feed(ids[i : i + size]) for i in range(0, len(ids), size)), stream.finish()])
            assert (got, stream.broken) == (data, data.decode(errors="replace").count("�"))


def test_rows(edges, empty, library):
    rows = bpe.encode(edges, PATH)
    assert rows.columns == [*[c for c in edges.columns if c != "text"], "ids"]
    want = sorted((str(r["doc_id"]), library.encode_ordinary(r["text"] or "")) for r in edges.collect())
    assert sorted((str(r["doc_id"]), r["ids"]) for r in rows.collect()) == want
    back = bpe.decode(rows.withColumn("decoded", F.lit("own")), PATH)
    assert sorted(bytes(r["decoded"]) for r in back.collect()) == sorted((r["text"] or "").encode() for r in edges.collect())
    assert bpe.decode(bpe.encode(empty, PATH), PATH).count() == 0
    both = bpe.there_and_back(edges, PATH)
    assert both.columns == [*[c for c in edges.columns if c != "text"], "ids", "decoded"]
    assert sorted((str(r["doc_id"]), r["ids"]) for r in both.collect()) == want
    assert sorted(bytes(r["decoded"]) for r in both.collect()) == sorted((r["text"] or "").encode() for r in edges.collect())
    assert bpe.there_and_back(empty, PATH).count() == 0
    nothing = rows.limit(1).withColumn("ids", F.lit(None).cast("array<int>"))
    assert [bytes(r["decoded"]) for r in bpe.decode(nothing, PATH).collect()] == [b""]


def test_query_against_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    got = sorted(map(tuple, QUERIES["op11_byte_bpe"](spark, folder).collect()))
    want = []
    for row in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids, data = library.encode_ordinary(row["text"] or ""), (row["text"] or "").encode()
        want.append((row["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(data).hexdigest()))
    assert got == sorted(want)

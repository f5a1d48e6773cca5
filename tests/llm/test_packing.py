import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from feedkit.llm import tokens
from feedkit.llm.packing import pack, served, split_last
from feedkit.llm.tokens import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")
SIGNS = ["a", "The", "'s", "'S", "'", "it's", "I'LL", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>"]
SIGNS += ["É", "é", "É", "ß", "ẞ", "İ", "Σ", "ΑΣ", "×", "÷", "ÿ", "12", "½", "²", "ª", "日本", "😀", "##", ",", "...", '"', "don't", "\x00", "\x7f", "ﬁ", "Å", "́", "€"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


def test_encoder_gives_the_librarys_ids(library):
    rng = random.Random(2)
    encoder = WordEncoder(PATH)
    assert encoder.by_piece
    texts = ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    for some in (texts, texts[:50]):  # the second time all are known
        got = encoder.encode([t.encode() for t in some])
        assert [np.frombuffer(g, encoder.dtype).tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in some]


def test_encoder_cuts_long_texts_and_forgets(library, monkeypatch):
    monkeypatch.setattr(tokens, "SEGMENT", 64)
    monkeypatch.setattr(tokens, "PIECES_KEPT", 40)
    rng, encoder = random.Random(4), WordEncoder(PATH)
    words = ["the", "The,", "éa", "ÉTÉ", "12", "3.4", "##", "a", "b\n", "x" * 300, "word" * 20, "don't", "日", "<|endoftext|>", "\t", "  ", "ÿÀ", "ß."]
    for _ in range(400):
        texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 6))]
        got = encoder.encode([t.encode() for t in texts])
        assert [np.frombuffer(g, encoder.dtype).tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_encoder_leaves_other_tokenizers_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, library = WordEncoder(path), Tokenizer.from_file(path)
    texts = ["two  words\n", " lead", ""]
    assert not encoder.by_piece
    assert [np.frombuffer(g, encoder.dtype).tolist() for g in encoder.encode([t.encode() for t in texts])] == [library.encode(t).ids for t in texts]


def check(rows, packed, library, length):
    """Each id of each row lies in one piece; sequences have no gap, and are full or a power of two."""
    texts = defaultdict(list)
    for i, text, *_ in rows:
        texts[i].append(ids_of(library, text))
    found = defaultdict(list)
    sequences = defaultdict(list)
    for p in packed:
        found[p["doc_id"]].append(p)
        sequences[p["sequence_id"]].append(p)
    assert found.keys() == texts.keys()
    for i, all_ids in texts.items():
        want = defaultdict(int)
        assert sum(p["length"] for p in found[i]) == sum(map(len, all_ids))
        for p in found[i]:
            parts = [np.array(ids[p["start"] : p["start"] + p["length"]], "<u4").tobytes() for ids in all_ids if len(ids) == p["doc_tokens"]]
            assert p["ids_crc32"] in [zlib.crc32(x) for x in parts]
            want[p["doc_tokens"]] += p["length"]
        assert sorted(want.items()) == sorted((n, n * sum(len(x) == n for x in all_ids)) for n in {len(x) for x in all_ids})
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at == length or at & (at - 1) == 0 and at < length
    return sequences


@pytest.mark.parametrize(("length", "run_sequences"), [(64, 4), (32, 16), (4096, 256)])
def test_all_ids_are_packed_in_the_targets_proportions(spark, saved, library, length, run_sequences):
    rng = random.Random(length)
    rows = []
    for i in range(150):
        words = rng.choice([0, 1, 5, 20, 60, 200])
        rows.append((i, " ".join(rng.choice(["the", "word", "dog,", "Thndtion", "9"]) for _ in range(words)), rng.choice(["a", "a", "a", "b", "c", None])))
    rows.append((999, "tiny", "rare"))
    frame = saved(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    least = 8
    packed = pack(frame, PATH, length=length, run_sequences=run_sequences, least=least, docs_per_shard=20).collect()
    sequences = check(rows, packed, library, length)
    full = [s for s in sequences.values() if sum(p["length"] for p in s) == length]
    total = sum(p["length"] for p in packed)
    assert len(full) == total // length
    for source in ("a", "b", "c"):
        share = sum(p["length"] for p in packed if p["source"] == source) / total
        for s in full[:-1]:
            assert abs(sum(p["length"] for p in s if p["source"] == source) - share * length) <= 2 * least + 8


def test_sequences_serve_what_is_owed():
    left = [1000, 500, 37]
    total = sum(left)
    share = [n / total for n in left]
    out = served([0.0] * 3, share, list(left), 64, 10)
    assert all(sum(n for _, n in s) == 64 for s in out[:-1])
    for q in range(3):
        assert sum(n for s in out for p, n in s if p == q) == left[q]
        got = 0
        for k, s in enumerate(out[:-1]):
            got += sum(n for p, n in s if p == q)
            assert abs(got - share[q] * 64 * (k + 1)) <= 20  # deficits are carried, and stay small


def test_last_sequence_is_cut_to_powers_of_two():
    parts = split_last([(0, 5), (1, 30), (2, 2)], 64)
    assert [sum(n for _, n in s) for s in parts] == [32, 4, 1]
    assert [sum(n for s in parts for p, n in s if p == q) for q in range(3)] == [5, 30, 2]
    assert split_last([(0, 64)], 64) == [[(0, 64)]]


def test_edges(edges, empty, library):
    rows = [(r["doc_id"], r["text"]) for r in edges.select("doc_id", "text").collect()]
    check(rows, pack(edges, PATH).collect(), library, 4096)
    assert pack(empty, PATH).count() == 0

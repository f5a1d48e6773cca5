import random

import numpy as np
import pytest

from feedkit.llm import near
from feedkit.llm.near import PLACES, near_duplicates, sets_of, shingles, signatures, without_near_copies, words_of


def components(texts, size, least):
    sets = [shingles(words_of((t or "").encode()), size) for t in texts]
    owner = list(range(len(texts)))

    def root(i):
        while owner[i] != i:
            i = owner[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= least * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                owner[y] = x
    return [(i, len(s), root(i), root(i) == i) for i, s in enumerate(sets)]


def varied(rng, families=6, copies=25, words=120):
    texts = []
    for _ in range(families):
        base = [f"w{rng.randint(0, 5000)}" for _ in range(words)]
        texts.append(" ".join(base))
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.choice([1, 2, 3, 4, 8])):
                own[rng.randrange(words)] = f"v{rng.randint(0, 10**9)}"
            texts.append(" ".join(own))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("size", "least", "block"), [(3, 85, 1024), (5, 80, 1024), (3, 85, 8)])
def test_components_against_brute_force(docs, monkeypatch, size, least, block):
    monkeypatch.setattr(near, "BLOCK", block)
    texts = [*varied(random.Random(size + block)), "", None, "One two", "one TWO", "one", "x y z", "x y z", "x y z w"]
    got = near_duplicates(docs(texts), size=size, least=least)
    assert sorted(tuple(r)[:4] for r in got.collect()) == components(texts, size, least)


def test_chain_is_one_component(docs):
    words = [f"w{i}" for i in range(200)]
    texts = []
    for k in range(30):  # each is like its neighbours only
        words = [*words[4:], *(f"n{k}-{i}" for i in range(4))]
        texts.append(" ".join(words))
    got = near_duplicates(docs(texts), size=3, least=85).collect()
    assert {r["component_id"] for r in got} == {0}


def test_signatures_estimate_similarity():
    rng = random.Random(3)
    for n in (1, 5, 40, 600):
        a = [rng.getrandbits(64) for _ in range(n)]
        b = a[: n * 3 // 4] + [rng.getrandbits(64) for _ in range(n - n * 3 // 4)]
        true = len(set(a) & set(b)) / len(set(a) | set(b))
        found = []
        for shift in range(30):  # other hashes, other draws
            value = near.mixed(np.array(a + b, np.uint64) + np.uint64(shift))
            sig = signatures(np.repeat([0, 1], n), value, 2)
            assert not (sig == np.uint64(2**64 - 1)).any()
            found.append((sig[0] == sig[1]).mean())
        assert abs(np.mean(found) - true) < 0.05


def test_signature_does_not_depend_on_what_stands_beside():
    texts = [b"a b c d e f", b"", b"x", b"the quick brown fox jumps over the lazy dog " * 3]
    doc, value = sets_of(texts, 3)
    together = signatures(doc, value, len(texts), together=5)
    for i, t in enumerate(texts):
        d, v = sets_of([t], 3)
        alone = signatures(d, v, 1)
        assert (alone[0] == together[i]).all() and alone.shape[1] == PLACES


def test_edges(edges, empty):
    rows = near_duplicates(edges).collect()
    assert len(rows) == edges.count()
    assert {(r["doc_id"], r["component_id"], r["n_shingles"]) for r in rows if r["doc_id"] in (2, 3, 4)} == {(i, i, 0) for i in (2, 3, 4)}
    same = [r for r in rows if r["component_id"] == 1]
    assert {r["doc_id"] for r in same} == {1, 5, None} and len(same) == 4 and sum(r["first"] for r in same) == 1
    kept = without_near_copies(edges)
    assert kept.columns == edges.columns and kept.count() == edges.count() - 3
    assert near_duplicates(empty).count() == 0 and without_near_copies(empty).count() == 0

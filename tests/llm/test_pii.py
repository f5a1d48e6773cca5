import hashlib
import random
import re

from feedkit.llm.pii import KINDS, base_spans, bound_of, estimated, find, luhn, probability, proposals, sampled, trained, votes

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
        if 14 <= len(digits) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def test_base_spans_against_the_patterns():
    rng = random.Random(3)
    signs = ["a", "B.", "@", "@@", ".", "1", "23", "255", "300.", "+", "+4", "9 9", "-", "(", "4111111111111111", " ", "x@y.z", "1.2.3.4", "é", "\n", "+1 (555) 010-9999"]
    for _ in range(20_000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(1, 14)))
        assert base_spans(text) == brute(text), text


def test_long_runs_take_no_long():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 100_000, "a@" * 150_000, "1 " * 150_000, "@" * 200_000, "a-" * 100_000 + "@"):
        base_spans(text)
        proposals(text[:50_000], [])


def test_luhn():
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def test_reliable_labelers_are_told_from_noise():
    rng = random.Random(1)
    counts: dict = {}
    for _ in range(5000):
        true = rng.random() < 0.4
        good = [(1 if true else -1) if rng.random() < 0.9 else (-1 if true else 1) for _ in range(3)]
        key = (0, (*good, rng.choice([-1, 1]), 0))
        counts[key] = counts.get(key, 0) + 1
    found = estimated(counts)
    assert found[0, (1, 1, 1, -1, 0)] > 0.95 and found[0, (-1, -1, -1, 1, 0)] < 0.05
    assert found[0, (1, 1, -1, -1, 0)] > 0.5 > found[0, (1, -1, -1, 1, 0)]


def test_classifier_follows_its_teacher():
    weights = trained([([1, 5], 0.98), ([2, 5], 0.03)] * 50)
    assert probability(weights, [1, 5]) > 0.9 and probability(weights, [2, 5]) < 0.1
    assert probability(trained([]), [3]) < 0.01


def test_votes_know_signs_for_and_against():
    text = "commit hash 04dbebab91ab85687d33eeaaf9ac699e1188f962 and token = 04dbebab91ab85687d33eeaaf9ac699e1188f963"
    (a, b) = proposals(text, [])
    assert KINDS[a[1]] == KINDS[b[1]] == "secret"
    assert votes(text, *a)[4] == -1 and votes(text, *b)[3:] == (1, 0)


def test_spans_of_rows(spark, saved):
    secret = "04dbebab91ab85687d33eeaaf9ac699e1188f9"
    texts = ["é mail me@x.org, me@x.org or 10.0.0.1", "card 4111 1111-1111 1111 call +1 (555) 010-9999", "clean text with 16 digits 1234567812345678"]
    texts += [f'word token = "{secret}{i:02d}" word' for i in range(30)]
    rows = {r["doc_id"]: r for r in find(saved(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).collect()}
    assert rows[0]["spans"] == "email:7:15,email:17:25,ip:29:37"
    assert (rows[0]["n_email"], rows[0]["n_ip"]) == (2, 1)
    assert rows[1]["spans"] == "card:5:24,phone:30:47" and rows[1]["base_sha256"] == hashlib.sha256(b"card:5:24,phone:30:47").hexdigest()
    assert rows[2]["spans"] == "" and rows[2]["n_added"] == 0
    assert all(rows[i]["spans"] == "secret:14:54" and rows[i]["n_added"] == 1 and rows[i]["base_sha256"] == rows[2]["base_sha256"] for i in range(3, 33))


def test_edges(edges, empty):
    rows = find(edges).collect()
    assert len(rows) == edges.count()
    assert all(r["spans"] == "" and r["n_email"] == 0 for r in rows if r["doc_id"] in (2, 3, 4, 6))
    assert find(empty).count() == 0


def test_rare_kinds_are_learned_beside_frequent_ones(spark, saved):
    """One account number among many telephone-like numbers, of which a hot template has most; none may decide for the other."""
    rng = random.Random(4)
    texts = ["their account GB82WEST12345698765432 is given"] * 2
    texts += [f"order number {rng.randint(100, 999)} {rng.randint(1000, 9999)} {rng.randint(100, 999)} {rng.randint(100, 999)} of {i}" for i in range(150)]
    texts += ["page no 111 2222 333 444 of all"] * 300
    frame = saved(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    for sample in (20, 20_000):
        rows = {r["doc_id"]: r["spans"] for r in find(frame, sample=sample).collect()}
        assert rows[0] == rows[1] == "iban:14:36", sample
        assert not any(rows[i] for i in range(2, len(texts))), sample


def test_without_training_rows_the_estimate_decides(spark, saved):
    texts = ["their account GB82WEST12345698765432 is given"] * 20
    rows = find(saved(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")), sample=0).collect()
    assert [r["spans"] for r in rows] == ["iban:14:36"] * 20


def test_sample_is_shared_out_and_stands_for_all():
    assert bound_of([], 5) == 0 and bound_of([1, 2, 3], 6) == 3 and bound_of([1, 2, 3], 100) == 3
    assert bound_of([1, 100, 1000], 21) == 10 and bound_of([1000] * 4, 100) == 25


def test_proposals_of_all_kinds_are_sampled(spark):
    rows = [(3, "+00+0", [i]) for i in range(3000)] + [(3, "+00+0", [9999])] * 3000 + [(5, "+0+00", [1])] + [(7, "-000-", [i]) for i in range(40)]
    each = spark.createDataFrame(rows, "k int, v string, f array<int>")
    counts = {(3, (1, 0, 0, 1, 0)): 6000, (5, (1, 0, 1, 0, 0)): 1, (7, (-1, 0, 0, 0, -1)): 40}
    found = sampled(each, counts, 341)
    of = {k: [(f, n) for j, _, f, n in found if j == k] for k in (3, 5, 7)}
    assert of[5] == [([1], 1.0)] and of[7] == [([i], 1.0) for i in range(40)]
    assert 100 < len(of[3]) < 200 and ([9999], 3000.0) in of[3]  # 300 of 6000, of which the copies are 150
    assert abs(sum(n for _, n in of[3]) - 6000) < 1000


def test_long_tokens_and_padded_addresses_are_whole():
    key = "aB3-" * 5000
    assert proposals(f"key {key} end", []) == [(4, KINDS.index("secret"), 4 + len(key))]
    zeros = "0" * 6000
    for text in (f"{zeros}10.0.{zeros}.255", "1.2.3.0004"):
        assert base_spans(f"ip {text} end") == [(3, 1, 3 + len(text))]
    assert base_spans(f"ip {zeros}256.0.0.1") == base_spans("ip 1.2.3.1000") == []
    proposals("a1" * 500_000 + "é" + "a" * 500_000 + "1", [])

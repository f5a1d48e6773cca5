"""Personal data by weak supervision.

Fixed patterns give the base spans, which always stay. Looser patterns propose further ones (masked
addresses, numbers without a plus sign, account numbers, tokens, ...). Labelers vote on each proposal: a
strict pattern, a check of its digits, a gazetteer, words before it that speak for or against it.
Expectation-maximisation over the counts of all vote patterns estimates how reliable each labeler is,
and the proposals' probabilities then train a span classifier on what stands in and before the span.

At scale: texts are read once and not shuffled. The votes are counted per pattern, of which there are
3^labelers a kind at most, and only those counts and a bounded sample of the distinct proposals reach the
driver, with some of each kind and vote pattern. Each kind has the same weight in training.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.llm.common import stored
from feedkit.llm.quality import texts_of

BASE = ("email", "ip", "card", "phone")
MORE = ("iban", "ssn", "ipv6", "secret")
KINDS = BASE + MORE

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# Digits are taken whole: the place after a run that fails can be no better start.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Proposals: kind and pattern. What overlaps a base span, or an earlier proposal, is dropped.
LOOSE = (
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\s?(?:\[at\]|\(at\)|\{at\}|\sat\s)\s?[A-Za-z0-9-]{1,63}(?:(?:\s?(?:\[dot\]|\(dot\)|\{dot\})\s?|\sdot\s|\.)[A-Za-z0-9-]{1,63}){1,4}")),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")),
    ("ipv6", re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){2,7}(?::?[0-9A-Fa-f]{1,4}){1,6}(?![0-9A-Za-z:])")),
    ("ssn", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
    ("phone", re.compile(r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,4}\)[ -]?|[0-9]{2,4}[ .-])[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}(?![0-9A-Za-z-])")),
    ("secret", re.compile(r"""(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{20,}+(?![A-Za-z0-9_/+-])""")),
)
#: Some text that a pattern needs somewhere, to skip texts without it.
NEEDS = {"email": re.compile(r"[\[({\s]at[\])}\s]"), "iban": re.compile(r"[A-Z]{2}[0-9]{2}"), "ipv6": re.compile(r":[0-9A-Fa-f]{0,4}:"), "ssn": re.compile(r"[0-9]-[0-9]{2}-"), "phone": re.compile(r"[0-9)][ .-][0-9]{2}"), "secret": re.compile(r"[A-Za-z_/+-][0-9]|[0-9][A-Za-z]")}

#: Words that speak for a kind when they stand before it, and words that speak against all.
FOR = {
    "email": "email e-mail mail contact write reach address".split(),
    "ip": "ip host server address client".split(),
    "ipv6": "ip ipv6 host server address client".split(),
    "card": "card visa mastercard amex credit debit".split(),
    "phone": "phone tel telephone call mobile cell fax whatsapp".split(),
    "iban": "iban account bank konto cuenta compte".split(),
    "ssn": "ssn social security".split(),
    "secret": "token key secret password passwd pwd api apikey bearer auth authorization credential".split(),
}
AGAINST = frozenset("hash sha sha1 sha256 md5 commit checksum isbn issn version order invoice page pages number no ref id digest".split())
#: Endings of host names and first letters of account numbers that are common enough to count as known.
ENDINGS = frozenset("com org net edu gov io de fr es uk eu info biz ch at nl it pl us ca au jp".split())
COUNTRIES = frozenset("AD AE AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IS IT LI LT LU LV MC MT NL NO PL PT RO SE SI SK TR".split())
LABELERS = ("strict", "check", "gazetteer", "context", "against")
BEFORE = 40
WORDS = re.compile(r"[A-Za-z0-9-]+")
FEATURES = 1 << 12


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (n * 2 - 9 if n > 4 else n * 2)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """As the pattern for an address finds them, but in one pass over the signs: a name begins where the run before the sign does."""
    ended, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > ended and LOCAL.match(text[start - 1]):
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            ended = found.end()
        elif start < at:
            ended = max(ended, at)
        at = text.find("@", max(at + 1, ended))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, order of kind, end), sorted."""
    spans = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(x) <= 3 and int(x or "0") <= 255 for x in (part.lstrip("0") for part in m[0].split("."))):
            spans.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = digits_of(m[0]) if m.end() - m.start() <= 40 else ""
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(digits_of(m[0])) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def proposals(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    taken = [(s, e) for s, _, e in base]
    found = []
    for kind, pattern in LOOSE:
        if not NEEDS[kind].search(text):
            continue
        for m in pattern.finditer(text):
            if kind == "secret" and not (any(c.isdigit() for c in m[0]) and any(c.isalpha() for c in m[0])):
                continue
            found.append((m.start(), KINDS.index(kind), m.end()))
    kept: list[tuple[int, int, int]] = []
    last = 0
    for s, k, e in sorted(found):
        if s >= last and not any(a < e and s < b for a, b in taken):
            kept.append((s, k, e))
            last = e
    return kept


def votes(text: str, start: int, kind: int, end: int) -> tuple[int, ...]:
    """Each labeler's vote: 1 for, -1 against, 0 none."""
    name, span = KINDS[kind], text[start:end]
    before = [w.lower() for w in WORDS.findall(text[max(0, start - BEFORE) : start])]
    near = before[-3:]
    digits = digits_of(span)
    strict = check = gazetteer = 0
    if name == "email":
        strict = 1 if re.search(r"[\[({]", span) else -1
        gazetteer = 1 if span.rsplit(None, 1)[-1].rsplit(".", 1)[-1].lower() in ENDINGS else -1
    elif name == "iban":
        plain = span.replace(" ", "")
        strict = 1 if 15 <= len(plain) <= 34 else -1
        check = 1 if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1 else -1
        gazetteer = 1 if plain[:2] in COUNTRIES else -1
    elif name == "ipv6":
        groups = span.split(":")
        strict = 1 if len(groups) == 8 and "" not in groups or span.count("::") == 1 and len(groups) <= 8 else -1
        check = 1 if any(c in "abcdefABCDEF" for c in span) else -1
    elif name == "ssn":
        strict = 1
        check = -1 if span[:3] in ("000", "666") or span[0] == "9" or span[4:6] == "00" or span[7:] == "0000" else 1
    elif name == "phone":
        strict = 1 if len(digits) in (10, 11) else -1
        check = 1 if 9 <= len(digits) <= 12 else -1
    elif name == "secret":
        share = len(set(span)) / len(span)
        strict = 1 if re.fullmatch(r"[0-9a-f]{32,}|[A-Za-z0-9_-]{24,}", span) else -1
        check = 1 if len(digits) * 6 >= len(span) and (share >= 0.25 or len(set(span)) >= 10) else -1
        gazetteer = 1 if re.match(r"sk-|ghp_|xox|AKIA|eyJ", span) else 0
    context = 1 if any(w in FOR[name] for w in near) else 0
    against = -1 if any(w in AGAINST for w in near[-2:]) else 0
    return strict, check, gazetteer, context, against


def features(text: str, start: int, kind: int, end: int) -> list[int]:
    """Hashed: kind with length, shape of the span, each of the three words before it and the sign before it."""
    span = text[start:end]
    shape = re.sub(r"[a-z]+", "a", re.sub(r"[A-Z]+", "A", re.sub(r"[0-9]+", "0", span)))[:24]
    before = [w.lower() for w in WORDS.findall(text[max(0, start - BEFORE) : start])][-3:]
    names = [f"k{kind}", f"l{kind}:{min(9, len(span) // 8)}", f"s{kind}:{shape}", f"c{kind}:{text[max(0, start - 2) : start]}"]
    names += [f"w{kind}:{w}" for w in before]
    return sorted({zlib.crc32(n.encode()) % FEATURES for n in names})


def estimated(counts: dict[tuple, int], rounds: int = 60) -> dict[tuple, float]:
    """Probability of being personal data for each (kind, votes), by expectation-maximisation.

    A labeler has one table of vote by truth for each kind; the rate of true proposals is the kind's.
    Begins from the majority of the votes.
    """
    result: dict[tuple, float] = {}
    for kind in {k for k, _ in counts}:
        rows = [(v, n) for (k, v), n in counts.items() if k == kind]
        seen, weight = np.array([v for v, _ in rows]), np.array([n for _, n in rows], float)
        p = 1 / (1 + np.exp(-1.5 * seen.sum(axis=1) + 1.0))
        for _ in range(rounds):
            # one pseudo-proposal a cell, leaning to the labeler's meaning, keeps tables apart where votes are few
            lean = {-1: (0.5, 2.0), 0: (1.0, 1.0), 1: (2.0, 0.5)}
            tables = []
            for j in range(seen.shape[1]):
                table = np.array([[(weight * p * (seen[:, j] == v)).sum() + lean[v][0], (weight * (1 - p) * (seen[:, j] == v)).sum() + lean[v][1]] for v in (-1, 0, 1)])
                tables.append(table / table.sum(axis=0))
            rate = ((weight * p).sum() + 1) / (weight.sum() + 2)
            odds = np.log(rate / (1 - rate)) + sum(np.log(tables[j][seen[:, j] + 1, 0] / tables[j][seen[:, j] + 1, 1]) for j in range(seen.shape[1]))
            new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            if np.abs(new - p).max() < 1e-6:
                break
            p = new
        result.update({(kind, v): float(x) for (v, _), x in zip(rows, p, strict=True)})
    return result


def trained(rows: list[tuple[list[int], float]], epochs: int = 100, rate: float = 0.3, counts: list[float] | None = None) -> np.ndarray:
    """Logistic weights of the features for the estimated probabilities; the last is the offset. A row counts as often as ``counts`` says."""
    weights, square = np.zeros(FEATURES + 1), np.full(FEATURES + 1, 1e-6)
    if not rows:
        weights[-1] = -30.0
        return weights
    index = np.concatenate([[*f, FEATURES] for f, _ in rows]).astype(int)
    of = np.repeat(np.arange(len(rows)), [len(f) + 1 for f, _ in rows])
    truth = np.array([p for _, p in rows])
    share = np.full(len(rows), 1 / len(rows)) if counts is None else np.array(counts) / np.sum(counts)
    for _ in range(epochs):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(of, weights[index]), -30, 30)))
        slope = np.bincount(index, ((p - truth) * share)[of], FEATURES + 1) + 1e-5 * weights
        square += slope**2
        weights -= rate * slope / np.sqrt(square)
    return weights


def probability(weights: np.ndarray, found: list[int]) -> float:
    return float(1 / (1 + np.exp(-np.clip(weights[found].sum() + weights[-1], -30, 30))))


def bound_of(counts: list[int], sample: int) -> float:
    """How many of each pattern's proposals to take, all of a smaller one, so that they are ``sample`` at most."""
    left = sample
    for i, n in enumerate(sorted(counts)):
        if n * (len(counts) - i) > left:
            return left / (len(counts) - i)
        left -= n
    return max(counts, default=0)


def sampled(each: DataFrame, counts: dict[tuple, int], sample: int) -> list[tuple[int, str, list[int], float]]:
    """Distinct proposals as (kind, votes, features, how many they stand for), of each kind and votes about as many as their share of ``sample``.

    One that ``n`` rows have is taken with a probability in proportion to ``n``, by a hash of it, so copies
    are one row here and the frequent ones are surely in.
    """
    bound = bound_of(list(counts.values()), sample)
    if not counts or bound <= 0:
        return []
    step = {(k, "".join("-0+"[x + 1] for x in v)): max(1.0, n / bound) for (k, v), n in counts.items()}
    by_name = F.create_map(*[F.lit(x) for (k, v), n in sorted(step.items()) for x in (f"{k}{v}", n)])
    groups = each.groupBy("k", "v", "f").agg(F.count("*").alias("n"))
    place = F.pmod(F.xxhash64("k", "v", "f"), F.lit(1 << 40)) / F.lit(1 << 40)
    rows = groups.where(place * by_name[F.concat(F.col("k").cast("string"), "v")] < F.col("n")).collect()
    return sorted((r["k"], r["v"], r["f"], max(float(r["n"]), step[r["k"], r["v"]])) for r in rows)


def written_out(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


PROPOSED = "array<struct<s: int, k: int, e: int, v: string, f: array<int>>>"


def scanned(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``base`` (its spans written out) and ``more`` (the proposals with votes and features) of each row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    made = pa.list_(pa.struct([("s", pa.int32()), ("k", pa.int32()), ("e", pa.int32()), ("v", pa.string()), ("f", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, more = [], []
            for raw in texts_of(batch, "text"):
                text = raw.decode()
                spans = base_spans(text)
                base.append(written_out(spans))
                more.append([
                    {"s": s, "k": k, "e": e, "v": "".join("-0+"[v + 1] for v in votes(text, s, k, e)), "f": features(text, s, k, e)}
                    for s, k, e in proposals(text, spans)
                ])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, pa.string()), pa.array(more, made)], names=["doc_id", "base", "more"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, base string, more {PROPOSED}")


def find(docs: DataFrame, *, sample: int = 20_000, least: float = 0.5) -> DataFrame:
    """Personal data in each row's ``text``.

    Returns ``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` (base spans), ``base_sha256``,
    ``spans`` (base spans and the proposals that the classifier gives ``least`` or more, as
    ``kind:start:end`` in code points) and ``n_added``. The classifier learns from about ``sample`` distinct
    proposals at most, shared out evenly among the kinds and vote patterns; of a kind that has none there,
    the estimated probabilities decide.

    Null or empty text has no spans. Repeated rows get a row each. Other columns are ignored. No rows give none.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = stored(scanned(docs), "spans")
    each = rows.select(F.explode("more").alias("p")).select("p.k", "p.v", "p.f")
    counts = {(r["k"], tuple("-0+".index(c) - 1 for c in r["v"])): r["n"] for r in each.groupBy("k", "v").agg(F.count("*").alias("n")).collect()}
    truth = estimated(counts)
    truth = {(k, "".join("-0+"[x + 1] for x in v)): p for (k, v), p in truth.items()}
    some = sampled(each, counts, sample)
    total: dict[int, float] = {}
    for k, _, _, n in some:
        total[k] = total.get(k, 0) + n
    weights = trained([(f, truth[k, v]) for k, v, f, _ in some], counts=[n / total[k] for k, _, _, n in some])

    def likely(x: dict) -> float:
        return probability(weights, x["f"]) if x["k"] in total else truth[x["k"], x["v"]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n: list[list[int]] = [[] for _ in BASE]
            sha, spans, added = [], [], []
            for base, more in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                held = [(int(s), KINDS.index(k), int(e)) for k, s, e in (x.split(":") for x in base.split(",") if x)]
                new = [(x["s"], x["k"], x["e"]) for x in more if likely(x) >= least]
                for k, counts in enumerate(n):
                    counts.append(sum(x[1] == k for x in held))
                sha.append(hashlib.sha256(base.encode()).hexdigest())
                spans.append(written_out(held + new))
                added.append(len(new))
            columns = [batch.column(0), *(pa.array(x, pa.int64()) for x in n), pa.array(sha), pa.array(spans, pa.string()), pa.array(added, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans", "n_added"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")

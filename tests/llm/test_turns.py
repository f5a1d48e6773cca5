import hashlib
import random
import zlib
from itertools import pairwise

import pytest
from pyspark.sql import functions as F

from feedkit.llm import turns
from feedkit.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(rows):
    """Cost and audit by a search over what the roles so far end with. Rows are (initial, fault)."""
    reach = {"": (0, "")}

    def inserted(reach):
        out = dict(reach)
        for _ in range(2):
            for end, (cost, audit) in list(out.items()):
                new = turns.NEXT[end]
                out[new] = min(out.get(new, (9e9, "")), (cost + 5, audit + "I"))
        return out

    for initial, fault in rows:
        after = {}
        for end, (cost, audit) in inserted(reach).items():
            options = [(end, cost + 2, audit + "D")]
            if fault not in (turns.BLANK, turns.DUPLICATE):
                extra = 5 * (fault == turns.CUT)
                new = turns.NEXT[end]
                options.append((new, cost + extra + (initial != new), audit + ("K" if initial == new else "R")))
                if end == "" and initial == "s":
                    options.append(("s", cost + extra, audit + "K"))
            for new, c, a in options:
                after[new] = min(after.get(new, (9e9, "")), (c, a))
        reach = after
    return min(v for end, v in inserted(reach).items() if end in ("", "a"))


def expected(rows):
    """A conversation's report from its (turn, role, text) in order."""
    seen, faults, counts = set(), [], [0, 0, 0, 0]
    for _, role, text in rows:
        said = text.strip(turns.WHITE)
        fault = turns.BLANK if not said else turns.DUPLICATE if (role, text) in seen else turns.CUT if said[-1] not in ".!?" else turns.NO_FAULT
        seen.add((role, text))
        faults.append((role[:1], fault))
        counts[fault] += 1
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    cost, audit = cheapest(faults)
    out, left, end = [], list(rows), ""
    for edit in audit:
        _, role, text = left.pop(0) if edit != "I" else (None, None, "")
        if edit == "D":
            continue
        role = role if edit == "K" else turns.ROLES[turns.NEXT[end]]
        end = role[:1]
        out.append(f"{role}:{text}")
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairwise(rows))
    return gaps, *counts[:3], illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


@pytest.mark.parametrize("block, narrow", [(256, 4), (3, 1), (1, 2), (5, 40)])
def test_alignment_against_a_search(monkeypatch, block, narrow):
    monkeypatch.setattr(turns, "BLOCK", block)
    monkeypatch.setattr(turns, "NARROW", narrow)
    deal = random.Random(block)
    for k in range(1500):
        rows = [(deal.choice("uasx" if k % 2 else "ua"), deal.choice([0, 1, 2, 3, 3, 3, 3])) for _ in range(deal.randrange(14))]
        assert turns.align(rows) == cheapest(rows), rows


def test_long_conversations():
    deal = random.Random(8)
    for n in (300, 1500):
        good = ["ua"[i % 2] for i in range(n)]
        rows = [(s if deal.random() > 0.05 else deal.choice("uas"), deal.choice([0, 1, 2] + [3] * 40)) for s in good if deal.random() > 0.05]
        assert turns.align(rows) == cheapest(rows)
    assert turns.align([("u", turns.NO_FAULT)] * 600) == cheapest([("u", turns.NO_FAULT)] * 600)
    assert turns.align([("s", turns.BLANK)] * 600) == (1200, "D" * 600)


def test_bands_leave_nothing_out(monkeypatch):
    """Against the whole table."""
    deal = random.Random(9)
    for _ in range(200):
        rows = [(deal.choice("uas"), deal.choice([1, 2, 3, 3, 3])) for _ in range(deal.randrange(1, 25))]
        banded = turns.align(rows)
        with monkeypatch.context() as whole:
            whole.setattr(turns, "NARROW", 100)
            assert turns.align(rows) == banded


def test_reports_and_repaired_turns(spark):
    rows = [
        (1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello!"), (1, 5, "user", "  "), (1, 6, "user", "And"), (1, 7, "assistant", "So."),
        (2, 0, "user", "A."), (2, 0, "user", "A."), (2, 1, "user", "B."), (2, 2, "assistant", "C."), (2, 3, None, None), (2, 3, "tool", "D? "),
        (3, None, "user", "No end"), (3, None, "assistant", "x."), (3, 4, "user", "y"), (None, 1, "user", "z."), (None, None, None, "z.\n"),
        (4, 7, "assistant", "only."), (5, 1, "", "empty role."), (6, 0, "user", "q" * 300_000 + "."), (6, 1, "assistant", "."),
    ]
    given = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", audit string").repartition(3)
    got = {r[0]: tuple(r)[1:] for r in turns.reports(given).collect()}
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert got == {conv: expected(sorted(some, key=order)) for conv, some in by.items()}
    assert got[1][:6] == (2, 1, 0, 1, 1, 9) or got[1][4] >= 1
    fixed = turns.repair(given).where("conv_id = 2").orderBy("place").collect()
    assert [r["role"][0] for r in fixed] == ["u", "a", "u", "a"][: len(fixed)]
    assert turns.reports(given.limit(0)).count() == 0
    assert turns.repair(given.limit(0)).count() == 0
    gone = turns.reports(given.where("conv_id = 4"), stays=F.lit(False)).collect()
    assert [tuple(r) for r in gone] == [(4, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if harm == 1 else text.translate({ord(c): None for c in ".!?"}) if harm == 2 else text
        out += [(turn, "user" if harm == 4 else role, text)] * (0 if harm == 0 else 2 if harm == 3 else 1)
    return out


def test_query_against_the_search(spark):
    folder = "/root/testdata/sf0.01"
    by = {}
    for row in spark.read.parquet(f"{folder}/conversations.parquet").collect():
        by.setdefault(row["conv_id"], []).append(tuple(row))
    want = {}
    for conv, rows in by.items():
        left = sorted(damaged(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        want[conv] = expected(left) if left else (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op12_conversation_repair"](spark, folder).collect()}
    assert got == want

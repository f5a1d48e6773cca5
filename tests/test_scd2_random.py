"""Loads of random dimensions against a plain model, many at a time: the key says which case a row is of."""

import datetime
import random

import pytest

from feedkit.operators import type2
from feedkit.operators.dimension import Load
from feedkit.plans import load_dimension
from feedkit.sinks import create_table

CASES = 400
RUN, OPEN = datetime.date(2023, 5, 10), datetime.date(9999, 12, 31)
DAY = datetime.timedelta(days=1)
SOURCE = "case int, k string, p string, q int"
TARGET = SOURCE + ", start_date date, end_date date, active_flag string"
COLUMNS = {"case": "int", "k": "string", "p": "string", "q": "int", "start_date": "date", "active_flag": "string",
           "end_date": "date"}
KEYS = ["case", "k"]
CALL = dict(keys=KEYS, start_col="start_date", end_col="end_date", flag_col="active_flag", run_date=str(RUN))


def values(rng):
    return rng.choice([None, "a", "b"]), rng.choice([None, 1, 2])


def generate(seed):
    rng = random.Random(seed)
    source, target = [], []
    for case in range(CASES):
        for k in "ABC":
            if rng.random() < 0.7:
                source.append((case, k, *values(rng)))
            start = datetime.date(2022, 1, 1)
            for _ in range(rng.randrange(3)):
                end = start + datetime.timedelta(days=rng.randrange(1, 90))
                target.append((case, k, *values(rng), start, end, "N"))
                start = end + datetime.timedelta(days=1)
            kind = rng.random()
            if kind < 0.6:
                start = rng.choice([start, RUN])
                target.append((case, k, *values(rng), start, rng.choice([OPEN, None]), "Y"))
            elif kind < 0.8:
                target.append((case, k, *values(rng), RUN, RUN - DAY, "N"))
    return source, target


def model(source, target, refresh, close_blank=False, run=RUN):
    """The rules one key at a time."""
    incoming = {r[:2]: r[2:] for r in source}
    result, written = [], set()
    current = {r[:2]: r for r in target if r[5] in (None, OPEN)}
    for key in incoming.keys() | current.keys():
        new, old = incoming.get(key), current.get(key)
        rows = []
        if old is None:
            rows = [(*key, *new, run, OPEN, "Y")]
        else:
            closed = (*old[:5], run - DAY, "N")
            if close_blank and old[2:4] == (None, None) and new in (None, (None, None)):
                rows = [closed]
            elif new is None:
                rows = [closed if refresh == "full" else old]
            elif new == old[2:4]:
                rows = [old]
            else:
                rows = [(*key, *new, run, OPEN, "Y")]
                if old[4] != run:
                    rows.append(closed)
        result += rows
        written |= {(*r[:2], r[4]) for r in rows}
    result += [r for r in target if r[5] not in (None, OPEN) and (*r[:2], r[4]) not in written]
    return sorted(result, key=repr)


@pytest.mark.parametrize("small_source", [False, True])
@pytest.mark.parametrize("close_blank", [False, True])
@pytest.mark.parametrize("refresh", ["delta", "full"])
def test_snapshot(spark, rows, refresh, close_blank, small_source):
    source, target = generate(1)
    load = Load.of(refresh_type=refresh, **CALL)
    frames = spark.createDataFrame(source, SOURCE), spark.createDataFrame(target, TARGET)
    result = type2.next_snapshot(*frames, load, close_blank, small_source)
    assert rows(result) == model(source, target, refresh, close_blank)


@pytest.mark.parametrize("buckets", [None, 3])
def test_table_through_several_days(spark, rows, buckets):
    """Loads of one table, on the same day and the next, each against the model."""
    _, target = generate(2)
    # Rows without an end date have a test of their own.
    target = [(*r[:5], OPEN if r[5] is None else r[5], r[6]) for r in target]
    stored = dict(clustered_by=KEYS, buckets=buckets) if buckets else {}
    create_table(spark, "dim_random", COLUMNS, replace=True, partitioned_by=["end_date"], **stored)
    spark.createDataFrame(target, TARGET).select(*COLUMNS).write.insertInto("dim_random")
    for seed, refresh, day in ((3, "full", RUN), (4, "full", RUN), (3, "delta", RUN), (5, "full", RUN + DAY), (3, "full", RUN + DAY)):
        source, _ = generate(seed)
        call = {**CALL, "refresh_type": refresh, "run_date": day}
        result = load_dimension(spark.createDataFrame(source, SOURCE), "dim_random", **call)
        expected = model(source, target, refresh, run=day)
        assert rows(spark.table("dim_random"), *[c.split()[0] for c in TARGET.split(", ")]) == expected
        assert sum(result.keys.values()) == len({r[:2] for r in source} | {r[:2] for r in target if r[5] == OPEN})
        target = expected

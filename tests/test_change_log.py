"""Loads that compare digests, and dimensions kept as a base and a log of changes."""

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.functions.hashing import blank_digest, row_digest
from feedkit.operators.digest import DIGEST, changes_by_digest, scd2_by_digest, with_digest
from feedkit.operators.dimension import Load
from feedkit.operators.type2 import change_set, scd2, stats
from feedkit.plans import LoadRejected, change_log, create_logged, first_rows, fold, load_logged, merge_logged
from feedkit.sinks.files import location_of

COLUMNS = {"store_id": "VARCHAR", "location": "VARCHAR", "value": "INTEGER", "start_date": "DATE", "end_date": "DATE", "active_flag": "VARCHAR"}
STORE = "store_id string, location string, value int"
DIMENSION = STORE + ", start_date date, end_date date, active_flag string"
OPEN = datetime.date(9999, 12, 31)


def load_of(refresh="delta", run="2023-05-10"):
    return Load.of(["store_id"], "start_date", "end_date", "active_flag", refresh, run)


def some_rows(deal, n, day):
    keys = deal.sample([f"S{k:03}" for k in range(40)], n)
    return [(k, deal.choice(["London", "York", None]), deal.choice([1, 2, None]), datetime.date(2023, 1, deal.randrange(1, day)), OPEN, "Y") for k in keys]


@pytest.mark.parametrize("refresh", ["delta", "full"])
@pytest.mark.parametrize("close_blank", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_by_digest_is_the_load(spark, rows, refresh, close_blank, seed):
    """Also where digests are missing, or those of other rows."""
    deal = random.Random(seed)
    target = some_rows(deal, 25, 20) + [("S001", "old", 1, datetime.date(2022, 1, 1), datetime.date(2022, 12, 31), "N")]
    target[3] = (*target[3][:3], datetime.date(2023, 5, 10), OPEN, "Y")
    source = spark.createDataFrame([r[:3] for r in some_rows(deal, 20, 20)] + [("S900", None, None)], STORE)
    held, load = spark.createDataFrame(target, DIMENSION), load_of(refresh)
    digested = with_digest(held, load).withColumn(DIGEST, F.when(F.hash("store_id") % 5 == 0, None).when(F.hash("store_id") % 5 == 1, F.unhex(F.md5(F.lit("x")))).otherwise(F.col(DIGEST)))
    changes = changes_by_digest(source, digested, load, close_blank)
    assert rows(changes.rows.drop(DIGEST)) == rows(change_set(source, held, load, close_blank))
    assert changes.keys == dict.fromkeys(changes.keys, 0) | {r["action"]: r["n"] for r in stats(source, held, load, close_blank).collect()}
    whole = scd2(source, held, ["store_id"], "start_date", "end_date", "active_flag", refresh, "2023-05-10", close_blank=close_blank)
    assert rows(scd2_by_digest(source, digested, load, close_blank).drop(DIGEST)) == rows(whole)
    assert rows(with_digest(changes.rows.drop(DIGEST), load)) == rows(changes.rows)


def test_the_first_join_moves_digests_alone_and_whole_rows_are_those_of_keys_that_differ(spark, tmp_path):
    held = with_digest(spark.createDataFrame(some_rows(random.Random(3), 30, 20), DIMENSION), load_of())
    held.write.parquet(str(tmp_path / "held"))
    target = spark.read.parquet(str(tmp_path / "held"))
    source = target.select("store_id", "location", F.when(F.col("store_id") < "S005", 7).otherwise(F.col("value")).alias("value"))
    changes = changes_by_digest(source, target, load_of("full"))
    plan = changes.rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2  # either side, whole, meets the changed keys first
    assert "FullOuter" in plan and plan.index("FullOuter") < plan.index("LeftSemi")
    assert changes.keys["same"] + changes.keys["version"] == 30


def test_digests_keep_values_apart(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        frame = spark.sql("""SELECT * FROM VALUES
            (timestamp_micros(1698537600000000), array('a, b'), named_struct('x', 1, 'y', CAST(NULL AS INT)), 'a', CAST(NULL AS STRING), X'00'),
            (timestamp_micros(1698541200000000), array('a, b'), named_struct('x', 1, 'y', CAST(NULL AS INT)), 'a', CAST(NULL AS STRING), X'00'),
            (timestamp_micros(1698537600000000), array('a', 'b'), named_struct('x', 1, 'y', CAST(NULL AS INT)), 'a', CAST(NULL AS STRING), X'00'),
            (timestamp_micros(1698537600000000), array('a, b'), named_struct('x', CAST(NULL AS INT), 'y', 1), 'a', CAST(NULL AS STRING), X'00'),
            (timestamp_micros(1698537600000000), array('a, b'), named_struct('x', 1, 'y', CAST(NULL AS INT)), CAST(NULL AS STRING), 'a', X'00'),
            (timestamp_micros(1698537600000000), array('a, b'), named_struct('x', 1, 'y', CAST(NULL AS INT)), 'a', CAST(NULL AS STRING), X'01'),
            (timestamp_micros(1698537600000000), array('a, b'), named_struct('x', 1, 'y', CAST(NULL AS INT)), 'a', '~', X'00'),
            (CAST(NULL AS TIMESTAMP), CAST(NULL AS ARRAY<STRING>), CAST(NULL AS STRUCT<x INT, y INT>), CAST(NULL AS STRING), CAST(NULL AS STRING), CAST(NULL AS BINARY))
            AS t(at, list, pair, one, two, raw)""")
        found = [bytes(r[0]) for r in frame.select(row_digest(frame.schema.fields)).collect()]
        assert len(set(found)) == len(found) == 8 and {len(x) for x in found} == {16}
        assert bytes(spark.range(1).select(blank_digest(6)).first()[0]) == found[-1]
        again = T.StructType(list(reversed(frame.schema.fields)))
        assert [bytes(r[0]) for r in frame.select(row_digest(again.fields)).collect()] == found
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


# ---------------------------------------------------------------- logs


@pytest.fixture
def dimension(spark):
    names = []

    def new():
        name = f"logged_{random.randrange(1 << 40)}"
        create_logged(spark, name, COLUMNS, ["store_id"], "start_date", "end_date")
        names.append(name)
        return name

    yield new
    for name in names:
        spark.sql(f"DROP VIEW {name}")
        for row in spark.sql(f"SHOW TABLES LIKE '{name}__*'").collect():
            spark.sql(f"DROP TABLE {row['tableName']}")


def size_of(folder):
    folder = folder.removeprefix("file:")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet"))


def test_loads_one_after_the_other(spark, rows, dimension):
    """Against loads of whole frames, folded now and then."""
    deal, name = random.Random(5), dimension()
    whole = spark.createDataFrame(some_rows(deal, 20, 9), DIMENSION)
    first_rows(whole, name, "active_flag")
    held = whole.collect()
    for k in range(7):
        source = spark.createDataFrame([r[:3] for r in some_rows(deal, 25, 9)], STORE)
        refresh, run = deal.choice(["delta", "full"]), f"2023-05-{10 + k // 2}"  # two loads a day
        result = load_logged(source, name, "active_flag", refresh, run)
        want = scd2(source, spark.createDataFrame(held, DIMENSION), ["store_id"], "start_date", "end_date", "active_flag", refresh, run)
        counts = {r["action"]: r["n"] for r in stats(source, spark.createDataFrame(held, DIMENSION), load_of(refresh, run)).collect()}
        held = want.collect()
        assert rows(spark.table(name)) == rows(want)
        assert {a: n for a, n in result.keys.items() if n} == counts
        if k in (1, 4):
            fold(spark, name)
            fold(spark, name)
            assert rows(spark.table(name)) == rows(want)
    tables = {r["tableName"] for r in spark.sql(f"SHOW TABLES LIKE '{name}__*'").collect()}
    assert tables == {f"{name}__log", f"{name}__base_3", f"{name}__base_6"}
    assert change_log._numbers(spark, change_log.logged(spark, name)) == [4, 5, 6, 7, 8]


def test_a_load_writes_what_it_changes(spark, dimension):
    name = dimension()
    rows = spark.range(20_000).selectExpr("concat('S', id) AS store_id", "uuid() AS location", "CAST(id AS INT) AS value", "DATE'2023-01-01' AS start_date", "DATE'9999-12-31' AS end_date", "'Y' AS active_flag")
    first_rows(rows, name, "active_flag")
    log = location_of(spark, f"{name}__log")
    before = size_of(log)
    source = spark.table(name).select("store_id", "location", F.when(F.col("value") < 20, -1).otherwise(F.col("value")).alias("value"))
    assert load_logged(source, name, "active_flag", "full", "2023-05-10").keys["version"] == 20
    assert size_of(log) - before < before / 50
    assert spark.read.parquet(f"{log}/load_number=2").count() == 40
    load_logged(spark.table(name).where("active_flag = 'Y'").select("store_id", "location", "value"), name, "active_flag", "full", "2023-05-11")
    assert sorted(os.listdir(log.removeprefix("file:"))) == ["load_number=1", "load_number=2"]  # nothing changed


def test_cut_and_refused_loads(spark, rows, dimension, monkeypatch):
    name = dimension()
    source = spark.createDataFrame([("A", "London", 1), ("B", "York", 2)], STORE)
    with monkeypatch.context() as cut:
        cut.setattr(change_log, "location_of", lambda *a: (_ for _ in ()).throw(RuntimeError("cut")))
        with pytest.raises(RuntimeError, match="cut"):
            load_logged(source, name, "active_flag", "delta", "2023-05-10")
    assert spark.table(name).count() == 0
    # files of a load that did not come to its commit
    folder = f"{location_of(spark, f'{name}__log')}/load_number=1"
    spark.range(5).write.parquet(folder)
    assert spark.table(name).count() == 0
    load_logged(source, name, "active_flag", "delta", "2023-05-10")
    assert spark.table(name).count() == 2
    with pytest.raises(LoadRejected, match="occur more than once"):
        load_logged(source.unionByName(source), name, "active_flag", "delta", "2023-05-11")
    with pytest.raises(LoadRejected, match="before the latest start"):
        load_logged(source, name, "active_flag", "delta", "2023-01-11")
    assert spark.table(name).count() == 2
    with pytest.raises(ValueError, match="no dimension with a log"):
        load_logged(source, f"{name}__log", "active_flag")


def test_a_cut_fold_changes_nothing_and_readers_keep_their_base(spark, rows, dimension, monkeypatch):
    name = dimension()
    for k in range(3):
        source = spark.createDataFrame([("A", f"place {k}", 1), (f"B{k}", "York", 2)], STORE)
        load_logged(source, name, "active_flag", "delta", f"2023-05-1{k}")
    before = rows(spark.table(name))
    with monkeypatch.context() as cut:
        cut.setattr(change_log.Logged, "show", lambda *a: (_ for _ in ()).throw(RuntimeError("cut")))
        with pytest.raises(RuntimeError):
            fold(spark, name)
    assert rows(spark.table(name)) == before
    reading = spark.table(name).toLocalIterator()
    next(reading)
    fold(spark, name)
    assert len(list(reading)) == len(before) - 1
    assert rows(spark.table(name)) == before
    plan = spark.table(name).where("end_date = DATE'9999-12-31'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(end_date" in plan


def test_merge_in_place(spark, rows, dimension):
    name, day = dimension(), datetime.date(2023, 1, 1)
    first = [("A", "x", 1, day, OPEN, "Y"), ("B", "x", 1, None, OPEN, "Y")]
    assert merge_logged(spark.createDataFrame(first, DIMENSION), name, "active_flag") == 1
    changes = [("A", "y", 2, day, OPEN, "Y"), ("B", "z", 3, None, OPEN, "Y"), ("A", "x", 1, datetime.date(2022, 1, 1), day, "N")]
    frame = spark.createDataFrame(changes, DIMENSION)
    assert merge_logged(frame.select(*[c.upper() for c in reversed(frame.columns)]), name, "active_flag") == 2
    assert rows(spark.table(name)) == sorted(changes, key=repr)
    assert merge_logged(frame.limit(0), name, "active_flag") == 0
    with pytest.raises(ValueError, match="several changes of one row"):
        merge_logged(frame.unionByName(frame), name, "active_flag")
    with pytest.raises(ValueError, match="only one of changes"):
        merge_logged(frame.drop("value"), name, "active_flag")

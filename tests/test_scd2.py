import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from feedkit.operators import quality
from feedkit.operators import type2 as steps
from feedkit.operators.dimension import Load
from feedkit.operators.type2 import scd2
from feedkit.plans import LoadRejected, create_dimension, create_snapshot, dimension_load, load_dimension
from feedkit.sinks import create_table
from feedkit.workdir import shared_folder

RUN = "2023-05-10"
STORE = "store_id string, location string, value int"
DIMENSION = STORE + ", start_date date, end_date date, active_flag string"
CALL = dict(keys=["store_id"], start_col="start_date", end_col="end_date", flag_col="active_flag", run_date=RUN)

FEED = [
    ("A0001", "London", 1000),
    ("B0001", "US", 2000),
    ("C0001", "Southampton", 2500),
    ("D0001", "Leeds", 1500),
    ("E0001", "London", 3500),
]
SOURCE = [("A0001", "London", 1000), ("B0001", "US", 2500), ("D0001", "Leeds", 1600), ("E0001", "York", 900)]


def d(text):
    return datetime.date.fromisoformat(text)


OPEN = d("9999-12-31")
TARGET = [
    ("A0001", "London", 1000, d("2023-01-01"), OPEN, "Y"),
    ("B0001", "US", 1800, d("2022-01-01"), d("2022-12-31"), "N"),
    ("B0001", "US", 2000, d("2023-01-01"), OPEN, "Y"),
    ("C0001", "Southampton", 2500, d("2023-01-01"), OPEN, "Y"),
    ("D0001", "Leeds", 1500, d("2023-05-10"), OPEN, "Y"),
]
COMMON = [
    ("A0001", "London", 1000, d("2023-01-01"), OPEN, "Y"),
    ("B0001", "US", 1800, d("2022-01-01"), d("2022-12-31"), "N"),
    ("B0001", "US", 2000, d("2023-01-01"), d("2023-05-09"), "N"),
    ("B0001", "US", 2500, d(RUN), OPEN, "Y"),
    ("D0001", "Leeds", 1600, d(RUN), OPEN, "Y"),
    ("E0001", "York", 900, d(RUN), OPEN, "Y"),
]
AFTER = {
    "delta": sorted([*COMMON, ("C0001", "Southampton", 2500, d("2023-01-01"), OPEN, "Y")], key=repr),
    "full": sorted([*COMMON, ("C0001", "Southampton", 2500, d("2023-01-01"), d("2023-05-09"), "N")], key=repr),
}


@pytest.fixture
def source(spark):
    return spark.createDataFrame(SOURCE, STORE)


@pytest.fixture
def target(spark):
    return spark.createDataFrame(TARGET, DIMENSION)


def test_first_load(spark, rows):
    result = scd2(spark.createDataFrame(FEED, STORE), spark.createDataFrame([], DIMENSION), **CALL)
    assert rows(result) == [(*f, d(RUN), OPEN, "Y") for f in FEED]


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("refresh", ["delta", "full", " FULL "])
def test_change(source, target, rows, refresh, small):
    result = scd2(source, target, refresh_type=refresh, small_source=small, **CALL)
    assert rows(result) == AFTER[refresh.strip().lower()]


def test_small_source_takes_the_same_actions(source, target, rows):
    load = Load.of(**CALL)
    for blank in (False, True):
        expected = rows(steps.classify(source, target, load, blank))
        assert rows(steps.classify(source, target, load, blank, small_source=True)) == expected


@pytest.mark.parametrize("refresh", ["delta", "full"])
def test_rerun_changes_nothing(spark, source, rows, refresh):
    before = spark.createDataFrame(AFTER[refresh], DIMENSION)
    assert rows(scd2(source, before, refresh_type=refresh, **CALL)) == AFTER[refresh]


def test_closed_and_reopened_on_one_day(spark, source, target, rows):
    once = scd2(source, target, refresh_type="full", **CALL)
    closed = scd2(source.where("store_id <> 'E0001'"), once, refresh_type="full", **CALL)
    assert rows(closed.where("store_id = 'E0001'")) == [("E0001", "York", 900, d(RUN), d("2023-05-09"), "N")]
    again = scd2(source, closed, refresh_type="full", **CALL)
    assert rows(again) == AFTER["full"]


def test_only_rows_with_the_same_key_and_start_are_replaced(spark, rows):
    history = [("A", "x", i, d(RUN), d("2023-05-09"), "N") for i in range(200)]
    history += [("A", "x", 1, d("2023-01-01"), d("2023-02-01"), "N"), ("B", "y", 1, d(RUN), d("2023-05-09"), "N")]
    target = spark.createDataFrame(history, DIMENSION)
    source = spark.createDataFrame([("A", "new", 0)], STORE)
    assert rows(scd2(source, target, **CALL)) == [
        ("A", "new", 0, d(RUN), OPEN, "Y"), *history[-2:],
    ]
    assert rows(scd2(source, target, same_day=False, **CALL)) == sorted(
        [*history, ("A", "new", 0, d(RUN), OPEN, "Y")], key=repr
    )


def test_names_match_without_regard_to_case(source, target, rows):
    shouted = source.toDF(*[c.upper() for c in source.columns])
    call = {**CALL, "keys": ["Store_ID"], "start_col": "START_DATE", "end_col": "End_Date", "flag_col": "ACTIVE_flag"}
    result = scd2(shouted, target, **call)
    assert result.columns == target.columns
    assert rows(result) == AFTER["delta"]


def test_source_of_strings_takes_the_target_types(spark, target, rows):
    text = spark.createDataFrame([(a, b, str(c)) for a, b, c in SOURCE], "store_id string, location string, value string")
    assert rows(scd2(text, target, **CALL)) == AFTER["delta"]


def test_null_against_value_is_a_change_and_null_against_null_is_not(spark, rows):
    source = spark.createDataFrame([("A", None, 1), ("B", "x", None)], STORE)
    target = spark.createDataFrame(
        [("A", None, 1, d("2023-01-01"), OPEN, "Y"), ("B", None, None, d("2023-01-01"), OPEN, "Y")], DIMENSION
    )
    load = Load.of(**CALL)
    assert rows(steps.classify(source, target, load)) == [("A", "same"), ("B", "version")]


def test_values_do_not_run_together(spark, rows):
    """('a', null) and (null, 'a') joined by commas without nulls would look the same."""
    schema = "k int, p string, q string"
    source = spark.createDataFrame([(1, "a", None), (2, "a,b", "c")], schema)
    target = spark.createDataFrame(
        [(1, None, "a", d("2023-01-01"), OPEN, "Y"), (2, "a", "b,c", d("2023-01-01"), OPEN, "Y")],
        schema + ", start_date date, end_date date, active_flag string",
    )
    load = Load.of(**{**CALL, "keys": ["k"]})
    assert rows(steps.classify(source, target, load)) == [(1, "version"), (2, "version")]


def test_open_interval(spark, source, rows):
    target = spark.createDataFrame([("A0001", "Paris", 1, d("2023-01-01"), None, "Y")], DIMENSION)
    result = scd2(source.where("store_id = 'A0001'"), target, **{**CALL, "active_end_date": None})
    assert rows(result) == [
        ("A0001", "London", 1000, d(RUN), None, "Y"),
        ("A0001", "Paris", 1, d("2023-01-01"), d("2023-05-09"), "N"),
    ]


def test_missing_start_date_counts_as_the_first_day(spark, source, rows):
    target = spark.createDataFrame([("A0001", "Paris", 1, None, OPEN, "Y")], DIMENSION)
    result = scd2(source.where("store_id = 'A0001'"), target, **CALL)
    assert ("A0001", "Paris", 1, None, d("2023-05-09"), "N") in rows(result)


def test_blank_rows_are_closed_once_on_request(spark, rows):
    source = spark.createDataFrame([("A", None, None), ("B", "x", 1)], STORE)
    blank = [("A", None, None), ("B", None, None), ("C", None, None)]
    target = spark.createDataFrame([(*b, d("2023-01-01"), OPEN, "Y") for b in blank], DIMENSION)
    load = Load.of(**CALL)
    assert len(rows(steps.blank_rows(target, load))) == 3
    assert rows(steps.classify(source, target, load, close_blank=True)) == [
        ("A", "blank"), ("B", "version"), ("C", "blank"),
    ]
    closed = [(*b, d("2023-01-01"), d("2023-05-09"), "N") for b in blank]
    expected = sorted([*closed, ("B", "x", 1, d(RUN), OPEN, "Y")], key=repr)
    assert rows(scd2(source, target, close_blank=True, **CALL)) == expected


def test_steps(source, target, rows):
    load = Load.of(**CALL)
    assert [r[0] for r in rows(steps.active(target, load))] == ["A0001", "B0001", "C0001", "D0001"]
    assert [r[0] for r in rows(steps.changed(source, target, load))] == ["B0001", "D0001"]
    assert [r[0] for r in rows(steps.new_rows(source, target, load))] == ["E0001"]
    assert [r[0] for r in rows(steps.to_close(source, target, load))] == ["B0001"]
    assert [r[0] for r in rows(steps.missing(source, target, load))] == ["C0001"]
    assert rows(steps.stats(source, target, load)) == [
        ("inplace", 1), ("insert", 1), ("missing", 1), ("same", 1), ("version", 1),
    ]
    changes = steps.change_set(source, target, load)
    assert changes.columns == target.columns
    assert [r[0] for r in rows(changes)] == ["B0001", "B0001", "D0001", "E0001"]


def test_closed_and_opened_rows_make_the_change_set(source, target, rows):
    load = Load.of(**{**CALL, "refresh_type": "full"})
    changed, new = steps.changed(source, target, load), steps.new_rows(source, target, load)
    by_step = (
        steps.closed(steps.to_close(source, target, load), load)
        .unionByName(steps.closed(steps.missing(source, target, load), load))
        .unionByName(steps.opened(changed.unionByName(new), target, load))
    )
    assert rows(by_step) == rows(steps.change_set(source, target, load))


def test_one_join_and_no_shuffle_of_history(spark, source, target, tmp_path):
    source.write.parquet(str(tmp_path / "s"))
    target.write.parquet(str(tmp_path / "t"))
    stored_source, stored_target = spark.read.parquet(str(tmp_path / "s")), spark.read.parquet(str(tmp_path / "t"))
    outputs = steps.current_rows(stored_source, stored_target, Load.of(**CALL))
    plan = outputs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1 and plan.count("Exchange") == 2


def test_small_source_leaves_the_target_in_place(spark, source, target, tmp_path):
    source.write.parquet(str(tmp_path / "s"))
    target.write.parquet(str(tmp_path / "t"))
    stored_source, stored_target = spark.read.parquet(str(tmp_path / "s")), spark.read.parquet(str(tmp_path / "t"))
    outputs = steps.current_rows(stored_source, stored_target, Load.of(**CALL), small_source=True)
    plan = outputs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    assert all("hashpartitioning" not in line for line in plan.splitlines())


def test_unknown_refresh_type_is_refused(source, target):
    with pytest.raises(ValueError, match="neither delta nor full"):
        scd2(source, target, refresh_type="partial", **CALL)


# ---------------------------------------------------------------- generated changes


def test_invariants(spark):
    base = spark.range(500).selectExpr(
        "id AS k", "CAST(id DIV 7 AS string) AS p", "IF(id % 5 = 0, NULL, id % 3) AS q"
    )
    target = base.where("k % 10 <> 0").selectExpr(
        "*",
        "IF(k % 4 = 0, DATE'2023-05-10', DATE'2023-01-01') AS start_date",
        "DATE'9999-12-31' AS end_date",
        "'Y' AS active_flag",
    )
    source = base.where("k % 7 <> 0").selectExpr("k", "p", "IF(k % 6 = 0, 99, q) AS q")
    call = {**CALL, "keys": ["k"]}
    for refresh in ("delta", "full"):
        result = scd2(source, target, refresh_type=refresh, **call)
        live = result.where("active_flag = 'Y'")
        assert live.count() == live.select("k").distinct().count()
        assert result.count() >= target.count()
        assert result.where("end_date < start_date AND start_date <> DATE'2023-05-10'").count() == 0
        keys = {r[0] for r in live.select("k").collect()}
        of_source, of_target = ({r[0] for r in f.select("k").collect()} for f in (source, target))
        assert keys == (of_source if refresh == "full" else of_source | of_target)
        again = scd2(source, result, refresh_type=refresh, **call)
        assert again.exceptAll(result).count() == 0 and result.exceptAll(again).count() == 0


# ---------------------------------------------------------------- checks


def failed(source, target, **changes):
    report = quality.report(source, target, Load.of(**{**CALL, **changes}))
    return {r["check"] for r in report.where("NOT passed").collect()}


def test_checks_pass_with_history_of_a_key(source, target):
    assert failed(source, target) == set()


@pytest.mark.parametrize(
    "changes, expected",
    [
        (dict(start_col=""), {"start_column_given", "start_column_in_target", "same_columns"}),
        (dict(end_col=" "), {"end_column_given", "end_column_in_target", "same_columns"}),
        (dict(flag_col=""), {"flag_column_given", "flag_column_in_target", "same_columns"}),
        (dict(start_col="begin"), {"start_column_in_target", "same_columns"}),
        (dict(keys=[]), {"keys_given"}),
        (dict(keys=["store_id", " STORE_ID "]), set()),
        (dict(keys=list("abcdef")), {"keys_in_target", "keys_in_source"}),
        (dict(keys=["store"]), {"keys_in_target", "keys_in_source"}),
        (dict(run_date="2023-05-09"), {"run_date_not_before_start"}),
        (dict(active_end_date="9000-01-01"), {"active_end_not_before_end"}),
    ],
)
def test_checks_on_arguments(source, target, changes, expected):
    assert failed(source, target, **changes) == expected


def test_number_of_keys_is_limited_on_request(source, target):
    report = quality.report(source, target, Load.of(**{**CALL, "keys": ["store_id", "value"]}), max_keys=1)
    assert "keys_at_most" in {r["check"] for r in report.where("NOT passed").collect()}


def test_checks_on_columns(spark, source, target):
    empty = spark.createDataFrame([()], "struct<>")
    assert "source_has_columns" in failed(empty, target)
    assert "target_has_columns" in failed(source, empty)
    assert failed(source.drop("value"), target) == {"same_columns"}


def test_checks_on_rows(spark, source, target):
    assert failed(source.union(source), target) == {"source_keys_unique"}
    twice = target.where("active_flag = 'Y'").union(target)
    assert failed(source, twice) == {"target_keys_unique"}
    no_key = spark.createDataFrame([(None, "x", 1)], STORE)
    assert failed(source.union(no_key), target) == {"source_keys_not_null"}
    assert failed(source, target.limit(0)) == set()


def test_duplicate_keys_and_max_dates(source, target, rows):
    assert rows(quality.duplicate_keys(source.union(source.limit(1)), ["store_id"])) == [("A0001", 2)]
    assert rows(quality.max_dates(target, Load.of(**CALL))) == [(d(RUN), OPEN)]


# ---------------------------------------------------------------- commit


COLUMNS = {
    "store_id": "VARCHAR(5)", "location": "VARCHAR(100)", "value": "INTEGER",
    "start_date": "DATE", "active_flag": "CHAR", "end_date": "DATE",
}
ORDER = DIMENSION.replace(" string", "").replace(" int", "").replace(" date", "").split(", ")


def fill_buckets(spark, name, target, n=8):
    create_dimension(spark, name, COLUMNS, "end_date", n, replace=True)
    rows = target.withColumn("key_bucket", F.pmod(F.xxhash64("store_id"), F.lit(n)).cast("int"))
    rows.select(*spark.table(name).columns).write.insertInto(name)


@pytest.fixture(params=["partitions", "buckets", "key_buckets", "snapshot", "plain"])
def table(spark, request, target):
    name = f"dim_{request.param}"
    if request.param == "snapshot":
        spark.sql(f"DROP VIEW IF EXISTS {name}")
        create_snapshot(target, name)
    elif request.param == "plain":
        target.write.mode("overwrite").saveAsTable(name)
    elif request.param == "key_buckets":
        fill_buckets(spark, name, target)
    else:
        stored_by_key = dict(clustered_by=["store_id"], buckets=4) if request.param == "buckets" else {}
        create_table(spark, name, COLUMNS, replace=True, partitioned_by=["end_date"], **stored_by_key)
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
        target.select(*COLUMNS).write.insertInto(name)
    return name


@pytest.mark.parametrize("refresh", ["delta", "full"])
def test_load(spark, source, table, rows, refresh):
    call = {**CALL, "refresh_type": refresh}
    result = load_dimension(source, table, **call)
    assert rows(spark.table(table), *ORDER) == AFTER[refresh]
    assert result.keys == {"insert": 1, "same": 1, "version": 1, "inplace": 1, "missing": 1, "blank": 0}
    again = load_dimension(source, table, stage_source=False, **call)
    assert rows(spark.table(table), *ORDER) == AFTER[refresh]
    assert again.keys["same"] + again.keys["missing"] == sum(again.keys.values())
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_load_that_closes_and_reopens(spark, source, table, rows):
    call = {**CALL, "refresh_type": "full"}
    load_dimension(source, table, **call)
    load_dimension(source.where("store_id <> 'E0001'"), table, **call)
    load_dimension(source, table, **call)
    assert rows(spark.table(table), *ORDER) == AFTER["full"]


def test_load_that_closes_everything(spark, source, table, rows):
    load_dimension(source.limit(0), table, **{**CALL, "refresh_type": "full"})
    assert spark.table(table).count() == len(TARGET)
    assert spark.table(table).where("active_flag = 'Y' OR end_date = DATE'9999-12-31'").count() == 0
    load_dimension(source.limit(1), table, **{**CALL, "run_date": "2023-05-11"})
    assert rows(spark.table(table).where("active_flag = 'Y'"), "store_id") == [("A0001",)]


def test_load_with_open_intervals(spark, source, target, rows):
    create_table(spark, "dim_open", COLUMNS, replace=True, partitioned_by=["end_date"])
    opened = target.selectExpr("store_id", "location", "value", "start_date",
                               "nullif(end_date, DATE'9999-12-31') AS end_date", "active_flag")
    opened.select(*COLUMNS).write.insertInto("dim_open")
    call = {**CALL, "refresh_type": "full", "active_end_date": None}
    load_dimension(source, "dim_open", **call)
    expected = sorted([(*r[:4], None if r[4] == OPEN else r[4], r[5]) for r in AFTER["full"]], key=repr)
    assert rows(spark.table("dim_open"), *ORDER) == expected
    load_dimension(source.limit(0), "dim_open", **call)
    assert spark.table("dim_open").where("end_date IS NULL").count() == 0
    assert spark.table("dim_open").count() == len(expected)


def test_large_source_loads_by_shuffle(spark, source, table, rows):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = load_dimension(source, table, **CALL)
        assert rows(spark.table(table), *ORDER) == AFTER["delta"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {**result.keys, "missing": 1} == {"insert": 1, "same": 1, "version": 1, "inplace": 1, "missing": 1, "blank": 0}


def test_load_completes_one_that_was_cut_short(spark, source, target, rows):
    """Closed rows written, active rows still as before: the state between the two partitions' commits."""
    create_table(spark, "dim_cut", COLUMNS, replace=True, partitioned_by=["end_date"])
    target.select(*COLUMNS).write.insertInto("dim_cut")
    half = spark.createDataFrame([r for r in AFTER["full"] if r[4] == d("2023-05-09")], DIMENSION)
    half.select(*COLUMNS).write.insertInto("dim_cut")
    load_dimension(source, "dim_cut", **{**CALL, "refresh_type": "full"})
    assert rows(spark.table("dim_cut"), *ORDER) == AFTER["full"]


def test_buckets_stay_few_files(spark, source, target):
    create_table(
        spark, "dim_files", COLUMNS, replace=True, partitioned_by=["end_date"], clustered_by=["store_id"], buckets=4
    )
    target.select(*COLUMNS).write.insertInto("dim_files")
    for run_date in (RUN, RUN, "2023-05-11"):
        load_dimension(source, "dim_files", **{**CALL, "run_date": run_date})
        files = spark.table("dim_files").where("end_date = DATE'9999-12-31'").inputFiles()
        buckets = [f.rsplit("_", 1)[1][:5] for f in files]
        # One of the join, one of the keys a small source brings in.
        assert all(buckets.count(b) <= 2 for b in buckets)


def test_bucketed_target_is_not_shuffled(spark, source, target):
    create_table(spark, "dim_local", COLUMNS, replace=True, partitioned_by=["end_date"], clustered_by=["store_id"], buckets=4)
    target.select(*COLUMNS).write.insertInto("dim_local")
    outputs = steps.current_rows(source, spark.table("dim_local"), Load.of(**CALL))
    plan = outputs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_load_leaves_other_history_unread(spark, source, target):
    create_table(spark, "dim_pruned", COLUMNS, replace=True, partitioned_by=["end_date"])
    target.select(*COLUMNS).write.insertInto("dim_pruned")
    files = "SELECT DISTINCT _metadata.file_path FROM dim_pruned WHERE end_date = DATE'2022-12-31'"
    before = spark.sql(files).collect()
    load_dimension(source, "dim_pruned", **CALL)
    assert spark.sql(files).collect() == before


def test_rejected_load_leaves_the_table(spark, source, table, rows):
    before = rows(spark.table(table))
    with pytest.raises(LoadRejected, match="more than once in the source"):
        load_dimension(source.union(source), table, **CALL)
    assert rows(spark.table(table)) == before


def test_load_into_another_kind_of_table(spark, source, target):
    target.write.mode("overwrite").partitionBy("active_flag").saveAsTable("dim_by_flag")
    with pytest.raises(ValueError, match="partitioned by active_flag"):
        load_dimension(source, "dim_by_flag", **CALL)


def test_replaced_table_leaves_no_others(spark, source, target):
    target.write.mode("overwrite").saveAsTable("dim_alone")
    load_dimension(source, "dim_alone", **CALL)
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("dim_alone")] == ["dim_alone"]


def test_merge_in_place_needs_a_catalog_for_it(spark, source, target):
    from feedkit.operators import merge_into

    spark.sql("DROP TABLE IF EXISTS dim_merge")
    target.write.saveAsTable("dim_merge")
    with pytest.raises(PySparkException, match="MERGE"):
        merge_into(target, "dim_merge", ["store_id"], "start_date")


# ---------------------------------------------------------------- interruptions


class CutShort(Exception):
    pass


@pytest.mark.parametrize("kind", ["partitions", "key_buckets"])
@pytest.mark.parametrize("refresh", ["delta", "full"])
def test_load_cut_short_anywhere_is_completed_by_the_next(spark, source, target, rows, monkeypatch, kind, refresh):
    """Stopped before each change of the catalog in turn: no row is out of reach, and a rerun gives the whole result."""
    point, call = dimension_load._point, {**CALL, "refresh_type": refresh}
    steps_seen = 0
    for stop in range(12):
        name = f"dim_cut_{kind}"
        if kind == "partitions":
            create_table(spark, name, COLUMNS, replace=True, partitioned_by=["end_date"])
            target.select(*COLUMNS).write.insertInto(name)
        else:
            fill_buckets(spark, name, target)
        done = []

        def stopping(*args, done=done, stop=stop):
            if len(done) == stop:
                raise CutShort
            point(*args)
            done.append(args[2])

        monkeypatch.setattr(dimension_load, "_point", stopping)
        try:
            load_dimension(source, name, **call)
            finished = True
        except CutShort:
            finished = False
        monkeypatch.setattr(dimension_load, "_point", point)
        steps_seen = max(steps_seen, len(done))
        spark.catalog.refreshTable(name)
        keys = {r[0] for r in spark.table(name).select("store_id").collect()}
        assert {r[0] for r in TARGET} <= keys  # of every key a version can be read at any time
        load_dimension(source, name, **call)
        assert rows(spark.table(name), *ORDER) == AFTER[refresh], stop
        if finished:
            break
    assert steps_seen >= 2


def test_closed_rows_of_an_earlier_load_outlive_an_interruption(spark, source, target, rows, monkeypatch):
    """The partition of closed rows is there already; the state in which it was lost for good."""
    create_table(spark, "dim_twice", COLUMNS, replace=True, partitioned_by=["end_date"])
    target.select(*COLUMNS).write.insertInto("dim_twice")
    load_dimension(source, "dim_twice", **CALL)
    closed = set(rows(spark.table("dim_twice").where("active_flag = 'N'"), *ORDER))
    changed = source.withColumn("value", F.col("value") + 1)

    def stopped(*_):
        raise CutShort

    point = dimension_load._point
    for at in range(3):
        calls = []
        monkeypatch.setattr(dimension_load, "_point", lambda *a, at=at, calls=calls: stopped() if len(calls) == at else (point(*a), calls.append(1)))
        try:
            load_dimension(changed, "dim_twice", **CALL)
        except CutShort:
            pass
        monkeypatch.setattr(dimension_load, "_point", point)
        assert closed <= set(rows(spark.table("dim_twice"), *ORDER))


def test_delta_leaves_untouched_buckets_in_place(spark, source, target, rows):
    fill_buckets(spark, "dim_touched", target, 64)
    files = "SELECT _metadata.file_path AS f, key_bucket AS b FROM dim_touched WHERE end_date = DATE'9999-12-31'"
    before = {r["f"]: r["b"] for r in spark.sql(files).collect()}
    some = source.where("store_id = 'A0001'").withColumn("value", F.lit(77))
    load_dimension(some, "dim_touched", **CALL)
    after = {r["f"]: r["b"] for r in spark.sql(files).collect()}
    changed = spark.range(1).select(F.pmod(F.xxhash64(F.lit("A0001")), F.lit(64))).first()[0]
    assert {f for f, b in before.items() if b != changed} == {f for f, b in after.items() if b != changed}
    assert {f for f, b in before.items() if b == changed}.isdisjoint(after)
    again = spark.sql(files).collect()
    load_dimension(some, "dim_touched", **CALL)  # nothing changes: nothing is replaced
    assert sorted(map(tuple, spark.sql(files).collect())) == sorted(map(tuple, again))


def test_nothing_is_left_behind(spark, source, target):
    import os

    create_table(spark, "dim_tidy", COLUMNS, replace=True, partitioned_by=["end_date"])
    target.select(*COLUMNS).write.insertInto("dim_tidy")
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    for run_date in (RUN, RUN, "2023-05-11"):
        load_dimension(source, "dim_tidy", **{**CALL, "run_date": run_date})
    assert set(os.listdir(folder)) == before
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("dim_tidy")] == ["dim_tidy"]
    spark.sql("DROP VIEW IF EXISTS dim_views")
    create_snapshot(target, "dim_views")
    for run_date in (RUN, "2023-05-11", "2023-05-12", "2023-05-13"):
        load_dimension(source, "dim_views", **{**CALL, "run_date": run_date})
    assert len([t for t in spark.catalog.listTables() if t.name.startswith("dim_views__")]) == 2


def files_of(spark, name):
    """Data files below a table's folder, and those its partitions name."""
    import glob

    from feedkit.sinks.files import location_of

    root = location_of(spark, name).removeprefix("file:")
    below = {f for f in glob.glob(f"{root}/**/*.parquet", recursive=True)}
    return below, {f.removeprefix("file://").removeprefix("file:") for f in spark.table(name).inputFiles()}


def dimension_of(spark, name, kind, rows):
    if kind == "key_buckets":
        fill_buckets(spark, name, rows, 8)
    else:
        create_table(spark, name, COLUMNS, replace=True, partitioned_by=["end_date"])
        rows.select(*COLUMNS).write.insertInto(name)


@pytest.mark.parametrize("kind", ["partitions", "key_buckets"])
def test_files_are_named_by_partitions_or_kept_for_readers_of_the_state_before(spark, rows, kind):
    name = f"dim_files_{kind}"
    many = spark.range(400).selectExpr("concat('K', id) AS store_id", "'x' AS location", "CAST(id AS INT) AS value", "DATE'2023-01-01' AS start_date", "DATE'9999-12-31' AS end_date", "'Y' AS active_flag")
    dimension_of(spark, name, kind, many)
    some = many.select("store_id", "location", "value").where("value < 300")
    sizes = []
    for k, day in enumerate(["2023-05-10", "2023-05-11", "2023-05-11", "2023-05-12"]):
        _, named_before = files_of(spark, name)
        reading = spark.table(name).toLocalIterator()
        next(reading)
        expected = spark.table(name).count() - 1
        source = some.withColumn("value", F.when(F.col("value") < 2, F.col("value") + 1000 * (k + 1)).otherwise(F.col("value")))
        result = load_dimension(source, name, **{**CALL, "run_date": day})
        assert result.keys["missing"] == 100
        assert len(list(reading)) == expected  # a reader under way finishes
        below, named = files_of(spark, name)
        assert named <= below
        assert below - named <= named_before
        sizes.append(len(below))
        assert spark.table(name).where("active_flag = 'Y'").count() == 400
    assert sizes[-1] <= max(sizes[:2]) + 8
    before, _ = files_of(spark, name)
    load_dimension(source, name, **{**CALL, "run_date": "2023-05-13"})  # nothing changes
    below, named = files_of(spark, name)
    assert below == named <= before


def test_untouched_buckets_get_no_bytes(spark):
    many = spark.range(400).selectExpr("concat('K', id) AS store_id", "'x' AS location", "CAST(id AS INT) AS value", "DATE'2023-01-01' AS start_date", "DATE'9999-12-31' AS end_date", "'Y' AS active_flag")
    dimension_of(spark, "dim_bytes", "key_buckets", many)
    before, _ = files_of(spark, "dim_bytes")
    source = many.select("store_id", "location", F.when(F.col("value") == 7, -7).otherwise(F.col("value")).alias("value"))
    assert load_dimension(source, "dim_bytes", **CALL).keys["version"] == 1
    below, _ = files_of(spark, "dim_bytes")
    changed = spark.range(1).select(F.pmod(F.xxhash64(F.lit("K7")), F.lit(8))).first()[0]
    assert below - before and all(f"key_bucket={changed}/" in f for f in below - before)


@pytest.mark.parametrize("kind", ["partitions", "key_buckets"])
def test_cut_and_refused_loads_are_swept(spark, source, target, rows, monkeypatch, kind):
    import os

    name, shared = f"dim_swept_{kind}", shared_folder(spark).removeprefix("file:")
    dimension_of(spark, name, kind, target)
    staged = set(os.listdir(shared))
    with pytest.raises(LoadRejected):
        load_dimension(source.union(source), name, **CALL)
    point = dimension_load._point
    for stop in range(2):
        done = []

        def stopping(*args, done=done, stop=stop):
            if len(done) == stop:
                raise CutShort
            point(*args)
            done.append(1)

        monkeypatch.setattr(dimension_load, "_point", stopping)
        with pytest.raises(CutShort):
            load_dimension(source.withColumn("value", F.col("value") + stop), name, **CALL)
        monkeypatch.setattr(dimension_load, "_point", point)
    assert set(os.listdir(shared)) == staged
    load_dimension(source, name, **CALL)
    load_dimension(source.withColumn("value", F.lit(5)), name, **{**CALL, "run_date": "2023-05-11"})
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name}__")]
    _, kept = files_of(spark, name)
    load_dimension(source.withColumn("value", F.lit(5)), name, **{**CALL, "run_date": "2023-05-12"})
    below, named = files_of(spark, name)
    assert below == named == kept


def test_impossible_intervals_refuse_a_tables_first_load(spark, source, target):
    wrong = target.unionByName(spark.createDataFrame([("Z", "x", 1, d("2023-02-01"), d("2023-01-01"), "N")], DIMENSION))
    dimension_of(spark, "dim_wrong", "partitions", wrong)
    with pytest.raises(LoadRejected, match="end before the day before"):
        load_dimension(source, "dim_wrong", **CALL)
    dimension_of(spark, "dim_right", "partitions", target)
    load_dimension(source, "dim_right", **CALL)
    assert spark.sql("SHOW TBLPROPERTIES dim_right ('feedkit.intervals')").first()["value"] == "checked"


def test_latest_dates_from_footers(spark, target, tmp_path):
    target.write.parquet(str(tmp_path / "dim"))
    load = Load.of(**{**CALL, "start_col": "START_DATE"})
    found = quality.max_dates_of_files(spark, str(tmp_path / "dim"), load)
    assert found.collect() == quality.max_dates(spark.read.parquet(str(tmp_path / "dim")), load).collect()
    assert "PushedAggregation: [MAX(start_date), MAX(end_date)]" in found._jdf.queryExecution().executedPlan().toString()
    target.limit(0).write.parquet(str(tmp_path / "none"))
    assert tuple(quality.max_dates_of_files(spark, str(tmp_path / "none"), load).first()) == (None, None)
    with pytest.raises(ValueError, match="no date column location"):
        quality.max_dates_of_files(spark, str(tmp_path / "dim"), Load.of(**{**CALL, "start_col": "location"}))
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""  # the caller's session is as it was


def test_the_run_date_is_the_sessions(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("Pacific/Kiritimati", "Pacific/Pago_Pago"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            today = spark.sql("SELECT current_date()").first()[0]
            assert Load.of(["k"], "s", "e", "f").run_date == today
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_table_keeps_its_definition(spark, source, target, rows):
    spark.sql("DROP TABLE IF EXISTS dim_defined")
    spark.sql("""CREATE TABLE dim_defined (store_id STRING COMMENT 'the key', location STRING, value INT, start_date DATE, end_date DATE,
        active_flag STRING) USING orc CLUSTERED BY (store_id) INTO 4 BUCKETS COMMENT 'stores' TBLPROPERTIES ('owner.team' = 'x')""")
    target.write.insertInto("dim_defined")
    load_dimension(source, "dim_defined", **CALL)
    assert rows(spark.table("dim_defined"), *ORDER) == AFTER["delta"]
    about = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED dim_defined").collect()}
    assert (about["Provider"], about["Num Buckets"], about["Comment"]) == ("orc", "4", "stores")
    assert "owner.team=x" in about["Table Properties"]
    assert spark.sql("DESCRIBE dim_defined").first()["comment"] == "the key"


def test_scans_of_the_history_have_a_lower_bound(spark, source, target):
    create_table(spark, "dim_bound", COLUMNS, replace=True, partitioned_by=["end_date"])
    target.select(*COLUMNS).write.insertInto("dim_bound")
    load, stored = Load.of(**CALL), spark.table("dim_bound")
    late = quality._latest_after(stored.where(f"end_date IS NULL OR end_date >= {load.run}"), load.start, load.run)
    for frame in (late, quality.data_checks(source, stored, load)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "FileScan" in line and "dim_bound" in line]
        assert scans and all("PartitionFilters: []" not in line for line in scans)
    assert quality.impossible_intervals(stored, load).count() == 0


def test_values_of_any_type_can_be_loaded(spark, rows):
    schema = "k int, v array<int>, start_date date, end_date date, active_flag string"
    spark.sql("DROP TABLE IF EXISTS dim_arrays")
    spark.createDataFrame([(1, [1], d("2023-01-01"), OPEN, "Y")], schema).write.saveAsTable("dim_arrays")
    source = spark.createDataFrame([(1, [1, 2]), (2, None)], "k int, v array<int>")
    for small in (False, True):
        load_dimension(source, "dim_arrays", **{**CALL, "keys": ["k"]}, small_source=small)
        assert rows(spark.table("dim_arrays").where("active_flag = 'Y'"), "k", "v") == [(1, [1, 2]), (2, None)]


def test_row_level_load_goes_by_merge(spark, source, target, rows):
    spark.sql("DROP TABLE IF EXISTS dim_rows")
    target.write.saveAsTable("dim_rows")
    with pytest.raises(PySparkException, match="MERGE"):
        load_dimension(source, "dim_rows", **CALL, row_level=True)
    assert rows(spark.table("dim_rows"), *ORDER) == rows(target, *ORDER)

"""Load a Type-2 dimension table: check, work out the change, commit.

Every commit writes new files beside the old ones and then changes the catalog, so that a load which is cut
short leaves no row out, and is completed by running it again with the same source and run date:

* A table partitioned by its end date gets new locations for the partitions that a load changes: that of
  the rows it closed first, that of the active rows last. All other history is neither read nor written.
  With the key's bucket as a second partition column (``create_dimension``) only the active partitions of
  buckets with a change are replaced, and only those of the source's keys are read in a delta load.
* A view over a snapshot table is switched to a newly written snapshot, and a table without partitions
  gets a new location. The whole dimension is rewritten; the switch is a single catalog change.
* A table whose catalog takes row-level changes gets them by ``MERGE``, with ``row_level=True``.

What a load replaces stays until the next load of the table, for readers under way; that one also deletes what loads that
were cut short have left. A row of the history is taken to end no earlier than the day before it began, as loads
leave it; a table's first load checks that.
"""

from __future__ import annotations

import datetime
import time
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedkit.functions.names import column, ref
from feedkit.operators.dimension import Load
from feedkit.operators.merge import merge_into
from feedkit.operators.quality import data_checks, impossible_intervals, structure_checks
from feedkit.operators.type2 import change_set, classify, current_rows, has_same_day_history, stats, with_history, without_replaced
from feedkit.sinks.files import delete, folder_of, folders_in, location_of, same_folder
from feedkit.sinks.tables import beside, create_table, left_beside, sweep, switch_rows
from feedkit.workdir import written_at

ACTIONS = ("insert", "same", "version", "inplace", "missing", "blank")
#: Table property with the number of key buckets, and the name of the column that holds a row's.
KEY_BUCKETS, BUCKET_COLUMN = "feedkit.key_buckets", "key_bucket"
#: Table property of a table whose intervals have been checked, and the file that names what the last load replaced.
INTERVALS, REPLACED = "feedkit.intervals", "_replaced"


class LoadRejected(ValueError):
    """The checks before a load found something; the table is as it was."""


@dataclass(frozen=True)
class LoadResult:
    run_date: datetime.date
    keys: dict[str, int]


def create_dimension(
    spark: SparkSession, table: str, columns: Mapping[str, str], end_col: str, key_buckets: int, *, replace: bool = False
) -> None:
    """Create a dimension table that is partitioned by end date and by the bucket of the key.

    A delta load of few keys then rewrites the buckets of those keys only. ``key_buckets`` trades files
    against rewriting; loads fill the bucket's column themselves.
    """
    create_table(spark, table, {**columns, BUCKET_COLUMN: "INT"}, replace=replace, partitioned_by=[end_col, BUCKET_COLUMN])
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{KEY_BUCKETS}' = '{key_buckets}')")


def load_dimension(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    start_col: str,
    end_col: str,
    flag_col: str,
    refresh_type: str = "delta",
    run_date: str | datetime.date | None = None,
    active_end_date: str | datetime.date | None = "9999-12-31",
    *,
    max_keys: int | None = None,
    close_blank: bool = False,
    stage_source: bool = True,
    small_source: bool = False,
    row_level: bool = False,
) -> LoadResult:
    """Load ``source`` into the dimension ``table`` and say how many keys took which action.

    The run date is the session's current date if none is given. The source is read once and kept in the
    shared folder for the checks and the load; that is not needed, ``stage_source=False``, if it is a
    stored table already. ``small_source=True`` chooses the form in which Spark can broadcast the source
    and leave the target in place; rows are the same in both forms.
    """
    spark = source.sparkSession
    load = Load.of(keys, start_col, end_col, flag_col, refresh_type, run_date, active_end_date)
    partitions = _partition_columns(spark, table)
    target = spark.table(table)
    bucketed = partitions[1:] == [BUCKET_COLUMN]
    rows = target.drop(BUCKET_COLUMN) if bucketed else target
    reject(structure_checks(source.columns, rows.columns, load, max_keys))
    load, source = load.resolved(source, rows)
    staged = None
    try:
        if stage_source:
            source, staged = written_at(source, "source")
        reject(data_checks(source, rows, load).collect())
        _check_intervals(spark, table, rows, load)
        if row_level:
            counts = _merge(source, rows, table, load, close_blank, small_source)
        elif partitions[:1] == [load.end] and (bucketed or len(partitions) == 1):
            counts = _write_partitions(source, target, table, load, close_blank, small_source, bucketed)
        elif partitions:
            raise ValueError(f"{table} is partitioned by {', '.join(partitions)}; only {load.end}, or it and {BUCKET_COLUMN}, can be loaded")
        else:
            commit = create_snapshot if _is_view(spark, table) else _replace_rows
            counts = _write_snapshot(source, target, table, load, close_blank, small_source, commit)
    finally:
        delete(spark, filter(None, [staged]))
    return LoadResult(load.run_date, counts)


def _is_view(spark: SparkSession, table: str) -> bool:
    return bool(spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Type' AND data_type = 'VIEW'").take(1))


def _check_intervals(spark: SparkSession, table: str, rows: DataFrame, load: Load) -> None:
    """Rows that loads rely on not being there. A table is read for them once, at its first load; a view each time."""
    if spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == INTERVALS).take(1):
        return
    if impossible_intervals(rows, load).take(1):
        raise LoadRejected(f"{table} has rows that end before the day before they begin")
    if not _is_view(spark, table):
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{INTERVALS}' = 'checked')")


def reject(checks: Iterable[tuple[str, bool, str]]) -> None:
    """Refuse the load if a check failed."""
    failed = [message for _, passed, message in checks if not passed]
    if failed:
        raise LoadRejected("; ".join(failed))


def _counters() -> list[Column]:
    return [F.expr(f"count_if(action = '{a}')").alias(a) for a in ACTIONS]


def _counts(seen: Observation) -> dict[str, int]:
    """Keys per action, out of the rows counted while they were written. A new version has two rows."""
    rows = seen.get
    return {a: rows[a] // 2 if a == "version" else rows[a] for a in ACTIONS}


# ---------------------------------------------------------------- row-level changes


def _merge(source: DataFrame, target: DataFrame, table: str, load: Load, close_blank: bool, small_source: bool) -> dict[str, int]:
    counts = {r["action"]: r["n"] for r in stats(source, target, load, close_blank, small_source).collect()}
    changes, folder = written_at(change_set(source, target, load, close_blank, small_source), "changes")
    merge_into(changes, table, load.keys, load.start)
    delete(source.sparkSession, [folder])
    return {a: counts.get(a, 0) for a in ACTIONS}


# ---------------------------------------------------------------- whole tables


def create_snapshot(rows: DataFrame, view: str, keep: int = 1) -> None:
    """Write ``rows`` as a new table and let ``view`` show it. Of earlier snapshots the last ``keep`` stay, for readers under way."""
    spark = rows.sparkSession
    database, _, name = view.rpartition(".")
    snapshot = f"{view}__{time.time_ns():020}_{uuid.uuid4().hex}"
    rows.write.saveAsTable(snapshot)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {snapshot}")
    listed = spark.sql(f"SHOW TABLES {f'IN {database} ' if database else ''}LIKE '{name.lower()}__*'").collect()
    snapshots = sorted(r["tableName"] for r in listed if r["tableName"].startswith(f"{name.lower()}__"))
    for old in snapshots[: -1 - keep]:
        spark.sql(f"DROP TABLE IF EXISTS {f'{database}.' if database else ''}{old}")


def _replace_rows(rows: DataFrame, table: str) -> None:
    sweep(rows.sparkSession, table)
    switch_rows(rows, table)


def _write_snapshot(
    source: DataFrame,
    target: DataFrame,
    name: str,
    load: Load,
    close_blank: bool,
    small_source: bool,
    commit: Callable[[DataFrame, str], None],
) -> dict[str, int]:
    seen, same_day, folder = Observation(), has_same_day_history(target, load), None
    outputs = current_rows(source, target, load, close_blank, small_source).observe(seen, *_counters())
    if same_day:
        outputs, folder = written_at(outputs, "outputs")
    commit(with_history(outputs.drop("action"), target, load, same_day), name)
    if folder:
        delete(source.sparkSession, [folder])
    return _counts(seen)


# ---------------------------------------------------------------- partitions


def _write_partitions(
    source: DataFrame, target: DataFrame, table: str, load: Load, close_blank: bool, small_source: bool, bucketed: bool
) -> dict[str, int]:
    """Only partitions with a change are written, once, and what they replace stays for readers until the next load."""
    spark, names, root = source.sparkSession, target.columns, location_of(source.sparkSession, table).rstrip("/")
    end, start = ref(load.end), ref(load.start)
    _sweep_partitions(spark, table, root, load)
    bucket = touched = counts = None
    rows = target.drop(BUCKET_COLUMN) if bucketed else target
    if bucketed:
        n = int(spark.sql(f"SHOW TBLPROPERTIES {table} ('{KEY_BUCKETS}')").first()["value"])
        bucket = F.pmod(F.xxhash64(*[column(k) for k in load.keys]), F.lit(n)).cast("int")
        counts, touched = _touched_buckets(source, target, load, bucket, close_blank, small_source)
        if not touched:
            return counts
        source = source.where(bucket.isin(touched))
        rows = target.where(F.col(BUCKET_COLUMN).isin(touched)).drop(BUCKET_COLUMN)

    # 1. what the load makes, written beside the table
    seen = Observation()
    outputs = current_rows(source, rows, load, close_blank, small_source).observe(seen, *_counters())
    folder = f"{root}/_load-{uuid.uuid4().hex}"
    made = beside(spark, table, folder)
    placed = outputs.withColumn(BUCKET_COLUMN, bucket) if bucketed else outputs
    placed.select(*[column(c) for c in names]).write.insertInto(made)
    counts = counts or _counts(seen)
    if not any(counts[a] for a in _changing(load)):
        _drop_beside(spark, [(made, folder)], set())
        return counts

    # 2. rows of the history that share a partition with closed rows, or that a new row replaces
    history = target.where(f"NOT {load.active} AND {end} >= {load.day_before}")  # a row that began today ends no earlier
    began = [r[0] for r in history.where(f"{start} = {load.run}").select(column(load.end)).distinct().collect()]
    ends = sorted({*began, load.run_date - datetime.timedelta(days=1)})
    there = {p for e in ends for p in _partitions(spark, table, load, e)}
    if bucketed:
        there = {p for p in there if p[1] in touched}
    new = _partitions(spark, made, load)
    closed = {p for p in new if not _is_active(p, load)} | there
    last = None
    if closed:
        ends = sorted({p[0] for p in closed})
        merged = spark.table(made).where(column(load.end).isin(ends))
        if there:
            kept = history.where(column(load.end).isin(ends))
            kept = kept.where(F.col(BUCKET_COLUMN).isin(sorted({p[1] for p in there}))) if bucketed else kept
            merged = merged.unionByName(without_replaced(kept, spark.table(made), load))
        # every task of the load left its few closed rows in a file of its own
        last_folder = f"{root}/_load-{uuid.uuid4().hex}"
        last = beside(spark, table, last_folder)
        spread = merged if _clustered(spark, table) else merged.hint("rebalance", *[column(c) for c in _partition_columns(spark, table)])
        spread.select(*[column(c) for c in names]).write.insertInto(last)

    # 3. the catalog: closed rows first, so that no moment lacks a version; then the active ones
    active_ends = {None, load.active_end_date}
    before = {p for e in {p[0] for p in closed} for p in _partitions(spark, table, load, e) if p in closed}
    before |= {p for e in active_ends for p in _partitions(spark, table, load, e) if not bucketed or p[1] in touched}
    _note_replaced(spark, table, root, load, before)
    done = {}
    if last:
        done |= {p: f"{last_folder}/{path}" for p, path in _partitions(spark, last, load).items()}
    done |= {p: f"{folder}/{path}" for p, path in new.items() if _is_active(p, load)}
    for current in (False, True):
        some = sorted((p for p in done if _is_active(p, load) == current), key=str)
        for group in [[p for p in some if p not in before], *[[p] for p in some if p in before]]:
            if group:
                _point(spark, table, [(_spec(p, load), done[p]) for p in group], group[0] in before)
    gone = sorted(before - set(done), key=str)
    if gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(f'PARTITION ({_spec(p, load)})' for p in gone)}")
    spark.catalog.refreshTable(table)
    _drop_beside(spark, [(made, folder), *([(last, last_folder)] if last else [])], set(done.values()))
    return counts


def _changing(load: Load) -> list[str]:
    return ["insert", "version", "inplace", "blank", *(["missing"] if load.refresh_type == "full" else [])]


def _touched_buckets(
    source: DataFrame, target: DataFrame, load: Load, bucket: Column, close_blank: bool, small_source: bool
) -> tuple[dict[str, int], list[int]]:
    """Keys per action, and the buckets in which something changes: at most as many numbers as there are buckets.

    A delta load reads the buckets of its source's keys; in the others all active keys are missing from the source, which
    takes no more than their number.
    """
    reach, beyond = target, 0
    if load.refresh_type == "delta" and not close_blank:
        own = [r[0] for r in source.select(bucket.alias("b")).distinct().collect()]
        inside = F.col(BUCKET_COLUMN).isin(own)
        reach, beyond = target.where(inside), target.where(load.active).where(~inside).count()
    keys = classify(source, reach.drop(BUCKET_COLUMN), load, close_blank, small_source)
    changes = F.collect_set(F.when(F.col("action").isin(_changing(load)), bucket)).alias("touched")
    found = keys.agg(*_counters(), changes).first()
    counts = {a: found[a] for a in ACTIONS}
    counts["missing"] += beyond
    return counts, sorted(found["touched"])


def _drop_beside(spark: SparkSession, tables: list[tuple[str, str]], named: set[str]) -> None:
    """Drop tables written beside another, with the files that none of its partitions names."""
    named = {same_folder(f) for f in named}
    for table, folder in tables:
        spark.sql(f"DROP TABLE {table}")
        inner = _leaves(spark, folder)
        unnamed = [f for f in inner if same_folder(f) not in named]
        delete(spark, [folder] if len(unnamed) == len(inner) else unnamed)


def _leaves(spark: SparkSession, folder: str) -> list[str]:
    """Folders of partitions below ``folder``, which are one or two levels deep."""
    found = []
    for outer in folders_in(spark, folder):
        inner = [f for f in folders_in(spark, outer) if f"{BUCKET_COLUMN}=" in f]
        found += inner or [outer]
    return found


def _note_replaced(spark: SparkSession, table: str, root: str, load: Load, partitions: set[tuple]) -> None:
    """Write down, before the catalog is changed, the folders whose partitions are about to get others."""
    folders = _folders(spark, table, load, {p[0] for p in partitions})
    if partitions and len(next(iter(partitions))) > 1:
        paths = {f"{BUCKET_COLUMN}={p[1]}" for p in partitions}
        folders = {f for f in folders if f.rpartition("/")[2] in paths}
    noted = spark.createDataFrame([(f,) for f in sorted(folders)], "value string")
    noted.coalesce(1).write.mode("overwrite").text(f"{root}/{REPLACED}")


def _folders(spark: SparkSession, table: str, load: Load, ends: set) -> set[str]:
    """Folders of the files in the partitions of some end dates, from the listing a scan would use; none is read."""
    days = [e for e in ends if e is not None]
    within = F.lit(False)
    if days:
        within = column(load.end).isin(days)
    if None in ends:
        within = within | column(load.end).isNull()
    return {folder_of(f) for f in spark.table(table).where(within).inputFiles()}


def _sweep_partitions(spark: SparkSession, table: str, root: str, load: Load) -> None:
    """Delete what the last load replaced, and what loads that were cut short have left, unless a partition names it."""
    noted = f"{root}/{REPLACED}"
    old = [r["value"] for r in spark.read.text(noted).collect()] if any(same_folder(f) == same_folder(noted) for f in folders_in(spark, root)) else []
    cut = [(name, location_of(spark, name)) for name in left_beside(spark, table)]
    old += [f for _, folder in cut for f in _leaves(spark, folder)]
    if not old and not cut:
        return
    spark.catalog.refreshTable(table)
    live = {same_folder(f) for f in _folders(spark, table, load, _ends_in(old, load))}
    delete(spark, [f for f in old if same_folder(f) not in live])
    for name, folder in cut:
        spark.sql(f"DROP TABLE {name}")
        if not _leaves(spark, folder):
            delete(spark, [folder])
    delete(spark, [noted])
    for folder in folders_in(spark, root):
        if "/_load-" in folder and not _leaves(spark, folder):
            delete(spark, [folder])


def _ends_in(folders: list[str], load: Load) -> set:
    """End dates that folders of partitions are named after."""
    found = set()
    for folder in folders:
        name = next(part for part in reversed(folder.split("/")) if part.lower().startswith(f"{load.end.lower()}="))
        found.add(_day(name.partition("=")[2]))
    return found


def _is_active(p: tuple, load: Load) -> bool:
    return p[0] is None or p[0] == load.active_end_date


def _spec(p: tuple, load: Load) -> str:
    day = "NULL" if p[0] is None else f"DATE'{p[0]}'"
    return f"`{load.end}` = {day}" + (f", {BUCKET_COLUMN} = {p[1]}" if len(p) > 1 else "")


def _partitions(spark: SparkSession, table: str, load: Load, end: object = ...) -> dict[tuple, str]:
    """(end date, bucket) or (end date,) of the table's partitions, or of those of one end date, with their paths; no file is read."""
    only = "" if end is ... else f" PARTITION (`{load.end}` = {'NULL' if end is None else f"DATE'{end}'"})"
    out = {}
    for row in spark.sql(f"SHOW PARTITIONS {table}{only}").collect():
        values = [part.partition("=")[2] for part in row[0].split("/")]
        day = _day(values[0])
        if end is ... or day == end:
            out[(day, *map(int, values[1:]))] = row[0]
    return out


def _day(text: str) -> datetime.date | None:
    return None if text in ("__HIVE_DEFAULT_PARTITION__", "null") else datetime.date.fromisoformat(text)


def _point(spark: SparkSession, table: str, places: list[tuple[str, str]], there: bool) -> None:
    """Give partitions their locations: new ones by one statement, one that is there by its own."""
    if there:
        ((spec, location),) = places
        spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{location}'")
    else:
        listed = " ".join(f"PARTITION ({spec}) LOCATION '{location}'" for spec, location in places)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {listed}")


def _clustered(spark: SparkSession, table: str) -> bool:
    return any(c.isBucket for c in spark.catalog.listColumns(table))


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]

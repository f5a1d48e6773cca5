"""A Type-2 dimension as a base table and a log of changes, merged when it is read.

For catalogs without row-level changes. A load appends its change set, and only that, as one partition of the log; adding
the partition to the catalog is the commit. The dimension is a view: of the base and the log, the latest row for each key and
start date. Rows keep a digest, so a load reads whole only what differs (:mod:`feedkit.operators.digest`).

``fold`` writes what the view shows as a new base and points the view at it, by one catalog change. The base before, and the
log that went into the new one, stay for readers under way until the next fold. A load or fold that was cut
short is done again under the same number, over what it left. One load runs at a time.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedkit.functions.names import column, name_difference, quoted, resolve
from feedkit.functions.types import spark_type
from feedkit.operators.digest import ACTIONS, DIGEST, changes_by_digest, with_digest
from feedkit.operators.dimension import NO_START, Load
from feedkit.operators.quality import data_checks, structure_checks
from feedkit.plans.dimension_load import LoadResult, reject
from feedkit.sinks.files import delete, location_of
from feedkit.workdir import written_at

#: The log's column that numbers loads, and the view's properties.
LOAD = "load_number"
BASE, FOLDED, KEYS, START, END = (f"feedkit.{name}" for name in ("base", "folded", "keys", "start", "end"))


@dataclass(frozen=True)
class Logged:
    """What the view of a dimension says of itself. ``base`` is empty until the first fold."""

    name: str
    columns: list[str]
    base: str
    folded: int
    keys: list[str]
    start: str
    end: str

    @property
    def log(self) -> str:
        return f"{self.name}__log"

    def select(self, with_digests: bool = False) -> str:
        """SQL for the rows as they are now."""
        names = ", ".join(f"a.{quoted(c)}" for c in [*self.columns, *([DIGEST] if with_digests else [])])
        same = [f"a.{quoted(k)} <=> n.{quoted(k)}" for k in self.keys]
        same.append(f"coalesce(a.{quoted(self.start)}, {NO_START}) = coalesce(n.{quoted(self.start)}, {NO_START})")
        newer = f"(SELECT * FROM {self.log} WHERE {LOAD} > {self.folded})"
        of_log = f"SELECT {names} FROM {newer} a LEFT ANTI JOIN {newer} n ON {' AND '.join(same)} AND n.{LOAD} > a.{LOAD}"
        if not self.base:
            return of_log
        return f"SELECT {names} FROM {self.base} a LEFT ANTI JOIN {newer} n ON {' AND '.join(same)} UNION ALL {of_log}"

    def show(self, spark: SparkSession) -> None:
        """Make the view show these rows: one catalog change."""
        about = {BASE: self.base, FOLDED: self.folded, KEYS: ",".join(self.keys), START: self.start, END: self.end}
        properties = ", ".join(f"'{k}' = '{v}'" for k, v in about.items())
        spark.sql(f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ({properties}) AS {self.select()}")


def create_logged(
    spark: SparkSession, name: str, columns: Mapping[str, str], keys: Sequence[str], start_col: str, end_col: str
) -> None:
    """Create an empty dimension of these columns. Type names may be the warehouse's; column names must not hold commas."""
    names = list(columns)
    start, end = resolve([start_col, end_col], names, "dimension")
    logged = Logged(name, names, "", 0, resolve(keys, names, "dimension"), start, end)
    listed = ", ".join(f"{quoted(c)} {spark_type(t)[0]}" for c, t in columns.items())
    spark.sql(f"CREATE TABLE {logged.log} ({listed}, {DIGEST} BINARY, {LOAD} BIGINT) USING parquet PARTITIONED BY ({LOAD})")
    logged.show(spark)


def logged(spark: SparkSession, name: str) -> Logged:
    about = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if BASE not in about:
        raise ValueError(f"{name} is no dimension with a log")
    return Logged(name, spark.table(name).columns, about[BASE], int(about[FOLDED]), about[KEYS].split(","), about[START], about[END])


def load_logged(
    source: DataFrame,
    name: str,
    flag_col: str,
    refresh_type: str = "delta",
    run_date: str | datetime.date | None = None,
    active_end_date: str | datetime.date | None = "9999-12-31",
    *,
    max_keys: int | None = None,
    close_blank: bool = False,
) -> LoadResult:
    """Load ``source`` into the dimension: checks, change set, one more partition of the log.

    Keys and dates are those the dimension was created with. The source is kept in the shared folder while the load
    runs. The run date is the session's current date if none is given. A load without changes adds nothing.
    """
    spark = source.sparkSession
    about = logged(spark, name)
    load = Load.of(about.keys, about.start, about.end, flag_col, refresh_type, run_date, active_end_date)
    rows = spark.table(name)
    reject(structure_checks(source.columns, rows.columns, load, max_keys))
    load, source = load.resolved(source, rows)
    staged = None
    try:
        source, staged = written_at(source, "source")
        reject(data_checks(source, rows, load).collect())
        changes = changes_by_digest(source, spark.sql(about.select(with_digests=True)), load, close_blank)
        append_changes(changes.rows, about)
    finally:
        delete(spark, filter(None, [staged]))
    return LoadResult(load.run_date, changes.keys)


def first_rows(rows: DataFrame, name: str, flag_col: str) -> None:
    """Give an empty dimension its rows, history included, as the log's first partition."""
    about = logged(rows.sparkSession, name)
    load = Load.of(about.keys, about.start, about.end, flag_col)
    append_changes(with_digest(rows.select(*[column(c) for c in about.columns]), load), about)


def merge_logged(changes: DataFrame, name: str, flag_col: str) -> int:
    """Merge rows into the dimension in place: update where key and start date match, insert otherwise.

    Columns go by name, whatever their order. A key and start date may occur once in ``changes``, which is checked first.
    Returns the number of the load, or 0 without rows.
    """
    spark = changes.sparkSession
    about, held = logged(spark, name), spark.table(name).schema.fields
    different = name_difference(changes.columns, about.columns)
    if different:
        raise ValueError(f"columns found in only one of changes and {name}: {' '.join(different)}")
    names = resolve(about.columns, changes.columns, "changes")
    rows = changes.select(*[column(n).cast(f.dataType).alias(f.name) for n, f in zip(names, held)])
    by = [*[column(k) for k in about.keys], F.coalesce(column(about.start), F.expr(NO_START)).alias("start")]
    if rows.groupBy(*by).count().where("`count` > 1").take(1):
        raise ValueError(f"several changes of one row: {', '.join(about.keys)} and the start date occur more than once")
    return append_changes(with_digest(rows, Load.of(about.keys, about.start, about.end, flag_col)), about)


def append_changes(changes: DataFrame, about: Logged) -> int:
    """Append rows that take the place of those with their key and start date; the number of the load, or 0 without rows."""
    spark = changes.sparkSession
    number = max([about.folded, *_numbers(spark, about)]) + 1
    folder = f"{location_of(spark, about.log).rstrip('/')}/{LOAD}={number}"
    seen = Observation()
    counted = changes.select(*[column(c) for c in about.columns], DIGEST).observe(seen, F.count("*").alias("n"))
    counted.write.mode("overwrite").parquet(folder)
    if not seen.get["n"]:
        delete(spark, [folder])
        return 0
    spark.sql(f"ALTER TABLE {about.log} ADD PARTITION ({LOAD} = {number}) LOCATION '{folder}'")
    return number


def fold(spark: SparkSession, name: str) -> None:
    """Write what the dimension shows as its new base, partitioned by end date, and let the log begin after it."""
    about = logged(spark, name)
    numbers = _numbers(spark, about)
    upto = max([about.folded, *numbers])
    if upto == about.folded:
        return
    base = f"{name}__base_{upto}"
    rows = spark.sql(about.select(with_digests=True)).hint("rebalance", column(about.end))
    folder = f"{location_of(spark, about.log).rstrip('/')}__base_{upto}"
    rows.write.mode("overwrite").option("path", folder).partitionBy(about.end).saveAsTable(base)
    Logged(name, about.columns, base, upto, about.keys, about.start, about.end).show(spark)
    for number in numbers:
        if number <= about.folded:
            spark.sql(f"ALTER TABLE {about.log} DROP IF EXISTS PARTITION ({LOAD} = {number})")
    database, _, plain = name.rpartition(".")
    listed = spark.sql(f"SHOW TABLES {f'IN {quoted(database)} ' if database else ''}LIKE '{plain.lower()}__base_*'").collect()
    for old in listed:
        table = f"{database}.{old['tableName']}" if database else old["tableName"]
        if table.lower() not in (base.lower(), about.base.lower()):
            folder = location_of(spark, table)
            spark.sql(f"DROP TABLE {table}")
            delete(spark, [folder])


def _numbers(spark: SparkSession, about: Logged) -> list[int]:
    return [int(r[0].partition("=")[2]) for r in spark.sql(f"SHOW PARTITIONS {about.log}").collect()]

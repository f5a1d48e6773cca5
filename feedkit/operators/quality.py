"""Checks before a dimension load, each a row (check, passed, message).

Names and arguments are compared on the driver. The checks that read data take one aggregation over
the source keys and one over the active target keys, in which counts are combined before they are
shuffled, so a key that fills a third of the table costs no more than any other. The date checks ask
the scan for dates past the limit and normally read next to nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.functions.names import column, find, name_difference, ref
from feedkit.operators.dimension import Load

REPORT_SCHEMA = "check string, passed boolean, message string"

Check = tuple[str, bool, str]


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return df.groupBy(*[column(k) for k in keys]).agg(F.count("*").alias("count")).where("`count` > 1")


def max_dates(target: DataFrame, load: Load) -> DataFrame:
    """Latest start and end date of the target: one row."""
    return target.agg(
        F.max(column(load.start)).cast("date").alias("max_start"),
        F.max(column(load.end)).cast("date").alias("max_end"),
    )


def max_dates_of_files(spark: SparkSession, path: str, load: Load) -> DataFrame:
    """The same of a table's Parquet files, from the statistics in their footers: no row is read.

    The frame belongs to a session of its own, in which Spark reads Parquet through the source that can answer an aggregate
    so. Files without statistics are read. Both must be columns of the files, not names of folders, and dates.
    """
    footers = spark.newSession()
    footers.conf.set("spark.sql.sources.useV1SourceList", "")
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    files = footers.read.parquet(path)
    columns = {name: find(given, files.columns) for name, given in (("max_start", load.start), ("max_end", load.end))}
    for given, name in zip((load.start, load.end), columns.values()):
        if name is None or files.schema[name].dataType != T.DateType():
            raise ValueError(f"the files have no date column {given}")
    return files.agg(*[F.max(column(name)).alias(alias) for alias, name in columns.items()])


def impossible_intervals(target: DataFrame, load: Load) -> DataFrame:
    """Rows that end before the day before they begin, which loads never leave. Reads both date columns."""
    start, end = ref(find(load.start, target.columns)), ref(find(load.end, target.columns))
    return target.where(f"{end} < date_sub(CAST({start} AS DATE), 1)")


def structure_checks(
    source_columns: Sequence[str], target_columns: Sequence[str], load: Load, max_keys: int | None = None
) -> list[Check]:
    """Checks on names and arguments alone."""

    def absent(names: Sequence[str], columns: Sequence[str]) -> list[str]:
        return [n for n in names if find(n, columns) is None]

    compared = load.shared(target_columns)
    different = name_difference(source_columns, compared)
    keys = " ".join(load.keys)
    checks: list[Check] = []

    def check(name: str, passed: bool, message: str) -> None:
        checks.append((name, passed, "" if passed else message))

    check("source_has_columns", bool(source_columns), "the source has no columns")
    check("target_has_columns", bool(target_columns), "the target has no columns")
    check("start_column_given", bool(load.start), "no start date column given")
    check("end_column_given", bool(load.end), "no end date column given")
    check("flag_column_given", bool(load.flag), "no active flag column given")
    for name, value in (("start", load.start), ("end", load.end), ("flag", load.flag)):
        check(f"{name}_column_in_target", not absent([value], target_columns), f"the target has no column {value}")
    check("keys_given", bool(load.keys), "no key column given")
    check("keys_at_most", max_keys is None or len(load.keys) <= max_keys, f"more than {max_keys} key columns: {keys}")
    missing = absent(load.keys, target_columns)
    check("keys_in_target", not missing, f"key columns not in the target: {' '.join(missing)}")
    missing = absent(load.keys, source_columns)
    check("keys_in_source", not missing, f"key columns not in the source: {' '.join(missing)}")
    check("same_columns", not different, f"columns found in one table but not in the other: {' '.join(different)}")
    return checks


def data_checks(source: DataFrame, target: DataFrame, load: Load) -> DataFrame:
    """Checks that read the tables, as one report; run them once the structure checks have passed."""
    # A row that begins after the run date ends on that date or later: the scan skips older partitions.
    end = ref(find(load.end, target.columns))
    late_start = _latest_after(target.where(f"{end} IS NULL OR {end} >= {load.run}"), load.start, load.run)
    reports = [
        _rows(
            late_start,
            (
                "run_date_not_before_start",
                F.col("latest").isNull(),
                _text(f"run date {load.run_date} is before the latest start date ", F.col("latest")),
            ),
        )
    ]
    # With open intervals there is no active end date that could be too early.
    limit = load.active_end if load.active_end_date else "DATE'9999-12-31'"
    late_end = _latest_after(target, load.end, limit)
    passed = F.col("latest").isNull() if load.active_end_date else F.lit(True)
    reports.append(
        _rows(
            late_end,
            (
                "active_end_not_before_end",
                passed,
                _text(f"active end date {load.active_end_date} is before the latest end date ", F.col("latest")),
            ),
        )
    )
    reports.append(
        _rows(
            _key_counts(target.where(load.active), load),
            (
                "target_keys_unique",
                F.col("repeated") == 0,
                _text("keys with more than one active row in the target: ", F.col("repeated")),
            ),
        )
    )
    reports.append(
        _rows(
            _key_counts(source, load),
            (
                "source_keys_unique",
                F.col("repeated") == 0,
                _text("keys that occur more than once in the source: ", F.col("repeated")),
            ),
            (
                "source_keys_not_null",
                F.col("without_key") == 0,
                _text("source rows with a null in the key: ", F.col("without_key")),
            ),
        )
    )
    return reduce(DataFrame.unionByName, reports)


def report(source: DataFrame, target: DataFrame, load: Load, max_keys: int | None = None) -> DataFrame:
    """All checks. Data is only read if names and arguments are in order."""
    structure = structure_checks(source.columns, target.columns, load, max_keys)
    result = source.sparkSession.createDataFrame(structure, REPORT_SCHEMA)
    if all(passed for _, passed, _ in structure):
        result = result.unionByName(data_checks(source, target, load))
    return result


def _latest_after(target: DataFrame, name: str, limit: str) -> DataFrame:
    """One row: the latest date after ``limit``, null if there is none.

    The comparison goes to the scan, where file statistics or partitions rule out nearly everything;
    the maximum of the whole column would have to read it.
    """
    day = ref(find(name, target.columns))
    return target.where(f"{day} > {limit}").agg(F.expr(f"CAST(max({day}) AS DATE)").alias("latest"))


def _key_counts(df: DataFrame, load: Load) -> DataFrame:
    """One row: how many keys are repeated, how many rows have a null in the key."""
    keys = [find(k, df.columns) for k in load.keys]
    no_key = " OR ".join(f"{ref(k)} IS NULL" for k in keys)
    counts = df.groupBy(*[column(k) for k in keys]).agg(F.count("*").alias("__n"))
    return counts.agg(
        F.expr("count_if(__n > 1)").alias("repeated"),
        F.expr(f"coalesce(sum(IF({no_key}, __n, 0)), 0)").alias("without_key"),
    )


def _text(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def _rows(one_row: DataFrame, *checks: tuple[str, Column, Column]) -> DataFrame:
    """A report row per check out of the columns of a one-row aggregate."""
    structs = [
        F.struct(
            F.lit(name).alias("check"),
            passed.alias("passed"),
            F.when(passed, F.lit("")).otherwise(message).alias("message"),
        )
        for name, passed, message in checks
    ]
    return one_row.select(F.inline(F.array(*structs)))

"""Load files in two steps: into a staging table as they are, then mapped into the target table.

``stage_load`` takes what it is given, each time. ``load_new_files`` keeps a ledger of files and takes those it has not
loaded, exactly once, also if a run is cut short and done again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedkit.functions.names import column, name_difference, quoted, resolve
from feedkit.functions.types import spark_type
from feedkit.operators.mapping import apply_mapping
from feedkit.sinks.files import location_of
from feedkit.sinks.tables import append_by_name, overwrite_table
from feedkit.sources.feeds import list_files, read_with_header

#: The column that numbers loads, and what is known of a loaded file. One with another length or time is a new one.
LOAD = "load_number"
FILE = "path STRING, length BIGINT, modificationTime TIMESTAMP"


def stage_load(
    spark: SparkSession,
    data_file: str,
    mapping: str | dict,
    staging_table: str,
    target_table: str,
    *,
    delimiter: str = ",",
    infer_types: bool = True,
    **mapping_options: object,
) -> None:
    """Overwrite ``staging_table`` with the file, then append its mapped rows to ``target_table`` by name.

    Source columns the mapping does not read are appended unchanged, so the target table has them too.
    """
    overwrite_table(read_with_header(spark, data_file, delimiter, infer_types), staging_table)
    staged = spark.table(staging_table)
    mapped = apply_mapping(staged, mapping, keep_unmapped=True, **mapping_options)
    append_by_name(mapped, target_table)


def create_loaded(spark: SparkSession, table: str, columns: Mapping[str, str]) -> None:
    """Create a table for :func:`load_new_files`: partitioned by load. Type names may be the warehouse's."""
    listed = ", ".join(f"{quoted(c)} {spark_type(t)[0]}" for c, t in columns.items())
    spark.sql(f"CREATE TABLE {table} ({listed}, {LOAD} BIGINT) USING parquet PARTITIONED BY ({LOAD})")


def ledger(spark: SparkSession, staging_table: str) -> DataFrame:
    """The files that a staging table was loaded from: ``path``, ``length``, ``modificationTime``, ``load_number``."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {staging_table}__files ({FILE}, {LOAD} BIGINT) USING parquet PARTITIONED BY ({LOAD})")
    return spark.table(f"{staging_table}__files")


def load_new_files(
    spark: SparkSession,
    folder: str,
    read: Callable[[list[str]], DataFrame],
    staging_table: str,
    targets: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
    *,
    pattern: str | None = None,
    files_per_load: int = 10_000,
) -> list[int]:
    """Load the files below ``folder`` that the ledger lacks, and say under which numbers.

    ``read`` makes rows of the staging table out of paths; each of ``targets`` gets what its function makes of the
    staged rows. Columns go by name. All are tables of :func:`create_loaded`. A load writes one partition of each, and
    its entry in the ledger is the commit, so a load that is cut short is done again from its files under the same number.
    Files are taken oldest first, at most ``files_per_load`` in one load; that many paths pass through the driver.
    """
    held, held_in, numbers = ledger(spark, staging_table), f"{staging_table}__files", []
    while True:
        found = list_files(spark, folder, pattern)
        same = [found[c] == held[c] for c in ("path", "length", "modificationTime")]
        new = found.join(held, same, "left_anti").orderBy("modificationTime", "path").limit(files_per_load).collect()
        if not new:
            return numbers
        number = max(_numbers(spark, held_in), default=0) + 1
        staged = _add(read([r["path"] for r in new]), staging_table, number)
        for table, transform in (targets or {}).items():
            _add(transform(staged), table, number)
        _add(spark.createDataFrame(new, FILE), held_in, number)
        numbers.append(number)
        held = spark.table(held_in)


def _add(rows: DataFrame, table: str, number: int) -> DataFrame:
    """Write rows as the partition of a load, over what a load that was cut short has left, and read them back."""
    spark = rows.sparkSession
    fields = [f for f in spark.table(table).schema.fields if f.name != LOAD]
    different = name_difference(rows.columns, [f.name for f in fields])
    if different:
        raise ValueError(f"columns found in only one of rows and table {table}: {' '.join(different)}")
    names = resolve([f.name for f in fields], rows.columns, "rows")
    folder = f"{location_of(spark, table).rstrip('/')}/{LOAD}={number}"
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({LOAD} = {number})")
    aligned = rows.select(*[column(n).cast(f.dataType).alias(f.name) for n, f in zip(names, fields)])
    aligned.write.mode("overwrite").parquet(folder)
    spark.sql(f"ALTER TABLE {table} ADD PARTITION ({LOAD} = {number}) LOCATION '{folder}'")
    return spark.table(table).where(F.col(LOAD) == number).drop(LOAD)


def _numbers(spark: SparkSession, table: str) -> list[int]:
    return [int(r[0].partition("=")[2]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]

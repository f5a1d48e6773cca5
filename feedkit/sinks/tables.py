"""Writing tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedkit.functions.names import column, name_difference, resolve
from feedkit.functions.types import spark_type
from feedkit.operators.mapping import conform
from feedkit.sinks.files import delete, location_of, same_folder

#: What the name of a table beside another goes on with, and the property that names the files it had before.
BESIDE, PREVIOUS = "__beside_", "feedkit.previous"


def run_sql(spark: SparkSession, statement: str) -> DataFrame:
    """Run a statement, DDL and DML included, in the session catalog."""
    return spark.sql(statement)


def create_table(
    spark: SparkSession,
    table: str,
    columns: Mapping[str, str],
    *,
    replace: bool = False,
    partitioned_by: Sequence[str] = (),
    clustered_by: Sequence[str] = (),
    buckets: int | None = None,
) -> None:
    """Create a Parquet table. Type names may be the warehouse's; text columns carry no length.

    ``clustered_by`` with ``buckets`` stores the rows by key, which spares later joins on that key
    the shuffle of this table.
    """
    if bool(clustered_by) != bool(buckets):
        raise ValueError("clustered_by and buckets go together")
    listed = ", ".join(f"`{name}` {spark_type(type_name)[0]}" for name, type_name in columns.items())
    statement = f"CREATE TABLE {table} ({listed}) USING parquet"
    if partitioned_by:
        statement += f" PARTITIONED BY ({_names(partitioned_by)})"
    if clustered_by:
        statement += f" CLUSTERED BY ({_names(clustered_by)}) SORTED BY ({_names(clustered_by)}) INTO {buckets} BUCKETS"
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(statement)


def overwrite_table(
    df: DataFrame, table: str, *, source: str | None = None, options: Mapping[str, str] | None = None
) -> None:
    """Replace a table's rows and columns, in the catalog or through a data source.

    In the catalog the rows are written beside the old ones first; a job that is cut short leaves the table as it was. With
    the columns it has, an unpartitioned table keeps its definition and is switched by one catalog change. Its old
    files then stay for readers under way until it is overwritten again, but for those in the folder it got when it was
    created. With other columns it is dropped and the new one takes its name.
    """
    spark = df.sparkSession
    if source is not None:
        df.write.format(source).options(**(options or {})).option("dbtable", table).mode("overwrite").save()
    elif not spark.catalog.tableExists(table):
        df.write.saveAsTable(table)
    else:
        sweep(spark, table)
        held = [(f.name, f.dataType) for f in spark.table(table).schema.fields]
        parted = any(c.isPartition for c in spark.catalog.listColumns(table))
        if not parted and held == [(f.name, f.dataType) for f in df.schema.fields]:
            switch_rows(df, table)
            return
        new, old = f"{table}{BESIDE}{uuid.uuid4().hex}", location_of(spark, table)
        previous = _property(spark, table, PREVIOUS)
        df.write.option("path", f"{old.rstrip('/')}__{uuid.uuid4().hex}").saveAsTable(new)
        spark.sql(f"DROP TABLE {table}")
        spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
        delete(spark, filter(None, [old, previous]))


def switch_rows(df: DataFrame, table: str) -> None:
    """Give an unpartitioned table these rows by one change of its location. Format, buckets and properties are the table's."""
    spark = df.sparkSession
    before, previous = location_of(spark, table), _property(spark, table, PREVIOUS)
    folder = f"{before.rstrip('/')}__{uuid.uuid4().hex}"
    new = beside(spark, table, folder)
    df.write.insertInto(new)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PREVIOUS}' = '{before}')")
    spark.sql(f"DROP TABLE {new}")
    # files in the folder that a table gets by its name would stand in the way of a table created anew under that name
    by_name = before.rstrip("/").rpartition("/")[2].lower() == table.rpartition(".")[2].lower()
    delete(spark, filter(None, [previous, before if by_name else None]))


def beside(spark: SparkSession, table: str, folder: str) -> str:
    """A table of the same kind whose files lie in ``folder`` and stay when its name is dropped."""
    name = f"{table}{BESIDE}{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} LIKE {table} LOCATION '{folder}'")
    return name


def left_beside(spark: SparkSession, table: str) -> list[str]:
    """Tables that writes which were cut short have left beside a table."""
    database, _, name = table.rpartition(".")
    listed = spark.sql(f"SHOW TABLES {f'IN {database} ' if database else ''}LIKE '{name.lower()}{BESIDE}*'").collect()
    return [f"{database}.{r['tableName']}" if database else r["tableName"] for r in listed]


def sweep(spark: SparkSession, table: str) -> None:
    """Delete what writes of an unpartitioned table that were cut short have left."""
    for old in left_beside(spark, table):
        folder = location_of(spark, old)
        spark.sql(f"DROP TABLE {old}")
        if same_folder(folder) != same_folder(location_of(spark, table)):
            delete(spark, [folder])


def _property(spark: SparkSession, table: str, name: str) -> str | None:
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == name).collect()
    return found[0]["value"] if found else None


def append_by_name(
    df: DataFrame, table: str, *, source: str | None = None, options: Mapping[str, str] | None = None
) -> None:
    """Add rows, matching columns by name and not by position; both must have the same names.

    A table of another system is read for its columns first, so that rows arrive in its order also
    where the system matches by position.
    """
    if source is not None:
        target = df.sparkSession.read.format(source).options(**(options or {})).option("dbtable", table).load()
    else:
        target = df.sparkSession.table(table)
    different = name_difference(df.columns, target.columns)
    if different:
        raise ValueError(f"columns found in only one of frame and table {table}: {' '.join(different)}")
    names = resolve(target.columns, df.columns, "frame")
    aligned = [column(n).cast(f.dataType).alias(f.name) for n, f in zip(names, target.schema.fields)]
    rows = df.select(*aligned)
    if source is None:
        rows.write.insertInto(table)
    else:
        rows.write.format(source).options(**(options or {})).option("dbtable", table).mode("append").save()


def load_positional(df: DataFrame, table: str) -> None:
    """Add rows matching columns by position: the i-th field becomes the i-th column, in its type."""
    target = df.sparkSession.table(table)
    if len(df.columns) != len(target.columns):
        raise ValueError(f"{len(df.columns)} fields for the {len(target.columns)} columns of {table}")
    layout = {"properties": [{"name": f.name, "type": f.dataType.simpleString()} for f in target.schema.fields]}
    append_by_name(conform(df.toDF(*target.columns), layout), table)


def truncate(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table}")


def _names(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)

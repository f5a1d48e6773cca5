"""Tables and queries as sources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    table: str | None = None,
    *,
    query: str | None = None,
    source: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table or a query, from the session catalog or through the data source named by ``source``.

    Connection options come from the caller. With a ``source`` the query runs in that system.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    if source is None:
        return spark.table(table) if table else spark.sql(query)
    reader = spark.read.format(source).options(**(options or {}))
    return reader.option("dbtable", table).load() if table else reader.option("query", query).load()


def preview(df: DataFrame, rows: int, order_by: list[str] | None = None) -> DataFrame:
    """The first rows; the same ones each time if ``order_by`` is a total order."""
    return (df.orderBy(*order_by) if order_by else df).limit(rows)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}" if database else "SHOW TABLES")

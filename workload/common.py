from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from feedkit.workdir import new_folder


@dataclass(frozen=True)
class Query:
    """A query on the tables of a folder, and the SQL for the same result where there is one."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def new_database(spark: SparkSession) -> str:
    """A database of its own in the shared folder, so that runs do not meet in each other's tables."""
    path = new_folder(spark, "database")
    name = "feedkit_" + path.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name

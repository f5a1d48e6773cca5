"""Files behind tables: where they lie, and deleting those that nothing names any more."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def location_of(spark: SparkSession, table: str, partition: str | None = None) -> str:
    """Where a table's files lie, or those of the partition that ``partition`` describes in SQL."""
    rows = spark.sql(f"DESCRIBE EXTENDED {table}" + (f" PARTITION ({partition})" if partition else "")).collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def delete(spark: SparkSession, folders: Iterable[str]) -> None:
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def folders_in(spark: SparkSession, folder: str) -> list[str]:
    """The folders directly in a folder; none if it is not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().toString() for s in system.listStatus(path) if s.isDirectory()] if system.exists(path) else []


def folder_of(file: str) -> str:
    return file.rpartition("/")[0]


def same_folder(folder: str) -> str:
    """A folder's path in one spelling: catalog and scans write schemes and slashes differently."""
    scheme, colon, path = folder.rpartition(":")
    return f"{scheme}{colon}/{path.strip('/')}"

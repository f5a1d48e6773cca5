"""What the operators share: tables, row identity, words, stored intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedkit.workdir import new_folder

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` into the shared folder and read it back: lineage ends there and lost executors cost nothing."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parted(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored part by part: what one task wrote is a ``part``, and one bucket of a table.

    Steps that need the rows of a part together, grouped or cogrouped by ``part``, read them where they are,
    without a shuffle of them. ``row`` numbers the rows.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"), *df.columns)
    table = f"{name}_{uuid.uuid4().hex}"
    writer = rows.write.format("parquet").option("path", new_folder(spark, name)).option("compression", "zstd")
    writer.bucketBy(buckets, "part").saveAsTable(table)
    kept = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # of an external table only the name goes
    return kept


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def located(df: DataFrame) -> DataFrame:
    """``df`` as rows that can be named: a frame that does not come from files is written to some first.

    A row is named by its file and its position there, so repeated rows and null or repeated
    identifiers are told apart, and a recomputed task gives the same names.
    """
    try:
        df.select("_metadata.row_index")
        return df
    except AnalysisException:
        return stored(df, "rows")


def locator(file: str = "row_file", row: str = "row_index") -> list[Column]:
    """The two columns that name a row of a located frame. The file is kept as a 64-bit hash of its path."""
    return [F.xxhash64("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row)]

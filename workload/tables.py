"""Table sources and sinks, in a database of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedkit.operators import apply_mapping, merge_upsert
from feedkit.plans import create_loaded, create_snapshot, load_new_files, stage_load
from feedkit.sinks import append_by_name, create_table, overwrite_table, run_sql, truncate
from feedkit.sources import list_files, list_tables, preview, read_table, read_with_header
from feedkit.workdir import new_folder
from workload.common import Query, new_database, table
from workload.mappings import to


def group_count(spark: SparkSession, folder: str) -> DataFrame:
    name = f"{new_database(spark)}.orders"
    overwrite_table(table(spark, folder, "orders").select("o_orderstatus", "o_orderpriority"), name)
    return read_table(spark, query=f"SELECT o_orderstatus, count(*) AS n FROM {name} GROUP BY o_orderstatus")


GROUP_COUNT_SQL = "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus"


def table_preview(spark: SparkSession, folder: str) -> DataFrame:
    return preview(table(spark, folder, "customer"), 20, ["c_custkey"])


PREVIEW_SQL = "SELECT * FROM customer ORDER BY c_custkey LIMIT 20"


def table_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A table read through a data source with options."""
    return read_table(spark, f"{folder}/supplier.parquet", source="parquet", options={"path": f"{folder}/supplier.parquet"})


def sql_query(spark: SparkSession, folder: str) -> DataFrame:
    table(spark, folder, "lineitem").createOrReplaceTempView("feedkit_lineitem")
    return run_sql(
        spark,
        """SELECT l_returnflag, l_linestatus, count(*) AS n, max(l_shipdate) AS last_ship
           FROM feedkit_lineitem GROUP BY l_returnflag, l_linestatus""",
    )


SQL_QUERY_SQL = """
SELECT l_returnflag, l_linestatus, count(*) AS n, max(l_shipdate) AS last_ship FROM lineitem GROUP BY ALL
"""


def append_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers, then customers with their columns in another order and spelling."""
    name = f"{new_database(spark)}.partners"
    create_table(spark, name, {"id": "bigint", "name": "VARCHAR", "balance": "DOUBLE"})
    suppliers, customers = table(spark, folder, "supplier"), table(spark, folder, "customer")
    append_by_name(suppliers.selectExpr("s_name AS name", "s_acctbal AS balance", "s_suppkey AS id"), name)
    append_by_name(customers.selectExpr("c_acctbal AS BALANCE", "c_custkey AS Id", "c_name AS NAME"), name)
    return read_table(spark, name)


APPEND_SQL = """
SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier
UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer
"""


def truncate_insert(spark: SparkSession, folder: str) -> DataFrame:
    """A table filled, emptied, and filled again by an INSERT ... SELECT and an INSERT ... VALUES."""
    name = f"{new_database(spark)}.parts"
    create_table(spark, name, {"id": "bigint", "name": "VARCHAR", "size": "INTEGER"})
    parts = table(spark, folder, "part")
    append_by_name(parts.selectExpr("p_partkey AS id", "p_name AS name", "p_size AS size"), name)
    truncate(spark, name)
    parts.createOrReplaceTempView("feedkit_part")
    run_sql(spark, f"INSERT INTO {name} SELECT p_partkey, p_brand, p_size FROM feedkit_part")
    run_sql(spark, f"INSERT INTO {name} VALUES (-1, 'none', NULL)")
    return spark.table(name)


TRUNCATE_SQL = "SELECT p_partkey AS id, p_brand AS name, p_size AS size FROM part UNION ALL SELECT -1, 'none', NULL"


def stage_load_customers(spark: SparkSession, folder: str) -> DataFrame:
    database, path = new_database(spark), new_folder(spark, "stage")
    customers = table(spark, folder, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))
    customers.write.options(header=True, sep="|").csv(path)
    target = f"{database}.customers"
    create_table(
        spark,
        target,
        {"segment": "VARCHAR", "cust_id": "bigint", "origin": "VARCHAR", "c_name": "VARCHAR",
         "c_nationkey": "INTEGER", "c_acctbal": "DOUBLE"},
    )
    mapping = {
        "mappings": [
            to("c_custkey", "cust_id", "INTEGER"),
            to("c_mktsegment", "segment", "VARCHAR(6)"),
            to("feed", "origin", "VARCHAR", source_type="constant"),
        ]
    }
    stage_load(spark, path, mapping, f"{database}.staging", target, delimiter="|")
    return spark.table(target)


STAGE_LOAD_SQL = """
SELECT c_custkey AS cust_id, substring(c_mktsegment, 1, 6) AS segment, 'feed' AS origin, c_name, c_nationkey, c_acctbal
FROM customer
"""


def customer_files(spark: SparkSession, folder: str, condition: str) -> str:
    """Customers as delimited files, one folder for each nation."""
    path = new_folder(spark, "nations")
    customers = table(spark, folder, "customer").where(condition)
    rows = customers.select("c_custkey", "c_name", F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal"), F.col("c_nationkey").alias("nation"))
    rows.hint("rebalance", "nation").write.partitionBy("nation").options(sep="|", header=True).csv(path)
    return path


def listed_files(spark: SparkSession, folder: str) -> DataFrame:
    """What a stage's listing says of the files: the nation in their path, and that they have bytes and a time."""
    files = list_files(spark, customer_files(spark, folder, "true"), "*.csv")
    nation = F.regexp_extract("path", r"nation=(\d+)/", 1).cast("int").alias("nation")
    return files.where("length > 0 AND modificationTime IS NOT NULL").select(nation).distinct()


LISTED_SQL = "SELECT DISTINCT CAST(c_nationkey AS INTEGER) AS nation FROM customer"


def new_files_loaded(spark: SparkSession, folder: str) -> DataFrame:
    """Three runs over a stage: files of some nations, nothing new, files of the others. Staged rows and mapped ones."""
    database = new_database(spark)
    staging, target = f"{database}.staging", f"{database}.customers"
    create_loaded(spark, staging, {"c_custkey": "VARCHAR", "c_name": "VARCHAR", "c_acctbal": "VARCHAR"})
    create_loaded(spark, target, {"id": "bigint", "balance": "DOUBLE"})
    mapping = {"mappings": [to("c_custkey", "id", "bigint"), to("c_acctbal", "balance", "DOUBLE")]}

    def load(path: str) -> list[int]:
        return load_new_files(
            spark, path, lambda paths: read_with_header(spark, paths, "|", infer_types=False), staging, {target: lambda rows: apply_mapping(rows, mapping)}, pattern="*.csv"
        )

    first, rest = (customer_files(spark, folder, f"c_nationkey {sign} 10") for sign in ("<", ">="))
    for path in (first, first, rest):
        load(path)
    staged = spark.table(staging).select(F.col("c_custkey").cast("bigint").alias("id"), "c_name", "load_number")
    return staged.join(spark.table(target), ["id", "load_number"])


NEW_FILES_SQL = """
SELECT c_custkey AS id, CASE WHEN c_nationkey < 10 THEN 1 ELSE 2 END AS load_number, c_name, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS balance
FROM customer
"""


def merge_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers merged into customers by number and nation: two keys."""
    customers = table(spark, folder, "customer").selectExpr(
        "c_custkey AS id", "c_nationkey AS nation", "c_name AS name", "c_acctbal AS balance"
    )
    suppliers = table(spark, folder, "supplier").selectExpr(
        "s_nationkey AS NATION", "s_acctbal AS balance", "s_name AS name", "s_suppkey AS id"
    )
    name = f"{new_database(spark)}.merged"
    create_snapshot(merge_upsert(customers, suppliers, ["id", "nation"]), name)
    return spark.table(name)


MERGE_SQL = """
SELECT s_suppkey AS id, s_nationkey AS nation, s_name AS name, s_acctbal AS balance FROM supplier
UNION ALL
SELECT c_custkey, c_nationkey, c_name, c_acctbal FROM customer
WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey AND s_nationkey = c_nationkey)
"""


def loaded_tables(spark: SparkSession, folder: str) -> DataFrame:
    """The tables of a database that has one for each market segment of the customers and one for their nations' names."""
    database = new_database(spark)
    customers = table(spark, folder, "customer")
    for (segment,) in customers.select("c_mktsegment").distinct().collect():  # a handful
        overwrite_table(customers.where(F.col("c_mktsegment") == segment), f"{database}.of_{segment.lower()}")
    overwrite_table(table(spark, folder, "nation"), f"{database}.nation")
    return list_tables(spark, database).where("NOT isTemporary").select("tableName", "isTemporary")


LIST_TABLES_SQL = """
SELECT DISTINCT 'of_' || lower(c_mktsegment) AS "tableName", FALSE AS "isTemporary" FROM customer UNION ALL SELECT 'nation', FALSE
"""


QUERIES = {
    "group_count": Query(group_count, GROUP_COUNT_SQL),
    "table_preview": Query(table_preview, PREVIEW_SQL),
    "table_scan": Query(table_scan, "SELECT * FROM supplier"),
    "sql_query": Query(sql_query, SQL_QUERY_SQL),
    "append_by_name": Query(append_twice, APPEND_SQL),
    "truncate_insert": Query(truncate_insert, TRUNCATE_SQL),
    "listed_files": Query(listed_files, LISTED_SQL),
    "new_files_loaded": Query(new_files_loaded, NEW_FILES_SQL),
    "stage_load": Query(stage_load_customers, STAGE_LOAD_SQL),
    "merge_upsert": Query(merge_customers, MERGE_SQL),
    "list_tables": Query(loaded_tables, LIST_TABLES_SQL),
}

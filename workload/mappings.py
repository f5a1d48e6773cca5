"""Mappings and column functions on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedkit.functions import (
    map_all,
    map_by_index,
    map_by_name,
    map_by_position,
    row_hash,
    substring_columns,
    with_function,
)
from feedkit.functions.declared import declare_functions
from feedkit.operators import apply_mapping, conform, rename, rename_by_mapping
from workload.common import Query, table

RUN_DATE = "2001-12-31"


def to(source: str, target: str, type_name: str | None = None, **more: str) -> dict:
    """One entry of a mapping document."""
    entry = {"source": {"name": source, "type": more.pop("source_type", "")}, "target": {"name": target, **more}}
    if type_name:
        entry["target"]["type"] = type_name
    return entry


def map_cast(spark: SparkSession, folder: str) -> DataFrame:
    mapping = {
        "mappings": [
            to("o_orderkey", "ORDER_TEXT", "VARCHAR"),
            to("o_custkey", "CUST_ID", "INTEGER"),
            to("o_totalprice", "PRICE", "DOUBLE"),
            to("o_orderdate", "ORDER_DATE", "DATE"),
            to("o_orderpriority", "PRIORITY", "VARCHAR(5)"),
            to("o_orderpriority", "PRIORITY_NAME", "VARCHAR"),
        ]
    }
    return apply_mapping(table(spark, folder, "orders"), mapping)


CAST_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS "ORDER_TEXT", CAST(o_custkey AS INTEGER) AS "CUST_ID", o_totalprice AS "PRICE",
       CAST(o_orderdate AS DATE) AS "ORDER_DATE", substring(o_orderpriority, 1, 5) AS "PRIORITY",
       o_orderpriority AS "PRIORITY_NAME"
FROM orders
"""

LINE_MAPPING = {
    "mappings": [
        to("l_orderkey", "ORDER_ID", "INTEGER"),
        to(
            "l_shipdate",
            "SHIP_DATE",
            "DATE",
            expression="TO_DATE(date_format(l_shipdate, 'dd/MM/yyyy'),'dd/mm/yyyy')",
        ),
        to("", "LINE_KEY", "VARCHAR", expression=" l_orderkey ||','|| l_linenumber "),
        to("", "STATUS", "VARCHAR", expression="concat(l_returnflag, l_linestatus)"),
        to("l_returnflag", "RETURNED", "VARCHAR", expression="substring(l_returnflag, 1, 1)"),
        to("", "NET", "DOUBLE", expression="l_extendedprice * (1 - l_discount)"),
        to("", "STATIC_VALUE", "VARCHAR", expression="concat('', 'Im constant string')"),
        to("", "LOADED_ON", "DATE", expression="current_date()"),
    ]
}


def map_expression(spark: SparkSession, folder: str) -> DataFrame:
    return apply_mapping(table(spark, folder, "lineitem"), LINE_MAPPING, run_date=RUN_DATE)


EXPRESSION_SQL = f"""
SELECT CAST(l_orderkey AS INTEGER) AS "ORDER_ID",
       CAST(strptime(strftime(l_shipdate, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS "SHIP_DATE",
       CAST(l_orderkey AS VARCHAR) || ',' || CAST(l_linenumber AS VARCHAR) AS "LINE_KEY",
       l_returnflag || l_linestatus AS "STATUS", l_returnflag AS "RETURNED",
       l_extendedprice * (1 - l_discount) AS "NET", 'Im constant string' AS "STATIC_VALUE",
       DATE '{RUN_DATE}' AS "LOADED_ON"
FROM lineitem
"""


def map_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    """The text of a timestamp read back by its pattern."""
    mapping = {
        "mappings": [
            to("event_id", "EVENT_ID", "VARCHAR"),
            to(
                "ts",
                "HAPPENED",
                "TIMESTAMP",
                expression="to_timestamp(date_format(ts, 'yyyy/MM/dd HH:mm:ss'), 'yyyy/MM/dd HH:mm:ss')",
            ),
            to("value", "VALUE", "DOUBLE"),
        ]
    }
    mapped = apply_mapping(table(spark, folder, "events"), mapping)
    return mapped.withColumn("HAPPENED", F.col("HAPPENED").cast("timestamp_ntz"))


TIMESTAMP_SQL = """
SELECT CAST(event_id AS VARCHAR) AS "EVENT_ID", date_trunc('second', ts) AS "HAPPENED", value AS "VALUE" FROM events
"""


def map_lenient(spark: SparkSession, folder: str) -> DataFrame:
    """Values that cannot be converted become null."""
    mapping = {
        "mappings": [
            to("o_orderkey", "o_orderkey"),
            to("o_orderpriority", "PRIORITY_NUMBER", "INTEGER"),
            to("", "PRIORITY_DATE", "DATE", expression="to_date(o_orderpriority, 'dd.mm.yyyy')"),
            to("", "PRIORITY_RANK", "VARCHAR", expression="substring(o_orderpriority, 1, 1)"),
        ]
    }
    return apply_mapping(table(spark, folder, "orders"), mapping, on_error="null")


LENIENT_SQL = """
SELECT o_orderkey, TRY_CAST(o_orderpriority AS INTEGER) AS "PRIORITY_NUMBER",
       CAST(try_strptime(o_orderpriority, '%d.%m.%Y') AS DATE) AS "PRIORITY_DATE",
       substring(o_orderpriority, 1, 1) AS "PRIORITY_RANK"
FROM orders
"""


def map_functions(spark: SparkSession, folder: str) -> DataFrame:
    """The functions a mapping's expressions use, on values with nulls."""
    orders = table(spark, folder, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    mapping = {
        "mappings": [
            to("o_orderkey", "ORDER_ID", "VARCHAR"),
            to("", "CODE", "VARCHAR", expression="substring(o_orderpriority, 3, 4)"),
            to("", "PIPED", "VARCHAR", expression="o_orderpriority || '/' || status"),
            to("", "JOINED", "VARCHAR", expression="concat('<', status, '>')"),
            to("", "LISTED", "VARCHAR", expression="concat_ws(',', o_custkey, status, o_orderpriority)"),
            to("", "STATUS", "VARCHAR", expression="coalesce(status, 'none')"),
            to("", "ORDERED", "DATE", expression="to_date(substring(cast(o_orderdate as string), 1, 10))"),
            to("", "DAY_BEFORE", "DATE", expression="date_add(o_orderdate, -1)"),
            to("", "TODAY", "DATE", expression="current_date()"),
            to("", "CENTS", "INTEGER", expression="cast(round(o_totalprice * 100) as bigint)"),
        ]
    }
    return apply_mapping(orders, mapping, run_date=RUN_DATE)


FUNCTIONS_SQL = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS "ORDER_ID", substring(o_orderpriority, 3, 4) AS "CODE",
       o_orderpriority || '/' || status AS "PIPED", '<' || status || '>' AS "JOINED",
       concat_ws(',', CAST(o_custkey AS VARCHAR), status, o_orderpriority) AS "LISTED",
       coalesce(status, 'none') AS "STATUS", CAST(o_orderdate AS DATE) AS "ORDERED",
       CAST(o_orderdate - INTERVAL 1 DAY AS DATE) AS "DAY_BEFORE", DATE '{RUN_DATE}' AS "TODAY",
       CAST(round(o_totalprice * 100) AS BIGINT) AS "CENTS"
FROM (SELECT *, nullif(o_orderstatus, 'P') AS status FROM orders)
"""


def map_constant(spark: SparkSession, folder: str) -> DataFrame:
    mapping = {
        "mappings": [
            to("c_custkey", "CUST_ID", "INTEGER"),
            to("c_name", "NAME", "VARCHAR(13)"),
            to("I'm Constant", "STATIC_VALUE", "VARCHAR", source_type="constant"),
            to("7", "STATIC_NUMBER", "INTEGER", source_type="constant"),
        ]
    }
    return apply_mapping(table(spark, folder, "customer"), mapping)


CONSTANT_SQL = """
SELECT CAST(c_custkey AS INTEGER) AS "CUST_ID", substring(c_name, 1, 13) AS "NAME",
       'I''m Constant' AS "STATIC_VALUE", 7 AS "STATIC_NUMBER"
FROM customer
"""


def map_passthrough(spark: SparkSession, folder: str) -> DataFrame:
    mapping = {
        "mappings": [
            to("C_CUSTKEY", "cust_id", "VARCHAR"),
            to("c_acctbal", "balance"),
            to("c_mktsegment", "segment", "VARCHAR(4)"),
        ]
    }
    return apply_mapping(table(spark, folder, "customer"), mapping, keep_unmapped=True)


PASSTHROUGH_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS cust_id, c_acctbal AS balance, substring(c_mktsegment, 1, 4) AS segment,
       c_name, c_nationkey
FROM customer
"""


def map_rename(spark: SparkSession, folder: str) -> DataFrame:
    return rename(table(spark, folder, "customer"), {"c_custkey": "id", "C_NAME": "name"})


RENAME_SQL = "SELECT c_custkey AS id, c_name AS name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def map_rename_by_mapping(spark: SparkSession, folder: str) -> DataFrame:
    mapping = {"mappings": [to("p_partkey", "id"), to("p_brand", "brand"), to("no_such_column", "ignored")]}
    return rename_by_mapping(table(spark, folder, "part"), mapping)


RENAME_BY_MAPPING_SQL = "SELECT p_partkey AS id, p_name, p_brand AS brand, p_type, p_size, p_retailprice FROM part"


def map_conform(spark: SparkSession, folder: str) -> DataFrame:
    layout = {
        "properties": [
            {"name": "C_MKTSEGMENT", "type": "VARCHAR(3)"},
            {"name": "C_CUSTKEY", "type": "INTEGER"},
            {"name": "CLOSED_ON", "type": "DATE"},
            {"name": "C_ACCTBAL", "type": "DOUBLE"},
        ]
    }
    return conform(table(spark, folder, "customer"), layout, on_extra="drop", on_missing="null")


CONFORM_SQL = """
SELECT substring(c_mktsegment, 1, 3) AS "C_MKTSEGMENT", CAST(c_custkey AS INTEGER) AS "C_CUSTKEY",
       CAST(NULL AS DATE) AS "CLOSED_ON", c_acctbal AS "C_ACCTBAL"
FROM customer
"""


def part_texts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select("p_name", "p_brand", "p_type")


def cut(start: int, length: int):
    return lambda c: F.substring(c, start, length)


CUTS = [cut(2, 5), cut(3, 3), cut(1, 7)]


def cols_all(spark: SparkSession, folder: str) -> DataFrame:
    return map_all(part_texts(spark, folder), cut(2, 5))


COLS_ALL_SQL = """
SELECT substring(p_name, 2, 5) AS p_name, substring(p_brand, 2, 5) AS p_brand, substring(p_type, 2, 5) AS p_type
FROM part
"""


def cols_by_position(spark: SparkSession, folder: str) -> DataFrame:
    return map_by_position(part_texts(spark, folder), CUTS[:2])


COLS_BY_POSITION_SQL = """
SELECT substring(p_name, 2, 5) AS p_name, substring(p_brand, 3, 3) AS p_brand, substring(p_type, 2, 5) AS p_type
FROM part
"""


def cols_by_index(spark: SparkSession, folder: str) -> DataFrame:
    return map_by_index(table(spark, folder, "part"), [("p_type", 2), ("p_name", 0)], CUTS)


COLS_BY_INDEX_SQL = "SELECT substring(p_type, 1, 7) AS p_type, substring(p_name, 2, 5) AS p_name FROM part"


def cols_by_name_keep(spark: SparkSession, folder: str) -> DataFrame:
    return map_by_name(table(spark, folder, "part"), {"p_name": F.upper, "p_size": lambda c: c + 1})


COLS_KEEP_SQL = """
SELECT p_partkey, upper(p_name) AS p_name, p_brand, p_type, p_size + 1 AS p_size, p_retailprice FROM part
"""

POSITIONS = {"properties": [{"name": "p_name", "position": "2,8"}, {"name": "p_brand", "position": "4,9"}]}


def cols_substring_keep(spark: SparkSession, folder: str) -> DataFrame:
    return substring_columns(part_texts(spark, folder), POSITIONS)


COLS_SUBSTRING_KEEP_SQL = """
SELECT substring(p_name, 2, 7) AS p_name, substring(p_brand, 4, 6) AS p_brand, p_type FROM part
"""


def cols_by_name_only(spark: SparkSession, folder: str) -> DataFrame:
    return substring_columns(part_texts(spark, folder), POSITIONS, keep_others=False)


COLS_ONLY_SQL = "SELECT substring(p_name, 2, 7) AS p_name, substring(p_brand, 4, 6) AS p_brand FROM part"


def udf_short_name(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    return with_function(parts, "short_name", "p_name", lambda name: name[:2])


UDF_SQL = "SELECT p_partkey, p_name, substring(p_name, 1, 2) AS short_name FROM part"


def udf_nullable_int(spark: SparkSession, folder: str) -> DataFrame:
    """A function of whole numbers some of which are null: checksums, which Spark has no function for in this form."""
    customers = table(spark, folder, "customer").select("c_custkey", F.nullif("c_nationkey", F.lit(3)).cast("int").alias("nation"))
    return with_function(customers, "digits", "nation", lambda nation: "-".join(str(nation)))


UDF_INT_SQL = """
SELECT c_custkey, CAST(nullif(c_nationkey, 3) AS INTEGER) AS nation,
       array_to_string(string_split(CAST(nullif(c_nationkey, 3) AS VARCHAR), ''), '-') AS digits
FROM customer
"""


def map_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Patterns of every date function, next to texts that only look like them."""
    day = "date_format(o_orderdate, 'dd/MM/yyyy')"
    mapping = {
        "mappings": [
            to("o_orderkey", "ORDER_ID", "BIGINT"),
            to("", "TRIED", expression=f"try_to_date({day}, 'dd/mm/yyyy')"),
            to("", "STAMP", expression=f"to_timestamp({day}, 'dd/mm/yyyy')"),
            to("", "SHOWN", expression="date_format(o_orderdate, 'dd.mm.yyyy')"),
            to("", "NOON", expression=f"to_timestamp(concat({day}, ' 12:34:56'), 'dd/mm/yyyy HH:mm:ss')"),
            to("", "NIGHT", expression=f"to_timestamp(concat({day}, ' 23:59:08'), 'DD/MM/YYYY HH24:MI:SS')"),
            to("", "NAMED", expression="to_date(date_format(o_orderdate, 'dd-MMM-yyyy'), 'dd-mon-yyyy')"),
            to("", "HALF", expression="date_format(timestamp(o_orderdate) + INTERVAL 15 HOUR, 'yyyymmdd hh12:mi am')"),
            to("", "QUOTED", expression="concat('to_date(x, ''dd/mm/yyyy'') on current_date() for ', o_orderkey)"),
        ]
    }
    mapped = apply_mapping(table(spark, folder, "orders"), mapping, run_date=RUN_DATE)
    return mapped.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("NOON", "NIGHT")})


DATES_SQL = """
SELECT o_orderkey AS "ORDER_ID", CAST(o_orderdate AS DATE) AS "TRIED",
       CAST(o_orderdate AS DATE) + INTERVAL '12:34:56' AS "NOON",
       CAST(o_orderdate AS DATE) + INTERVAL '23:59:08' AS "NIGHT",
       CAST(o_orderdate AS DATE) AS "NAMED", strftime(o_orderdate, '%Y%m%d') || ' 03:00 PM' AS "HALF",
       CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS "STAMP", strftime(o_orderdate, '%d.%m.%Y') AS "SHOWN",
       'to_date(x, ''dd/mm/yyyy'') on current_date() for ' || o_orderkey AS "QUOTED"
FROM orders
"""


def map_lenient_cast(spark: SparkSession, folder: str) -> DataFrame:
    """Casts inside expressions give null where they would fail."""
    mapping = {
        "mappings": [
            to("o_orderkey", "ORDER_ID", "BIGINT"),
            to("o_orderpriority", "RANK", expression="cast(substr(o_orderpriority, 1, 1) as int) + 1"),
            to("o_orderpriority", "NUMBER", expression="coalesce(CAST(o_orderpriority AS INT), -1)"),
            to("o_orderstatus", "DAY", expression="to_date(concat(o_orderstatus, '1/01/2000'), 'dd/mm/yyyy')"),
            to("", "COLONS", expression="coalesce(substr(o_orderpriority, 1, 1)::int + 1, -1) + coalesce(o_orderpriority::bigint, 100)"),
            to("", "DIGIT", expression="(substring(o_orderpriority, 1, 1))::int::string"),
            to("", "CALLED", expression="int(nullif(substring(o_orderpriority, 1 + int(o_orderkey % 3), 1), '-'))"),
            to("", "DATED", expression="date(concat('1995-0', substr(o_orderpriority, 1, 1), '-', o_orderkey % 40))"),
            to("", "SECONDS", expression="unix_timestamp(concat('1995-01-01 00:00:', lpad(o_orderkey % 70, 2, '0'))) - unix_timestamp('1995-01-01 00:00:00')"),
        ]
    }
    return apply_mapping(table(spark, folder, "orders"), mapping, on_error="null")


LENIENT_CAST_SQL = """
SELECT o_orderkey AS "ORDER_ID", TRY_CAST(substring(o_orderpriority, 1, 1) AS INTEGER) + 1 AS "RANK",
       coalesce(TRY_CAST(o_orderpriority AS INTEGER), -1) AS "NUMBER", CAST(NULL AS DATE) AS "DAY",
       TRY_CAST(substring(o_orderpriority, 1, 1) AS INTEGER) + 101 AS "COLONS", substring(o_orderpriority, 1, 1) AS "DIGIT",
       TRY_CAST(nullif(substring(o_orderpriority, CAST(1 + o_orderkey % 3 AS INTEGER), 1), '-') AS INTEGER) AS "CALLED",
       TRY_CAST('1995-0' || substring(o_orderpriority, 1, 1) || '-' || o_orderkey % 40 AS DATE) AS "DATED",
       CASE WHEN o_orderkey % 70 < 60 THEN o_orderkey % 70 END AS "SECONDS"
FROM orders
"""


def map_declared(spark: SparkSession, folder: str) -> DataFrame:
    """Expressions that call functions declared in SQL, one of which calls another."""
    day = {"name": "day", "type": "DATE"}
    declare_functions(
        spark,
        {
            "functions": [
                {"name": "feedkit_rank", "parameters": [{"name": "priority", "type": "VARCHAR(20)"}], "returns": "INTEGER", "body": "CAST(substr(priority, 1, 1) AS INT)"},
                {"name": "feedkit_due", "parameters": [day, {"name": "priority", "type": "VARCHAR"}], "returns": "DATE", "body": "date_add(day, 10 * feedkit_rank(priority))"},
                {"name": "feedkit_shown", "parameters": [day], "returns": "VARCHAR", "body": "date_format(day, 'dd/mm/yyyy')"},
            ]
        },
    )
    mapping = {
        "mappings": [
            to("o_orderkey", "ORDER_ID", "BIGINT"),
            to("", "RANK", expression="feedkit_rank(o_orderpriority)"),
            to("", "DUE", expression="feedkit_shown(feedkit_due(date(o_orderdate), o_orderpriority))"),
        ]
    }
    return apply_mapping(table(spark, folder, "orders"), mapping)


DECLARED_SQL = """
SELECT o_orderkey AS "ORDER_ID", CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS "RANK",
       strftime(CAST(o_orderdate AS DATE) + 10 * CAST(substring(o_orderpriority, 1, 1) AS INTEGER), '%d/%m/%Y') AS "DUE"
FROM orders
"""


def customer_hash(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return customers.select("c_custkey", row_hash(["c_name", "c_nationkey", "c_mktsegment"]).alias("row_hash"))


def hash_part(text: str) -> str:
    return f"coalesce(length({text}) || ':' || {text}, '~')"


HASH_SQL = f"""
SELECT c_custkey, md5(concat_ws('|', {hash_part("nullif(c_mktsegment, 'BUILDING')")}, {hash_part("c_name")},
                                {hash_part("CAST(c_nationkey AS VARCHAR)")})) AS row_hash
FROM customer
"""

QUERIES = {
    "map_cast": Query(map_cast, CAST_SQL),
    "map_expression": Query(map_expression, EXPRESSION_SQL),
    "map_timestamp": Query(map_timestamp, TIMESTAMP_SQL),
    "map_lenient": Query(map_lenient, LENIENT_SQL),
    "map_functions": Query(map_functions, FUNCTIONS_SQL),
    "map_constant": Query(map_constant, CONSTANT_SQL),
    "map_passthrough": Query(map_passthrough, PASSTHROUGH_SQL),
    "map_rename": Query(map_rename, RENAME_SQL),
    "map_rename_by_mapping": Query(map_rename_by_mapping, RENAME_BY_MAPPING_SQL),
    "map_conform": Query(map_conform, CONFORM_SQL),
    "cols_all": Query(cols_all, COLS_ALL_SQL),
    "cols_by_position": Query(cols_by_position, COLS_BY_POSITION_SQL),
    "cols_by_index": Query(cols_by_index, COLS_BY_INDEX_SQL),
    "cols_by_name_keep": Query(cols_by_name_keep, COLS_KEEP_SQL),
    "cols_substring_keep": Query(cols_substring_keep, COLS_SUBSTRING_KEEP_SQL),
    "cols_by_name_only": Query(cols_by_name_only, COLS_ONLY_SQL),
    "udf_short_name": Query(udf_short_name, UDF_SQL),
    "udf_nullable_int": Query(udf_nullable_int, UDF_INT_SQL),
    "map_declared": Query(map_declared, DECLARED_SQL),
    "map_dates": Query(map_dates, DATES_SQL),
    "map_lenient_cast": Query(map_lenient_cast, LENIENT_CAST_SQL),
    "row_hash": Query(customer_hash, HASH_SQL),
}

"""Feeds: the given tables written as files of each kind and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedkit.sinks import create_table, load_positional
from feedkit.sources import (
    list_files,
    read_feed,
    read_fixed_width,
    read_positional,
    read_widths,
    read_with_header,
    split_feed,
)
from feedkit.sources.feeds import SplitFeed
from feedkit.workdir import new_folder
from workload.common import Query, new_database, table

CUSTOMER_SCHEMA = {
    "field_delimiter": "|",
    "header": False,
    "isFixedWidth": False,
    "properties": [
        {"name": "CUST_ID", "type": "INTEGER"},
        {"name": "NAME", "type": "VARCHAR"},
        {"name": "NATION", "type": "INTEGER"},
        {"name": "BALANCE", "type": "FLOAT"},
        {"name": "SEGMENT", "type": "VARHCAR"},
    ],
}


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as a feed has them: amounts with two decimals, one segment left empty."""
    return table(spark, folder, "customer").select(
        F.col("c_custkey"),
        F.col("c_name"),
        F.col("c_nationkey"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"),
    )


def feed_delimited(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "delimited")
    customers(spark, folder).write.options(sep="|", nullValue="NULL").csv(path)
    return read_feed(spark, path, CUSTOMER_SCHEMA, file_format={"null_if": ("NULL", "NULL")})


def feed_gzip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "gzip")
    customers(spark, folder).write.options(sep="|", header=True, compression="gzip").csv(path)
    return read_feed(spark, path, {**CUSTOMER_SCHEMA, "header": True})


CUSTOMER_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS "CUST_ID", c_name AS "NAME", CAST(c_nationkey AS VARCHAR) AS "NATION",
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS "BALANCE",
       nullif(c_mktsegment, 'BUILDING') AS "SEGMENT"
FROM customer
"""


def feed_header_infer(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "header")
    customers(spark, folder).write.options(sep=";", header=True).csv(path)
    df = read_with_header(spark, path, ";")
    return df.select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"),
        "c_name",
        F.col("c_nationkey").cast("int").alias("c_nationkey"),
        F.col("c_acctbal").cast("double").alias("c_acctbal"),
        "c_mktsegment",
    )


HEADER_SQL = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer
"""


def feed_positional(spark: SparkSession, folder: str) -> DataFrame:
    path, database = new_folder(spark, "positional"), new_database(spark)
    table(spark, folder, "supplier").withColumn("s_acctbal", F.col("s_acctbal").cast("decimal(18,2)")).write.csv(path)
    fields = read_positional(spark, path, [1, 4, 2], width=4)
    target = f"{database}.staging_supplier"
    create_table(spark, target, {"id": "INTEGER", "balance": "DOUBLE", "name": "VARCHAR(100)"})
    load_positional(fields, target)
    return spark.table(target)


POSITIONAL_SQL = "SELECT CAST(s_suppkey AS INTEGER) AS id, s_acctbal AS balance, s_name AS name FROM supplier"


def lineitem_lines(spark: SparkSession, folder: str) -> str:
    """Line items as a fixed-width file: fields of 12, 12, 4, 10 and 1 characters."""
    path = new_folder(spark, "fixed")
    amount = F.col("l_quantity").cast("decimal(8,2)").cast("string")
    table(spark, folder, "lineitem").select(
        F.concat(
            F.lpad(F.col("l_orderkey").cast("string"), 12, "0"),
            F.lpad(F.col("l_partkey").cast("string"), 12, " "),
            F.rpad(F.col("l_linenumber").cast("string"), 4, " "),
            F.lpad(amount, 10, " "),
            F.col("l_returnflag"),
        ).alias("value")
    ).write.text(path)
    return path


START_LENGTH = {
    "header": False,
    "isFixedWidth": True,
    "properties": [
        {"name": "ORDER_ID", "type": "INTEGER", "position": "1,12"},
        {"name": "LINE", "type": "INTEGER", "position": "25,4"},
        {"name": "QUANTITY", "type": "DOUBLE", "position": "29,10"},
        {"name": "FLAG", "type": "VARCHAR", "position": "39,1"},
    ],
}
START_END = [
    {"name": "ORDER_ID", "position": "1,12"},
    {"name": "PART_ID", "position": "13,24"},
    {"name": "FLAG", "position": "39,39"},
]


def fixed_start_length(spark: SparkSession, folder: str) -> DataFrame:
    return read_feed(spark, lineitem_lines(spark, folder), START_LENGTH)


START_LENGTH_SQL = """
SELECT lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS "ORDER_ID",
       rpad(CAST(l_linenumber AS VARCHAR), 4, ' ') AS "LINE",
       lpad(CAST(CAST(l_quantity AS DECIMAL(8,2)) AS VARCHAR), 10, ' ') AS "QUANTITY",
       l_returnflag AS "FLAG"
FROM lineitem
"""


def fixed_start_end(spark: SparkSession, folder: str) -> DataFrame:
    return read_fixed_width(spark, lineitem_lines(spark, folder), START_END, "start_end")


START_END_SQL = """
SELECT lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS "ORDER_ID",
       lpad(CAST(l_partkey AS VARCHAR), 12, ' ') AS "PART_ID", l_returnflag AS "FLAG"
FROM lineitem
"""


def fixed_widths(spark: SparkSession, folder: str) -> DataFrame:
    schema = "order_id INT, part_id INT, line INT, quantity DOUBLE, flag STRING(1)"
    return read_widths(spark, lineitem_lines(spark, folder), "12,12,4,10,1", schema)


WIDTHS_SQL = """
SELECT CAST(l_orderkey AS INTEGER) AS order_id, CAST(l_partkey AS INTEGER) AS part_id, l_linenumber AS line,
       l_quantity AS quantity, l_returnflag AS flag
FROM lineitem
"""


def fixed_generated_names(spark: SparkSession, folder: str) -> DataFrame:
    return read_widths(spark, lineitem_lines(spark, folder), [12, 12, 15])


GENERATED_SQL = """
SELECT lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS col0, lpad(CAST(l_partkey AS VARCHAR), 12, ' ') AS col1,
       rpad(CAST(l_linenumber AS VARCHAR), 4, ' ')
           || lpad(CAST(CAST(l_quantity AS DECIMAL(8,2)) AS VARCHAR), 10, ' ') || l_returnflag AS col2
FROM lineitem
"""


HEADER_LINE = "order_id    part_id     lineamount    f"


def lineitem_lines_with_header(spark: SparkSession, folder: str) -> str:
    """The fixed-width line items with a line of names on top of each file, and once more among the rows."""
    path = new_folder(spark, "fixed-header")
    rows = spark.read.text(lineitem_lines(spark, folder))
    again = spark.createDataFrame([(HEADER_LINE,)], "value string")
    # the CSV writer puts the column's name on top of each file; no line has its separator
    rows.unionByName(again).toDF(HEADER_LINE).write.options(header=True, sep="\u0001", quote="").csv(path)
    return path


def fixed_widths_header(spark: SparkSession, folder: str) -> DataFrame:
    schema = "order_id INT, part_id INT, line INT, amount DOUBLE, flag STRING(1)"
    path = lineitem_lines_with_header(spark, folder)
    return read_widths(spark, path, "12,12,4,10,1", schema, header=True, on_error="null")


WIDTHS_HEADER_SQL = """
SELECT CAST(l_orderkey AS INTEGER) AS order_id, CAST(l_partkey AS INTEGER) AS part_id, l_linenumber AS line,
       l_quantity AS amount, l_returnflag AS flag
FROM lineitem
UNION ALL SELECT NULL, NULL, NULL, NULL, 'f'
"""


def fixed_generated_names_header(spark: SparkSession, folder: str) -> DataFrame:
    return read_widths(spark, lineitem_lines_with_header(spark, folder), [12, 12, 15], header=True)


GENERATED_HEADER_SQL = GENERATED_SQL + f"""
UNION ALL SELECT '{HEADER_LINE[:12]}', '{HEADER_LINE[12:24]}', '{HEADER_LINE[24:]}'
"""


def fixed_null_if(spark: SparkSession, folder: str) -> DataFrame:
    """A fixed-width feed under a named file format: padding trimmed, tokens read as null."""
    settings = {"trim_space": True, "null_if": ["N", "1"]}
    return read_feed(spark, lineitem_lines(spark, folder), START_LENGTH, file_format=settings)


FIXED_NULL_SQL = """
SELECT lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS "ORDER_ID", nullif(CAST(l_linenumber AS VARCHAR), '1') AS "LINE",
       CAST(CAST(l_quantity AS DECIMAL(8,2)) AS VARCHAR) AS "QUANTITY", nullif(l_returnflag, 'N') AS "FLAG"
FROM lineitem
"""


def feed_options(spark: SparkSession, folder: str) -> DataFrame:
    """A delimited feed of many files, each with a title above its line of names; quoted and padded fields, null tokens."""
    path = new_folder(spark, "options")
    fields = F.concat_ws(
        ";", F.col("c_custkey").cast("string"), F.concat(F.lit(' "'), "c_name", F.lit(';x" ')), F.col("c_nationkey").cast("string"), F.lit("-"),
        F.coalesce("c_mktsegment", F.lit("?")),
    )
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = customers(spark, folder).select(F.pmod(F.xxhash64("c_custkey"), F.lit(files)).alias("part"), F.lit(2).alias("line"), fields.alias("value"))
    above = ["customers of the day", "CUST_ID;NAME;NATION;BALANCE;SEGMENT"]
    tops = lines.select("part").distinct().select("part", F.posexplode(F.array(*map(F.lit, above))).alias("line", "value"))
    parts = lines.unionByName(tops).repartition("part").sortWithinPartitions("part", "line")
    parts.drop("line").write.partitionBy("part").text(path)
    settings = {"skip_header": 2, "field_delimiter": ";", "field_optionally_enclosed_by": '"', "trim_space": True, "null_if": ["-", "?"]}
    return read_feed(spark, path, {"properties": CUSTOMER_SCHEMA["properties"]}, file_format=settings)


FEED_OPTIONS_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS "CUST_ID", c_name || ';x' AS "NAME", CAST(c_nationkey AS VARCHAR) AS "NATION",
       CAST(NULL AS VARCHAR) AS "BALANCE", nullif(c_mktsegment, 'BUILDING') AS "SEGMENT"
FROM customer
"""


def uneven_customers(spark: SparkSession, folder: str) -> tuple[SplitFeed, str]:
    """Customers as a feed in which some lines have a field too many and some two too few, and where it is."""
    path, key = new_folder(spark, "uneven"), F.col("c_custkey")
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")]
    line = F.when(key % 7 == 0, F.concat_ws("|", *fields, F.lit("extra"))).when(key % 5 == 1, F.concat_ws("|", *fields[:3]))
    lines = customers(spark, folder).select(F.coalesce(line, F.concat_ws("|", *fields)).alias("value"))
    lines.write.text(path)
    return split_feed(spark, path, CUSTOMER_SCHEMA), path


def feed_split_rows(spark: SparkSession, folder: str) -> DataFrame:
    return uneven_customers(spark, folder)[0].rows


SPLIT_ROWS_SQL = CUSTOMER_SQL + "WHERE c_custkey % 7 <> 0 AND c_custkey % 5 <> 1"


def feed_split_rejects(spark: SparkSession, folder: str) -> DataFrame:
    feed, path = uneven_customers(spark, folder)
    inside = F.col("file").contains(path.rpartition("/")[2]) & (F.col("block") >= 0)
    return feed.rejects.select("line", "reason", inside.alias("has_place"))


SPLIT_REJECTS_SQL = """
SELECT CASE WHEN c_custkey % 7 = 0 THEN concat_ws('|', c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)),
                                                  CASE c_mktsegment WHEN 'BUILDING' THEN '' ELSE c_mktsegment END, 'extra')
            ELSE concat_ws('|', c_custkey, c_name, c_nationkey) END AS line,
       'field_count' AS reason, true AS has_place
FROM customer WHERE c_custkey % 7 = 0 OR c_custkey % 5 = 1
"""


def feed_split_counts(spark: SparkSession, folder: str) -> DataFrame:
    """How many lines of the feed are rows and how many are not, without a look at any field."""
    feed, _ = uneven_customers(spark, folder)
    kept, refused = feed.rows.agg(F.count("*").alias("kept")), feed.rejects.agg(F.count("*").alias("refused"))
    return kept.join(refused)


SPLIT_COUNTS_SQL = """
SELECT count(*) FILTER (c_custkey % 7 <> 0 AND c_custkey % 5 <> 1) AS kept, count(*) FILTER (c_custkey % 7 = 0 OR c_custkey % 5 = 1) AS refused
FROM customer
"""


def stage_files(spark: SparkSession, folder: str) -> DataFrame:
    return list_files(spark, folder, "*.parquet")


QUERIES = {
    "feed_delimited": Query(feed_delimited, CUSTOMER_SQL),
    "feed_gzip": Query(feed_gzip, CUSTOMER_SQL),
    "feed_header_infer": Query(feed_header_infer, HEADER_SQL),
    "feed_positional": Query(feed_positional, POSITIONAL_SQL),
    "fixed_start_length": Query(fixed_start_length, START_LENGTH_SQL),
    "fixed_start_end": Query(fixed_start_end, START_END_SQL),
    "fixed_widths": Query(fixed_widths, WIDTHS_SQL),
    "fixed_generated_names": Query(fixed_generated_names, GENERATED_SQL),
    "fixed_widths_header": Query(fixed_widths_header, WIDTHS_HEADER_SQL),
    "fixed_generated_names_header": Query(fixed_generated_names_header, GENERATED_HEADER_SQL),
    "fixed_null_if": Query(fixed_null_if, FIXED_NULL_SQL),
    "feed_options": Query(feed_options, FEED_OPTIONS_SQL),
    "feed_split_rows": Query(feed_split_rows, SPLIT_ROWS_SQL),
    "feed_split_rejects": Query(feed_split_rejects, SPLIT_REJECTS_SQL),
    "feed_split_counts": Query(feed_split_counts, SPLIT_COUNTS_SQL),
    "list_files": Query(stage_files),
}

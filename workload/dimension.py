"""Checks and Type-2 loads on a dimension of buying profiles.

The dimension has a row per customer and order priority. All orders up to the run date make the
dimension as it stands, with the first order's profile as history until the end of its year; all later
orders make the feed.
So some keys are only in one of the two, some are equal, some differ, and some began on the run date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedkit.operators import apply_mapping, merge_upsert, quality
from feedkit.operators import type2 as steps
from feedkit.operators.digest import DIGEST, scd2_by_digest, with_digest
from feedkit.operators.dimension import Load
from feedkit.operators.type2 import scd2
from feedkit.plans import create_dimension, create_logged, first_rows, fold, load_dimension, load_logged, merge_logged
from feedkit.sinks import create_table
from feedkit.sources import read_feed
from feedkit.workdir import new_folder, written
from workload.common import Query, new_database, table
from workload.mappings import to

RUN_DATE = "1998-06-30"
KEYS = ["cust_id", "priority"]
VALUES = ["finished", "open", "tier"]
VALIDITY = dict(start_col="start_date", end_col="end_date", flag_col="active_flag")
CALL = dict(keys=KEYS, **VALIDITY, run_date=RUN_DATE)


def profiles(orders: DataFrame) -> DataFrame:
    """One row per key. All its aggregates combine before the shuffle."""
    return orders.groupBy(F.col("o_custkey").alias("cust_id"), F.col("o_orderpriority").alias("priority")).agg(
        F.when(F.count_if(F.col("o_orderstatus") == "F") > 0, "F").alias("finished"),
        F.when(F.count_if(F.col("o_orderstatus") == "O") > 0, "O").alias("open"),
        F.nullif(F.floor(F.max("o_totalprice") / 100000).cast("int"), F.lit(0)).alias("tier"),
        F.nullif(F.floor(F.min("o_totalprice") / 100000).cast("int"), F.lit(0)).alias("first_tier"),
        F.min("o_orderdate").cast("date").alias("first_day"),
        F.max("o_orderdate").cast("date").alias("last_day"),
    )


def feed(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").where(F.col("o_orderdate").cast("date") > F.lit(RUN_DATE).cast("date"))
    return profiles(orders).select(*KEYS, *VALUES)


def past_profiles(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").where(F.col("o_orderdate").cast("date") <= F.lit(RUN_DATE).cast("date"))
    return profiles(orders)


def dimension(spark: SparkSession, folder: str) -> DataFrame:
    """The profile now, and before it that of the first order if it was in an earlier year."""
    versions = F.when(F.year("first_day") < F.year("last_day"), F.array(F.lit(True), F.lit(False)))
    rows = past_profiles(spark, folder).withColumn("now", F.explode(F.coalesce(versions, F.array(F.lit(True)))))
    now, year_end = F.col("now"), F.make_date(F.year("first_day"), F.lit(12), F.lit(31))
    return rows.select(
        *KEYS,
        F.when(now, F.col("finished")).alias("finished"),
        F.when(now, F.col("open")).otherwise("O").alias("open"),
        F.when(now, F.col("tier")).otherwise(F.col("first_tier")).alias("tier"),
        F.when(now, F.col("last_day")).otherwise(F.col("first_day")).alias("start_date"),
        F.when(now, F.lit("9999-12-31").cast("date")).otherwise(year_end).alias("end_date"),
        F.when(now, "Y").otherwise("N").alias("active_flag"),
    )


def load_of(refresh_type: str = "delta", **changes: str) -> Load:
    return Load.of(refresh_type=refresh_type, **{**CALL, **changes})


# ---------------------------------------------------------------- the same in SQL

TIERS = "nullif(CAST(floor({}(o_totalprice) / 100000) AS INTEGER), 0)"


def profiles_sql(name: str, condition: str = "") -> str:
    return f"""{name} AS (
    SELECT o_custkey AS cust_id, o_orderpriority AS priority,
           CASE WHEN bool_or(o_orderstatus = 'F') THEN 'F' END AS finished,
           CASE WHEN bool_or(o_orderstatus = 'O') THEN 'O' END AS open,
           {TIERS.format("max")} AS tier, {TIERS.format("min")} AS first_tier,
           CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day
    FROM orders {condition and f"WHERE CAST(o_orderdate AS DATE) {condition} DATE '{RUN_DATE}'"} GROUP BY ALL)"""


TABLES_SQL = f"""
WITH {profiles_sql("past", "<=")}, {profiles_sql("future", ">")},
feed AS (SELECT cust_id, priority, finished, open, tier FROM future),
dim AS (
    SELECT cust_id, priority, finished, open, tier, last_day AS start_date, DATE '9999-12-31' AS end_date,
           'Y' AS active_flag FROM past
    UNION ALL
    SELECT cust_id, priority, NULL, 'O', first_tier, first_day, make_date(year(first_day), 12, 31), 'N'
    FROM past WHERE year(first_day) < year(last_day))"""

SAME_KEY = "f.cust_id = a.cust_id AND f.priority = a.priority"
DIFFERENT = "(f.finished, f.open, f.tier) IS DISTINCT FROM (a.finished, a.open, a.tier)"
IS_ACTIVE = "(end_date IS NULL OR end_date = DATE '9999-12-31')"
NEW = f"DATE '{RUN_DATE}' AS start_date, DATE '9999-12-31' AS end_date, 'Y' AS active_flag"
A_VALUES = "a.cust_id, a.priority, a.finished, a.open, a.tier"
F_VALUES = "f.cust_id, f.priority, f.finished, f.open, f.tier"
CLOSED = f"{A_VALUES}, a.start_date, DATE '{RUN_DATE}' - 1 AS end_date, 'N' AS active_flag"


def load_sql(dim: str, source: str, out: str, refresh_type: str = "delta") -> str:
    """The load as a union of joins: CTEs that end in ``out``, and ``out_changes`` on the way."""
    gone = f"SELECT * FROM {out}_act a WHERE NOT EXISTS (SELECT 1 FROM {source} f WHERE {SAME_KEY})"
    if refresh_type == "full":
        closed_gone, kept_gone = f"UNION ALL SELECT {CLOSED} FROM ({gone}) a", ""
    else:
        closed_gone, kept_gone = "", f"UNION ALL {gone}"
    return f"""
{out}_act AS (SELECT * FROM {dim} WHERE {IS_ACTIVE}),
{out}_new AS (
    SELECT {F_VALUES}, {NEW} FROM {source} f LEFT JOIN {out}_act a ON {SAME_KEY}
    WHERE a.cust_id IS NULL OR {DIFFERENT}),
{out}_changes AS (
    SELECT * FROM {out}_new
    UNION ALL
    SELECT {CLOSED} FROM {out}_act a JOIN {source} f ON {SAME_KEY}
    WHERE {DIFFERENT} AND a.start_date <> DATE '{RUN_DATE}'
    {closed_gone}),
{out} AS (
    SELECT * FROM {out}_changes
    UNION ALL
    SELECT a.* FROM {out}_act a JOIN {source} f ON {SAME_KEY} WHERE NOT ({DIFFERENT})
    {kept_gone}
    UNION ALL
    SELECT h.* FROM {dim} h WHERE NOT {IS_ACTIVE}
        AND NOT EXISTS (SELECT 1 FROM {out}_new n WHERE n.cust_id = h.cust_id AND n.priority = h.priority
                        AND n.start_date = h.start_date))"""


def on_tables(*ctes: str, select: str) -> str:
    return ",".join([TABLES_SQL, *ctes]) + "\n" + select


# ---------------------------------------------------------------- steps


def scd2_active(spark: SparkSession, folder: str) -> DataFrame:
    return steps.active(dimension(spark, folder), load_of())


def scd2_blank(spark: SparkSession, folder: str) -> DataFrame:
    return steps.blank_rows(dimension(spark, folder), load_of())


def scd2_changed(spark: SparkSession, folder: str) -> DataFrame:
    return steps.changed(feed(spark, folder), dimension(spark, folder), load_of())


def scd2_new(spark: SparkSession, folder: str) -> DataFrame:
    return steps.new_rows(feed(spark, folder), dimension(spark, folder), load_of())


def scd2_to_close(spark: SparkSession, folder: str) -> DataFrame:
    return steps.to_close(feed(spark, folder), dimension(spark, folder), load_of())


def scd2_missing(spark: SparkSession, folder: str) -> DataFrame:
    return steps.missing(feed(spark, folder), dimension(spark, folder), load_of())


def scd2_stats(spark: SparkSession, folder: str) -> DataFrame:
    return steps.stats(feed(spark, folder), dimension(spark, folder), load_of())


def scd2_change_set(spark: SparkSession, folder: str) -> DataFrame:
    return steps.change_set(feed(spark, folder), dimension(spark, folder), load_of("full"))


ACT = f"act AS (SELECT * FROM dim WHERE {IS_ACTIVE})"

STATS_SQL = on_tables(
    ACT,
    select=f"""
SELECT CASE WHEN a.cust_id IS NULL THEN 'insert' WHEN f.cust_id IS NULL THEN 'missing'
            WHEN NOT ({DIFFERENT}) THEN 'same' WHEN a.start_date = DATE '{RUN_DATE}' THEN 'inplace'
            ELSE 'version' END AS action, count(*) AS n
FROM feed f FULL JOIN act a ON {SAME_KEY} GROUP BY 1""",
)

def scd2_steps(spark: SparkSession, folder: str) -> DataFrame:
    """The change set put together from the single steps."""
    source, target, load = feed(spark, folder), dimension(spark, folder), load_of("full")
    incoming = steps.changed(source, target, load).unionByName(steps.new_rows(source, target, load))
    outgoing = steps.to_close(source, target, load).unionByName(steps.missing(source, target, load))
    return steps.opened(incoming, target, load).unionByName(steps.closed(outgoing, load))


# ---------------------------------------------------------------- loads


def scd2_delta(spark: SparkSession, folder: str) -> DataFrame:
    shouted = dict(keys=["CUST_ID", "Priority"], start_col="START_DATE", end_col="End_Date", flag_col="ACTIVE_FLAG")
    return scd2(feed(spark, folder), dimension(spark, folder), refresh_type=" Delta", run_date=RUN_DATE, **shouted)


def scd2_full(spark: SparkSession, folder: str) -> DataFrame:
    return scd2(feed(spark, folder), dimension(spark, folder), refresh_type="full", **CALL)


def scd2_small_source(spark: SparkSession, folder: str) -> DataFrame:
    """A full load in the form that leaves the target in place when the source can be broadcast."""
    source = written(feed(spark, folder), "feed")
    return scd2(source, dimension(spark, folder), refresh_type="full", small_source=True, **CALL)


def scd2_close_blank(spark: SparkSession, folder: str) -> DataFrame:
    return scd2(feed(spark, folder), dimension(spark, folder), close_blank=True, **CALL)


def scd2_first_load(spark: SparkSession, folder: str) -> DataFrame:
    """Profiles of all orders into an empty dimension."""
    empty = spark.createDataFrame([], dimension(spark, folder).schema)
    return scd2(profiles(table(spark, folder, "orders")).select(*KEYS, *VALUES), empty, **CALL)


def scd2_merge(spark: SparkSession, folder: str) -> DataFrame:
    """The change set merged into the dimension by key and start date."""
    target = dimension(spark, folder)
    changes = written(steps.change_set(feed(spark, folder), target, load_of()), "changes")
    return merge_upsert(target, changes, KEYS, "start_date")


def scd2_digest(spark: SparkSession, folder: str) -> DataFrame:
    """A full load into a dimension that keeps a digest of each row: only keys that differ are read whole."""
    target = written(with_digest(dimension(spark, folder), load_of()), "digested")
    return scd2_by_digest(feed(spark, folder), target, load_of("full")).drop(DIGEST)


def logged_dimension(spark: SparkSession, folder: str) -> str:
    name = f"{new_database(spark)}.profiles"
    create_logged(spark, name, COLUMNS, KEYS, "start_date", "end_date")
    first_rows(dimension(spark, folder), name, "active_flag")
    return name


NEXT_DATE = "1998-07-31"


def scd2_logged_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Loads that append their changes to a log, merged when read: a full one, a delta, and once the log is folded a full one."""
    name = logged_dimension(spark, folder)
    before = past_profiles(spark, folder).select(*KEYS, *VALUES)
    load_logged(feed(spark, folder), name, "active_flag", "full", RUN_DATE)
    load_logged(before, name, "active_flag", "delta", NEXT_DATE)
    fold(spark, name)
    load_logged(feed(spark, folder), name, "active_flag", "full", NEXT_DATE)
    return spark.table(name)


def scd2_merge_logged(spark: SparkSession, folder: str) -> DataFrame:
    """The change set merged in place into a dimension with a log, its columns in another order."""
    name = logged_dimension(spark, folder)
    changes = steps.change_set(feed(spark, folder), spark.table(name), load_of())
    merge_logged(changes.select(*reversed(changes.columns)), name, "active_flag")
    return spark.table(name)


LOGGED_SQL = on_tables(
    "before AS (SELECT cust_id, priority, finished, open, tier FROM past)",
    load_sql("dim", "feed", "one", "full"),
    load_sql("one", "before", "two").replace(RUN_DATE, NEXT_DATE),
    load_sql("two", "feed", "three", "full").replace(RUN_DATE, NEXT_DATE),
    select="SELECT * FROM three",
)


COLUMNS = {
    "cust_id": "bigint", "priority": "VARCHAR", "finished": "VARCHAR", "open": "VARCHAR", "tier": "INTEGER",
    "start_date": "DATE", "active_flag": "CHAR", "end_date": "DATE",
}


def dimension_table(spark: SparkSession, folder: str) -> str:
    name = f"{new_database(spark)}.profiles"
    create_table(spark, name, COLUMNS, partitioned_by=["end_date"])
    # Brings the rows of an end date together in few files, and splits a date that has very many.
    rows = dimension(spark, folder).select(*COLUMNS).hint("rebalance", "end_date")
    rows.write.insertInto(name)
    return name


def scd2_load_table(spark: SparkSession, folder: str) -> DataFrame:
    name = dimension_table(spark, folder)
    load_dimension(written(feed(spark, folder), "feed"), name, refresh_type="full", **CALL)
    return spark.table(name)


def bucketed_table(spark: SparkSession, folder: str) -> str:
    """The dimension as a table whose rows are kept by bucket of the key."""
    name = f"{new_database(spark)}.profiles"
    create_dimension(spark, name, {c: t for c, t in COLUMNS.items() if c != "end_date"} | {"end_date": "DATE"}, "end_date", 32)
    bucket = F.pmod(F.xxhash64(*KEYS), F.lit(32)).cast("int").alias("key_bucket")
    rows = dimension(spark, folder).select(*[c for c in COLUMNS if c != "end_date"], "end_date", bucket)
    rows.hint("rebalance", "end_date", "key_bucket").write.insertInto(name)
    return name


def scd2_delta_touched(spark: SparkSession, folder: str) -> DataFrame:
    """A delta load into a table with key buckets; those without a change stay."""
    name = bucketed_table(spark, folder)
    load_dimension(feed(spark, folder), name, **CALL)
    return spark.table(name).drop("key_bucket")


FEED_SCHEMA = {
    "field_delimiter": "|",
    "header": False,
    "isFixedWidth": False,
    "properties": [{"name": n.upper(), "type": "VARCHAR"} for n in [*KEYS, *VALUES]],
}
FEED_MAPPING = {
    "mappings": [
        to("CUST_ID", "cust_id", "bigint"),
        to("PRIORITY", "priority", "VARCHAR(20)"),
        to("FINISHED", "finished", "VARCHAR(1)"),
        to("OPEN", "open", "VARCHAR(1)"),
        to("TIER", "tier", "INTEGER"),
    ]
}


def feed_to_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """From file to dimension: a delimited feed read by its schema, mapped, checked and loaded."""
    path, name = new_folder(spark, "feed"), dimension_table(spark, folder)
    feed(spark, folder).write.options(sep="|").csv(path)
    mapped = apply_mapping(read_feed(spark, path, FEED_SCHEMA), FEED_MAPPING)
    load_dimension(mapped, name, refresh_type="full", **CALL)
    return spark.table(name)


def scd2_rerun_same_day(spark: SparkSession, folder: str) -> DataFrame:
    """Three loads on one day: the feed, the profiles of before, the feed again. Keys close and reopen."""
    name = dimension_table(spark, folder)
    today = written(feed(spark, folder), "feed")
    before = written(past_profiles(spark, folder).select(*KEYS, *VALUES), "before")
    for source in (today, before, today):
        load_dimension(source, name, refresh_type="full", **CALL)
    return spark.table(name)


CLOSE_BLANK_SQL = on_tables(
    load_sql("dim", "feed", "loaded"),
    select=f"""
SELECT cust_id, priority, finished, open, tier, start_date,
       CASE WHEN {{blank}} THEN DATE '{RUN_DATE}' - 1 ELSE end_date END AS end_date,
       CASE WHEN {{blank}} THEN 'N' ELSE active_flag END AS active_flag
FROM loaded l""".format(
        blank=f"""(finished IS NULL AND open IS NULL AND tier IS NULL AND {IS_ACTIVE}
            AND EXISTS (SELECT 1 FROM loaded_act a WHERE a.cust_id = l.cust_id AND a.priority = l.priority
                        AND a.finished IS NULL AND a.open IS NULL AND a.tier IS NULL))"""
    ),
)

# ---------------------------------------------------------------- checks


def dq_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


def dq_max_dates(spark: SparkSession, folder: str) -> DataFrame:
    return quality.max_dates(dimension(spark, folder), load_of())


def dq_max_dates_footers(spark: SparkSession, folder: str) -> DataFrame:
    """The latest dates of the stored dimension, out of its files' footers."""
    rows, path = dimension(spark, folder), new_folder(spark, "dimension")
    rows.write.parquet(path)
    return quality.max_dates_of_files(spark, path, load_of())


def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    """All checks, on a feed with a row per order and a load dated before the dimension's latest start."""
    orders = table(spark, folder, "orders")
    repeated = orders.select(
        F.nullif("o_custkey", F.lit(1)).alias("CUST_ID"),
        F.col("o_orderpriority").alias("PRIORITY"),
        F.col("o_orderstatus").alias("FINISHED"),
        F.col("o_orderstatus").alias("OPEN"),
        F.lit(1).alias("TIER"),
    )
    return quality.report(repeated, dimension(spark, folder), load_of(run_date="1998-01-01"))


def dq_report_passed(spark: SparkSession, folder: str) -> DataFrame:
    return quality.report(feed(spark, folder), dimension(spark, folder), load_of())


def dq_report_failed_names(spark: SparkSession, folder: str) -> DataFrame:
    """Names that one of the tables lacks, and more keys than allowed."""
    load = Load.of(["o_custkey", "c_custkey", "nobody"], "c_since", "c_until", "c_active", run_date=RUN_DATE)
    return quality.report(table(spark, folder, "orders"), table(spark, folder, "customer"), load, max_keys=2)


def dq_report_failed_arguments(spark: SparkSession, folder: str) -> DataFrame:
    """Nothing given, for tables whose columns differ."""
    load = Load.of([], "", " ", "", run_date=RUN_DATE)
    return quality.report(table(spark, folder, "nation"), table(spark, folder, "region"), load, max_keys=5)


def names_sql(source: str, target: str, keys: list[str], start: str, end: str, flag: str, most: int) -> str:
    """The checks of names and arguments, from the tables' own columns. Names are compared in lower case."""
    listed = ", ".join(f"'{k}'" for k in keys)
    return f"""
WITH s AS (SELECT column_name AS c, row_number() OVER () AS i FROM (DESCRIBE {source})),
t AS (SELECT column_name AS c, row_number() OVER () AS i FROM (DESCRIBE {target})),
k AS (SELECT unnest([{listed}]::VARCHAR[]) AS c, generate_subscripts([{listed}]::VARCHAR[], 1) AS i),
compared AS (SELECT c FROM t WHERE lower(c) NOT IN ('{start}', '{end}', '{flag}')),
different AS (
    SELECT c FROM s WHERE lower(c) NOT IN (SELECT lower(c) FROM compared)
    UNION ALL SELECT c FROM compared WHERE lower(c) NOT IN (SELECT lower(c) FROM s)),
checks AS (
    SELECT 'source_has_columns' AS "check", EXISTS (FROM s) AS passed, 'the source has no columns' AS message
    UNION ALL SELECT 'target_has_columns', EXISTS (FROM t), 'the target has no columns'
    UNION ALL SELECT 'start_column_given', '{start}' <> '', 'no start date column given'
    UNION ALL SELECT 'end_column_given', '{end}' <> '', 'no end date column given'
    UNION ALL SELECT 'flag_column_given', '{flag}' <> '', 'no active flag column given'
    UNION ALL SELECT 'start_column_in_target', '{start}' IN (SELECT c FROM t), 'the target has no column {start}'
    UNION ALL SELECT 'end_column_in_target', '{end}' IN (SELECT c FROM t), 'the target has no column {end}'
    UNION ALL SELECT 'flag_column_in_target', '{flag}' IN (SELECT c FROM t), 'the target has no column {flag}'
    UNION ALL SELECT 'keys_given', EXISTS (FROM k), 'no key column given'
    UNION ALL SELECT 'keys_at_most', (SELECT count(*) FROM k) <= {most}, 'more than {most} key columns: ' || coalesce((SELECT string_agg(c, ' ' ORDER BY i) FROM k), '')
    UNION ALL SELECT 'keys_in_target', NOT EXISTS (SELECT 1 FROM k WHERE c NOT IN (SELECT c FROM t)),
        'key columns not in the target: ' || coalesce((SELECT string_agg(c, ' ' ORDER BY i) FROM k WHERE c NOT IN (SELECT c FROM t)), '')
    UNION ALL SELECT 'keys_in_source', NOT EXISTS (SELECT 1 FROM k WHERE c NOT IN (SELECT c FROM s)),
        'key columns not in the source: ' || coalesce((SELECT string_agg(c, ' ' ORDER BY i) FROM k WHERE c NOT IN (SELECT c FROM s)), '')
    UNION ALL SELECT 'same_columns', NOT EXISTS (FROM different),
        'columns found in one table but not in the other: ' || coalesce((SELECT string_agg(lower(c), ' ' ORDER BY lower(c)) FROM different), ''))
SELECT "check", passed, CASE WHEN passed THEN '' ELSE message END AS message FROM checks"""


def dq_report_failed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Keys that repeat on both sides, and an active end date before the latest end date."""
    load = load_of(keys=["priority"], active_end_date="1995-12-31")
    return quality.report(feed(spark, folder), dimension(spark, folder), load)


FAILED_ROWS_SQL = on_tables(
    "act AS (SELECT * FROM dim WHERE end_date IS NULL OR end_date = DATE '1995-12-31')",
    select=f"""
SELECT "check", passed, CASE WHEN passed THEN '' ELSE message END AS message FROM (
    SELECT unnest({{checks}}) AS "check", TRUE AS passed, '' AS message
    UNION ALL
    SELECT 'run_date_not_before_start', max(start_date) <= DATE '{RUN_DATE}', '' FROM dim
    UNION ALL
    SELECT 'active_end_not_before_end', max(end_date) <= DATE '1995-12-31',
           'active end date 1995-12-31 is before the latest end date ' || max(end_date) FROM dim
    UNION ALL
    SELECT 'target_keys_unique', count(*) = 0, 'keys with more than one active row in the target: ' || count(*)
    FROM (SELECT priority FROM act GROUP BY priority HAVING count(*) > 1)
    UNION ALL
    SELECT 'source_keys_unique', count(*) = 0, 'keys that occur more than once in the source: ' || count(*)
    FROM (SELECT priority FROM feed GROUP BY priority HAVING count(*) > 1)
    UNION ALL
    SELECT 'source_keys_not_null', count(*) = 0, 'source rows with a null in the key: ' || count(*) FROM feed WHERE priority IS NULL)
""",
)

CHECKS = [
    "source_has_columns", "target_has_columns", "start_column_given", "end_column_given", "flag_column_given",
    "start_column_in_target", "end_column_in_target", "flag_column_in_target", "keys_given", "keys_at_most",
    "keys_in_target", "keys_in_source", "same_columns",
]


def report_sql(source: str, run_date: str) -> str:
    passed = "\nUNION ALL ".join(f"SELECT '{c}' AS \"check\", TRUE AS passed, '' AS message" for c in CHECKS)
    return on_tables(
        f"src AS ({source})",
        ACT,
        f"""counted AS (
    SELECT 'target_keys_unique' AS "check", 'keys with more than one active row in the target: ' AS message,
           (SELECT count(*) FROM (SELECT 1 FROM act GROUP BY cust_id, priority HAVING count(*) > 1)) AS n
    UNION ALL
    SELECT 'source_keys_unique', 'keys that occur more than once in the source: ',
           (SELECT count(*) FROM (SELECT 1 FROM src GROUP BY cust_id, priority HAVING count(*) > 1))
    UNION ALL
    SELECT 'source_keys_not_null', 'source rows with a null in the key: ',
           (SELECT count(*) FROM src WHERE cust_id IS NULL OR priority IS NULL)),
dated AS (
    SELECT 'run_date_not_before_start' AS "check", DATE '{run_date}' AS given, max(start_date) AS latest,
           'run date {run_date} is before the latest start date ' AS message FROM dim
    UNION ALL
    SELECT 'active_end_not_before_end', DATE '9999-12-31', max(end_date),
           'active end date 9999-12-31 is before the latest end date ' FROM dim)""",
        select=f"""
{passed}
UNION ALL
SELECT "check", n = 0, CASE WHEN n = 0 THEN '' ELSE message || n END FROM counted
UNION ALL
SELECT "check", latest <= given, CASE WHEN latest <= given THEN '' ELSE message || CAST(latest AS VARCHAR) END FROM dated
""",
    )


QUERIES = {
    "scd2_active": Query(scd2_active, on_tables(ACT, select="SELECT * FROM act")),
    "scd2_blank": Query(
        scd2_blank,
        on_tables(ACT, select="SELECT * FROM act WHERE finished IS NULL AND open IS NULL AND tier IS NULL"),
    ),
    "scd2_changed": Query(
        scd2_changed,
        on_tables(ACT, select=f"SELECT f.* FROM feed f JOIN act a ON {SAME_KEY} WHERE {DIFFERENT}"),
    ),
    "scd2_new": Query(
        scd2_new,
        on_tables(ACT, select=f"SELECT f.* FROM feed f LEFT JOIN act a ON {SAME_KEY} WHERE a.cust_id IS NULL"),
    ),
    "scd2_to_close": Query(
        scd2_to_close,
        on_tables(
            ACT,
            select=f"""SELECT a.* FROM act a JOIN feed f ON {SAME_KEY}
WHERE {DIFFERENT} AND a.start_date <> DATE '{RUN_DATE}'""",
        ),
    ),
    "scd2_missing": Query(
        scd2_missing,
        on_tables(ACT, select=f"SELECT a.* FROM act a LEFT JOIN feed f ON {SAME_KEY} WHERE f.cust_id IS NULL"),
    ),
    "scd2_stats": Query(scd2_stats, STATS_SQL),
    "scd2_change_set": Query(
        scd2_change_set,
        on_tables(load_sql("dim", "feed", "loaded", "full"), select="SELECT * FROM loaded_changes"),
    ),
    "scd2_steps": Query(
        scd2_steps,
        on_tables(load_sql("dim", "feed", "loaded", "full"), select="SELECT * FROM loaded_changes"),
    ),
    "scd2_delta": Query(scd2_delta, on_tables(load_sql("dim", "feed", "loaded"), select="SELECT * FROM loaded")),
    "scd2_full": Query(
        scd2_full, on_tables(load_sql("dim", "feed", "loaded", "full"), select="SELECT * FROM loaded")
    ),
    "scd2_small_source": Query(
        scd2_small_source, on_tables(load_sql("dim", "feed", "loaded", "full"), select="SELECT * FROM loaded")
    ),
    "scd2_close_blank": Query(scd2_close_blank, CLOSE_BLANK_SQL),
    "scd2_first_load": Query(scd2_first_load, on_tables(profiles_sql("whole"), select=f"SELECT cust_id, priority, finished, open, tier, {NEW} FROM whole")),
    "scd2_merge": Query(scd2_merge, on_tables(load_sql("dim", "feed", "loaded"), select="SELECT * FROM loaded")),
    "scd2_load_table": Query(
        scd2_load_table, on_tables(load_sql("dim", "feed", "loaded", "full"), select="SELECT * FROM loaded")
    ),
    "scd2_delta_touched": Query(
        scd2_delta_touched, on_tables(load_sql("dim", "feed", "loaded"), select="SELECT * FROM loaded")
    ),
    "scd2_digest": Query(scd2_digest, on_tables(load_sql("dim", "feed", "loaded", "full"), select="SELECT * FROM loaded")),
    "scd2_logged_loads": Query(scd2_logged_loads, LOGGED_SQL),
    "scd2_merge_logged": Query(scd2_merge_logged, on_tables(load_sql("dim", "feed", "loaded"), select="SELECT * FROM loaded")),
    "feed_to_dimension": Query(
        feed_to_dimension, on_tables(load_sql("dim", "feed", "loaded", "full"), select="SELECT * FROM loaded")
    ),
    "scd2_rerun_same_day": Query(
        scd2_rerun_same_day,
        on_tables(
            "before AS (SELECT cust_id, priority, finished, open, tier FROM past)",
            load_sql("dim", "feed", "one", "full"),
            load_sql("one", "before", "two", "full"),
            load_sql("two", "feed", "three", "full"),
            select="SELECT * FROM three",
        ),
    ),
    "dq_duplicates": Query(
        dq_duplicates,
        'SELECT l_orderkey, l_linenumber, count(*) AS "count" FROM lineitem GROUP BY ALL HAVING count(*) > 1',
    ),
    "dq_max_dates": Query(
        dq_max_dates,
        on_tables(select="SELECT max(start_date) AS max_start, max(end_date) AS max_end FROM dim"),
    ),
    "dq_max_dates_footers": Query(
        dq_max_dates_footers,
        on_tables(select="SELECT max(start_date) AS max_start, max(end_date) AS max_end FROM dim"),
    ),
    "dq_report": Query(
        dq_report,
        report_sql(
            "SELECT nullif(o_custkey, 1) AS cust_id, o_orderpriority AS priority FROM orders", "1998-01-01"
        ),
    ),
    "dq_report_failed_names": Query(
        dq_report_failed_names, names_sql("orders", "customer", ["o_custkey", "c_custkey", "nobody"], "c_since", "c_until", "c_active", 2)
    ),
    "dq_report_failed_arguments": Query(dq_report_failed_arguments, names_sql("nation", "region", [], "", "", "", 5)),
    "dq_report_failed_rows": Query(dq_report_failed_rows, FAILED_ROWS_SQL.format(checks=CHECKS)),
    "dq_report_passed": Query(dq_report_passed, report_sql("SELECT * FROM feed", RUN_DATE)),
}

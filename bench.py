"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and then three times into the ``noop`` sink; the median counts. Input
files and tables that a query reads but does not make are written before the clock starts, and so is the
dimension table that a whole load (checks, change, commit) is measured on, anew for each run.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from feedkit.operators.digest import changes_by_digest, with_digest
from feedkit.operators.type2 import scd2
from feedkit.plans import load_dimension, load_logged
from feedkit.sources import read_feed
from feedkit.workdir import written
from workload import dimension, feeds, mappings

RUNS = 3
FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def headline(spark: SparkSession) -> dict:
    lines = feeds.lineitem_lines(spark, FOLDER)
    profiles = written(dimension.dimension(spark, FOLDER), "profiles")
    feed = written(dimension.feed(spark, FOLDER), "feed")
    digested = written(with_digest(profiles, dimension.load_of()), "digested")
    call = dimension.CALL
    return {
        "map_expression": lambda: mappings.map_expression(spark, FOLDER),
        "fixed_start_length": lambda: read_feed(spark, lines, feeds.START_LENGTH),
        "scd2_delta": lambda: scd2(feed, profiles, refresh_type="delta", **call),
        "scd2_full": lambda: scd2(feed, profiles, refresh_type="full", **call),
        "scd2_small_source": lambda: scd2(feed, profiles, small_source=True, **call),
        "changes_by_digest": lambda: changes_by_digest(feed, digested, dimension.load_of("full")).rows,
        "dq_duplicates": lambda: dimension.dq_duplicates(spark, FOLDER),
        "dq_report": lambda: dimension.quality.data_checks(feed, profiles, dimension.load_of()),
    }


def seconds(query) -> float:
    begin = time.perf_counter()
    query().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def load_seconds(spark: SparkSession, make_table, load) -> float:
    name = make_table(spark, FOLDER)
    begin = time.perf_counter()
    load(name)
    return time.perf_counter() - begin


def loads(feed) -> dict:
    """Whole loads: how the table is made, and how it is loaded."""

    def plain(refresh_type: str):
        return lambda name: load_dimension(feed, name, refresh_type=refresh_type, stage_source=False, **dimension.CALL)

    return {
        "load_dimension_delta": (dimension.dimension_table, plain("delta")),
        "load_dimension_full": (dimension.dimension_table, plain("full")),
        "load_dimension_buckets": (dimension.bucketed_table, plain("delta")),
        "load_logged_delta": (dimension.logged_dimension, lambda name: load_logged(feed, name, "active_flag", "delta", dimension.RUN_DATE)),
    }


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name, query in headline(spark).items():
        seconds(query)
        times[name] = round(statistics.median(seconds(query) for _ in range(RUNS)), 4)
    feed = written(dimension.feed(spark, FOLDER), "feed")
    for name, (make_table, load) in loads(feed).items():
        load_seconds(spark, make_table, load)
        times[name] = round(statistics.median(load_seconds(spark, make_table, load) for _ in range(RUNS)), 4)
    result = {
        "metric": "headline queries, total of medians",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()

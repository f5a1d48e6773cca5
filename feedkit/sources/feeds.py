"""Feeds: delimited, compressed and fixed-width files."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.functions.names import column, quoted, reject_duplicates
from feedkit.functions.positions import spans
from feedkit.functions.types import cast_as, one_of
from feedkit.sources.config import load_json
from feedkit.sources.options import (
    after_read,
    checked_line,
    csv_options,
    fixed_field,
    fixed_width_settings,
    header_lines,
    settings_of,
    text_options,
)
from feedkit.workdir import new_folder, written

MISMATCHES = ("fail", "permit")
#: Column of a line that cannot be read as its schema says.
LINE = "__line"


def read_feed(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str | dict,
    *,
    file_format: Mapping[str, object] | None = None,
    on_mismatch: str = "fail",
    positions: str = "start_length",
    partitions: int | None = None,
) -> DataFrame:
    """Read a feed as its schema document declares it; every field is a string.

    ``isFixedWidth`` in the document chooses fixed width, otherwise ``header`` and ``field_delimiter``
    apply, together with the options of ``file_format``. Declared types are left to the mapping, so a
    bad value is met where a rule for it exists. A row with too few or too many fields fails the read
    unless ``on_mismatch='permit'``. ``partitions`` spreads rows after the read: a gzip file arrives
    in one task, whatever its size.
    """
    document = load_json(spark, schema)
    properties = document["properties"]
    one_of(on_mismatch, MISMATCHES, "on_mismatch")
    if document.get("isFixedWidth"):
        header = bool(document.get("header"))
        df = read_fixed_width(spark, path, properties, positions, header=header, file_format=file_format)
    else:
        names = [p["name"] for p in properties]
        reject_duplicates(names, "feed schema")
        df = _delimited(spark, path, names, _settings(document, file_format, on_mismatch == "fail"))
    return df if partitions is None else df.repartition(partitions)


@dataclass(frozen=True)
class SplitFeed:
    """A feed's ``rows``, and its ``rejects``: ``file``, ``block`` (where the split begins), ``line`` and ``reason``."""

    rows: DataFrame
    rejects: DataFrame


def split_feed(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str | dict,
    *,
    file_format: Mapping[str, object] | None = None,
    positions: str = "start_length",
) -> SplitFeed:
    """Rows of a feed as :func:`read_feed` gives them and, apart from them, the lines that are none.

    A line goes with the reason ``field_count`` if it has too few or too many fields, ``characters`` if it holds bytes
    that are no text, unless they are to be replaced; its bytes then show as U+FFFD. Fixed width knows only the second:
    a short line has empty fields. The feed is read once, and both results stored apart in the shared folder.
    """
    document = load_json(spark, schema)
    settings = _settings(document, file_format, mismatch_fails=True)
    replaces = str(settings_of(settings)["replace_invalid_characters"]).strip().upper() == "TRUE"
    if document.get("isFixedWidth"):
        fixed_width_settings(file_format)
        names = ["value"]
        skip = max(header_lines(settings_of(file_format)), int(bool(document.get("header"))))
        read = _placed_lines(spark, path, skip, settings_of(file_format))
        wrong = F.lit(not replaces) & ~F.is_valid_utf8("value")
        judged = read.select("value", "file", "block", F.when(wrong, F.make_valid_utf8("value")).alias("line"), F.when(wrong, "characters").alias("reason"))
    else:
        names = [p["name"] for p in document["properties"]]
        reject_duplicates([*names, LINE, "file", "block", "line", "reason", "rejected"], "feed schema")
        read = _delimited_with_place(spark, path, names, settings)
        whole = F.concat_ws(settings_of(settings)["field_delimiter"], *[column(n) for n in names])
        wrong = F.lit(not replaces) & whole.contains("\ufffd")
        reason = F.when(F.col(LINE).isNotNull(), "field_count").when(wrong, "characters")
        judged = read.select(*[column(n) for n in names], "file", "block", F.coalesce(LINE, F.when(wrong, whole)).alias("line"), reason.alias("reason"))
    stored, kept = new_folder(spark, "feed"), [column(n) for n in names]
    judged.withColumn("rejected", F.col("reason").isNotNull()).write.partitionBy("rejected").parquet(stored)
    fields = ", ".join([_ddl(names), "file string, block long, line string, reason string, rejected boolean"])
    both = spark.read.schema(fields).parquet(stored)
    rows = both.where("NOT rejected").select(*kept)
    if document.get("isFixedWidth"):
        rows = _cut(rows.select(F.make_valid_utf8("value").alias("value")), document["properties"], positions, fixed_width_settings(file_format), file_format)
    else:
        rows = after_read(rows, settings)
    return SplitFeed(rows, both.where("rejected").select("file", "block", "line", "reason"))


def read_with_header(
    spark: SparkSession, path: str | Sequence[str], delimiter: str = ",", infer_types: bool = True
) -> DataFrame:
    """A delimited file that names its own columns. Inferring types costs a second pass over the file."""
    return spark.read.options(header=True, inferSchema=infer_types, sep=delimiter).csv(path)


def read_positional(
    spark: SparkSession,
    path: str | Sequence[str],
    ordinals: Sequence[int],
    *,
    width: int,
    file_format: Mapping[str, object] | None = None,
) -> DataFrame:
    """Fields of a staged file of ``width`` columns by ordinal, counted from 1, as ``_c0``, ``_c1``, ...

    The width is declared because finding it out would mean reading the file first.
    """
    if not ordinals or min(ordinals) < 1 or max(ordinals) > width:
        raise ValueError(f"ordinals are 1 to {width}")
    names = [f"_c{i}" for i in range(width)]
    return _delimited(spark, path, names, file_format).select(*[names[i - 1] for i in ordinals])


def read_fixed_width(
    spark: SparkSession,
    path: str | Sequence[str],
    properties: Sequence[dict],
    positions: str = "start_length",
    *,
    header: bool = False,
    file_format: Mapping[str, object] | None = None,
) -> DataFrame:
    """Fixed-width lines cut by position, every field a string with its padding.

    Lines are read as text, so no character can split a row; blank lines are dropped. A field beyond
    the end of a short line is empty. ``header=True`` drops the first line of each file, whatever it
    holds; ``file_format`` may name more lines, and what else means something without delimiters.
    """
    settings = fixed_width_settings(file_format)
    lines = _lines(spark, path, max(header_lines(settings), int(header)), settings)
    return _cut(lines, properties, positions, settings, file_format)


def read_widths(
    spark: SparkSession,
    path: str | Sequence[str],
    widths: str | Sequence[int],
    schema: str | None = None,
    *,
    header: bool = False,
    length_policy: str = "truncate",
    on_error: str = "raise",
) -> DataFrame:
    """Fixed-width lines cut into consecutive ``widths`` (``"10,5,10"``).

    With a ``schema`` such as ``"col1 STRING(10), col2 INT"`` the fields are trimmed and cast, without
    one they are the strings ``col0``, ``col1``, ... as cut. ``header=True`` drops the first line of
    each file, whatever it holds.
    """
    numbers = [int(w) for w in (widths.split(",") if isinstance(widths, str) else widths)]
    fields = parse_schema(schema) if schema else [(f"col{i}", None) for i in range(len(numbers))]
    if len(fields) != len(numbers):
        raise ValueError(f"{len(fields)} columns but {len(numbers)} widths")
    reject_duplicates([name for name, _ in fields], "fixed-width layout")
    layout = spans([{"name": n, "position": w} for (n, _), w in zip(fields, numbers)], "widths")
    cuts = {name: F.substring("value", start, length) for name, start, length in layout}
    return _lines(spark, path, int(header), settings_of(None)).select(
        *[
            cuts[name].alias(name)
            if type_name is None
            else cast_as(F.trim(cuts[name]), type_name, length_policy=length_policy, on_error=on_error).alias(name)
            for name, type_name in fields
        ]
    )


def parse_schema(text: str) -> list[tuple[str, str]]:
    """``"a STRING(10), b INT"`` -> ``[("a", "STRING(10)"), ("b", "INT")]``."""
    fields = []
    for part in re.split(r",(?![^(]*\))", text):
        match = re.fullmatch(r"\s*(\w+)\s+(\w+\s*(?:\([\d\s,]+\))?)\s*", part)
        if not match:
            raise ValueError(f"{part.strip()!r} is not a column name and a type")
        fields.append((match[1], match[2].strip()))
    return fields


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Directory of a stage: path, size and modification time. File contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length", "modificationTime")


def _settings(document: dict, file_format: Mapping[str, object] | None, mismatch_fails: bool) -> dict[str, object]:
    """What the schema document and the file format say of a delimited feed."""
    settings = {"field_delimiter": document.get("field_delimiter", ","), "error_on_column_count_mismatch": mismatch_fails, **(file_format or {})}
    if "header" in document and header_lines(settings_of(settings)) < 2:
        settings["skip_header"] = int(bool(document["header"]))
    return settings


def _cut(
    lines: DataFrame, properties: Sequence[dict], positions: str, settings: Mapping[str, object], file_format: Mapping[str, object] | None
) -> DataFrame:
    reject_duplicates([p["name"] for p in properties], "fixed-width layout")
    fields = {name: F.substring("value", start, length) for name, start, length in spans(properties, positions)}
    return lines.select(*[fixed_field(cut, settings, file_format).alias(n) for n, cut in fields.items()])


def _strings(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def _delimited(
    spark: SparkSession, path: str | Sequence[str], names: Sequence[str], file_format: Mapping[str, object] | None
) -> DataFrame:
    settings, options = settings_of(file_format), csv_options(file_format)
    skip = header_lines(settings)
    if skip < 2:
        return after_read(spark.read.options(**options).schema(_strings(names)).csv(path), file_format)
    parsed = F.from_csv("value", _ddl(names), options)
    rows = _lines(spark, path, skip, settings).select(parsed.alias("row"))
    # the condition holds for every row; without it a row of which no field is used would not be parsed, nor its fields counted
    return after_read(rows.where("row IS NOT NULL").select("row.*"), file_format)


def _delimited_with_place(
    spark: SparkSession, path: str | Sequence[str], names: Sequence[str], file_format: Mapping[str, object]
) -> DataFrame:
    """The fields as read, ``LINE`` where their number is wrong, and file and block."""
    settings, skip = settings_of(file_format), header_lines(settings_of(file_format))
    options = {**csv_options(file_format), "mode": "PERMISSIVE", "columnPruning": "false", "columnNameOfCorruptRecord": LINE}
    if skip < 2:
        read = spark.read.options(**options).schema(_strings([*names, LINE])).csv(path)
        return read.select("*", *_place())
    parsed = F.from_csv("value", _ddl([*names, LINE]), options)
    return _placed_lines(spark, path, skip, settings).select(parsed.alias("row"), "file", "block").select("row.*", "file", "block")


def _lines(spark: SparkSession, path: str | Sequence[str], skip: int, settings: Mapping[str, object]) -> DataFrame:
    """Lines that are not blank, without the first ``skip`` of each file."""
    return _placed_lines(spark, path, skip, settings).select(checked_line(settings).alias("value"))


def _placed_lines(spark: SparkSession, path: str | Sequence[str], skip: int, settings: Mapping[str, object]) -> DataFrame:
    lines = spark.read.options(**text_options(settings)).text(path).select("value", *_place())
    return (_without_first(lines, skip) if skip else lines).where(F.trim("value") != "")


def _place() -> list[Column]:
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]


def _without_first(lines: DataFrame, skip: int) -> DataFrame:
    """Lines by their place in the file, not by what they hold, and whichever splits the first ones lie in.

    A pass over the lines counts those of each split; running totals by where the splits begin tell which lines come
    first. Lines are known by a number that Spark gives them as it reads, the same in both passes: the files, and
    how they are split, are those of one relation. Neither pass leaves the JVM. The numbers of the first lines,
    ``skip`` a file, are written to the shared folder, so that Spark sees whether they can be broadcast.
    """
    placed = lines.withColumn("number", F.monotonically_increasing_id())
    splits = placed.groupBy("file", "block").agg(F.min("number").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    tops = splits.withColumn("left", skip - before).where("left > 0 AND n > 0")
    numbers = tops.select(F.explode(F.expr("sequence(first, first + least(n, left) - 1)")).alias("number"))
    first = written(numbers, "first-lines").withColumn("goes", F.lit(True))
    # null, not an anti join: a condition on the value alone would be moved below that, and a check of fields meet the first lines
    value = F.when(F.col("goes").isNull(), F.col("value")).alias("value")
    return placed.join(first, "number", "left").select(value, "file", "block")


def _ddl(names: Sequence[str]) -> str:
    return ", ".join(f"{quoted(n)} string" for n in names)

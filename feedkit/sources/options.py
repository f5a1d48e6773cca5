"""Named file formats: warehouse CSV options as ``DataFrameReader`` options."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.functions.names import column

# The options of a delimited file format and their defaults.
FILE_FORMAT_DEFAULTS = {
    "field_delimiter": ",",
    "skip_header": "0",
    "compression": "AUTO",
    "record_delimiter": "\\n",
    "skip_blank_lines": "FALSE",
    "date_format": "AUTO",
    "time_format": "AUTO",
    "timestamp_format": "AUTO",
    "binary_format": "HEX",
    "escape": "NONE",
    "escape_unenclosed_field": "NONE",
    "trim_space": "FALSE",
    "field_optionally_enclosed_by": "NONE",
    "error_on_column_count_mismatch": "TRUE",
    "replace_invalid_characters": "FALSE",
    "empty_field_as_null": "TRUE",
    "skip_byte_order_mark": "TRUE",
    "encoding": "UTF8",
    "file_extension": "",
    "null_if": "",
}

# Option names that mean one of the above.
OPTION_ALIASES = {"comperssion": "compression", "delimiter": "field_delimiter"}

# The options that mean something for fields cut by position.
FIXED_WIDTH = (
    "skip_header", "compression", "record_delimiter", "skip_blank_lines", "trim_space", "replace_invalid_characters",
    "empty_field_as_null", "skip_byte_order_mark", "encoding", "file_extension", "null_if",
)

# What Spark always does; the opposite is refused.
ALWAYS = ("skip_blank_lines", "skip_byte_order_mark")

# Formats Spark recognises by the file's extension; there is nothing to set on the reader.
COMPRESSIONS = ("AUTO", "NONE", "GZIP", "BZ2", "DEFLATE", "SNAPPY", "ZSTD")


def settings_of(file_format: Mapping[str, object] | None) -> dict[str, object]:
    """The format's options under their own names, with the defaults of those not given."""
    given = {}
    for name, value in (file_format or {}).items():
        key = OPTION_ALIASES.get(name.lower(), name.lower())
        if key == "type":
            if str(value).upper() != "CSV":
                raise ValueError(f"file format type {value} is not delimited text")
        elif key in ALWAYS and _flag(value) == "false":
            raise ValueError(f"{key}=FALSE: Spark always does")
        elif key in FILE_FORMAT_DEFAULTS:
            given[key] = value
        else:
            raise ValueError(f"unknown file format option {name}")
    return {**FILE_FORMAT_DEFAULTS, **given}


def fixed_width_settings(file_format: Mapping[str, object] | None) -> dict[str, object]:
    """The format's options for fields cut by position; one that is only for delimited fields is refused."""
    for name in file_format or {}:
        key = OPTION_ALIASES.get(name.lower(), name.lower())
        if key in FILE_FORMAT_DEFAULTS and key not in FIXED_WIDTH:
            raise ValueError(f"{name} means nothing for fixed width")
    return settings_of(file_format)


def text_options(settings: Mapping[str, object]) -> dict[str, str]:
    """Reader options for lines of text."""
    if _upper(settings["compression"]) not in COMPRESSIONS:
        raise ValueError(f"compression {settings['compression']} cannot be read")
    options = {} if _upper(settings["encoding"]) == "UTF8" else {"encoding": str(settings["encoding"])}
    if _text(settings["record_delimiter"]) not in ("\n", "\r\n"):
        options["lineSep"] = _text(settings["record_delimiter"])
    if settings["file_extension"]:
        options["pathGlobFilter"] = "*" + str(settings["file_extension"])
    return options


def header_lines(settings: Mapping[str, object]) -> int:
    """How many lines at the top of each file are no rows."""
    lines = int(settings["skip_header"])
    if lines < 0:
        raise ValueError(f"skip_header {lines} is no number of lines")
    return lines


def csv_options(file_format: Mapping[str, object] | None = None) -> dict[str, str]:
    """Reader options of a file format. What Spark cannot do is refused rather than ignored.

    Spark itself skips one line of a file; the callers skip more.
    """
    merged = settings_of(file_format)
    options = {
        "sep": _text(merged["field_delimiter"]),
        "header": str(header_lines(merged) == 1).lower(),
        "encoding": "UTF-8" if _upper(merged["encoding"]) == "UTF8" else str(merged["encoding"]),
        "ignoreLeadingWhiteSpace": _flag(merged["trim_space"]),
        "ignoreTrailingWhiteSpace": _flag(merged["trim_space"]),
    }
    if _upper(merged["compression"]) not in COMPRESSIONS:
        raise ValueError(f"compression {merged['compression']} cannot be read")
    if _text(merged["record_delimiter"]) not in ("\n", "\r\n"):
        options["lineSep"] = _text(merged["record_delimiter"])
    for ours, spark_option in (("date_format", "dateFormat"), ("timestamp_format", "timestampFormat")):
        if _upper(merged[ours]) != "AUTO":
            options[spark_option] = str(merged[ours])
    if _upper(merged["time_format"]) != "AUTO":
        raise ValueError("time_format: fields are read as text, convert them in the mapping")
    if _upper(merged["binary_format"]) != "HEX":
        raise ValueError("binary_format: only HEX, decoded with unhex in the mapping")
    quote = merged["field_optionally_enclosed_by"]
    options["quote"] = "" if _upper(quote) == "NONE" else _text(quote)
    escapes = {_text(merged[k]) for k in ("escape", "escape_unenclosed_field")} - {"NONE"}
    if len(escapes) > 1:
        raise ValueError("escape and escape_unenclosed_field differ; Spark has one escape character")
    options["escape"] = escapes.pop() if escapes else '"'
    if _flag(merged["error_on_column_count_mismatch"]) == "true":
        # Without reading every column Spark would not notice a wrong column count in count() or a
        # narrow select, so the check costs column pruning.
        options.update(mode="FAILFAST", columnPruning="false")
    tokens = null_tokens(merged)
    if len(tokens) == 1 and not _keeps_empty(merged):
        options["nullValue"] = tokens[0]
    if merged["file_extension"]:
        options["pathGlobFilter"] = "*" + str(merged["file_extension"])
    return options


def null_tokens(settings: Mapping[str, object]) -> list[str]:
    """The distinct texts that stand for null, in the order given."""
    value = settings["null_if"] or []
    values: Sequence[str] = [value] if isinstance(value, str) else list(value)
    return list(dict.fromkeys(values))


def after_read(df: DataFrame, file_format: Mapping[str, object] | None) -> DataFrame:
    """What the reader cannot do by itself: several null tokens, empty fields that stay empty, bytes that are no text."""
    settings = settings_of(file_format)
    tokens, keeps_empty = null_tokens(settings), _keeps_empty(settings)
    columns = []
    for name in df.columns:
        value = checked(column(name), settings)
        value = F.coalesce(value, F.lit("")) if keeps_empty else value
        several = len(tokens) > 1 or (tokens and keeps_empty)
        columns.append((F.when(~value.isin(*tokens), value) if several else value).alias(name))
    return df.select(*columns)


def checked(value: Column, settings: Mapping[str, object]) -> Column:
    """Bytes that are no text arrive as U+FFFD. Unless they are to be replaced, such a field fails the read."""
    if _flag(settings["replace_invalid_characters"]) == "true":
        return value
    message = F.concat(F.lit("invalid characters in "), value)
    return F.when(value.contains("\ufffd"), F.raise_error(message).cast("string")).otherwise(value)


def checked_line(settings: Mapping[str, object]) -> Column:
    """A line of text as it was read, under the same rule."""
    if _flag(settings["replace_invalid_characters"]) == "true":
        return F.make_valid_utf8("value")
    message = F.concat(F.lit("invalid characters in "), F.make_valid_utf8("value"))
    return F.when(~F.is_valid_utf8("value"), F.raise_error(message).cast("string")).otherwise(F.col("value"))


def fixed_field(value: Column, settings: Mapping[str, object], given: Mapping[str, object] | None) -> Column:
    """A field cut by position under the format's options. Tokens for null are compared without the padding."""
    if _flag(settings["trim_space"]) == "true":
        value = F.trim(value)
    tokens = null_tokens(settings)
    if any(name.lower() == "empty_field_as_null" for name in given or {}) and _flag(settings["empty_field_as_null"]) == "true":
        tokens = [*tokens, ""]
    return F.when(~F.trim(value).isin(*tokens), value) if tokens else value


def _keeps_empty(settings: Mapping[str, object]) -> bool:
    if _flag(settings["empty_field_as_null"]) == "true":
        return False
    if _flag(settings["error_on_column_count_mismatch"]) == "false":
        raise ValueError("empty_field_as_null=FALSE: in rows that are too short an absent field would look empty")
    return True


def _upper(value: object) -> str:
    return str(value).strip().upper()


def _flag(value: object) -> str:
    text = _upper(value)
    if text not in ("TRUE", "FALSE"):
        raise ValueError(f"expected TRUE or FALSE, not {value}")
    return text.lower()


def _text(value: object) -> str:
    return str(value).replace("\\r", "\r").replace("\\n", "\n").replace("\\t", "\t")

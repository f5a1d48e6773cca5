"""Type names, length rules and date patterns of schema and mapping files.

Those files are written for a warehouse: ``VARCHAR(5)``, ``INTEGER``, ``dd/mm/yyyy``. Spark spells
these differently or, worse, accepts them with another meaning, so they are translated here once.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedkit.functions.lenient import lenient

# The type names that occur in schema and mapping files, and the Spark type of each.
# VARHCAR is a misspelling that occurs in real schema files; CHAR maps to string because Spark's
# char(n) pads with blanks on read.
TYPE_NAMES = {
    "CHAR": "string",
    "DATE": "date",
    "DOUBLE": "double",
    "FLOAT": "float",
    "INT": "int",
    "INTEGER": "int",
    "STRING": "string",
    "TIMESTAMP": "timestamp",
    "VARCHAR": "string",
    "VARHCAR": "string",
}

LENGTH_POLICIES = ("truncate", "error", "ignore")
DATE_DIALECTS = ("warehouse", "spark")
ERROR_MODES = ("raise", "null")

_TYPE = re.compile(r"\s*([A-Za-z_]+)\s*(?:\(\s*(\d+)\s*\))?\s*")
# Functions whose last argument is the pattern of a date.
DATE_FUNCTIONS = ("to_date", "try_to_date", "to_timestamp", "try_to_timestamp", "date_format", "unix_timestamp", "to_unix_timestamp")

_LITERAL = re.compile(r"('(?:[^'\\]|\\.|'')*')")
_CALL = re.compile(r"(\w*)\s*\(|\)|(\S)")
# The elements of a warehouse's date patterns, in any case, and Spark's letters for each. ``mm`` is
# the month, or the minute next to hours or seconds; ``hh`` counts to 24 unless the pattern tells am from pm.
PATTERN_ELEMENTS = {
    "yyyy": "yyyy", "yy": "yy", "month": "MMMM", "mmmm": "MMMM", "mon": "MMM", "mmm": "MMM", "mm": "MM", "m": "M", "dd": "dd", "d": "d",
    "day": "EEEE", "dy": "EEE", "hh24": "HH", "hh12": "hh", "hh": "HH", "h": "H", "mi": "mm", "ss": "ss", "s": "s", "ff3": "SSS",
    "ff6": "SSSSSS", "ff": "SSSSSS", "am": "a", "pm": "a", "a": "a", "tzh:tzm": "XXX", "tzhtzm": "XX",
}
_HOURS, _DATES = ("hh24", "hh12", "hh", "h"), ("yyyy", "yy", "mon", "month", "mmm", "mmmm", "dd", "d", "day", "dy")
_ELEMENT = re.compile("|".join([*sorted(PATTERN_ELEMENTS, key=len, reverse=True), r'"[^"]*"', r"\w", r"\W"]), re.IGNORECASE)
_CURRENT_DATE = re.compile(r"\bcurrent_date\b(\s*\(\s*\))?", re.IGNORECASE)


def one_of(value: str, allowed: tuple[str, ...], what: str) -> str:
    if value not in allowed:
        raise ValueError(f"{what} must be one of {', '.join(allowed)}, not {value!r}")
    return value


def spark_type(name: str) -> tuple[str, int | None]:
    """``'VARCHAR(5)'`` -> ``('string', 5)``. Names not in the table (``decimal(10,2)``) go to Spark as they are."""
    match = _TYPE.fullmatch(name)
    if match and match[1].upper() in TYPE_NAMES:
        spark_name = TYPE_NAMES[match[1].upper()]
        return spark_name, int(match[2]) if match[2] and spark_name == "string" else None
    return name.strip(), None


def cast_as(
    column: Column, type_name: str, *, length_policy: str = "truncate", on_error: str = "raise"
) -> Column:
    """Cast to a declared type. A cast to ``VARCHAR(n)`` does not shorten text in Spark, hence ``length_policy``."""
    one_of(length_policy, LENGTH_POLICIES, "length_policy")
    one_of(on_error, ERROR_MODES, "on_error")
    name, length = spark_type(type_name)
    cast = column.try_cast(name) if on_error == "null" else column.cast(name)
    if length is None or length_policy == "ignore":
        return cast
    if length_policy == "truncate":
        return F.substring(cast, 1, length)
    message = F.concat(F.lit(f"value longer than {type_name}: "), cast)
    return F.when(F.length(cast) > length, F.raise_error(message).cast("string")).otherwise(cast)


def sql_expression(
    text: str, *, date_dialect: str = "warehouse", on_error: str = "raise", run_date: str | None = None
) -> Column:
    """SQL text of a mapping file as a column.

    ``date_dialect='warehouse'`` reads the patterns of date functions as a warehouse does (:func:`spark_pattern`); Spark
    itself reads ``mm`` as the minute and silently returns January. ``on_error='null'`` makes casts of any form
    and date functions give null where they would fail. ``run_date`` stands in for ``current_date()`` so that a load can be repeated.
    Text in quotes is left as it is, but for the patterns of date functions.
    """
    one_of(on_error, ERROR_MODES, "on_error")
    parts = _LITERAL.split(date_text(text, date_dialect))  # every second one is a literal
    for i in range(0, len(parts), 2):
        if run_date is not None:
            parts[i] = _CURRENT_DATE.sub(f"DATE'{run_date}'", parts[i])
    whole = "".join(parts)
    return F.expr(lenient(whole) if on_error == "null" else whole)


def date_text(text: str, date_dialect: str) -> str:
    """SQL text with the patterns of its date functions in Spark's letters."""
    one_of(date_dialect, DATE_DIALECTS, "date_dialect")
    parts = _LITERAL.split(text)
    if date_dialect == "warehouse":
        for i in _patterns(parts):
            parts[i] = f"'{spark_pattern(parts[i][1:-1])}'"
    return "".join(parts)


def spark_pattern(pattern: str) -> str:
    """A warehouse's date pattern in Spark's letters, as it stands in an SQL literal.

    One with letters that are no element, or with neither a date nor hours in it, is taken to be Spark's own.
    """
    found = _ELEMENT.findall(pattern)
    names = [e.lower() for e in found]
    known = [n for n in names if n in PATTERN_ELEMENTS]
    if any(re.fullmatch(r"\w", e) and e.lower() not in PATTERN_ELEMENTS and not e.isdigit() for e in found) or not {*_DATES, *_HOURS}.intersection(known):
        return pattern
    halves = {"am", "pm", "a"}.intersection(known)
    out, place = [], -1
    for element, name in zip(found, names):
        if name not in PATTERN_ELEMENTS:
            # text in double quotes stands for itself
            out.append(f"''{element[1:-1]}''" if len(element) > 1 else element)
            continue
        place += 1
        beside = known[place - 1 : place] if place else [], known[place + 1 : place + 2]
        letters = PATTERN_ELEMENTS[name]
        if name in ("mm", "m") and "mi" not in known and (beside[0] and beside[0][0] in _HOURS or beside[1] and beside[1][0] in ("ss", "s")):
            letters = letters.lower()
        if name in ("hh", "h") and halves:
            letters = letters.lower()
        out.append(letters)
    return "".join(out)


def _patterns(parts: list[str]) -> list[int]:
    """The literals that end the arguments of a date function."""
    found, called, last = [], [], None
    for i, part in enumerate(parts):
        if i % 2:
            last = i
            continue
        for token in _CALL.finditer(part):
            if token[0] == ")":
                name = called.pop() if called else ""
                if name in DATE_FUNCTIONS and last is not None:
                    found.append(last)
            elif token[0].endswith("("):
                called.append(token[1].lower())
            last = None
    return found

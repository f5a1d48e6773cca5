"""Mapping of a source layout to a target layout.

A mapping is a document ``{"mappings": [{"source": {...}, "target": {...}}, ...]}``. It becomes one
projection over the source: all expressions see the source columns, also where a target column has
the name of a source column.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.functions.names import column, find, reject_duplicates, resolve
from feedkit.functions.types import cast_as, one_of, spark_type, sql_expression
from feedkit.sources.config import load_json

EXTRAS = ("error", "drop")
MISSING = ("error", "null")


def apply_mapping(
    df: DataFrame,
    mapping: str | dict,
    *,
    keep_unmapped: bool = False,
    length_policy: str = "truncate",
    date_dialect: str = "warehouse",
    on_error: str = "raise",
    run_date: str | None = None,
) -> DataFrame:
    """The target columns of ``mapping``, a document or its path, in its order.

    A target with an ``expression`` takes the value and type of that SQL text. A source of type
    ``constant`` gives its name as the value. Any other source column is cast to the target type, or
    only renamed if the target has none. ``keep_unmapped`` appends the source columns no mapping
    reads by name, unchanged and in source order. ``on_error='null'`` turns values that cannot be
    converted into nulls instead of failing. Expressions are run as given: take mappings from trusted
    places only.
    """
    columns, used = [], set()
    for entry in load_json(df.sparkSession, mapping)["mappings"]:
        source, target = entry.get("source") or {}, entry["target"]
        if "expression" in target:
            value = sql_expression(
                target["expression"], date_dialect=date_dialect, on_error=on_error, run_date=run_date
            )
            name = find(source.get("name") or "", df.columns)
        elif str(source.get("type", "")).lower() == "constant":
            value, name = _typed(F.lit(source["name"]), target, length_policy, on_error), None
        else:
            name = resolve([source["name"]], df.columns, "source")[0]
            value = _typed(column(name), target, length_policy, on_error)
        columns.append((target["name"], value))
        used.add(name)
    if keep_unmapped:
        columns += [(c, column(c)) for c in df.columns if c not in used]
    reject_duplicates([name for name, _ in columns], "mapping result")
    return df.select(*[value.alias(name) for name, value in columns])


def _typed(value: Column, target: dict, length_policy: str, on_error: str) -> Column:
    if not target.get("type"):
        return value
    return cast_as(value, target["type"], length_policy=length_policy, on_error=on_error)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Source name -> target name; other columns keep theirs."""
    found = dict(zip(resolve(list(names), df.columns, "frame"), names.values()))
    reject_duplicates([found.get(c, c) for c in df.columns], "rename result")
    return df.withColumnsRenamed(found)


def rename_by_mapping(df: DataFrame, mapping: str | dict) -> DataFrame:
    """Only the renames of a mapping document: source name -> target name, for the columns there are."""
    names = {}
    for entry in load_json(df.sparkSession, mapping)["mappings"]:
        name = find((entry.get("source") or {}).get("name") or "", df.columns)
        if name is not None:
            names[name] = entry["target"]["name"]
    return rename(df, names)


@dataclass(frozen=True)
class LayoutDifference:
    """How a frame departs from a target layout."""

    missing: list[str]
    extra: list[str]
    mistyped: list[str]

    def __bool__(self) -> bool:
        return bool(self.missing or self.extra or self.mistyped)


def compare_layout(df: DataFrame, layout: str | dict) -> LayoutDifference:
    """Names and types of ``df`` against ``layout['properties']``. Reads no data."""
    layout = load_json(df.sparkSession, layout)
    expected = {p["name"].lower(): p for p in layout["properties"]}
    actual = {f.name.lower(): f for f in df.schema.fields}
    return LayoutDifference(
        missing=[p["name"] for n, p in expected.items() if n not in actual],
        extra=[f.name for n, f in actual.items() if n not in expected],
        mistyped=[
            f"{p['name']}: {actual[n].dataType.simpleString()} instead of {p['type']}"
            for n, p in expected.items()
            if n in actual and actual[n].dataType.simpleString() != spark_type(p["type"])[0]
        ],
    )


def conform(
    df: DataFrame,
    layout: str | dict,
    *,
    on_extra: str = "error",
    on_missing: str = "error",
    length_policy: str = "truncate",
    on_error: str = "raise",
) -> DataFrame:
    """The columns of a target layout, in its order and with its types."""
    one_of(on_extra, EXTRAS, "on_extra")
    one_of(on_missing, MISSING, "on_missing")
    layout = load_json(df.sparkSession, layout)
    difference = compare_layout(df, layout)
    if difference.extra and on_extra == "error":
        raise ValueError(f"not in the target layout: {', '.join(difference.extra)}")
    if difference.missing and on_missing == "error":
        raise ValueError(f"missing for the target layout: {', '.join(difference.missing)}")
    columns = []
    for field in layout["properties"]:
        name = find(field["name"], df.columns)
        value = F.lit(None) if name is None else column(name)
        columns.append(
            cast_as(value, field["type"], length_policy=length_policy, on_error=on_error).alias(field["name"])
        )
    return df.select(*columns)

"""One function, or one function per column, over the columns of a DataFrame.

Each operator is a single projection of ``Column -> Column`` functions, so the whole row stays in
one generated stage however many columns there are.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.functions.names import column, resolve
from feedkit.functions.positions import spans

ColumnFunction = Callable[[Column], Column]


def map_all(df: DataFrame, function: ColumnFunction) -> DataFrame:
    """The same function on every column."""
    return df.select(*[function(column(c)).alias(c) for c in df.columns])


def map_by_position(df: DataFrame, functions: Sequence[ColumnFunction]) -> DataFrame:
    """Column ``i`` goes through function ``i``; the functions repeat when there are more columns."""
    return df.select(
        *[functions[i % len(functions)](column(c)).alias(c) for i, c in enumerate(df.columns)]
    )


def map_by_index(
    df: DataFrame, chosen: Sequence[tuple[str, int]], functions: Sequence[ColumnFunction]
) -> DataFrame:
    """Each ``(name, i)`` goes through function ``i``; only the listed columns are kept, in that order."""
    names = resolve([name for name, _ in chosen], df.columns, "frame")
    return df.select(*[functions[i](column(n)).alias(n) for n, (_, i) in zip(names, chosen)])


def map_by_name(
    df: DataFrame, functions: Mapping[str, ColumnFunction], keep_others: bool = True
) -> DataFrame:
    """A function per named column. Other columns stay as they are, or go with ``keep_others=False``."""
    names = resolve(list(functions), df.columns, "frame")
    chosen = dict(zip(names, functions.values()))
    if not keep_others:
        return df.select(*[f(column(n)).alias(n) for n, f in chosen.items()])
    return df.select(*[chosen[c](column(c)).alias(c) if c in chosen else column(c) for c in df.columns])


def substring_columns(
    df: DataFrame, layout: dict, positions: str = "start_end", keep_others: bool = True
) -> DataFrame:
    """Cut each column listed in ``layout['properties']`` to its ``position``."""
    return map_by_name(
        df,
        {name: _cut(start, length) for name, start, length in spans(layout["properties"], positions)},
        keep_others,
    )


def _cut(start: int, length: int) -> ColumnFunction:
    return lambda c: F.substring(c, start, length)


def with_function(
    df: DataFrame, name: str, source: str, function: Callable[[object], object], return_type: str = "string"
) -> DataFrame:
    """Add ``name`` = a Python function of one column, for logic Spark has no function for.

    Runs in Arrow batches; the function gets each value in its declared type, whatever else its batch
    holds, and no nulls. Prefer a ``Column`` function where there is one: it needs no Python worker.
    """
    called = F.udf(lambda value: None if value is None else function(value), return_type, useArrow=True)
    return df.withColumn(name, called(column(source)))

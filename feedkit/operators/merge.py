"""Merge of changed rows into a table: update where key and start date match, insert otherwise."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.functions.names import column, name_difference, resolve
from feedkit.operators.dimension import NO_START


def merge_upsert(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], start_col: str | None = None
) -> DataFrame:
    """The target with ``changes`` merged in, as a new frame.

    A changed row takes the place of the target rows with its key and start date; the other target
    rows stay. ``changes`` must hold a key and start date at most once, which is checked first, by a job
    over the changes alone. When they are small enough for a broadcast, which Spark decides by size, the
    target is not shuffled.
    """
    different = name_difference(target.columns, changes.columns)
    if different:
        raise ValueError(f"columns found in one table but not in the other: {' '.join(different)}")
    names = resolve(target.columns, changes.columns, "changes")
    aligned = changes.select(
        *[column(n).cast(f.dataType).alias(f.name) for n, f in zip(names, target.schema.fields)]
    )
    by = [column(k) for k in resolve(keys, target.columns, "target")]
    if start_col:
        by.append(F.coalesce(column(resolve([start_col], target.columns, "target")[0]), F.expr(NO_START)).alias("start"))
    if aligned.groupBy(*by).count().where("`count` > 1").take(1):
        raise ValueError(f"several changes of one row: {', '.join(keys)} and the start date occur more than once")
    on = _matches(target, keys, start_col)
    return target.alias("t").join(aligned.alias("c"), on, "left_anti").unionByName(aligned)


def merge_into(changes: DataFrame, table: str, keys: Sequence[str], start_col: str | None = None) -> None:
    """The same as a ``MERGE`` in place, for catalogs whose tables take row-level changes."""
    target = changes.sparkSession.table(table)
    fixed = {c.lower() for c in [*keys, *([start_col] if start_col else [])]}
    updates = {c: column(c, "c") for c in target.columns if c.lower() not in fixed}
    on = _matches(target, keys, start_col, side=table)
    merge = changes.alias("c").mergeInto(table, on)
    if updates:
        merge = merge.whenMatched().update(updates)
    merge.whenNotMatched().insert({c: column(c, "c") for c in target.columns}).merge()


def _matches(target: DataFrame, keys: Sequence[str], start_col: str | None, side: str = "t") -> Column:
    on = [column(k, side) == column(k, "c") for k in resolve(keys, target.columns, "target")]
    if start_col:
        start = resolve([start_col], target.columns, "target")[0]
        on.append(F.coalesce(column(start, side), F.expr(NO_START)) == F.coalesce(column(start, "c"), F.expr(NO_START)))
    return reduce(and_, on)

"""Type-2 slowly changing dimension: what a load does to each key, and the rows that follow from it.

Source and active target rows meet in one full outer join on the key, which gives every key one
action. Closed history takes no part in it: it is passed on without a shuffle, apart from the few
rows an output row may replace. For a source small enough for a broadcast there is another form,
``small_source``, in which the target is not shuffled either.

==========  =======================================  =====================  ====================
action      key                                      delta                  full
==========  =======================================  =====================  ====================
insert      only in the source                       new row                new row
same        in both, equal                           kept                   kept
version     in both, different                       closed and new row     closed and new row
inplace     in both, different, began on the run     new values, old start  new values, old start
missing     only in the target                       kept                   closed
blank       has no values, ``close_blank`` set       closed                 closed
==========  =======================================  =====================  ====================

Closing on the day a row began gives it an end date one day before its start.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.functions.names import column, ref
from feedkit.operators.dimension import Load

# Which of the two joined rows an output row is made from, and how.
KEEP, CLOSE, NEW = 0, 1, 2

_PRESENT, _OUT = "__present", "__out"


def scd2(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    start_col: str,
    end_col: str,
    flag_col: str,
    refresh_type: str = "delta",
    run_date: str | datetime.date | None = None,
    active_end_date: str | datetime.date | None = "9999-12-31",
    close_blank: bool = False,
    small_source: bool = False,
    same_day: bool | None = None,
) -> DataFrame:
    """The whole dimension after loading ``source`` into ``target``.

    Expects input that passes :func:`feedkit.operators.quality.report`. See :func:`next_snapshot`.
    """
    load = Load.of(keys, start_col, end_col, flag_col, refresh_type, run_date, active_end_date)
    return next_snapshot(source, target, load, close_blank, small_source, same_day)


# ---------------------------------------------------------------- single steps


def active(target: DataFrame, load: Load) -> DataFrame:
    """Target rows that are valid now."""
    return target.where(load.active)


def blank_rows(target: DataFrame, load: Load) -> DataFrame:
    """Active rows in which every column but the key and the validity is null."""
    return active(target, load).where(_is_blank(_values(target, load)))


def changed(source: DataFrame, target: DataFrame, load: Load) -> DataFrame:
    """Source rows whose key is active in the target with other values."""
    load, source, rows = _sides(source, target, load)
    differs = F.expr(f"{_same_key(load)} AND NOT ({_same_values(target, load)})")
    return source.join(rows, differs, "left_semi")


def new_rows(source: DataFrame, target: DataFrame, load: Load) -> DataFrame:
    """Source rows whose key is not active in the target."""
    load, source, rows = _sides(source, target, load)
    return source.join(rows, F.expr(_same_key(load)), "left_anti")


def to_close(source: DataFrame, target: DataFrame, load: Load) -> DataFrame:
    """Active target rows with other values in the source that did not begin on the run date."""
    load, source, rows = _sides(source, target, load)
    differs = f"{_same_key(load)} AND NOT ({_same_values(target, load)})"
    return rows.join(source, F.expr(f"{differs} AND {load.start_of('t')} <> {load.run}"), "left_semi")


def missing(source: DataFrame, target: DataFrame, load: Load) -> DataFrame:
    """Active target rows whose key the source no longer has."""
    load, source, rows = _sides(source, target, load)
    return rows.join(source, F.expr(_same_key(load)), "left_anti")


def closed(rows: DataFrame, load: Load) -> DataFrame:
    """Target rows ended on the day before the run."""
    return rows.withColumns({load.end: F.expr(load.day_before), load.flag: F.lit("N")})


def opened(rows: DataFrame, target: DataFrame, load: Load) -> DataFrame:
    """Source rows as versions that begin on the run date, in the target's layout."""
    load, aligned = load.resolved(rows, target)
    validity = {load.start: F.expr(load.run), load.end: F.expr(load.active_end), load.flag: F.lit("Y")}
    return aligned.withColumns(validity).select(*[column(c) for c in target.columns])


# ---------------------------------------------------------------- the load


def classify(
    source: DataFrame, target: DataFrame, load: Load, close_blank: bool = False, small_source: bool = False
) -> DataFrame:
    """Every key of the source and the active target, with its action."""
    load, joined = _joined(source, target, load, close_blank, small_source)
    keys = [f"coalesce({ref(k, 's')}, {ref(k, 't')}) AS {ref(k)}" for k in load.keys]
    return joined.selectExpr(*keys, "action")


def stats(
    source: DataFrame, target: DataFrame, load: Load, close_blank: bool = False, small_source: bool = False
) -> DataFrame:
    """Number of keys per action."""
    _, joined = _joined(source, target, load, close_blank, small_source)
    return joined.groupBy("action").agg(F.count("*").alias("n"))


def change_set(
    source: DataFrame, target: DataFrame, load: Load, close_blank: bool = False, small_source: bool = False
) -> DataFrame:
    """Rows to merge into the target: new versions and closed rows, without the rows that stay."""
    outputs = _outputs(source, target, load, close_blank, small_source)
    return outputs.where(F.col(_OUT) != KEEP).drop(_OUT, "action")


def current_rows(
    source: DataFrame, target: DataFrame, load: Load, close_blank: bool = False, small_source: bool = False
) -> DataFrame:
    """Active target rows after the load plus those it closed; with ``action`` telling why each is there."""
    return _outputs(source, target, load, close_blank, small_source).drop(_OUT)


def next_snapshot(
    source: DataFrame,
    target: DataFrame,
    load: Load,
    close_blank: bool = False,
    small_source: bool = False,
    same_day: bool | None = None,
) -> DataFrame:
    """Target rows after the load, history included.

    ``same_day`` says whether history may hold rows that began on the run date, which only an earlier
    load of that day leaves behind. They cost a second join. Left open, the target's dates are looked
    at first, in a job of its own.
    """
    load, _ = load.resolved(source, target)
    outputs = current_rows(source, target, load, close_blank, small_source).drop("action")
    if same_day is None:
        same_day = has_same_day_history(target, load)
    return with_history(outputs, target, load, same_day)


def has_same_day_history(target: DataFrame, load: Load) -> bool:
    """Whether a closed row began on the run date. Such a row ends no earlier than the day before."""
    recent = f"{ref(load.end)} >= {load.day_before}"
    return not target.where(f"NOT {load.active} AND {recent} AND {_began_today(load)}").select(F.lit(1)).isEmpty()


def with_history(outputs: DataFrame, target: DataFrame, load: Load, same_day: bool) -> DataFrame:
    """Output rows and the target's closed rows, less those replaced."""
    history = target.where(f"NOT {load.active}")
    if not same_day:
        return outputs.unionByName(history)
    reopened = without_replaced(history.where(_began_today(load)), outputs, load)
    return outputs.unionByName(history.where(f"NOT ({_began_today(load)})")).unionByName(reopened)


def without_replaced(history: DataFrame, outputs: DataFrame, load: Load) -> DataFrame:
    """History rows, less those an output row replaces: same key and start.

    A key opened, closed and opened again on one run date has such a row. An anti join leaves it to
    Spark to split a key that fills much of the history.
    """
    replaces = outputs.select(*[column(c) for c in (*load.keys, load.start)]).alias("o")
    same = [f"{ref(k, 'h')} = {ref(k, 'o')}" for k in load.keys]
    same.append(f"{load.start_of('h')} = {load.start_of('o')}")
    return history.alias("h").join(replaces, F.expr(" AND ".join(same)), "left_anti")


# ---------------------------------------------------------------- parts


def _sides(source: DataFrame, target: DataFrame, load: Load) -> tuple[Load, DataFrame, DataFrame]:
    load, aligned = load.resolved(source, target)
    return load, aligned.alias("s"), active(target, load).alias("t")


def _values(target: DataFrame, load: Load) -> list[str]:
    keys = {k.lower() for k in load.keys}
    return [c for c in load.shared(target.columns) if c.lower() not in keys]


def _began_today(load: Load) -> str:
    return f"{ref(load.start)} <=> {load.run}"


def _same_key(load: Load) -> str:
    return " AND ".join(f"{ref(k, 's')} = {ref(k, 't')}" for k in load.keys)


def _same_values(target: DataFrame, load: Load) -> str:
    """Exact and null-safe, which a hash of the joined texts is not."""
    return " AND ".join(f"{ref(c, 's')} <=> {ref(c, 't')}" for c in _values(target, load)) or "true"


def _is_blank(values: Sequence[str], side: str | None = None) -> str:
    return " AND ".join(f"{ref(c, side)} IS NULL" for c in values) or "false"


def _joined(
    source: DataFrame, target: DataFrame, load: Load, close_blank: bool, small_source: bool
) -> tuple[Load, DataFrame]:
    """Source and active target rows by key, as ``s`` and ``t``, and the key's action."""
    load, aligned = load.resolved(source, target)
    left = aligned.selectExpr("*", f"true AS {_PRESENT}").alias("s")
    right = active(target, load).selectExpr("*", f"true AS {_PRESENT}").alias("t")
    if small_source:
        joined = _joined_to_small(left, right, load)
    else:
        joined = left.join(right, F.expr(_same_key(load)), "full_outer")
    same = _same_values(target, load)
    no_source, no_target = f"s.{_PRESENT} IS NULL", f"t.{_PRESENT} IS NULL"
    blank = f"{_is_blank(_values(target, load), 't')} AND ({no_source} OR ({same}))" if close_blank else "false"
    action = f"""CASE WHEN {no_target} THEN 'insert'
                      WHEN {blank} THEN 'blank'
                      WHEN {no_source} THEN 'missing'
                      WHEN {same} THEN 'same'
                      WHEN {load.start_of("t")} = {load.run} THEN 'inplace'
                      ELSE 'version' END"""
    return load, joined.withColumn("action", F.expr(action))


def _joined_to_small(left: DataFrame, right: DataFrame, load: Load) -> DataFrame:
    """The full outer join in two parts, in each of which Spark can broadcast the source.

    There is no hint: whether it does is up to Spark's size limit. Target rows keep their place; only
    the keys found in both, at most as many as the source has, are moved.
    """
    same_key = F.expr(_same_key(load))
    found = right.join(left, same_key, "left_semi").select(*[column(k, "t").alias(k) for k in load.keys])
    only_source = left.join(found.alias("t"), same_key, "left_anti")
    from_target = right.join(left, same_key, "left_outer").select(
        F.struct("s.*").alias("s"), F.struct("t.*").alias("t")
    )
    absent = F.lit(None).cast(from_target.schema["t"].dataType)
    return from_target.unionByName(only_source.select(F.struct("s.*").alias("s"), absent.alias("t")))


def _outputs(
    source: DataFrame, target: DataFrame, load: Load, close_blank: bool, small_source: bool
) -> DataFrame:
    load, joined = _joined(source, target, load, close_blank, small_source)
    of_missing = CLOSE if load.refresh_type == "full" else KEEP
    codes = f"""CASE WHEN action IN ('insert', 'inplace') THEN array({NEW})
                     WHEN action = 'version' THEN array({CLOSE}, {NEW})
                     WHEN action = 'blank' THEN array({CLOSE})
                     WHEN action = 'missing' THEN array({of_missing})
                     ELSE array({KEEP}) END"""
    new, close = f"{_OUT} = {NEW}", f"{_OUT} = {CLOSE}"
    values = {c: f"IF({new}, {ref(c, 's')}, {ref(c, 't')})" for c in load.shared(target.columns)}
    values[load.start] = f"IF({new}, {load.run}, {ref(load.start, 't')})"
    values[load.end] = (
        f"CASE WHEN {new} THEN {load.active_end} WHEN {close} THEN {load.day_before} ELSE {ref(load.end, 't')} END"
    )
    values[load.flag] = f"CASE WHEN {new} THEN 'Y' WHEN {close} THEN 'N' ELSE {ref(load.flag, 't')} END"
    rows = joined.withColumn(_OUT, F.explode(F.expr(codes)))
    return rows.selectExpr(*[f"{values[c]} AS {ref(c)}" for c in target.columns], "action", _OUT)

"""A Type-2 load that compares digests first, for targets that keep a digest of each row.

The first join moves keys and digests alone. Full rows are then read of the keys that differ, and compared value by
value, so a digest that is missing, or made otherwise, costs reading and changes nothing. Two different rows are taken
for equal only if their 128 bits agree.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from feedkit.functions.hashing import blank_digest, row_digest
from feedkit.functions.names import column, ref
from feedkit.operators.dimension import Load
from feedkit.operators.merge import merge_upsert
from feedkit.operators.type2 import active, change_set, stats
from feedkit.workdir import written

#: The target's column of digests. It covers all columns but the key and the validity.
DIGEST = "row_digest"
ACTIONS = ("insert", "same", "version", "inplace", "missing", "blank")


@dataclass(frozen=True)
class Changes:
    """Rows to merge into the target by key and start date, digests included, and the number of keys for each action."""

    rows: DataFrame
    keys: dict[str, int]


def with_digest(rows: DataFrame, load: Load) -> DataFrame:
    """Rows in a target's layout with their digests."""
    plain = rows.drop(DIGEST)
    return plain.withColumn(DIGEST, _digest(plain, load))


def _values(rows: DataFrame, load: Load) -> list[str]:
    keys = {k.lower() for k in load.keys}
    return [c for c in load.shared(rows.columns) if c.lower() not in keys]


def _digest(rows: DataFrame, load: Load) -> Column:
    return row_digest([rows.schema[c] for c in _values(rows, load)])


def changes_by_digest(source: DataFrame, target: DataFrame, load: Load, close_blank: bool = False) -> Changes:
    """What :func:`feedkit.operators.type2.change_set` gives, for a target with digests.

    The keys that differ are written to the shared folder; they decide which rows of both sides are read whole.
    """
    plain = target.drop(DIGEST)
    load, aligned = load.resolved(source, plain)
    keys, values = [column(k) for k in load.keys], _values(plain, load)
    given = aligned.select(*keys, _digest(aligned, load).alias("digest"), F.lit(True).alias("there")).alias("s")
    held = active(target, load).select(*keys, column(DIGEST).alias("digest"), F.lit(True).alias("there")).alias("t")
    on = " AND ".join(f"{ref(k, 's')} = {ref(k, 't')}" for k in load.keys)
    state = F.expr("""CASE WHEN t.there IS NULL THEN 'new' WHEN s.there IS NULL THEN 'missing'
                           WHEN s.digest = t.digest THEN 'same' ELSE 'differs' END""")
    empty = F.lit(bool(close_blank and values)) & F.coalesce(F.col("t.digest") == blank_digest(len(values)), F.lit(False))
    both = given.join(held, F.expr(on), "full_outer").select(
        *[F.coalesce(column(k, "s"), column(k, "t")).alias(k) for k in load.keys], state.alias("state"), empty.alias("empty")
    )
    seen = Observation()
    both = both.withColumn("blank", F.col("empty") & F.col("state").isin("same", "missing"))
    both = both.observe(seen, *[F.count_if((F.col("state") == s) & ~F.col("blank")).alias(s) for s in ("same", "missing")])
    differ = F.col("blank") | F.col("state").isin("new", "differs", *(["missing"] if load.refresh_type == "full" else []))
    touched = written(both.where(differ).select(*keys), "changed-keys")
    some, of_target = (_only(rows, touched, load) for rows in (aligned, active(plain, load)))
    counts = dict.fromkeys(ACTIONS, 0) | {r["action"]: r["n"] for r in stats(some, of_target, load, close_blank).collect()}
    counts["same"] += seen.get["same"]
    if load.refresh_type == "delta":
        counts["missing"] += seen.get["missing"]
    return Changes(with_digest(change_set(some, of_target, load, close_blank), load), counts)


def scd2_by_digest(source: DataFrame, target: DataFrame, load: Load, close_blank: bool = False) -> DataFrame:
    """The whole dimension after the load, digests included."""
    load, _ = load.resolved(source, target.drop(DIGEST))
    changes = written(changes_by_digest(source, target, load, close_blank).rows, "changes")
    return merge_upsert(target, changes, load.keys, load.start)


def _only(rows: DataFrame, keys: DataFrame, load: Load) -> DataFrame:
    """Rows of some keys. A null in the key of a target row meets nothing, as in the load itself."""
    same = [f"{ref(k, 'r')} = {ref(k, 'k')}" for k in load.keys]
    return rows.alias("r").join(keys.alias("k"), F.expr(" AND ".join(same)), "left_semi")

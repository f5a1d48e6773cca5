"""Column names: quoting, case-insensitive lookup, duplicates."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ref(name: str, side: str | None = None) -> str:
    """A column in SQL text by its exact name, also when the name holds dots or blanks."""
    return quoted(name) if side is None else f"{side}.{quoted(name)}"


def column(name: str, side: str | None = None) -> Column:
    return F.col(ref(name, side))


def find(name: str, columns: Iterable[str]) -> str | None:
    """The spelling under which ``name`` occurs in ``columns``, or None."""
    wanted = name.strip().lower()
    return next((c for c in columns if c.lower() == wanted), None)


def resolve(names: Sequence[str], columns: Sequence[str], what: str) -> list[str]:
    found = [find(n, columns) for n in names]
    missing = [n for n, f in zip(names, found) if f is None]
    if missing:
        raise ValueError(f"{what} has no column {', '.join(missing)}; it has {', '.join(columns)}")
    return found


def reject_duplicates(names: Iterable[str], what: str) -> None:
    repeated = [n for n, k in Counter(n.lower() for n in names).items() if k > 1]
    if repeated:
        raise ValueError(f"{what}: more than one column named {', '.join(sorted(repeated))}")


def name_difference(left: Iterable[str], right: Iterable[str]) -> list[str]:
    """Names found in one list but not in the other, without regard to case."""
    return sorted({n.lower() for n in left} ^ {n.lower() for n in right})

"""What a Type-2 dimension and one load of it look like."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from feedkit.functions.names import ref, resolve

REFRESH_TYPES = ("delta", "full")
# A missing start date compares as this day.
NO_START = "DATE'1901-01-01'"


def as_date(value: str | datetime.date, what: str) -> datetime.date:
    if isinstance(value, datetime.datetime):
        return value.date()
    if isinstance(value, datetime.date):
        return value
    try:
        return datetime.date.fromisoformat(value.strip())
    except ValueError:
        raise ValueError(f"{what} {value!r} is not a date of the form yyyy-mm-dd") from None


def session_date() -> datetime.date:
    """The current date of the active session, in its time zone: the run date if none is given."""
    return SparkSession.active().sql("SELECT current_date()").first()[0]


@dataclass(frozen=True)
class Load:
    """Parameters of one load. ``active_end_date=None`` means an open interval: active rows have no end date."""

    keys: tuple[str, ...]
    start: str
    end: str
    flag: str
    refresh_type: str
    run_date: datetime.date
    active_end_date: datetime.date | None

    @staticmethod
    def of(
        keys: Sequence[str],
        start_col: str,
        end_col: str,
        flag_col: str,
        refresh_type: str = "delta",
        run_date: str | datetime.date | None = None,
        active_end_date: str | datetime.date | None = "9999-12-31",
    ) -> Load:
        refresh = refresh_type.strip().lower()
        if refresh not in REFRESH_TYPES:
            raise ValueError(f"refresh type {refresh_type!r} is neither delta nor full")
        given = run_date.strip() if isinstance(run_date, str) else run_date
        return Load(
            keys=tuple({k.strip().lower(): k.strip() for k in keys}.values()),
            start=(start_col or "").strip(),
            end=(end_col or "").strip(),
            flag=(flag_col or "").strip(),
            refresh_type=refresh,
            run_date=as_date(given, "run date") if given else session_date(),
            active_end_date=as_date(active_end_date, "active end date") if active_end_date else None,
        )

    def resolved(self, source: DataFrame, target: DataFrame) -> tuple[Load, DataFrame]:
        """This load in the target's spelling, and the source with the target's names, order and types."""
        keys = resolve(self.keys, target.columns, "target")
        start, end, flag = resolve((self.start, self.end, self.flag), target.columns, "target")
        load = replace(self, keys=tuple(keys), start=start, end=end, flag=flag)
        fields = [f for f in target.schema.fields if f.name not in (start, end, flag)]
        names = resolve([f.name for f in fields], source.columns, "source")
        # Casting here, not in the join condition, also keeps the join keys of equal type.
        aligned = source.selectExpr(
            *[f"CAST({ref(n)} AS {f.dataType.simpleString()}) AS {ref(f.name)}" for n, f in zip(names, fields)]
        )
        return load, aligned

    def shared(self, target_columns: Sequence[str]) -> list[str]:
        """Target columns that come from the source: all but the three that record validity."""
        audit = {n.lower() for n in (self.start, self.end, self.flag)}
        return [c for c in target_columns if c.lower() not in audit]

    # Parts of conditions and projections, as SQL text.

    @property
    def run(self) -> str:
        return f"DATE'{self.run_date}'"

    @property
    def day_before(self) -> str:
        return f"DATE'{self.run_date - datetime.timedelta(days=1)}'"

    @property
    def active_end(self) -> str:
        return f"DATE'{self.active_end_date}'" if self.active_end_date else "CAST(NULL AS DATE)"

    @property
    def active(self) -> str:
        """Rows without an end date or with the active end date."""
        end = ref(self.end)
        if self.active_end_date is None:
            return f"({end} IS NULL)"
        return f"({end} IS NULL OR {end} = {self.active_end})"

    def start_of(self, side: str) -> str:
        return f"coalesce({ref(self.start, side)}, {NO_START})"

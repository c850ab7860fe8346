"""Date parts, bounds and interval predicates."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

OLDEST_PLAUSIBLE = dt.date(1900, 1, 1)


class Bounds(NamedTuple):
    """Plausible range of a date column, open or closed at both ends."""

    low: dt.date
    high: dt.date
    closed: bool = False

    def contains(self, column: Column) -> Column:
        """NULL for a NULL date, so that a filter drops it."""
        if self.closed:
            return column.between(F.lit(self.low), F.lit(self.high))
        return (column > F.lit(self.low)) & (column < F.lit(self.high))


def as_date(column: Column | str) -> Column:
    """Date from a date or a text column; text that is no date becomes NULL."""
    column = F.col(column) if isinstance(column, str) else column
    return column.try_cast("date")


def date_parts(column: Column | str) -> list[Column]:
    """`annee`, `trimestre`, `mois` of a date."""
    return [
        F.year(column).alias("annee"),
        F.quarter(column).alias("trimestre"),
        F.month(column).alias("mois"),
    ]


def exclusive_end(column: Column | str) -> Column:
    """Day after an inclusive closing date."""
    return F.date_add(column, 1)


def today(as_of: dt.date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def valid_at(day: dt.date, start: str = "valid_from", end: str = "valid_to") -> Column:
    """Version in force on `day`: half-open interval `[start, end)`, NULL end is open."""
    return (F.col(start) <= F.lit(day)) & (F.col(end).isNull() | (F.col(end) > F.lit(day)))


def year_between(column: Column | str, first: int, last: int) -> Column:
    return F.year(column).between(first, last)

"""Column expressions used across the operators. All of them stay on the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a number when text is coerced: no type suffix, no NaN, no infinity.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def coerce_number(col: str | Column) -> Column:
    """Text or number to double; anything that is no finite decimal number becomes NULL."""
    text = F.col(col).cast("string") if isinstance(col, str) else col.cast("string")
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def coerce_timestamp(col: str | Column, formats: Sequence[str] = ()) -> Column:
    """Text to a zone-free timestamp; unparsable text becomes NULL.

    ISO text is tried first, then the given patterns in turn.
    """
    column = F.col(col) if isinstance(col, str) else col
    text = column.cast("string")
    tried = [column.try_cast("timestamp_ntz")]
    tried += [F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz") for pattern in formats]
    return F.coalesce(*tried)


def micros(ts: str | Column) -> Column:
    """Microseconds of a zone-free timestamp since 1970, whatever the session time zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    days = F.date_diff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    seconds = days * 86_400 + F.hour(ts) * 3_600 + F.minute(ts) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")


def minutes_between(earlier: Column, later: Column) -> Column:
    """Difference in minutes with microsecond precision."""
    return (micros(later) - micros(earlier)) / F.lit(6e7)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Division that turns an undefined result (NULL input, zero divisor) into 0."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def bands(value: Column, upper_bounds: list[tuple[float, str]], above: str) -> Column:
    """Right-closed labelled bands: the first bound that is not below the value wins.

    NULL stays NULL.
    """
    column = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, label in upper_bounds:
        column = column.when(value <= bound, label)
    return column.otherwise(above)


def hours(count: float) -> Column:
    """A day-time interval of the given number of hours."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(count * 3600.0))


def to_ntz(value: str | date | datetime | Column) -> Column:
    """A zone-free timestamp column from a literal or a column."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    text = value if isinstance(value, str) else value.isoformat()
    return F.lit(text).cast("timestamp_ntz")

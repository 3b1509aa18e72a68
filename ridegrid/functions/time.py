"""Column functions on wall-clock (``timestamp_ntz``) time.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen and never depend on the session time zone.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import HOUR_FORMAT, SERVED_TIMEZONE

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_hour(c: ColumnOrName) -> Column:
    """Truncate to the hour, keeping ``timestamp_ntz`` (no time-zone round trip)."""
    c = _c(c)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c),
                                F.lit(0), F.lit(0))


def ceil_hour(c: ColumnOrName) -> Column:
    """Round up to the next whole hour unless already whole."""
    c = _c(c)
    down = floor_hour(c)
    return F.when(c > down, F.timestamp_add("HOUR", F.lit(1), down)).otherwise(down)


def epoch_seconds(c: ColumnOrName) -> Column:
    """Whole epoch seconds of a wall-clock time (floor, as ``unix_timestamp``)."""
    return F.unix_timestamp(_c(c))


def from_epoch_seconds(c: ColumnOrName) -> Column:
    """Epoch seconds back to ``timestamp_ntz``."""
    return F.timestamp_add("SECOND", _c(c), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def hour_sequence(lo: ColumnOrName, hi: ColumnOrName) -> Column:
    """Array of every hour from ``lo`` to ``hi`` inclusive (explode it)."""
    return F.sequence(_c(lo), _c(hi), F.expr("INTERVAL 1 HOUR"))


def from_parts(year: ColumnOrName, month: ColumnOrName, day: ColumnOrName,
               hour: ColumnOrName) -> Column:
    """Timestamp from year, month, day, hour columns (``make_timestamp_ntz``)."""
    return F.make_timestamp_ntz(_c(year), _c(month), _c(day), _c(hour), F.lit(0), F.lit(0))


def month_start(year: ColumnOrName | int, month: ColumnOrName | int) -> Column:
    y = F.lit(year) if isinstance(year, int) else _c(year)
    m = F.lit(month) if isinstance(month, int) else _c(month)
    return F.make_timestamp_ntz(y, m, F.lit(1), F.lit(0), F.lit(0), F.lit(0))


def next_month_start(year: ColumnOrName | int, month: ColumnOrName | int) -> Column:
    """First instant of the following month; December rolls over to January."""
    return F.timestamp_add("MONTH", F.lit(1), month_start(year, month))


def minus_days(c: ColumnOrName, days: int) -> Column:
    """Wall-clock subtraction of whole days."""
    return F.timestamp_add("DAY", F.lit(-days), _c(c))


def utc_to_local(c: ColumnOrName, tz: str = SERVED_TIMEZONE) -> Column:
    """Wall-clock time in ``tz`` of a UTC wall-clock instant."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(c))


def format_hour(c: ColumnOrName) -> Column:
    """Text form ``yyyy-MM-dd HH:mm:ss`` as served to clients."""
    return F.date_format(_c(c), HOUR_FORMAT)


# Hour-of-day bands of the demand profile (inclusive hour ranges).
PEAK_HOURS = [(7, 9), (16, 18)]
NIGHT_HOURS = (0, 5)


def hour_band(c: ColumnOrName) -> Column:
    """'peak', 'night' or 'regular' for the hour of day of a timestamp."""
    h = F.hour(_c(c))
    peak = (h.between(*PEAK_HOURS[0])) | (h.between(*PEAK_HOURS[1]))
    return (F.when(peak, F.lit("peak"))
            .when(h.between(*NIGHT_HOURS), F.lit("night"))
            .otherwise(F.lit("regular")))

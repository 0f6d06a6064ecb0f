"""Time columns.

Event timestamps are zone-less wall clock sent as epoch micros "as if UTC".
Everything here is plain arithmetic on the micros or on ``TIMESTAMP_NTZ``,
so results do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000
_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def micros_to_ntz(col: str | Column) -> Column:
    """Epoch micros -> ``TIMESTAMP_NTZ`` holding the same wall clock."""
    return F.timestamp_add("MICROSECOND", _c(col), F.expr(_EPOCH_NTZ))


def ntz_to_micros(col: str | Column) -> Column:
    """``TIMESTAMP_NTZ`` -> epoch micros (inverse of ``micros_to_ntz``)."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), _c(col))


def event_date_from_micros(col: str | Column) -> Column:
    """Partition day of an event: floor(micros / day) as a ``DATE``.

    Exact integer floor, so one micro before midnight stays on its day and
    negative micros land on the day before the epoch.
    """
    m = _c(col)
    days = (m - F.pmod(m, F.lit(MICROS_PER_DAY))) / F.lit(MICROS_PER_DAY)
    return F.date_from_unix_date(days.cast("int"))


def event_time(col: str | Column) -> Column:
    """``TIMESTAMP`` (session zone UTC) for watermarks and event-time windows,
    which reject ``TIMESTAMP_NTZ``."""
    return F.timestamp_micros(ntz_to_micros(col))

"""Date/time helpers over text timestamps, as column expressions.

Fixed formats (must equal the source data's):
- time text ``yyyy-MM-dd HH:mm:ss``; the hour may have one digit, so parsing
  uses ``H`` (``HH`` yields NULL for ``5:07:08``), formatting pads with ``HH``;
- date text ``yyyy-MM-dd``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PARSE_TIME = "yyyy-MM-dd H:mm:ss"
FORMAT_TIME = "yyyy-MM-dd HH:mm:ss"
FORMAT_TIME_UNPADDED = "yyyy-MM-dd H:mm:ss"
FORMAT_DATE = "yyyy-MM-dd"


def parse_time(text: Column) -> Column:
    """Timestamp of a time text; NULL when it does not parse."""
    return F.try_to_timestamp(text, F.lit(PARSE_TIME))


def before(a: Column, b: Column) -> Column:
    """``a`` strictly earlier than ``b``; false when either does not parse."""
    return F.coalesce(parse_time(a) < parse_time(b), F.lit(False))


def after(a: Column, b: Column) -> Column:
    return F.coalesce(parse_time(a) > parse_time(b), F.lit(False))


def minus_seconds(a: Column, b: Column) -> Column:
    """Whole seconds ``a - b``; 0 when either does not parse."""
    return F.coalesce(F.unix_seconds(parse_time(a)) - F.unix_seconds(parse_time(b)), F.lit(0).cast("bigint"))


def date_hour(text: Column) -> Column:
    """``yyyy-MM-dd_H`` taken textually from a time text (the hour is not padded)."""
    parts = F.split(text, " ")
    hour = F.get(F.split(F.get(parts, 1), ":"), 0)
    return F.concat(F.get(parts, 0), F.lit("_"), hour)


def format_date(ts: Column) -> Column:
    return F.date_format(ts, FORMAT_DATE)


def format_time(ts: Column) -> Column:
    return F.date_format(ts, FORMAT_TIME)


def today(as_of: Column | None = None) -> Column:
    """Today's date text; pass ``as_of`` (a date) to make results repeatable."""
    return format_date(as_of if as_of is not None else F.current_date())


def yesterday(as_of: Column | None = None) -> Column:
    return format_date(F.date_sub(as_of if as_of is not None else F.current_date(), 1))


def whole_seconds_between(start: Column, end: Column, wall_clock: bool = True) -> Column:
    """Seconds from ``start`` to ``end`` after cutting both to whole seconds,
    as a ``yyyy-MM-dd H:mm:ss`` text round trip would.

    ``wall_clock=True`` (``timestamp_ntz`` input): the difference of the wall
    clocks, computed without a time zone (``date_trunc`` would go through the
    session zone and shift across a DST change). ``False`` (``timestamp``
    input): the difference of the instants."""
    if wall_clock:
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

        def whole(c: Column) -> Column:
            return F.floor((c - epoch).cast("decimal(24,6)"))
    else:
        def whole(c: Column) -> Column:
            return F.floor(F.unix_micros(c) / F.lit(1_000_000))
    return (whole(end) - whole(start)).cast("bigint")


_EPOCH_NTZ = "1970-01-01 00:00:00"


def wall_clock_as_instant(wall: Column, session_tz: str | None = None) -> Column:
    """A ``timestamp_ntz`` wall-clock value as the ``timestamp`` instant of that
    wall clock in UTC (``withWatermark`` and streaming windows need
    ``timestamp``). Computed as microseconds from the epoch on the wall
    clock itself, so no time zone is consulted: exact in any session zone,
    DST transitions included (a plain cast would read the wall clock in the
    session zone). ``session_tz`` is accepted for symmetry and ignored."""
    epoch = F.lit(_EPOCH_NTZ).cast("timestamp_ntz")
    # ntz - ntz is an exact day-time interval (timestamp_diff would go through
    # the session zone); as decimal seconds it keeps the microseconds.
    seconds = (wall - epoch).cast("decimal(24,6)")
    return F.timestamp_micros((seconds * F.lit(1_000_000)).cast("bigint"))


def instant_as_wall_clock(instant: Column, session_tz: str | None = None) -> Column:
    """Inverse of :func:`wall_clock_as_instant`: the UTC wall clock of an
    instant as ``timestamp_ntz``, again without consulting a time zone."""
    epoch = F.lit(_EPOCH_NTZ).cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)

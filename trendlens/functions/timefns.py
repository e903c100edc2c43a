"""Time helpers that do not depend on the session time zone.

Wall-clock values (``TIMESTAMP_NTZ``, stamps like ``yyyyMMddHHmmss``) are
read as UTC. Conversions go through epoch microseconds, so the same query
gives the same answer whatever ``spark.sql.session.timeZone`` is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

_EPOCH_NTZ = "1970-01-01 00:00:00"
_US_PER_DAY = 86_400_000_000

# Segment raster of the news feed (minutes).
SEGMENT_MINUTES = 15


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_ntz() -> Column:
    return F.lit(_EPOCH_NTZ).cast("timestamp_ntz")


def ntz_micros(col) -> Column:
    """Microseconds since the epoch of a ``TIMESTAMP_NTZ`` read as UTC.

    A difference of two wall-clock values is an interval, which no zone shifts;
    ``timestamp_diff`` would read both as instants of the session zone.
    """
    seconds = (_c(col) - epoch_ntz()).cast("interval second").cast("decimal(20,6)")
    return (seconds * F.lit(1_000_000)).cast("bigint")


def micros_of(df: DataFrame, name: str) -> Column:
    """Epoch microseconds of column ``name`` whatever its timestamp flavour."""
    dt = df.schema[name].dataType
    if isinstance(dt, T.TimestampNTZType):
        return ntz_micros(name)
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(F.col(name))
    if isinstance(dt, T.DateType):
        return F.unix_date(F.col(name)).cast("bigint") * F.lit(_US_PER_DAY)
    return F.col(name).cast("bigint")


def ntz_from_micros(col) -> Column:
    """Inverse of :func:`ntz_micros`."""
    us = _c(col)
    days = F.floor(us / F.lit(_US_PER_DAY))
    rest = (us - days * F.lit(_US_PER_DAY)) / F.lit(1_000_000)
    return epoch_ntz() + F.make_dt_interval(days.cast("int"), F.lit(0), F.lit(0), rest.cast("decimal(18,6)"))


def ltz_from_micros(col) -> Column:
    """An instant (``TIMESTAMP``) from epoch microseconds."""
    return F.timestamp_micros(_c(col))


def as_event_time(df: DataFrame, name: str) -> Column:
    """``TIMESTAMP`` instant usable by ``withWatermark`` from any time column."""
    dt = df.schema[name].dataType
    if isinstance(dt, T.TimestampType):
        return F.col(name)
    return ltz_from_micros(micros_of(df, name))


def day_from_stamp(col) -> Column:
    """``yyyyMMdd…`` text → date by its first 8 characters; null if invalid."""
    return F.to_date(F.try_to_timestamp(F.substring(_c(col), 1, 8), F.lit("yyyyMMdd")))


def floor_to_interval_us(us, minutes: int = SEGMENT_MINUTES) -> Column:
    step = minutes * 60_000_000
    return F.floor(_c(us) / F.lit(step)) * F.lit(step)


def next_boundary_us(us, minutes: int = SEGMENT_MINUTES) -> Column:
    """Next raster boundary strictly after the minute of ``us`` (0→15, 14→15, 15→30).

    Seconds are ignored as in the producer: the boundary is computed from
    the minute the time falls in.
    """
    return floor_to_interval_us(us, minutes) + F.lit(minutes * 60_000_000)


def stamp_micros(col) -> Column:
    """Epoch microseconds (UTC) of the leading ``yyyyMMddHHmm`` of a stamp; null if invalid.

    Its fields are read as a wall-clock time, never as an instant of the
    session zone, so hours that the zone skips are kept.
    """
    stamp = F.regexp_extract(_c(col), r"^\d{12}", 0)
    part = lambda a, n: F.substring(stamp, a, n).try_cast("int")
    return ntz_micros(F.try_make_timestamp_ntz(part(1, 4), part(5, 2), part(7, 2), part(9, 2), part(11, 2),
                                               F.lit(0).cast("decimal(16,6)")))


def parse_record_id(col) -> Column:
    """``<stamp>-<seq>`` → struct(stamp bigint, seq bigint); (0, 0) when malformed."""
    parts = F.split(_c(col), "-", -1)
    a = parts.getItem(0).try_cast("bigint")
    b = parts.getItem(1).try_cast("bigint")
    ok = (F.size(parts) == 2) & a.isNotNull() & b.isNotNull()
    return F.struct(F.when(ok, a).otherwise(F.lit(0)).alias("stamp"),
                    F.when(ok, b).otherwise(F.lit(0)).alias("seq"))


def first_field(col, sep: str = "\t") -> Column:
    """First tab-separated field of a line (the record id)."""
    return F.substring_index(_c(col), sep, 1)

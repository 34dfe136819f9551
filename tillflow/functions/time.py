"""Time expressions: week bounds, ISO-8601 text, exact zone-free conversions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T



def _epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def week_bounds(as_of: dt.datetime | dt.date | None = None, days: int = 7) -> tuple[dt.datetime, dt.datetime]:
    """(start, end) of the half-open period that ends at midnight of ``as_of``.

    ``end`` is exclusive (midnight of the day, not the last day of the week) and
    ``start`` is ``days`` earlier. Without ``as_of`` today's date in UTC is used.
    """
    if as_of is None:
        as_of = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(as_of, dt.datetime):
        as_of = as_of.date()
    end = dt.datetime(as_of.year, as_of.month, as_of.day)
    return end - dt.timedelta(days=days), end


def as_time_literal(value: dt.datetime | str | Column, dtype: T.DataType) -> Column:
    """A literal bound of the same type as the column it is compared with.

    Python datetimes are wall-clock values in UTC; for ``timestamp_ntz`` they stay
    wall-clock, for ``timestamp`` they become the UTC instant. No session zone is used.
    """
    if isinstance(value, Column):
        return value
    text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else str(value)
    ntz = F.to_timestamp_ntz(F.lit(text))
    if isinstance(dtype, T.TimestampNTZType):
        return ntz
    if isinstance(dtype, T.TimestampType):
        return ntz_to_instant(ntz)
    if isinstance(dtype, T.DateType):
        return ntz.cast("date")
    return F.lit(text)


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch of an instant (``timestamp``)."""
    return F.unix_micros(_c(ts))


def ntz_micros(ts: Column | str) -> Column:
    """Microseconds since the epoch of a ``timestamp_ntz`` wall clock read as UTC.

    Built from fields (day number, hour, minute, seconds with fraction), which
    are zone-free for ``timestamp_ntz``; ``timestamp_diff`` would go through the
    session zone and shift wall clocks that fall in a daylight-saving gap.
    """
    t = _c(ts)
    return (
        F.unix_date(F.to_date(t)).cast("long") * F.lit(86_400_000_000)
        + F.hour(t).cast("long") * F.lit(3_600_000_000)
        + F.minute(t).cast("long") * F.lit(60_000_000)
        + (F.extract(F.lit("SECOND"), t) * F.lit(1_000_000)).cast("long")
    )


def ntz_to_instant(ts: Column | str) -> Column:
    """Read a ``timestamp_ntz`` wall clock as UTC; the result is a ``timestamp``."""
    return F.timestamp_micros(ntz_micros(ts))


def instant_to_ntz(ts: Column | str) -> Column:
    """UTC wall clock of an instant, as ``timestamp_ntz``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(ts)), _epoch_ntz())


_DATE_TIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?$"


def parse_iso(text: Column | str) -> Column:
    """ISO-8601 date and time (``2019-01-01T12:22:22Z``) to an instant; null if malformed.

    Only a full date with a time counts, without padding; a missing offset reads
    as UTC, so the result depends on neither the session zone nor today's date.
    """
    t = _c(text)
    zoned = F.when(t.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), t).otherwise(F.concat(t, F.lit("Z")))
    return F.when(t.rlike(_DATE_TIME), F.try_to_timestamp(zoned))


_UTC_ZONES = {"UTC", "GMT", "Z", "+00:00", "Etc/UTC", "Etc/GMT", "UCT", "Zulu", "Universal"}


def _session_is_utc() -> bool:
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    return spark is not None and spark.conf.get("spark.sql.session.timeZone") in _UTC_ZONES


def _iso_of_ntz(ts: Column, digits: int) -> Column:
    """ISO text of a UTC wall clock, independent of the session zone.

    ``date_format`` reads a wall clock through the session zone, which can shift
    times that fall in a daylight-saving gap; it is used only when the session
    zone is UTC (it is the fastest). Otherwise the text is assembled from the
    zone-free string form of the wall clock.
    """
    pattern = "yyyy-MM-dd'T'HH:mm:ss." + "S" * digits + "'Z'"
    if _session_is_utc():
        return F.date_format(ts, pattern)
    text = ts.cast("string")  # 'yyyy-MM-dd HH:mm:ss[.f...]', trailing zeros dropped
    frac = F.when(F.length(text) > 19, F.substring(text, 21, 6)).otherwise(F.lit(""))
    return F.concat(
        F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("."),
        F.substring(F.rpad(frac, 6, "0"), 1, digits), F.lit("Z"),
    )


def iso_millis(ts: Column | str) -> Column:
    """``1970-01-01T00:13:59.999Z`` text of an instant, independent of the session zone."""
    return _iso_of_ntz(instant_to_ntz(ts), 3)


def iso_micros_of_ntz(ts: Column | str) -> Column:
    """Exact ISO text (microseconds, ``Z``) of a UTC wall clock held as ``timestamp_ntz``."""
    return _iso_of_ntz(_c(ts), 6)


def window_max_timestamp(end: Column | str) -> Column:
    """Last instant inside a window that ends (exclusive) at ``end``: end minus 1 ms."""
    return _c(end) - F.expr("INTERVAL 1 MILLISECOND")

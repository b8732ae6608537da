"""Date and time expressions.

Nothing here reads the clock: every "today" or "now" of the reference is an
``as_of`` argument, so a rerun of yesterday's job gives yesterday's answer.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(d) -> Column:
    """A date argument as a literal column (``'2024-01-30'`` or a ``date``)."""
    if isinstance(d, Column):
        return d
    if isinstance(d, _dt.datetime):
        d = d.date()
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


def as_ts(t) -> Column:
    """A timestamp argument as a ``timestamp_ntz`` literal (naive UTC)."""
    if isinstance(t, Column):
        return t
    if isinstance(t, str):
        t = _dt.datetime.fromisoformat(t)
    return F.lit(t).cast("timestamp_ntz")


def event_date(c: str | Column = "event_time") -> Column:
    """``DATE(ts)``."""
    return F.to_date(_col(c))


def days_back(as_of, n: int) -> Column:
    """``DATE_SUB(as_of, INTERVAL n DAY)``."""
    return F.date_sub(as_date(as_of), n)


def ymd(c: str | Column) -> Column:
    """Date in the compact ``yyyyMMdd`` form used by landing folders."""
    return F.date_format(_col(c), "yyyyMMdd")


def hour_boundaries_between(start: str | Column, end) -> Column:
    """Hour boundaries crossed from ``start`` to ``end`` (a datetime
    difference in hours): 00:59 -> 02:00 is 2."""
    return F.timestamp_diff("HOUR", F.date_trunc("HOUR", _col(start)), F.date_trunc("HOUR", as_ts(end)))


def whole_hours_between(start: str | Column, end) -> Column:
    """Whole hours elapsed from ``start`` to ``end`` (a timestamp difference
    in hours): 00:59 -> 02:00 is 1."""
    return F.timestamp_diff("HOUR", _col(start), as_ts(end))


def timestamp_millis(ms: str | Column) -> Column:
    """Milliseconds since 1970 (UTC) as a ``timestamp_ntz``; the session's
    time zone plays no part."""
    return F.lit(_dt.datetime(1970, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(secs=(_col(ms) / 1000).cast("decimal(18,6)"))


def date_in_name(c: str | Column) -> Column:
    """Date of the first ``_YYYYMMDD`` in a name; NULL when there is none
    or it is not a real date."""
    digits = F.regexp_extract(_col(c), r"_(\d{8})", 1)
    return F.to_date(F.try_to_timestamp(digits, F.lit("yyyyMMdd")))

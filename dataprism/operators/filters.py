"""Day filters written on the raw event-time column, so they reach the Parquet scan.

A predicate on ``date_trunc('DAY', ts)`` is opaque to the scan (no pushed filter); the same set of rows is a range
on ``ts`` itself, which is pushed down and prunes row groups. The bounds are computed on the driver from literals:

=====================  ===========================================
on the truncated day   on the raw column
=====================  ===========================================
``day = d``            ``d <= ts < d + 1 day`` (empty unless d is a midnight)
``day >= a``           ``ts >= ceil_day(a)``
``day >  a``           ``ts >= floor_day(a) + 1 day``
``day <= b``           ``ts <  floor_day(b) + 1 day``
``day <  b``           ``ts <  ceil_day(b)``
=====================  ===========================================
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dataprism.operators.config import col

_DAY = dt.timedelta(days=1)


def _as_datetime(v: str | dt.date | dt.datetime) -> dt.datetime:
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day)
    return dt.datetime.fromisoformat(str(v).strip().replace("T", " "))


def _floor_day(t: dt.datetime) -> dt.datetime:
    return dt.datetime(t.year, t.month, t.day)


def _ceil_day(t: dt.datetime) -> dt.datetime:
    f = _floor_day(t)
    return f if f == t else f + _DAY


def _lit(df: DataFrame, ts: str, t: dt.datetime) -> Column:
    kind = df.schema[ts].dataType
    zone = "+00:00" if isinstance(kind, T.TimestampType) else ""  # an instant is bounded in UTC, whatever the session
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f") + zone).cast(kind)


def day_range_condition(df: DataFrame, ts: str, *, day=None, start=None, end=None, include_start: bool = True,
                        include_end: bool = True) -> Column:
    """Condition on raw ``ts`` equivalent to bounds on ``date_trunc('DAY', ts)``."""
    lo: dt.datetime | None = None
    hi: dt.datetime | None = None  # exclusive
    if day is not None:
        d = _as_datetime(day)
        if _floor_day(d) != d:
            return F.lit(False)
        lo, hi = d, d + _DAY
    if start is not None:
        a = _as_datetime(start)
        s = _ceil_day(a) if include_start else _floor_day(a) + _DAY
        lo = s if lo is None else max(lo, s)
    if end is not None:
        b = _as_datetime(end)
        e = _floor_day(b) + _DAY if include_end else _ceil_day(b)
        hi = e if hi is None else min(hi, e)
    c = col(ts)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c >= _lit(df, ts, lo))
    if hi is not None:
        cond = cond & (c < _lit(df, ts, hi))
    if lo is not None and hi is not None and lo >= hi:
        return F.lit(False)
    return cond


def filter_days(df: DataFrame, ts: str, *, day=None, start=None, end=None, include_start: bool = True,
                include_end: bool = True) -> DataFrame:
    """Rows whose event day is ``day``, or lies between ``start`` and ``end`` (flags choose open/closed ends)."""
    return df.filter(day_range_condition(df, ts, day=day, start=start, end=end, include_start=include_start,
                                         include_end=include_end))

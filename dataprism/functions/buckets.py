"""Time buckets (frequency strings) as column expressions.

A frequency string names how rows are grouped in time; every row gets the *label* of its bucket as a
``timestamp_ntz``. The accepted strings and their labels:

* ``D``, ``h``/``H``, ``min``/``T``, ``s``/``S`` with an optional multiple (``15min``, ``6h``, ``5D``): fixed-width
  buckets, labelled by their start. When the width divides a day the buckets are midnight aligned. Otherwise
  (``5D``, ``7h``, ``36h``, ``7min``) they start at midnight of the partition's earliest row, so the label depends on
  the partition: such frequencies are *origin-dependent* (see ``profile``).
* ``W`` (= ``W-SUN``) and ``W-MON`` .. ``W-SAT``: week closing on that weekday, labelled with the closing day.
* ``M``/``ME`` month end, ``MS`` month start; ``Q``/``QE`` quarter end, ``QS`` quarter start; ``Y``/``YE``/``A`` year end,
  ``YS``/``AS`` year start. Quarters and years take a month (``Q-JAN``, ``QS-FEB``, ``A-JUN``): that in which a quarter
  or the year ends, or begins.
* ``SM``/``SME`` half-months beginning on the 15th and the last day of a month, ``SMS`` on the 1st and the 15th; ``B``
  business days, a weekend belonging to its Friday. Both are labelled by their start.

Calendar frequencies take a multiple too (``2W``, ``3MS``, ``10B``): that many periods in a row, counted from the period
of the partition's earliest row, so these are origin-dependent as well. Those that close a period (week, month, quarter
and year ends) are labelled with the last period of a bucket, whose first bucket ends with the first row's period; the
others with the first.

Anything else (``BME``, ``CBMS``, ...) raises ``ValueError``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_DAY = 86_400_000

# Unit aliases accepted in frequency strings and their width in milliseconds.
_TICK_UNITS = {
    "D": MS_PER_DAY,
    "H": 3_600_000,
    "h": 3_600_000,
    "T": 60_000,
    "min": 60_000,
    "S": 1_000,
    "s": 1_000,
    "L": 1,
    "ms": 1,
}

# Week anchors in the order Spark's dayofweek numbers them (1 = Sunday .. 7 = Saturday).
_WEEKDAYS = ["SUN", "MON", "TUE", "WED", "THU", "FRI", "SAT"]

# Months in the order of the year.
_MONTHS = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]

# Calendar aliases, their kind and the month they are anchored to by default (0: none).
_CALENDAR = {
    "M": ("month_end", 0),
    "ME": ("month_end", 0),
    "MS": ("month_start", 0),
    "Q": ("quarter_end", 12),
    "QE": ("quarter_end", 12),
    "QS": ("quarter_start", 1),
    "Y": ("year_end", 12),
    "YE": ("year_end", 12),
    "A": ("year_end", 12),
    "YS": ("year_start", 1),
    "AS": ("year_start", 1),
    "SM": ("semi_end", 0),
    "SME": ("semi_end", 0),
    "SMS": ("semi_start", 0),
    "B": ("business", 0),
}

# Kinds whose buckets close on their label.
_CLOSING = ("week", "month_end", "quarter_end", "year_end")


@dataclass(frozen=True)
class Freq:
    """A parsed frequency.

    ``kind`` is ``tick`` (fixed width ``width_ms``), ``week`` (``anchor`` = Spark dayofweek number of the closing day)
    or one of the calendar kinds in ``_CALENDAR`` (``anchor`` = month number of quarters and years); ``mult`` periods of
    a calendar kind make a bucket.
    """

    text: str
    kind: str
    width_ms: int = 0
    anchor: int = 0
    mult: int = 1

    @property
    def origin_dependent(self) -> bool:
        """True when labels depend on the partition's earliest row (a width that does not divide a day, or several
        calendar periods)."""
        return MS_PER_DAY % self.width_ms != 0 if self.kind == "tick" else self.mult > 1


_FREQ_RE = re.compile(r"^\s*(\d*)\s*([A-Za-z]+)(?:-([A-Za-z]+))?\s*$")


def parse_freq(freq: str | None) -> Freq:
    """Parse a frequency string; raise ``ValueError`` for anything outside the supported set."""
    if freq is None or not isinstance(freq, str):
        raise ValueError(f"frequency must be a string, got {freq!r}")
    text = freq.strip()
    m = _FREQ_RE.match(text)
    if m:
        mult = int(m.group(1)) if m.group(1) else 1
        unit, anchor = m.group(2), (m.group(3) or "").upper()
        if mult <= 0:
            raise ValueError(f"frequency multiple must be positive: {freq!r}")
        if unit == "W":
            if (anchor or "SUN") not in _WEEKDAYS:
                raise ValueError(f"unsupported week anchor in frequency {freq!r}")
            return Freq(text, "week", anchor=_WEEKDAYS.index(anchor or "SUN") + 1, mult=mult)
        if unit in _CALENDAR:
            kind, month = _CALENDAR[unit]
            if anchor and (not month or anchor not in _MONTHS):
                raise ValueError(f"unsupported anchor in frequency {freq!r}")
            return Freq(text, kind, anchor=_MONTHS.index(anchor) + 1 if anchor else month, mult=mult)
        if unit in _TICK_UNITS and not anchor:
            return Freq(text, "tick", width_ms=mult * _TICK_UNITS[unit])
    raise ValueError(
        f"unsupported frequency {freq!r}: use D/h/min/s, W[-DAY], M/ME/MS, Q/QE/QS[-MONTH], Y/YE/A/YS/AS[-MONTH], "
        "SM/SMS or B, with an optional multiple"
    )


def to_ntz(ts: Column) -> Column:
    """Cast a bucket expression (date, timestamp_ntz) to timestamp_ntz."""
    return ts.cast("timestamp_ntz")


def utc_ntz(instant: Column) -> Column:
    """The UTC wall-clock time of a TIMESTAMP (an instant), whatever the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), _epoch())


def floor_div(a: Column, n: int | Column) -> Column:
    """``floor(a / n)`` of a bigint in integer arithmetic (a double quotient is wrong beyond 2**53)."""
    n = n if isinstance(n, Column) else F.lit(n).cast("bigint")
    return F.call_function("div", a - F.pmod(a, n), n)


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since the epoch of a naive-UTC timestamp (``date_part(EPOCH_MILLISECONDS, ts)``).

    Computed on the wall-clock value (``timestamp_ntz`` arithmetic), so the session time zone never shifts it; floor
    division keeps sub-millisecond times before 1970 in the right millisecond.
    """
    return floor_div(epoch_us(ts), 1000)


def epoch_us(ts: Column) -> Column:
    """Microseconds since the epoch of a wall-clock time, from its date and time-of-day fields.

    The field extractors are zone-free on ``timestamp_ntz``; ``unix_micros(cast(ts as timestamp))``,
    ``timestamp_diff`` and NTZ subtraction all pass through the session zone and shift around DST changes.
    """
    t = ts.cast("timestamp_ntz")
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("bigint")
    secs = F.date_part(F.lit("SECOND"), t)  # seconds with microsecond fraction
    return (days * F.lit(86_400_000_000) + F.hour(t).cast("bigint") * F.lit(3_600_000_000)
            + F.minute(t).cast("bigint") * F.lit(60_000_000) + (secs * F.lit(1_000_000)).cast("bigint"))


def from_epoch_ms(ms: Column) -> Column:
    """Naive-UTC timestamp of an epoch-millisecond value (zone-free)."""
    return F.timestamp_add("MILLISECOND", ms.cast("bigint"), _epoch())


def floor_ms(ts: Column, width_ms: int | Column) -> Column:
    """Epoch-aligned floor of ``ts`` to ``width_ms`` (midnight aligned when the width divides a day)."""
    ms = epoch_ms(ts)
    return from_epoch_ms(ms - F.pmod(ms, width_ms if isinstance(width_ms, Column) else F.lit(width_ms).cast("bigint")))


def _month_index(day: Column) -> Column:
    return (F.year(day) * 12 + F.month(day) - 1).cast("bigint")


def _first_of_month(index: Column) -> Column:
    return F.make_date(floor_div(index, 12).cast("int"), (F.pmod(index, F.lit(12)) + 1).cast("int"), F.lit(1))


def _days_since(day: Column, start: str) -> Column:
    return F.datediff(day, F.lit(start).cast("date")).cast("bigint")


def _after(days: Column, start: str) -> Column:
    return F.date_add(F.lit(start).cast("date"), days.cast("int"))


# A Sunday and a Monday from which weeks and business days are counted.
_SUNDAY, _MONDAY = "1970-01-04", "1969-12-29"


def period(ts: Column, freq: Freq) -> Column:
    """The running number of the calendar period of ``ts`` (of its label too)."""
    day = F.to_date(ts)
    month = _month_index(day)
    if freq.kind == "week":
        return floor_div(_days_since(F.date_add(day, F.pmod(F.lit(freq.anchor) - F.dayofweek(day), F.lit(7))), _SUNDAY), 7)
    if freq.kind in ("month_end", "month_start"):
        return month
    if freq.kind == "semi_end":
        last = F.dayofmonth(F.last_day(day)) == F.dayofmonth(day)
        return 2 * month + F.when(last, F.lit(1)).when(F.dayofmonth(day) >= 15, F.lit(0)).otherwise(F.lit(-1))
    if freq.kind == "semi_start":
        return 2 * month + F.when(F.dayofmonth(day) >= 15, F.lit(1)).otherwise(F.lit(0))
    if freq.kind == "business":
        days = _days_since(day, _MONDAY)
        return floor_div(days, 7) * 5 + F.least(F.pmod(days, F.lit(7)), F.lit(4))
    size = 3 if freq.kind.startswith("quarter") else 12
    shift = (freq.anchor - 1) % size
    return floor_div(month - shift + (size - 1 if freq.kind.endswith("end") else 0), size)


def period_label(number: Column, freq: Freq) -> Column:
    """The label (timestamp_ntz) of a calendar period by its running number."""
    n = number.cast("bigint")
    if freq.kind == "week":
        return to_ntz(_after(n * 7 + (freq.anchor - 1), _SUNDAY))
    if freq.kind == "business":
        return to_ntz(_after(floor_div(n, 5) * 7 + F.pmod(n, F.lit(5)), _MONDAY))
    if freq.kind in ("semi_end", "semi_start"):
        first = _first_of_month(floor_div(n, 2))
        second, odd = F.date_add(first, 14), F.pmod(n, F.lit(2)) == 1
        return to_ntz(F.when(odd, F.last_day(first) if freq.kind == "semi_end" else second)
                      .otherwise(second if freq.kind == "semi_end" else first))
    size = 1 if freq.kind.startswith("month") else 3 if freq.kind.startswith("quarter") else 12
    first = _first_of_month(n * size + (freq.anchor - 1) % size)
    return to_ntz(F.last_day(first) if freq.kind.endswith("end") else first)


def _simple_label(day: Column, freq: Freq) -> Column:
    """The label of a single calendar period: by truncation of the date where Spark has one (not date_trunc, which goes
    through the session zone), else by the period's number."""
    if freq.kind == "week":
        return to_ntz(F.date_add(day, F.pmod(F.lit(freq.anchor) - F.dayofweek(day), F.lit(7))))
    if freq.kind == "month_end":
        return to_ntz(F.last_day(day))
    if freq.kind == "month_start":
        return to_ntz(F.trunc(day, "month"))
    if freq.anchor in (1, 12) and freq.kind.endswith("start") == (freq.anchor == 1):
        unit = freq.kind.split("_")[0]
        if freq.anchor == 1:
            return to_ntz(F.trunc(day, unit))
        if unit == "quarter":
            return to_ntz(F.date_sub(F.add_months(F.trunc(day, unit), 3), 1))
        return to_ntz(F.make_date(F.year(day), F.lit(12), F.lit(31)))
    return period_label(period(day, freq), freq)


def bucket_label(ts: Column, freq: Freq, origin_day: Column | None = None) -> Column:
    """Label of the bucket of ``ts``. Several calendar periods need ``origin_day``, midnight of the partition's earliest
    row; fixed widths that depend on it go through ``origin_label``."""
    if freq.kind == "tick":
        if freq.origin_dependent:
            raise ValueError(f"frequency {freq.text!r} depends on the partition origin; use origin_label")
        if freq.width_ms == MS_PER_DAY:
            return to_ntz(F.to_date(ts))
        return floor_ms(ts, freq.width_ms)
    if freq.mult == 1:
        return _simple_label(F.to_date(ts), freq)
    if origin_day is None:
        raise ValueError(f"frequency {freq.text!r} depends on the partition origin")
    first = period(origin_day, freq)
    past = period(ts, freq) - first
    steps = floor_div(past + freq.mult - 1, freq.mult) if freq.kind in _CLOSING else floor_div(past, freq.mult)
    return period_label(first + steps * freq.mult, freq)


def origin_label(ts: Column, origin_day: Column, width_ms: int | Column) -> Column:
    """Label of a fixed width from an origin: ``origin + floor((ts - origin) / width) * width``.

    ``origin_day`` is midnight of the partition's earliest row.
    """
    o = epoch_ms(origin_day)
    width = width_ms if isinstance(width_ms, Column) else F.lit(width_ms).cast("bigint")
    return from_epoch_ms(o + floor_div(epoch_ms(ts) - o, width) * width)


def bucket_ordinal(label: Column, freq: Freq) -> Column:
    """An integer that grows by one from each bucket to the next; ``max - min + 1`` counts all bins between two
    labels, empty ones included (``group_count``)."""
    if freq.kind == "tick":
        return floor_div(epoch_ms(label), freq.width_ms)
    # The labels of a partition are whole multiples apart, so their quotients differ by the number of buckets.
    return floor_div(period(label, freq), freq.mult)

"""Scalar column expressions (Column -> Column), all JVM-side built-ins.

Every helper returns a Catalyst expression, so it stays inside whole-stage codegen
and filters built from it reach the Parquet scan when they compare a bare column
with a literal.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(value: str | _dt.date | _dt.datetime) -> Column:
    """A ``timestamp_ntz`` literal; comparing NTZ columns with it needs no time zone
    and is pushed down to Parquet as is."""
    if isinstance(value, (_dt.date, _dt.datetime)):
        value = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else value.isoformat()
    return F.lit(value).cast("timestamp_ntz")


def surrogate_key(*cols: ColumnOrName, sep: str = "|") -> Column:
    """md5 over the string forms joined by ``sep`` (F1).

    ``concat_ws`` skips NULLs, so two rows whose NULLs sit in different columns can
    collide; the separator prevents '1'+'23' == '12'+'3'.
    """
    return F.md5(F.concat_ws(sep, *[col(c).cast("string") for c in cols]))


def epoch_seconds(ts: ColumnOrName) -> Column:
    """Seconds since 1970-01-01 00:00 of a ``timestamp_ntz`` wall-clock value, read as
    UTC, with the fraction kept (decimal). Built from calendar fields only, so the
    session time zone never enters (a cast to ``timestamp`` would apply it)."""
    c = col(ts)
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.date_part(F.lit("SECOND"), c)


def seconds_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole seconds from ``start`` to ``end`` (F3), truncated toward zero like
    ``timestampdiff(SECOND, ...)``. NTZ minus NTZ is a day-time interval computed
    without any time zone; it is read as whole seconds."""
    return (col(end) - col(start)).cast("interval second").cast("bigint")


def instant_from_ntz(ts: ColumnOrName) -> Column:
    """The ``timestamp`` instant of an NTZ wall-clock value read as UTC (for event
    time in streaming), independent of the session time zone."""
    return F.timestamp_micros((epoch_seconds(ts) * 1_000_000).cast("bigint"))


def ntz_from_instant(ts: ColumnOrName) -> Column:
    """Inverse of ``instant_from_ntz``: the UTC wall clock of an instant as NTZ."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(col(ts)), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def minutes_between(start: ColumnOrName, end: ColumnOrName, digits: int = 2) -> Column:
    """Duration in minutes rounded half-up to ``digits`` (F4), as double."""
    return half_up(seconds_between(start, end), F.lit(60), digits)


def hours_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Duration in hours (F5), as double."""
    return seconds_between(start, end) / 3600.0


def half_up(num: ColumnOrName, den: ColumnOrName, digits: int = 0) -> Column:
    """``num / den`` of two whole numbers, rounded HALF_UP (away from zero, as SQL ``round``) to
    ``digits`` places (F10), as double; NULL when ``den`` is 0. Computed in whole numbers, so
    halves are exact on both signs: 201 / 200 is 1.01 and -25 / 10 is -3."""
    n, d = col(num).cast("bigint"), F.nullif(col(den).cast("bigint"), F.lit(0).cast("bigint"))
    twice = F.abs(n) * (2 * 10 ** digits) + F.abs(d)
    whole = F.call_function("div", twice, 2 * F.abs(d))
    return F.signum(n.cast("double")) * F.signum(d.cast("double")) * whole / 10 ** digits + 0.0


def round_half_up(c: ColumnOrName, digits: int = 0) -> Column:
    """SQL ``round`` of a double: HALF_UP on its decimal digits, on both signs (F10). Ratios of
    whole numbers use ``half_up``, which is exact."""
    return F.round(col(c).cast("double"), digits)


def cents(c: ColumnOrName) -> Column:
    """Money in integer cents (bigint). Sums of cents are exact and order free."""
    return F.round(col(c) * 100).cast("bigint")


def ratio_pct(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / nullif(den, 0) * 100 (A8, F13, F16); NULL, not an error, when ``den`` is 0."""
    return col(num) / F.nullif(col(den), F.lit(0)) * 100


def hundredths(c: ColumnOrName) -> Column:
    """A quantity of two decimals in whole hundredths (bigint), for exact sums."""
    return F.round(col(c) * 100).cast("bigint")


def count_if(pred: Column) -> Column:
    return F.sum(F.when(pred, 1).otherwise(0)).cast("bigint")


# English weekday names in ``dayofweek`` order (1 = Sunday).
WEEKDAY_BY_DOW = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def weekday_name(ts: ColumnOrName) -> Column:
    """Full English weekday name (F8), like ``date_format(ts, 'EEEE')`` but from the
    calendar date, so no time zone is applied to NTZ values."""
    names = F.element_at(F.array(*[F.lit(d) for d in WEEKDAY_BY_DOW]), F.dayofweek(F.to_date(col(ts))))
    return F.when(col(ts).isNotNull(), names)      # a null index would read the last element


def year_month(ts: ColumnOrName) -> Column:
    """'yyyy-MM' (F7) from the calendar fields (time-zone free on NTZ values)."""
    c = col(ts)
    return F.concat(F.lpad(F.year(c).cast("string"), 4, "0"), F.lit("-"),
                    F.lpad(F.month(c).cast("string"), 2, "0"))


def day_range(ts: ColumnOrName, day: str | _dt.date) -> Column:
    """``date(ts) = day`` written as a half-open range so it is pushed down (P10)."""
    d = _dt.date.fromisoformat(day) if isinstance(day, str) else day
    nxt = d + _dt.timedelta(days=1)
    return (col(ts) >= ntz(d.isoformat())) & (col(ts) < ntz(nxt.isoformat()))


def in_window(ts: ColumnOrName, start: str, end: str) -> Column:
    """Half-open time window ``start <= ts < end``."""
    return (col(ts) >= ntz(start)) & (col(ts) < ntz(end))


def tip_pct(tip: ColumnOrName, total: ColumnOrName) -> Column:
    """Native tip percentage (D1, searched CASE F14): NULL when either side is NULL or
    total is 0."""
    return F.when(col(total) != 0, col(tip) / col(total) * 100)


# Payment type codes of the trip schema and their labels.
PAYMENT_LABELS = {1: "Card", 2: "Cash"}
PAYMENT_OTHER = "Other"


def payment_label(code: ColumnOrName) -> Column:
    """Simple CASE on the payment code."""
    expr = None
    for k, v in PAYMENT_LABELS.items():
        expr = F.when(col(code) == k, v) if expr is None else expr.when(col(code) == k, v)
    return expr.otherwise(PAYMENT_OTHER)

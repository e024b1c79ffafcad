"""Date and time column functions.

All take and return Columns built from Spark's own date expressions, so they
stay inside whole-stage codegen. Epoch conversions assume the session zone
is UTC (see ``feedyard.session.use_utc``); nothing reads the wall clock:
where "today" matters the caller passes an ``as_of`` column or literal.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedyard.schema import FULL_RUN_START, ISO_FORMAT

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _date(d) -> Column:
    """A column name / Column, or a ``datetime.date`` taken as a literal."""
    if isinstance(d, (Column, str)):
        return _c(d)
    return F.to_date(F.lit(d.isoformat()))


# -- O14 ---------------------------------------------------------------------
#: ISO text in its usual form, in which a cast reads what ``ISO_FORMAT`` does.
ISO_USUAL = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\z"


def iso_timestamp(c: ColumnOrName) -> Column:
    """Strict ISO text (no zone) -> timestamp in the session zone; malformed -> null.

    Text in the usual form is cast, which takes a fraction of the time that
    the formatter does; the formatter has the last word on all other.
    """
    c = _c(c)
    return F.coalesce(F.when(c.rlike(ISO_USUAL), c.try_cast("timestamp")), F.try_to_timestamp(c, F.lit(ISO_FORMAT)))


def iso_to_epoch(c: ColumnOrName, default: int | None = 0) -> Column:
    """ISO text -> epoch seconds. Null or '' -> ``default``; malformed -> null.

    Malformed values are never turned into the default: ``iso_is_malformed``
    flags them so the row can be sent to the rejects table.
    """
    c = _c(c)
    parsed = F.unix_seconds(iso_timestamp(c))
    blank = c.isNull() | (c == F.lit(""))
    return F.when(blank, F.lit(default).cast("bigint")).otherwise(parsed)


def iso_is_malformed(c: ColumnOrName) -> Column:
    """True where the text is present but does not parse as strict ISO."""
    c = _c(c)
    return c.isNotNull() & (c != F.lit("")) & iso_timestamp(c).isNull()


# -- O15 ---------------------------------------------------------------------
def month_boundaries(start: ColumnOrName, end: ColumnOrName) -> Column:
    """[start, first of each month strictly between, end]; empty unless start < end."""
    s, e = _date(start), _date(end)
    inner = F.filter(
        F.sequence(F.trunc(s, "MM"), F.trunc(e, "MM"), F.expr("INTERVAL 1 MONTH")),
        lambda x: (x > s) & (x < e),
    )
    bounds = F.concat(F.array(s), inner, F.array(e))
    return F.when(s < e, bounds).otherwise(F.array().cast("array<date>"))


def month_windows(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Array of (window_start, window_end, is_last) structs cut at month starts.

    Windows are half-open [start, end) except the last, which is closed, so
    adjacent windows never share a day. start >= end gives no window.
    Pairs come from ``zip_with`` over two slices of the boundary array, so
    the array is built once per row, not once per element.
    """
    e = _date(end)
    b = month_boundaries(start, end)
    n = F.size(b) - 1
    pairs = F.zip_with(
        F.slice(b, 1, F.greatest(n, F.lit(1))), F.slice(b, 2, F.greatest(n, F.lit(1))),
        lambda ws, we: F.struct(ws.alias("window_start"), we.alias("window_end"), (we == e).alias("is_last")),
    )
    empty = F.array().cast("array<struct<window_start:date,window_end:date,is_last:boolean>>")
    return F.when(n > 0, pairs).otherwise(empty)


# -- O16 ---------------------------------------------------------------------
def month_ends(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Last day of every month from start's to end's, the final one clipped to end."""
    s, e = _c(start), _c(end)
    months = F.sequence(F.trunc(s, "MM"), F.trunc(e, "MM"), F.expr("INTERVAL 1 MONTH"))
    ends = F.transform(months, lambda x: F.least(F.last_day(x), e))
    return F.when(s <= e, ends).otherwise(F.array().cast("array<date>"))


# -- O17 ---------------------------------------------------------------------
def lookback_window(as_of: ColumnOrName, run_type: Column | str, days: int | Column = 30,
                    full_start: str = FULL_RUN_START) -> Column:
    """(window_from, window_to): a full run starts at ``full_start``, any other
    run ``days`` before ``as_of``; both end at ``as_of``. A plain string
    ``run_type`` is a literal ('all' or any other run type)."""
    a = _date(as_of)
    rt = run_type if isinstance(run_type, Column) else F.lit(run_type)
    d = days if isinstance(days, Column) else F.lit(int(days))
    start = F.when(rt == F.lit("all"), F.to_date(F.lit(full_start))).otherwise(F.date_sub(a, d))
    return F.struct(start.alias("window_from"), a.alias("window_to"))


# -- O18 - O22: epoch-millisecond helpers ------------------------------------
def _ms_to_date(ms: ColumnOrName) -> Column:
    return F.to_date(F.timestamp_millis(_c(ms)))


def day_start_ms(d: ColumnOrName) -> Column:
    return F.unix_millis(_c(d).cast("timestamp"))


def end_of_day_ms(d: ColumnOrName, offset_days: int = 0) -> Column:
    """Epoch ms of 23:59:59.999 on ``d + offset_days`` (today: 0, yesterday: -1)."""
    day = F.date_add(_c(d), offset_days) if offset_days else _c(d)
    return day_start_ms(F.date_add(day, 1)) - F.lit(1)


def prev_month_end_ms(ms: ColumnOrName) -> Column:
    """23:59:59.999 on the last day of the month before the one holding ``ms``."""
    return end_of_day_ms(F.date_sub(F.trunc(_ms_to_date(ms), "MM"), 1))


def month_start_ms(ms: ColumnOrName) -> Column:
    """00:00:00.000 on the first day of the month holding ``ms``."""
    return F.unix_millis(F.date_trunc("month", F.timestamp_millis(_c(ms))))


def days_before_start_ms(ms: ColumnOrName, n: int | Column) -> Column:
    """Midnight ``n`` days before the day holding ``ms``."""
    n = n if isinstance(n, Column) else F.lit(int(n))
    return day_start_ms(F.date_sub(_ms_to_date(ms), n))


def ms_to_sql_date(ms: ColumnOrName) -> Column:
    """'yyyy-MM-dd' of the day holding ``ms``."""
    return F.date_format(F.timestamp_millis(_c(ms)), "yyyy-MM-dd")


# -- O23 ---------------------------------------------------------------------
def months_before(date_text: ColumnOrName, n: int | Column, clamp: str = "calendar") -> Column:
    """Same day ``n`` months earlier (n may exceed 12 or be negative).

    ``calendar`` clips the day to the target month's length. ``legacy``
    reproduces the source helper: target months 1-9 are clipped to the
    length of February of the target year, months 10-12 to their own length.
    """
    d = F.try_to_date(F.substring(_c(date_text), 1, 10), "yyyy-MM-dd")
    n = n if isinstance(n, Column) else F.lit(int(n))
    shifted = F.add_months(d, -n)
    if clamp == "calendar":
        return shifted
    if clamp != "legacy":
        raise ValueError("clamp must be 'calendar' or 'legacy'")
    first = F.add_months(F.trunc(d, "MM"), -n)
    y, m = F.year(first), F.month(first)
    feb_len = F.dayofmonth(F.last_day(F.make_date(y, F.lit(2), F.lit(1))))
    limit = F.when(m <= 9, feb_len).otherwise(F.dayofmonth(F.last_day(first)))
    return F.make_date(y, m, F.least(F.dayofmonth(d), limit))


# -- O24 ---------------------------------------------------------------------
def day_label(d: ColumnOrName) -> Column:
    return F.date_format(_c(d), "dd/MM/yyyy")


def month_label(d: ColumnOrName) -> Column:
    return F.date_format(F.trunc(_c(d), "MM"), "dd/MM/yyyy")


def next_month_label(d: ColumnOrName) -> Column:
    return F.date_format(F.add_months(F.trunc(_c(d), "MM"), 1), "dd/MM/yyyy")


def request_date(d: ColumnOrName) -> Column:
    """Date as the source service's request parameter text, MM/dd/yyyy."""
    return F.date_format(_c(d), "MM/dd/yyyy")


def instant(as_of: _dt.datetime | str | Column) -> Column:
    """A timestamp column for one instant, whatever the session time zone; a
    datetime or ISO text without a zone is UTC."""
    if isinstance(as_of, Column):
        return as_of
    at = _dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    at = at if at.tzinfo else at.replace(tzinfo=_dt.timezone.utc)
    return F.timestamp_micros(F.lit((at - _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)) // _dt.timedelta(microseconds=1)))

"""Date helpers: month arithmetic, windows and sargable date-range predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def same_month(a: Column | str, b: Column | str) -> Column:
    """``a`` and ``b`` fall in the same month. NULL when either is NULL, so a
    NULL month fails both this test and its negation (as in SQL)."""
    return F.trunc(_col(a), "MM") == F.trunc(_col(b), "MM")


def first_of_month(d: dt.date) -> dt.date:
    return d.replace(day=1)


def add_months(d: dt.date, n: int) -> dt.date:
    y, m = divmod(d.year * 12 + (d.month - 1) + n, 12)
    return dt.date(y, m + 1, 1) if d.day == 1 else _clip_day(y, m + 1, d.day)


def _clip_day(y: int, m: int, day: int) -> dt.date:
    import calendar
    return dt.date(y, m, min(day, calendar.monthrange(y, m)[1]))


def last_day(d: dt.date) -> dt.date:
    return add_months(first_of_month(d), 1) - dt.timedelta(days=1)


def rollup_window(as_of: dt.date, months: int = C.BACKFILL_MONTHS) -> tuple[dt.date, dt.date]:
    """Service-level rewrite window: first of the month ``months`` back .. as_of."""
    return first_of_month(add_months(first_of_month(as_of), -months)), as_of


def previous_month(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """First and last day of the month before ``as_of``."""
    start = add_months(first_of_month(as_of), -1)
    return start, last_day(start)


def refresh_window(as_of: dt.date, provider: str, first_run: bool,
                   explicit_start: dt.date | None = None) -> tuple[dt.date, dt.date]:
    """Ingest window of one run (inclusive bounds).

    * explicit start wins;
    * a first run back-fills to the first of the month six months back;
    * on the full-refresh days of month the whole previous month is re-read
      (AWS uses a longer day list than GCP/Huawei);
    * otherwise the last ``min(day of month, 10)`` days.
    """
    if explicit_start is not None:
        return explicit_start, as_of
    if first_run:
        return rollup_window(as_of)
    days = C.AWS_FULL_REFRESH_DAYS if provider == C.AWS else C.OTHER_FULL_REFRESH_DAYS
    if as_of.day in days:
        return add_months(first_of_month(as_of), -1), as_of
    n = min(as_of.day, C.RECENT_DAYS_CAP)
    return as_of - dt.timedelta(days=n - 1), as_of


def ts_date_between(ts: Column | str, lo: dt.date, hi: dt.date) -> Column:
    """``date(ts) BETWEEN lo AND hi`` written on the raw timestamp so that the
    predicate reaches the parquet reader (a cast to DATE would not)."""
    c = _col(ts)
    return (c >= F.lit(_ts(lo))) & (c < F.lit(_ts(hi + dt.timedelta(days=1))))


def ts_date_from(ts: Column | str, lo: dt.date) -> Column:
    """``date(ts) >= lo`` on the raw timestamp (pushable)."""
    return _col(ts) >= F.lit(_ts(lo))


def _ts(d: dt.date) -> dt.datetime:
    return dt.datetime(d.year, d.month, d.day)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c

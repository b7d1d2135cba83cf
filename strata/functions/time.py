"""Time expressions: parsing, calendar columns and sargable day predicates."""

from __future__ import annotations

import datetime as _dt
import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# A time without a full date would silently become one of the day of the run.
FULL_DATE = r"^\s*\d{4}-\d{2}-\d{2}([T ]|$)"


def row_time(timestamp: str = "timestamp", created_utc: str = "created_utc") -> Column:
    """Per-row event time: ``timestamp``, else ``created_utc``; empty strings
    count as missing. Text that is no time, or none with a full date, gives
    NULL instead of failing the job."""
    raw = raw_time(timestamp, created_utc)
    return F.when(raw.rlike(FULL_DATE), F.try_to_timestamp(raw))


def raw_time(timestamp: str = "timestamp", created_utc: str = "created_utc") -> Column:
    return F.coalesce(F.nullif(F.col(timestamp), F.lit("")), F.nullif(F.col(created_utc), F.lit("")))


def iso_string(ts: Column) -> Column:
    """Instant → ISO-8601 text with microseconds and offset (``Z`` for UTC)."""
    return F.date_format(ts.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def day_of(ts: str | Column = "timestamp") -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.to_date(c)


def parse_day(date: str | _dt.date) -> _dt.date:
    """Validate a ``YYYY-MM-DD`` filter argument up front (ANSI casts would
    otherwise fail deep inside a job)."""
    if isinstance(date, _dt.date):
        return date
    try:
        return _dt.date.fromisoformat(str(date))
    except ValueError as e:
        raise ValueError(f"date filter must be YYYY-MM-DD, got {date!r}") from e


def midnight(d: _dt.date, dtype: T.DataType) -> Column:
    """Start of day ``d`` as a literal of ``dtype``, read in the session
    zone (a Python datetime literal would use the driver's OS zone)."""
    return F.lit(f"{d.isoformat()} 00:00:00").cast(dtype)


def _range_condition(df: DataFrame, first: _dt.date, last: _dt.date, ts: str) -> Column:
    """Days ``first`` to ``last``, both included."""
    after = last + _dt.timedelta(days=1)
    dtype = df.schema[ts].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        cond = (F.col(ts) >= midnight(first, dtype)) & (F.col(ts) < midnight(after, dtype))
    else:
        cond = F.to_date(F.col(ts)).between(F.lit(first), F.lit(last))
    if {"year", "month", "day"} <= set(df.columns):
        number = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
        low, high = (d.year * 10000 + d.month * 100 + d.day for d in (first, last))
        cond = number.between(low, high) & cond
    return cond


def on_date(df: DataFrame, date: str | _dt.date, ts: str = "timestamp") -> DataFrame:
    """Rows whose UTC day is ``date``.

    Written as a half-open range on the raw time column (not a cast of it) so
    the predicate reaches the Parquet reader; when the table carries the
    stored ``year/month/day`` partition columns those are constrained too,
    which turns the filter into partition pruning.
    """
    return on_dates(df, [date], ts)


def on_dates(df: DataFrame, dates, ts: str = "timestamp") -> DataFrame:
    """Rows whose UTC day is any of ``dates``: one range for each run of
    consecutive days."""
    days = sorted({parse_day(d) for d in dates})
    if not days:
        return df.filter(F.lit(False))
    runs: list[list[_dt.date]] = []
    for d in days:
        if runs and d - runs[-1][1] == _dt.timedelta(days=1):
            runs[-1][1] = d
        else:
            runs.append([d, d])
    return df.filter(functools.reduce(Column.__or__, (_range_condition(df, a, b, ts) for a, b in runs)))


def as_wall_clock(c: Column) -> Column:
    """Instant → ``timestamp_ntz`` wall clock in the (UTC) session zone."""
    return c.cast("timestamp_ntz")

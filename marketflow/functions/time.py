"""Time helpers.

Raw timestamps are instants (``timestamptz``).  Input columns may be
``timestamp`` or ``timestamp_ntz``; NTZ values are read as UTC wall time, which
``configure`` guarantees by pinning the session time zone to UTC.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def instant(col) -> Column:
    """The column as a TIMESTAMP instant (no-op for TIMESTAMP, UTC for NTZ)."""
    col = F.col(col) if isinstance(col, str) else col
    return col.cast(T.TimestampType())


def micros_between(later, earlier) -> Column:
    """``extract(epoch from later - earlier)`` in whole microseconds (LONG)."""
    return F.unix_micros(instant(later)) - F.unix_micros(instant(earlier))


def as_of_column(as_of: dt.datetime | None) -> Column:
    """The evaluation instant: a fixed literal, or ``current_timestamp()`` (= ``now()``)."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of).cast(T.TimestampType()) if as_of.tzinfo else F.lit(
        as_of.isoformat(sep=" ")).cast(T.TimestampType())


def as_of_text(as_of: dt.datetime | None) -> str:
    """The evaluation instant as SQL text."""
    if as_of is None:
        return "current_timestamp()"
    utc = as_of.astimezone(dt.timezone.utc).replace(tzinfo=None) if as_of.tzinfo else as_of
    return f"TIMESTAMP '{utc.isoformat(sep=' ')}+00:00'"


def ts_literal(value: dt.datetime, dtype: T.DataType) -> Column:
    """A literal of the column's own timestamp type, so the comparison is pushed
    to the Parquet scan without a cast on the column side."""
    text = value.astimezone(dt.timezone.utc).replace(tzinfo=None) if value.tzinfo else value
    lit = F.lit(text.isoformat(sep=" "))
    if isinstance(dtype, T.TimestampNTZType):
        return lit.cast(T.TimestampNTZType())
    return lit.cast(T.TimestampType())


def lower_bound(df, column: str, as_of: dt.datetime | None, lookback: dt.timedelta) -> Column:
    """Predicate ``column >= as_of - lookback`` (the trailing-window filter).

    With a fixed ``as_of`` the bound is a literal of the column's type (pushed to
    the scan); with ``as_of=None`` it is ``now() - interval``.
    """
    dtype = df.schema[column].dataType
    if as_of is not None:
        return F.col(column) >= ts_literal(as_of - lookback, dtype)
    seconds = int(lookback.total_seconds())
    bound = F.current_timestamp() - F.expr(f"INTERVAL {seconds} SECONDS")
    if isinstance(dtype, T.TimestampNTZType):
        bound = bound.cast(T.TimestampNTZType())
    return F.col(column) >= bound


def upper_bound(df, column: str, as_of: dt.datetime | None) -> Column:
    """Predicate ``column <= as_of`` for point-in-time reads (TRUE when live)."""
    if as_of is None:
        return F.lit(True)
    return F.col(column) <= ts_literal(as_of, df.schema[column].dataType)

"""Time functions.

All are native Catalyst expressions, so they stay inside whole-stage codegen
and keep filters on the raw column pushable.  Naive timestamps
(``TIMESTAMP_NTZ``) are treated as UTC wall-clock time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def year_month(ts: Column | str) -> Column:
    """``YYYY-MM`` partition id of a timestamp."""
    return F.date_format(_c(ts), "yyyy-MM")


def is_weekend(ts: Column | str, tz: str = "America/New_York") -> Column:
    """1 when the UTC instant falls on Saturday/Sunday in ``tz``, else 0."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), from_epoch_micros(epoch_micros(ts)))
    return F.dayofweek(local).isin(1, 7).cast("int")


def _epoch() -> Column:
    return F.expr(_EPOCH_NTZ)


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since the epoch: of an instant (``TIMESTAMP``) in any session zone, of a naive timestamp read as UTC wall time."""
    c = _c(ts)
    naive = F.timestamp_diff("MICROSECOND", _epoch(), c.cast("timestamp_ntz"))
    return F.when(F.typeof(c) == "timestamp", F.unix_micros(c.cast("timestamp"))).otherwise(naive)  # decided when the plan is made


def from_epoch_micros(us: Column, ntz: bool = True) -> Column:
    out = F.timestamp_add("MICROSECOND", us, _epoch())
    return out if ntz else out.cast("timestamp")


def ceil_minutes(ts: Column | str, n: int, ntz: bool = True) -> Column:
    """ceil a timestamp to the next multiple of ``n`` minutes.

    Exact boundaries stay unchanged.  Integer arithmetic only
    (``us + pmod(-us, step)``), so there is no float rounding at the edge.
    """
    step = int(n) * 60 * 1_000_000
    us = epoch_micros(ts)
    return from_epoch_micros(us + F.pmod(-us, F.lit(step)), ntz)


def window_end(window_col: Column | str) -> Column:
    """the end instant of a ``window`` struct (already a timestamp)."""
    return _c(window_col).getField("end")


def plus_months(d: Column | str, n: int) -> Column:
    """``DATEADD(MONTH, n, d)`` keeping the time of day (end-of-month clamps)."""
    col = _c(d)
    return F.timestamp_add("MONTH", F.lit(int(n)), col)


def as_date(c: Column | str) -> Column:
    """timestamp or text to date."""
    return F.to_date(_c(c))


def from_millis(c: Column | str) -> Column:
    """F8: epoch milliseconds to timestamp."""
    return F.timestamp_millis(_c(c))


def as_ts(c: Column | str, fmt: str | None = None) -> Column:
    """text to timestamp; text that is none gives null."""
    return F.try_to_timestamp(_c(c), F.lit(fmt)) if fmt else F.try_to_timestamp(_c(c))


def is_ntz(dtype: DataType) -> bool:
    return isinstance(dtype, TimestampNTZType)

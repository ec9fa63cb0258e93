"""Timestamp casts, month truncation and epoch arithmetic, all zone-free (NTZ)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import TimestampNTZType

_EPOCH_TEXT = "1970-01-01 00:00:00"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_timestamp_strict(c: Column | str) -> Column:
    """``cast(x as timestamp)``: ISO-8601 text or a timestamp -> TIMESTAMP_NTZ.

    A trailing ``Z`` or ``+hh:mm`` offset is dropped, as the reference's cast
    does. Malformed text raises (ANSI cast); use :func:`try_timestamp` and a
    rejects split where bad input must not stop the job.
    """
    return _c(c).cast(TimestampNTZType())


def try_timestamp(c: Column | str) -> Column:
    """Like :func:`to_timestamp_strict` but malformed text becomes NULL."""
    return _c(c).try_cast(TimestampNTZType())


def month_start(c: Column | str) -> Column:
    """``date_trunc('month', ts)`` returned as TIMESTAMP_NTZ, independent of the session zone."""
    return F.trunc(F.to_date(_c(c)), "MM").cast(TimestampNTZType())


def epoch_seconds(c: Column | str) -> Column:
    """``extract('epoch' from ts)``: seconds since 1970 as DOUBLE (micros / 1e6)."""
    return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH_TEXT).cast(TimestampNTZType()), _c(c)).cast("double") / F.lit(1000000.0)


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """``(epoch(later) - epoch(earlier)) / 86400.0`` as fractional days."""
    return (epoch_seconds(later) - epoch_seconds(earlier)) / F.lit(86400.0)

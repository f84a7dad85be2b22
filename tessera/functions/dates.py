"""Time-zone independent epoch arithmetic for TIMESTAMP_NTZ columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_micros(col) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock timestamp (no session-TZ shift)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, _c(col).cast("timestamp_ntz"))


def epoch_seconds(col) -> Column:
    """Seconds since 1970-01-01 as a double (fractional part kept)."""
    return epoch_micros(col) / F.lit(1_000_000.0)

"""Epoch conversions and duration arithmetic."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}

# How many ticks of an epoch unit make one second.
EPOCH_TICKS = {"s": 1, "ms": 1_000, "us": 1_000_000, "ns": 1_000_000_000}

# The accepted range is 2000-01-01 00:00:00 to 2100-01-01 00:00:00 UTC, both inclusive.
MIN_VALID_SECONDS = 946_684_800
MAX_VALID_SECONDS = 4_102_444_800


def micros(duration: str) -> int:
    """Length in microseconds of a duration such as ``"30 seconds"``."""
    match = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", duration.lower())
    if not match or match.group(2) not in _UNIT_MICROS or int(match.group(1)) == 0:
        raise ValueError(f"not a positive fixed-length duration: {duration!r}")
    return int(match.group(1)) * _UNIT_MICROS[match.group(2)]


def epoch_to_timestamp(ticks: Column, unit: str) -> Column:
    """Exact integer conversion of an epoch count to a timestamp (nanoseconds lose their last 3 digits)."""
    if unit == "s":
        return F.timestamp_seconds(ticks)
    if unit == "ms":
        return F.timestamp_millis(ticks)
    if unit == "us":
        return F.timestamp_micros(ticks)
    if unit == "ns":
        return F.timestamp_micros(F.call_function("div", ticks, F.lit(1_000)))
    raise ValueError(f"unknown epoch unit: {unit!r}")


def epoch_to_whole_seconds(ticks: Column, unit: str) -> Column:
    """Timestamp truncated to whole seconds, as the warehouse table stores it."""
    if unit not in EPOCH_TICKS:
        raise ValueError(f"unknown epoch unit: {unit!r}")
    return F.timestamp_seconds(F.call_function("div", ticks, F.lit(EPOCH_TICKS[unit])))


def is_valid_epoch(ticks: Column, unit: str) -> Column:
    """True inside the accepted range; null and out-of-range values give false."""
    if unit not in EPOCH_TICKS:
        raise ValueError(f"unknown epoch unit: {unit!r}")
    scale = EPOCH_TICKS[unit]
    return ticks.isNotNull() & ticks.between(MIN_VALID_SECONDS * scale, MAX_VALID_SECONDS * scale)


def unix_micros(ts: Column) -> Column:
    """Microseconds since the epoch; also for timestamps without time zone (read as UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def time_chunk(ts: Column, length: str) -> Column:
    """Number of the fixed-length stretch of time that ``ts`` falls into."""
    return F.call_function("div", unix_micros(ts), F.lit(micros(length)))


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")

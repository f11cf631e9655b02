"""Scalar column functions and the fixed values they use."""

from . import constants
from .numeric import nan_to_null, round2, safe_ratio
from .timeofday import (
    event_seconds,
    once,
    parse_time_of_day,
    session_instant,
    slot_start,
    time_of_day_instant,
    time_of_day_text,
    wall_clock_as_utc,
)

__all__ = [
    "constants",
    "event_seconds",
    "nan_to_null",
    "once",
    "parse_time_of_day",
    "round2",
    "safe_ratio",
    "session_instant",
    "slot_start",
    "time_of_day_instant",
    "time_of_day_text",
    "wall_clock_as_utc",
]

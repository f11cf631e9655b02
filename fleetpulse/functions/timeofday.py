"""Column functions for `HH:mm:ss` event times (P9, T1 arithmetic).

All of them are built-in Catalyst expressions, so they stay inside
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import EPOCH_DATE_PREFIX, LABEL_FORMAT, PARSE_FORMAT, SLIDE_SECONDS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_time_of_day(ts: Column | str) -> Column:
    """`HH:mm:ss` text -> timestamp on 1970-01-01.

    Strict: anything that is not exactly a two-digit time of day gives
    null. `try_to_timestamp` keeps ANSI mode from raising on bad text.
    """
    text = F.concat(F.lit(EPOCH_DATE_PREFIX), _col(ts))
    return F.try_to_timestamp(text, F.lit(PARSE_FORMAT))


def once(c: Column) -> Column:
    """Evaluate `c` once per row, even when later filters test its result.

    Catalyst pushes a filter on a projected column below the projection
    and copies the expression into it, so an expensive expression (a
    time parse, a JSON parse) runs once in the filter and again in the
    projection. A one-element `explode` is a generator: predicates on its
    output stay above it. One generator per `select`.
    """
    return F.explode(F.array(c))


def event_seconds(ts: Column | str) -> Column:
    """`HH:mm:ss` text -> epoch seconds (long) of that time on 1970-01-01."""
    return F.unix_seconds(parse_time_of_day(ts))


def slot_start(seconds: Column | str, offset: Column | int) -> Column:
    """Start of the 10 s slot (pane) holding `seconds`, aligned to `offset`.

    Slots are the slide-sized pieces every sliding window is made of: a
    30 s window starting at `w` is the union of the slots `w`, `w+10`,
    `w+20`. `pmod` keeps the alignment right for negative differences.
    """
    off = offset if isinstance(offset, Column) else F.lit(int(offset))
    s = _col(seconds)
    return s - F.pmod(s - off, F.lit(SLIDE_SECONDS))


def time_of_day_instant(ts: Column | str) -> Column:
    """A timestamp's time of day (whole seconds) on 1970-01-01, session time zone.

    The same instant as parsing its `HH:mm:ss` text with `parse_time_of_day`,
    without formatting and parsing text: for sources that carry real
    timestamps.
    """
    t = _col(ts)
    return F.make_timestamp(F.lit(1970), F.lit(1), F.lit(1), F.hour(t), F.minute(t), F.second(t))


def wall_clock_as_utc(t: Column | str) -> Column:
    """Session-local timestamp -> the same wall-clock time as a UTC instant.

    Times of day on 1970-01-01 are then never before the epoch, whatever
    the session time zone; streaming watermarks start at the epoch and
    would treat earlier rows as late.
    """
    return F.from_utc_timestamp(_col(t), F.current_timezone())


def session_instant(t: Column | str) -> Column:
    """Inverse of `wall_clock_as_utc`."""
    return F.to_utc_timestamp(_col(t), F.current_timezone())


def time_of_day_text(ts: Column | str) -> Column:
    """Timestamp -> `HH:mm:ss` text, fractions dropped (event adapter)."""
    return F.date_format(_col(ts), LABEL_FORMAT)

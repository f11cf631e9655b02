"""The two alert jobs, end to end, as lazy DataFrame plans.

`alerts(...)` is the whole computation of one reference job:
typed projection -> global offset -> 30 s/10 s windows per server ->
both metrics side by side -> warm-up drop -> labels.

`form="slots"` (default) is the single-pass slot plan; `form="join"` is
the reference's shape (per-metric window aggregates, full outer join,
rank). Both return the same rows; tests hold them equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import slot_start
from ..operators.alerts import label
from ..operators.combine import combine_windows
from ..operators.event_time import with_event_time
from ..operators.status import offset_from_min
from ..operators.warmup import drop_warmup, drop_warmup_by_first
from ..operators.windows import (
    long_form,
    slot_aggregates,
    slot_window_aggregates,
    slots_from_seconds,
    window_aggregate,
)
from ..schemas import CPU_MEM, NET_DISK, MetricPair


def long_offset(long: DataFrame) -> Column:
    """Offset of a long-form input as a scalar subquery (A2, A3).

    Catalyst runs it once before the stage that needs it; it reads only
    the columns the time parse needs.
    """
    return long.agg(offset_from_min(F.min("sec"))).scalar()


def long_windows(long: DataFrame, pair: MetricPair, offset: int | Column | None = None) -> DataFrame:
    """(server_id, window, <left aggregate>, <right aggregate>) from a long form."""
    if offset is None:
        offset = long_offset(long)
    return slot_window_aggregates(slot_aggregates(long, pair, offset), pair).drop("ws")


def combined_windows(
    left: DataFrame,
    right: DataFrame,
    pair: MetricPair,
    offset: int | Column | None = None,
    form: str = "slots",
) -> DataFrame:
    """(server_id, window, <left aggregate>, <right aggregate>) before warm-up.

    `left`/`right` are landed metric tables (ts text, server_id,
    measures). `offset=None` derives it from the data as the reference
    does, lazily, via a scalar subquery.
    """
    lt, rt = with_event_time(left, pair.left), with_event_time(right, pair.right)
    if form == "join":
        long = long_form(lt, rt, pair)
        off = long_offset(long) if offset is None else offset
        a = window_aggregate(lt, pair.left, off, keyed=True)
        b = window_aggregate(rt, pair.right, off, keyed=True)
        return combine_windows(a, b)
    if form != "slots":
        raise ValueError(f"unknown form {form!r}")
    return long_windows(long_form(lt, rt, pair), pair, offset)


def alerts(
    left: DataFrame,
    right: DataFrame,
    pair: MetricPair,
    thresholds: tuple[float, float] | None = None,
    offset: int | Column | None = None,
    form: str = "slots",
    warmup: int = K.WARMUP_WINDOWS,
) -> DataFrame:
    """Labelled alert rows of one job from two landed tables (unsorted;
    sorting is the sink's job)."""
    windows = drop_warmup(combined_windows(left, right, pair, offset, form), warmup)
    return label(windows, pair, thresholds)


def alerts_from_long(
    long: DataFrame,
    pair: MetricPair,
    thresholds: tuple[float, float] | None = None,
    offset: int | Column | None = None,
    warmup: int = K.WARMUP_WINDOWS,
) -> DataFrame:
    """Labelled alert rows from one long-form input (server_id, sec, l, r),
    e.g. `tagged_long_form` over a stream of both topics: one scan."""
    return label(drop_warmup(long_windows(long, pair, offset), warmup), pair, thresholds)


def alerts_from_states(
    states: DataFrame,
    pair: MetricPair,
    thresholds: tuple[float, float] | None = None,
    offset: int | Column = 0,
    warmup: int = K.WARMUP_WINDOWS,
) -> DataFrame:
    """Labelled alert rows from landed `second_states`: states are merged, no row is read again."""
    windows = slot_window_aggregates(slots_from_seconds(states, pair, offset), pair).drop("ws")
    return label(drop_warmup(windows, warmup), pair, thresholds)


def kept_windows(long: DataFrame, pair: MetricPair, offset: int | Column | None = None, since: int | None = None) -> DataFrame:
    """Windows after the warm-up, without a step that gathers a server.

    Windows are merged on (server, window) and the warm-up is found from
    each server's first slot, so this holds on full event times (D8).
    `since` (epoch seconds) gives only the windows that start at it or
    later; older rows are then read for the servers' first slots alone.
    """
    if offset is None:
        offset = long_offset(long)
    slots = slot_aggregates(long if since is None else long.filter(F.col("sec") >= since), pair, offset)
    windows = slot_window_aggregates(slots, pair, by_server=False)
    firsts = slots
    if since is not None:
        windows = windows.filter(F.col("ws") >= since)
        firsts = long.withColumn("slot", slot_start(F.col("sec"), offset)).select("server_id", "slot")
    return drop_warmup_by_first(windows, firsts).drop("ws")


def full_time_alerts(
    long: DataFrame,
    pair: MetricPair,
    thresholds: tuple[float, float] | None = None,
    offset: int | Column | None = None,
) -> DataFrame:
    """Alert rows of a long form on full event times (D8), with the windows' times."""
    return label(kept_windows(long, pair, offset), pair, thresholds, full_time=True)


def cpu_mem_alerts(
    cpu: DataFrame,
    mem: DataFrame,
    cpu_threshold: float = K.CPU_THRESHOLD,
    mem_threshold: float = K.MEM_THRESHOLD,
    offset: int | Column | None = None,
    form: str = "slots",
) -> DataFrame:
    """CPU/MEM job: 30 s averages every 10 s per server, labelled (L1)."""
    return alerts(cpu, mem, CPU_MEM, (cpu_threshold, mem_threshold), offset, form)


def net_disk_alerts(
    net: DataFrame,
    disk: DataFrame,
    net_threshold: float = K.NET_THRESHOLD,
    disk_threshold: float = K.DISK_THRESHOLD,
    offset: int | Column | None = None,
    form: str = "slots",
) -> DataFrame:
    """NET/DISK job: 30 s maxima every 10 s per server, labelled (L2)."""
    return alerts(net, disk, NET_DISK, (net_threshold, disk_threshold), offset, form)

"""Batch job runner: landed tables in, guarded, alerts CSV out.

The reference job scans each input five times (two counts, an
existence probe, a minimum, the result). Here: one aggregate pass gives
the counts, the guard status and the offset; the offset then goes into
the plan as a literal, and the result pass writes the sorted output and
counts it on the way. Tables that a stream landed come with their counts
and earliest times, so they need no first pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Observation, SparkSession

from ..operators.status import STATUS_NO_DATA, STATUS_NO_TIME, input_status, landed_status
from ..schemas import PAIRS, MetricPair
from ..sources.csv_tables import read_table, write_alerts
from ..streaming.commits import landing
from ..streaming.ingest import read_landed, read_landed_times, read_states, states_table
from .jobs import alerts, alerts_from_states


class NoEventTimeError(ValueError):
    """No input row has a parseable `HH:mm:ss` time."""


@dataclass
class JobResult:
    status: str
    left_rows: int
    right_rows: int
    window_offset: int | None
    output: str | None
    rows: int = 0


def run_alert_job(
    spark: SparkSession,
    pair: MetricPair | str,
    left_path: str,
    right_path: str,
    out_path: str,
    thresholds: tuple[float, float] | None = None,
    single_file: bool = False,
    fmt: str = "csv",
    landed_base: str | None = None,
    from_states: bool = False,
) -> JobResult:
    """Run one alert job over landed tables (CSV by default, as the
    reference; `fmt="parquet"` at scale).

    Both inputs empty -> status `no data`, nothing written (P12). No
    parseable time anywhere -> `NoEventTimeError` (P13). The result's row
    count (A1) is observed while it is written. `landed_base` is the
    folder of a stream's landing that the two tables are part of: guards
    and offset then come from its commit records. `from_states=True`
    computes the windows from the states landed with the tables; the
    tables themselves are not read.
    """
    p = PAIRS[pair] if isinstance(pair, str) else pair
    if from_states and landed_base is None:
        raise ValueError("states are part of a landing: give landed_base")
    if landed_base is not None:
        left, right = (read_landed(spark, m, path, fmt) for m, path in ((p.left, left_path), (p.right, right_path)))
        status = landed_status(read_landed_times(spark, landed_base), p)
    else:
        left, right = (read_table(spark, m, path, fmt) for m, path in ((p.left, left_path), (p.right, right_path)))
        status = input_status(left, right)
    st = status.first()
    if st.status == STATUS_NO_DATA:
        return JobResult(st.status, 0, 0, None, None)
    if st.status == STATUS_NO_TIME:
        raise NoEventTimeError("all timestamps are null or unparseable; expected HH:mm:ss")
    if from_states:
        land = landing(spark, landed_base)
        if missing := set(land.tables) - set(land.names(states_table(p))):
            raise ValueError(f"landed without states of {p.name}: {sorted(missing)}")
        out = alerts_from_states(read_states(spark, land, p), p, thresholds, int(st.window_offset))
    else:
        out = alerts(left, right, p, thresholds, offset=int(st.window_offset))
    seen = Observation()
    write_alerts(out, out_path, single_file=single_file, seen=seen)
    return JobResult(st.status, st.left_rows, st.right_rows, int(st.window_offset), out_path, seen.get["rows"])

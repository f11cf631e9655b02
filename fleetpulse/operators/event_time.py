"""Event-time projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import once, parse_time_of_day
from ..schemas import Metric


def with_event_time(df: DataFrame, metric: Metric, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed projection of a landed metric table (P9 + P10).

    Output: `server_id`, `ts_dt` (timestamp on 1970-01-01, null when the
    text is not a strict `HH:mm:ss`), then the measures, the aggregated
    one cast to the metric's type and renamed as the jobs do
    (`cpu_pct` -> `cpu_val`, `mem_pct` -> `mem_val`; net/disk keep names).
    `keep` names input columns to carry along unchanged.
    """
    # Parsed once per row: the not-null filters downstream read `ts_dt`.
    cols = [*[F.col(c) for c in keep], F.col("server_id"), once(parse_time_of_day("ts")).alias("ts_dt")]
    for m in metric.measures:
        name = metric.value_alias if m == metric.measure else m
        dtype = metric.dtype if m == metric.measure else "double"
        cols.append(F.col(m).cast(dtype).alias(name))
    return df.select(*cols)


def has_event_time(df: DataFrame, col: str = "ts_dt") -> DataFrame:
    """Rows whose event time parsed."""
    return df.filter(F.col(col).isNotNull())

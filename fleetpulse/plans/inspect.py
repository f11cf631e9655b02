"""Plan inspection: the text of `explain` and the shuffles it shows."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame

SUBQUERIES = "===== Subqueries ====="


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def main_tree(df: DataFrame) -> str:
    """Operator tree of the main query (formatted mode), subqueries excluded."""
    return plan_text(df).split(SUBQUERIES)[0].split("\n\n")[0]


def shuffle_count(df: DataFrame) -> int:
    """Exchanges in the main query's physical plan."""
    return main_tree(df).count("Exchange")

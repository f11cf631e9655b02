"""`spark-submit` entry for one alert job over landed CSV tables.

    spark-submit fleetpulse/plans/submit.py cpu_mem --left cpu_data --right mem_data \
        --out cpu_mem_alerts [--left-threshold 80.07] [--right-threshold 89.36] [--single-file] [--format parquet] \
        [--landed-base landed [--from-states]]

Exit status: 0 on success or when both inputs are empty (nothing is
written), 1 when no input row has a parseable time.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> int:
    from fleetpulse.plans.run import NoEventTimeError, run_alert_job
    from fleetpulse.schemas import PAIRS

    p = argparse.ArgumentParser(description="windowed metric alerts")
    p.add_argument("job", choices=sorted(PAIRS))
    p.add_argument("--left", required=True, help="cpu or net table")
    p.add_argument("--right", required=True, help="mem or disk table")
    p.add_argument("--out", required=True)
    p.add_argument("--left-threshold", type=float)
    p.add_argument("--right-threshold", type=float)
    p.add_argument("--single-file", action="store_true")
    p.add_argument("--format", default="csv", help="format of the input tables (csv, parquet, ...)")
    p.add_argument("--landed-base", help="landing of a stream that both tables are part of")
    p.add_argument("--from-states", action="store_true", help="compute windows from the states of the landing")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"fleetpulse-{a.job}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    thresholds = None
    if a.left_threshold is not None or a.right_threshold is not None:
        from fleetpulse.functions import constants as K

        defaults = {
            "cpu_mem": (K.CPU_THRESHOLD, K.MEM_THRESHOLD),
            "net_disk": (K.NET_THRESHOLD, K.DISK_THRESHOLD),
        }[a.job]
        thresholds = (
            defaults[0] if a.left_threshold is None else a.left_threshold,
            defaults[1] if a.right_threshold is None else a.right_threshold,
        )
    try:
        res = run_alert_job(spark, a.job, a.left, a.right, a.out, thresholds, a.single_file, a.format, a.landed_base, a.from_states)
    except NoEventTimeError as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    print(f"{a.job}: status={res.status} left_rows={res.left_rows} right_rows={res.right_rows} "
          f"offset={res.window_offset} rows={res.rows} output={res.output}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

"""Scaling check: the CPU/MEM job on k-times denser data, in each plan form.

    python tools/scale_check.py --factor 50 [--sf-dir /root/testdata/sf0.1] [--scratch DIR]

Derives the data with Spark from `events`: each row repeated `factor`
times, copy i shifted by 3*i+1 seconds, same servers (so every server
keeps a fifth of all rows), written as 16 files into the scratch
folder (a fresh `mktemp` folder unless given). Prints the median of 3
runs and the shuffle records and bytes of one run per form, taken from
Spark's event log in the scratch folder.
"""

from __future__ import annotations

import argparse
import collections
import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from fleetpulse import cpu_mem_alerts  # noqa: E402
from fleetpulse.plans.jobs import alerts_from_long  # noqa: E402
from fleetpulse.schemas import CPU, CPU_MEM, MEM  # noqa: E402
from fleetpulse.session import build_session  # noqa: E402
from fleetpulse.sources.events import metric_table, pair_long_table, read_events, read_events_at  # noqa: E402


def _shuffle_by_group(log_dir: str) -> dict[str, tuple[int, int]]:
    stage_group, out = {}, collections.defaultdict(lambda: [0, 0])
    apps = glob.glob(f"{log_dir}/eventlog*") + glob.glob(f"{log_dir}/local-*")
    for app in sorted(apps, key=os.path.getmtime)[-1:]:  # this run only
        files = sorted(glob.glob(f"{app}/events_*")) if os.path.isdir(app) else [app]
        for fn in files:
            with open(fn) as fh:
                for line in fh:
                    e = json.loads(line)
                    if e["Event"] == "SparkListenerJobStart":
                        g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                        for s in e["Stage IDs"]:
                            stage_group[s] = g
                    elif e["Event"] == "SparkListenerStageCompleted":
                        si = e["Stage Info"]
                        g = stage_group.get(si["Stage ID"])
                        if g:
                            acc = {a["Name"]: a.get("Value") for a in si.get("Accumulables", [])}
                            out[g][0] += int(acc.get("internal.metrics.shuffle.write.recordsWritten", 0) or 0)
                            out[g][1] += int(acc.get("internal.metrics.shuffle.write.bytesWritten", 0) or 0)
    return {k: tuple(v) for k, v in out.items()}


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--factor", type=int, default=10)
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--scratch", default=None)
    a = ap.parse_args()
    scratch = a.scratch or tempfile.mkdtemp(prefix="scale-")
    logs = f"{scratch}/eventlog"
    os.makedirs(logs, exist_ok=True)
    spark = build_session(spark__eventLog__enabled="true", spark__eventLog__dir=logs, spark__eventLog__compress="false")
    sc = spark.sparkContext
    data = f"{scratch}/events_x{a.factor}"
    if not os.path.exists(data):
        ev = read_events(spark, a.sf_dir)
        shift = F.make_dt_interval(secs=F.col("rep") * 3 + F.lit(1))
        (ev.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(a.factor - 1))))
           .withColumn("ts", (F.col("ts").cast("timestamp") + shift).cast("timestamp_ntz"))
           .drop("rep").repartition(16).write.parquet(data))
    e = read_events_at(spark, data)
    forms = {
        "slots_one_scan": lambda: alerts_from_long(pair_long_table(e, CPU_MEM), CPU_MEM),
        "slots_two_tables": lambda: cpu_mem_alerts(metric_table(e, CPU), metric_table(e, MEM)),
        "join_form": lambda: cpu_mem_alerts(metric_table(e, CPU), metric_table(e, MEM), form="join"),
    }
    times = {}
    for name, build in forms.items():
        build().write.format("noop").mode("overwrite").save()
        ts = []
        for i in range(3):
            sc.setJobGroup(f"{name}#{i}", name)
            t0 = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            ts.append(time.perf_counter() - t0)
        times[name] = statistics.median(ts)
    rows_in = e.count()
    spark.stop()
    shuffles = _shuffle_by_group(logs)
    print(f"factor {a.factor}: {rows_in} events, scratch {scratch}")
    for name in forms:
        recs, byts = shuffles.get(f"{name}#0", (0, 0))
        print(f"  {name:17s} median {times[name]:.2f} s   shuffle {recs:,} records / {byts / 1e6:.1f} MB")


if __name__ == "__main__":
    main()

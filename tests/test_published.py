"""Landing as one commit, states, compaction, and published versions that late rows repair."""

import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fleetpulse.operators.records import decode, fan_out, records_long, route
from fleetpulse.operators.status import input_status, landed_status
from fleetpulse.plans.inspect import plan_text
from fleetpulse.plans.jobs import alerts_from_long, full_time_alerts
from fleetpulse.plans.run import run_alert_job
from fleetpulse.schemas import CPU, CPU_MEM, CPU_MEM_ALERT_SCHEMA, MEM, NET_DISK, WIDE_SCHEMA
from fleetpulse.session import shared_dir
from fleetpulse.sources.csv_tables import read_alerts
from fleetpulse.streaming import ingest, published
from fleetpulse.streaming.commits import folder, landing, read_commits
from fleetpulse.streaming.ingest import compact, land_stream, landing_counts, read_landed, read_landed_times, read_quarantine, read_record_files, read_states

METRICS = ("cpu", "mem", "net", "disk")


def _samples(seed, n, hours=(9, 12), servers=("s1", "s2", "s3", None)):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        h, m, s = rnd.randrange(*hours), rnd.randrange(60), rnd.randrange(60)
        ts = rnd.choice([f"{h:02d}:{m:02d}:{s:02d}"] * 20 + ["bad", None])
        out.append((ts, rnd.choice(servers), *[rnd.choice([None, round(rnd.uniform(60, 100), 2)]) for _ in range(2)], rnd.uniform(5000, 7000), 1.0, rnd.uniform(1000, 2500)))
    return out


def _drop(spark, base, i, samples, junk=1):
    recs = fan_out(spark.createDataFrame(samples, WIDE_SCHEMA), "00:00:00")
    bad = spark.createDataFrame([("topic-cpu", bytearray(b"s1"), bytearray(b"bad{"))] * junk, recs.schema) if junk else recs.limit(0)
    recs.unionByName(bad).coalesce(1).write.parquet(f"{base}/in/{i}")


def _land(spark, base, metrics=("cpu", "mem"), **kw):
    land_stream(read_record_files(spark, f"{base}/in/*", max_files=1), f"{base}/landed", metrics, f"{base}/ck", **kw).awaitTermination()


def _decoded(spark, base):
    return decode(spark.read.parquet(f"{base}/in/*"))


def _want(spark, base, pair):
    return rows(alerts_from_long(records_long(_decoded(spark, base), pair), pair))


@pytest.fixture()
def three(spark):
    base = shared_dir(spark, "published")
    for i in range(3):
        _drop(spark, base, i, _samples(i, 150))
    return base


def test_versions_follow_every_commit_and_equal_the_batch(spark, three):
    """Each drop covers the same hours, so the second and third are late as a whole."""
    outs = {p.name: f"{three}/{p.name}" for p in (CPU_MEM, NET_DISK)}
    _land(spark, three, METRICS, publish=outs)
    for pair in (CPU_MEM, NET_DISK):
        assert rows(published.read_published(spark, outs[pair.name], pair)) == _want(spark, three, pair)
        now = published.current(spark, outs[pair.name])
        assert now.number == 3 and now.merged == frozenset(landing(spark, f"{three}/landed").tables)
        assert published.refresh(spark, f"{three}/landed", pair, outs[pair.name]) == now


def test_a_stream_from_an_empty_folder_finds_its_offset_and_keeps_it(spark):
    base = shared_dir(spark, "offset")
    out = {"cpu_mem": f"{base}/out"}
    _drop(spark, base, 0, [("10:00:07", "a", 90.0, 90.0, 1.0, 1.0, 1.0)] + _samples(5, 60, (11, 13)))
    _land(spark, base, publish=out)
    assert published.current(spark, f"{base}/out").offset == 7
    _drop(spark, base, 1, [("10:00:08", "b", 90.0, 95.0, 1.0, 1.0, 1.0)] + _samples(6, 60, (12, 14)))
    _land(spark, base, publish=out)
    now = published.current(spark, f"{base}/out")
    assert (now.number, now.offset) == (2, 7)
    assert rows(published.read_published(spark, f"{base}/out", CPU_MEM)) == _want(spark, base, CPU_MEM)
    # An earlier event with another last digit moves every window.
    _drop(spark, base, 2, [("09:59:58", "b", 1.0, 2.0, 1.0, 1.0, 1.0)])
    _land(spark, base, publish=out)
    now = published.current(spark, f"{base}/out")
    assert (now.number, now.offset) == (3, 8)
    assert rows(published.read_published(spark, f"{base}/out", CPU_MEM)) == _want(spark, base, CPU_MEM)


def test_a_late_row_repairs_its_windows_and_warm_up_only(spark):
    base = shared_dir(spark, "late")
    out = f"{base}/out"
    first = [(f"{h:02d}:{m:02d}:05", s, 90.0, 90.0, 1.0, 1.0, 1.0) for h in (2, 5) for m in range(0, 60, 3) for s in ("a", "b")]
    _drop(spark, base, 0, first)
    _land(spark, base, publish={"cpu_mem": out})
    before = published.current(spark, out)
    assert before.late == 0
    # Late for a published window of b, and before the first event of a.
    _drop(spark, base, 1, [("02:00:15", "b", 10.0, 10.0, 1.0, 1.0, 1.0), ("01:30:05", "a", 1.0, 1.0, 1.0, 1.0, 1.0)])
    _land(spark, base, publish={"cpu_mem": out})
    now = published.current(spark, out)
    ledger = {(r.server_id, r.ws, r.late) for r in published.read_ledger(spark, out, 2).collect()}
    at = 2 * 3600 + 5
    assert ledger == {("b", at, True), ("b", at + 10, False), ("a", 1.5 * 3600 + 5, False), ("a", at - 20, False), ("a", at - 10, False)}
    assert (now.touched, now.late) == (5, 1)
    assert {h for h, v in now.parts.items() if v == 2} == {1, 2} and now.parts[5] == 1
    assert rows(published.read_published(spark, out, CPU_MEM)) == _want(spark, base, CPU_MEM)
    assert published.read_published(spark, out, CPU_MEM, version=1).count() == before.touched


def test_repair_reads_and_merges_touched_slots_only(spark, three):
    _land(spark, three)
    land = landing(spark, f"{three}/landed")
    keys = spark.createDataFrame([("s1", 3 * 3600 + 7)], "server_id string, ws long")
    df = published.windows_of(read_states(spark, land, CPU_MEM), keys, [3], CPU_MEM, 7)
    plan = plan_text(df, "simple")
    assert "hour#" in plan and "PartitionFilters: [" in plan and "= 3)" in plan.split("PartitionFilters: [")[1].split("]")[0]
    # The semi join with the touched slots stands below every aggregate of states.
    lines = plan.splitlines()
    aggregates = [i for i, line in enumerate(lines) if "partial_sum(l_sum" in line]
    semi = [i for i, line in enumerate(lines) if "LeftSemi" in line]
    assert aggregates and semi and max(semi) > max(aggregates)
    assert df.count() <= 1


def test_a_publication_cut_off_leaves_the_version_before(spark, three, monkeypatch):
    out = f"{three}/cut"
    _land(spark, three)
    published.refresh(spark, f"{three}/landed", CPU_MEM, out)
    want = rows(published.read_published(spark, out, CPU_MEM))
    _drop(spark, three, 3, _samples(9, 50))
    _land(spark, three)

    def dies(*a, **k):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(published, "_at", lambda o, kind, v, at=published._at: dies() if (kind, v) == (published.MANIFEST, 2) else at(o, kind, v))
        with pytest.raises(RuntimeError, match="killed"):
            published.refresh(spark, f"{three}/landed", CPU_MEM, out)
    assert os.path.exists(f"{out}/data/v=2") and rows(published.read_published(spark, out, CPU_MEM)) == want
    published.refresh(spark, f"{three}/landed", CPU_MEM, out)
    assert rows(published.read_published(spark, out, CPU_MEM)) == _want(spark, three, CPU_MEM) != want


def _everything(spark, landed):
    return (
        {m: rows(read_landed(spark, m, f"{landed}/{m}")) for m in METRICS},
        rows(read_quarantine(spark, landed).select("topic", "text")),
        rows(landing_counts(spark, landed)),
        {p.name: rows(landed_status(read_landed_times(spark, landed), p)) for p in (CPU_MEM, NET_DISK)},
    )


def test_a_batch_cut_off_is_not_seen_and_its_replay_counts_once(spark, three, monkeypatch):
    landed = f"{three}/landed"
    seen = []

    def dies(topics, base, name, tables, *a):
        seen.append(_everything(spark, landed))  # as a reader sees it while the batch lands
        if len(seen) == 2:
            raise RuntimeError("killed before its commit")
        return commit(topics, base, name, tables, *a)

    commit = ingest.commit
    with monkeypatch.context() as m:
        m.setattr(ingest, "commit", dies)
        with pytest.raises(Exception, match="killed before its commit"):
            _land(spark, three, METRICS)
    names = list(landing(spark, landed).tables)
    assert len(names) == 1 and all(not r for r in seen[0][0].values()) and seen[0][2] == []
    assert _everything(spark, landed) == seen[1]
    folders = [d for d in os.listdir(f"{landed}/cpu") if d.startswith("batch=")]
    assert len(folders) == 2  # the cut-off batch left one
    _land(spark, three, METRICS)  # the restart replays it
    one = f"{three}/whole"
    land_stream(read_record_files(spark, f"{three}/in/*", max_files=None), one, METRICS, f"{three}/ck1").awaitTermination()
    assert _everything(spark, landed) == _everything(spark, one) and len(landing(spark, landed).tables) == 3
    d = _decoded(spark, three)
    assert rows(landed_status(read_landed_times(spark, landed), CPU_MEM)) == rows(input_status(route(d, CPU), route(d, MEM)))


def test_a_batch_committed_before_its_checkpoint_is_not_landed_twice(spark, three, monkeypatch):
    def dies(*a, **k):
        raise RuntimeError("killed after its commit")

    with monkeypatch.context() as m:
        m.setattr(published, "refresh", dies)
        with pytest.raises(Exception, match="killed after its commit"):
            _land(spark, three, publish={"cpu_mem": f"{three}/out"})
    assert len(landing(spark, f"{three}/landed").tables) == 1
    written = []
    land_batch = ingest._land_batch
    monkeypatch.setattr(ingest, "_land_batch", lambda b, base, name, *a: (written.append(name), land_batch(b, base, name, *a)))
    _land(spark, three, publish={"cpu_mem": f"{three}/out"})
    assert len(written) == 2
    assert rows(published.read_published(spark, f"{three}/out", CPU_MEM)) == _want(spark, three, CPU_MEM)


def test_states_give_the_job_without_the_tables(spark, three):
    landed = f"{three}/landed"
    _land(spark, three, METRICS, fmt="parquet")
    for pair, schema in ((CPU_MEM, CPU_MEM_ALERT_SCHEMA), (NET_DISK, NET_DISK.output_schema)):
        paths = [f"{landed}/{m.name}" for m in (pair.left, pair.right)]
        done = run_alert_job(spark, pair, *paths, f"{three}/o-{pair.name}", fmt="parquet", landed_base=landed, from_states=True)
        got = read_alerts(spark, schema, f"{three}/o-{pair.name}")
        assert rows(got) == _want(spark, three, pair) and done.rows == got.count()
    with pytest.raises(ValueError, match="landed_base"):
        run_alert_job(spark, CPU_MEM, "a", "b", "c", from_states=True)


def test_compaction_keeps_every_row_in_few_files(spark):
    base = shared_dir(spark, "compact")
    for i in range(5):
        _drop(spark, base, i, _samples(20 + i, 15), junk=i % 2)
    out, landed = f"{base}/out", f"{base}/landed"
    _land(spark, base, METRICS, publish={"net_disk": out})
    was = _everything(spark, landed)
    version = published.current(spark, out)
    states = read_states(spark, landing(spark, landed), CPU_MEM).count()
    name = compact(spark, landed)
    assert list(landing(spark, landed).tables) == [name] and _everything(spark, landed) == was
    assert len([f for f in os.listdir(folder(landed, "cpu", name)) if f.startswith("part-")]) < 5
    assert read_states(spark, landing(spark, landed), CPU_MEM).count() <= states
    assert compact(spark, landed) is None
    # What a compaction holds is published already.
    assert published.refresh(spark, landed, NET_DISK, out) == version
    _drop(spark, base, 5, _samples(50, 15))
    _land(spark, base, METRICS, publish={"net_disk": out})
    assert rows(published.read_published(spark, out, NET_DISK)) == _want(spark, base, NET_DISK)
    second = compact(spark, landed)
    assert read_commits(spark, landed).count() == 8 and list(landing(spark, landed).tables) == [second]
    assert rows(landing_counts(spark, landed)) == rows(decode(spark.read.parquet(f"{base}/in/*")).groupBy("topic").agg(
        F.count("*").alias("messages"), F.count_if("valid").alias("stored"), F.count_if(~F.col("valid")).alias("quarantined")))


def test_nothing_landed_and_nothing_timed(spark):
    base = shared_dir(spark, "nothing")
    assert published.refresh(spark, f"{base}/landed", CPU_MEM, f"{base}/out") is None
    assert published.read_published(spark, f"{base}/out", CPU_MEM).collect() == []
    assert read_landed(spark, "cpu", f"{base}/landed/cpu").collect() == [] and landing_counts(spark, f"{base}/landed").collect() == []
    _drop(spark, base, 0, [("bad", "a", 1.0, 1.0, 1.0, 1.0, 1.0)], junk=0)
    _land(spark, base, publish={"cpu_mem": f"{base}/out"})
    assert published.current(spark, f"{base}/out").parts == {} and published.read_published(spark, f"{base}/out", CPU_MEM).collect() == []
    assert read_quarantine(spark, f"{base}/landed").collect() == []
    _drop(spark, base, 1, [("10:00:01", "a", 1.0, 1.0, 1.0, 1.0, 1.0)], junk=0)
    _land(spark, base, publish={"cpu_mem": f"{base}/out"})
    assert rows(published.read_published(spark, f"{base}/out", CPU_MEM)) == _want(spark, base, CPU_MEM)


def test_published_full_time_equals_the_batch(spark):
    base = shared_dir(spark, "full")
    for i, day in enumerate(("2024-03-01", "2024-02-29")):
        recs = fan_out(
            spark.createDataFrame(_samples(30 + i, 80), WIDE_SCHEMA).withColumn("timestamp", F.try_to_timestamp(F.concat_ws(" ", F.lit(day), F.col("ts")))),
            "00:00:00",
        ).filter("timestamp IS NOT NULL")
        recs.coalesce(1).write.parquet(f"{base}/in/{i}")
    src = read_record_files(spark, f"{base}/in/*", max_files=1, timed=True)
    land_stream(src, f"{base}/landed", ("cpu", "mem"), f"{base}/ck", publish={"cpu_mem": f"{base}/out"}, full_time=True).awaitTermination()
    want = full_time_alerts(records_long(_decoded(spark, base), CPU_MEM, full_time=True), CPU_MEM)
    assert rows(published.read_published(spark, f"{base}/out", CPU_MEM, full_time=True)) == rows(want)

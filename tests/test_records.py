"""Record operators P1-P8, A9 on the FIXTURES §5 rows."""

import json

from conftest import rows

from fleetpulse.operators.records import decode, fan_out, quarantine, replay_order, route, topic_counts
from fleetpulse.schemas import CPU, DISK, MEM, NET, RECORD_SCHEMA, WIDE_SCHEMA


def _records(spark, items):
    data = [(t, None if k is None else k.encode(), None if v is None else v.encode()) for t, k, v in items]
    return spark.createDataFrame(data, RECORD_SCHEMA)


FIX = [
    ("topic-cpu", "s1", '{"timestamp":"x","original_ts":"20:52:00","server_id":"s1","cpu_pct":87.78}'),
    ("topic-cpu", "7", '{"original_ts":"20:52:00","server_id":7,"cpu_pct":1}'),
    ("topic-mem", "s1", '{"original_ts":"20:52:00","server_id":"s1"}'),
    ("topic-cpu", "s1", '{"original_ts":"20:52:00","server_id":"s1","cpu_pct":"12.5"}'),
    ("topic-cpu", "s1", '{"original_ts":"20:52:00","server_id":"s1","cpu_pct":NaN}'),
    ("topic-cpu", "s1", "bad{"),
    ("topic-mem", "s1", "[1]"),
    ("topic-net", "s1", '"str"'),
    ("topic-disk", "s1", ""),
    ("topic-other", "s9", '{"original_ts":"20:52:00","server_id":"s9","cpu_pct":5}'),
]


def test_decode_route_fixtures(spark):
    d = decode(_records(spark, FIX))
    cpu = rows(route(d, CPU))
    assert cpu == sorted(
        [("20:52:00", "s1", 87.77999877929688), ("20:52:00", "7", 1.0), ("20:52:00", "s1", 12.5), ("20:52:00", "s1", None)],
        key=lambda t: tuple((x is not None, x) for x in t),
    )
    assert rows(route(d, MEM)) == [("20:52:00", "s1", None)]
    assert route(d, NET).count() == 0 and route(d, DISK).count() == 0


def test_quarantine_and_counts(spark):
    d = decode(_records(spark, FIX))
    q = {(r.topic, r.text) for r in quarantine(d).collect()}
    assert q == {("topic-cpu", "bad{"), ("topic-mem", "[1]"), ("topic-net", '"str"'), ("topic-disk", "")}
    c = {r.topic: (r.messages, r.stored, r.quarantined) for r in topic_counts(d).collect()}
    assert c == {
        "topic-cpu": (5, 4, 1),
        "topic-mem": (2, 1, 1),
        "topic-net": (1, 0, 1),
        "topic-disk": (1, 0, 1),
        "topic-other": (1, 0, 0),
    }


def test_fan_out_shape_and_round_trip(spark):
    samples = spark.createDataFrame(
        [
            ("20:52:00", "s1", 10.5, 20.25, 100.0, 50.0, 7.0),
            ("20:52:01", "", float("nan"), None, 1.0, 2.0, 3.0),
        ],
        WIDE_SCHEMA,
    )
    recs = fan_out(samples, "12:00:00")
    assert [(f.name, f.dataType) for f in recs.schema] == [(f.name, f.dataType) for f in RECORD_SCHEMA]
    got = recs.collect()
    assert len(got) == 8 and {r.topic for r in got} == {"topic-cpu", "topic-mem", "topic-net", "topic-disk"}
    empty_key = [r for r in got if json.loads(r.value.decode())["original_ts"] == "20:52:01"]
    assert all(r.key is None for r in empty_key)
    cpu_msg = next(json.loads(r.value.decode()) for r in got if r.topic == "topic-cpu" and r.key == b"s1")
    assert cpu_msg == {"timestamp": "12:00:00", "original_ts": "20:52:00", "server_id": "s1", "cpu_pct": 10.5}
    nan_msg = next(json.loads(r.value.decode()) for r in empty_key if r.topic == "topic-cpu")
    assert nan_msg["cpu_pct"] is None and "mem_pct" not in nan_msg
    d = decode(recs)
    assert rows(route(d, NET)) == sorted([("20:52:00", "s1", 100.0, 50.0), ("20:52:01", "", 1.0, 2.0)])


def test_replay_order(spark):
    samples = spark.createDataFrame(
        [("00:00:02", "b", 1.0, 1.0, 1.0, 1.0, 1.0), (None, "x", 1.0, 1.0, 1.0, 1.0, 1.0), ("00:00:01", "a", 1.0, 1.0, 1.0, 1.0, 1.0), ("00:00:02", "a", 1.0, 1.0, 1.0, 1.0, 1.0)],
        WIDE_SCHEMA,
    )
    got = [(r.ts, r.server_id) for r in replay_order(samples).collect()]
    assert got == [("00:00:01", "a"), ("00:00:02", "a"), ("00:00:02", "b")]


def test_fan_out_is_narrow(spark):
    samples = spark.createDataFrame([("00:00:01", "a", 1.0, 1.0, 1.0, 1.0, 1.0)], WIDE_SCHEMA)
    plan = decode(fan_out(samples, "00:00:00"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_route_all_equals_union_of_routes(spark):
    from fleetpulse.operators.records import route_all

    d = decode(_records(spark, FIX))
    got = rows(route_all(d))
    want = []
    for m in (CPU, MEM, NET, DISK):
        for r in route(d, m).collect():
            extra = r["net_out"] if "net_out" in m.measures else None
            want.append((m.name, r.ts, r.server_id, None if r[m.measure] is None else float(r[m.measure]), extra))
    assert got == sorted(want, key=lambda t: tuple((x is not None, x) for x in t))


def test_decode_parses_once(spark):
    from fleetpulse.operators.records import records_long
    from fleetpulse.plans.inspect import plan_text
    from fleetpulse.schemas import CPU_MEM

    assert plan_text(records_long(decode(_records(spark, FIX)), CPU_MEM)).count("from_json") == 1

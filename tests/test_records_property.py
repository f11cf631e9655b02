"""Random record payloads: decode + route equal a plain-Python model of the consumer.

Model (SURVEY P6-P8, D1, D5, D12): a value is kept only if it is a JSON
object; `original_ts` becomes `ts`; a number id becomes its text; a
measure that is a number or numeric text becomes a float, anything else
(missing, null, NaN, text, true/false) null; other topics are ignored.
"""

import json
import math
import struct

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fleetpulse.operators.records import decode, quarantine, route
from fleetpulse.schemas import CPU, MEM, RECORD_SCHEMA

MISSING = object()
ts_vals = st.sampled_from(["20:52:00", "00:00:05", "9:05:00", "", None, MISSING])
id_vals = st.one_of(st.sampled_from(["s1", "s2", "", None, MISSING]), st.integers(0, 9))
num_vals = st.one_of(
    st.sampled_from([None, MISSING, True, "x", "12.5", float("nan"), 80.07, 0.0]),
    st.integers(-5, 100000),
    st.integers(0, 100000).map(lambda k: k / 100),
)
payloads = st.fixed_dictionaries({"original_ts": ts_vals, "server_id": id_vals, "cpu_pct": num_vals, "mem_pct": num_vals})
junk = st.sampled_from(["bad{", "[1]", '"str"', "null", "", "42"])
records = st.lists(
    st.tuples(st.sampled_from(["topic-cpu", "topic-mem", "topic-other"]), st.one_of(payloads, junk)),
    max_size=40,
)


def _text(v):
    if isinstance(v, str):
        return v
    return json.dumps({k: x for k, x in v.items() if x is not MISSING})


def _f32(x):
    return None if x is None else struct.unpack("f", struct.pack("f", x))[0]


def _measure(x):
    if x is MISSING or x is None or isinstance(x, bool):
        return None
    if isinstance(x, str):
        try:
            v = float(x)
        except ValueError:
            return None
    else:
        v = float(x)
    return None if math.isnan(v) else _f32(v)


def _model(items, topic, measure):
    out, bad = [], []
    for t, v in items:
        try:
            obj = json.loads(_text(v)) if isinstance(v, str) else v
        except ValueError:
            obj = None
        if not isinstance(obj, dict):
            bad.append((t, _text(v)))
            continue
        if t != topic:
            continue
        ts = obj.get("original_ts", MISSING)
        sid = obj.get("server_id", MISSING)
        sid = None if sid is MISSING or sid is None else str(sid)
        out.append((None if ts is MISSING else ts, sid, _measure(obj.get(measure, MISSING))))
    return out, bad


def _key(t):
    return tuple((x is not None, x) for x in t)


@settings(max_examples=15, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(records)
def test_decode_route_matches_model(spark, items):
    data = [(t, b"k", _text(v).encode()) for t, v in items]
    d = decode(spark.createDataFrame(data, RECORD_SCHEMA))
    for metric in (CPU, MEM):
        want, bad = _model(items, metric.topic, metric.measure)
        assert rows(route(d, metric)) == sorted(want, key=_key)
    assert sorted((r.topic, r.text) for r in quarantine(d).collect()) == sorted(bad)

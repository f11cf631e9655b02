"""Brute-force model of one alert job in plain Python, for property tests.

Written from the semantics in SURVEY §2 (not from any Spark plan): strict
time parse, global offset, three windows per row, per-server rank,
half-up rounding of the double's shortest decimal text, ordered labels.
"""

from __future__ import annotations

import re
import struct
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

TIME = re.compile(r"([01][0-9]|2[0-3]):([0-5][0-9]):([0-5][0-9])")


def sec_of(ts):
    if ts is None:
        return None
    m = TIME.fullmatch(ts)
    return None if m is None else int(m[1]) * 3600 + int(m[2]) * 60 + int(m[3])


def f32(x):
    return None if x is None else struct.unpack("f", struct.pack("f", x))[0]


def round2(x):
    return None if x is None else float(Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def hms(s):
    s %= 86400
    return f"{s // 3600:02d}:{s % 3600 // 60:02d}:{s % 60:02d}"


def alerts(left, right, kind, thresholds):
    """left/right: lists of (ts, server, value). kind: 'cpu_mem' or 'net_disk'."""
    avg = kind == "cpu_mem"
    rows = [(sec_of(t), s, f32(v) if avg else v, 0) for t, s, v in left]
    rows += [(sec_of(t), s, f32(v) if avg else v, 1) for t, s, v in right]
    rows = [r for r in rows if r[0] is not None]
    if not rows:
        return []
    off = min(r[0] for r in rows) % 10
    groups = defaultdict(lambda: ([], []))
    for sec, server, v, side in rows:
        slot = sec - (sec - off) % 10
        for ws in (slot - 20, slot - 10, slot):
            groups[(server, ws)][side].append(v)

    def agg(vals):
        vals = [v for v in vals if v is not None]
        if not vals:
            return None
        return sum(vals) / len(vals) if avg else max(vals)

    per_server = defaultdict(list)
    for (server, ws), (lv, rv) in groups.items():
        per_server[server].append((ws, round2(agg(lv)), round2(agg(rv))))
    out = []
    t_l, t_r = thresholds
    for server, wins in per_server.items():
        for ws, a, b in sorted(wins)[2:]:
            ge_a = a is not None and a >= t_l
            ge_b = b is not None and b >= t_r
            if avg:
                alert = ("CPU and Memory spike" if ge_a and ge_b else "Memory saturation suspected" if ge_b
                         else "CPU spike suspected" if ge_a else None)
                out.append((server, hms(ws), hms(ws + 30), f32(a), f32(b), alert))
            else:
                lt_a = a is not None and a < t_l
                lt_b = b is not None and b < t_r
                alert = ("Network flood + Disk thrash suspected" if ge_a and ge_b else "Possible DDoS" if ge_a and lt_b
                         else "Disk thrash suspected" if ge_b and lt_a else None)
                out.append((server, hms(ws), hms(ws + 30), a, b, alert))
    return out

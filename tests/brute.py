"""One-pass Python versions of the order-dependent rules."""

from __future__ import annotations

from collections import defaultdict


def by_key(rows, *names):
    out = defaultdict(list)
    for row in rows:
        out[tuple(row[n] for n in names)].append(row)
    return out


def count_events(times):
    times = sorted(times)
    anchor, flag, n = times[0], False, 0
    for t in times[1:]:
        if t - anchor <= 180:
            if not flag:
                n, flag = n + 1, True
        else:
            anchor, flag = t, False
    return n


def alarms(marks, fire_at=2, slide=False):
    """``marks``: (t, previous fix time), strictly increasing t."""
    fired, state = [], None
    for t, pre in marks:
        if state and state["last"] < t < state["ends"]:
            state["seen"] += 1
            if state["seen"] == fire_at:
                fired.append((t, state["opened"], state["ends"]))
            if slide and state["seen"] <= fire_at:
                state["ends"] = t + 180
            state["last"] = t
        else:
            state = {"opened": pre, "last": t, "seen": 1, "ends": (t if slide else pre) + 180}
    return fired


def running(scores):
    out, now = [], None
    for c in scores:
        now = round(((c if now is None else now) + c) / 2 + 1e-9, 2)
        out.append(now)
    return out


def trips(fixes, ends=None):
    """``fixes``: dicts in time order with t, status, mark, over."""
    out, status, begin, counts = [], None, None, defaultdict(int)
    for f in fixes:
        counts[f"m{f['mark']}"] += 1
        counts[f"o{f['over']}"] += 1
        if status is None:
            status, begin = f["status"], f["t"]
        elif f["status"] != status:
            if ends is None or (status, f["status"]) in ends:
                out.append((begin, f["t"], counts["m1"], counts["m2"], counts["m3"], counts["o0"]))
                counts = defaultdict(int)
            status, begin = f["status"], f["t"]
    return out

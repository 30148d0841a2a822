"""Plain-Python models of the stateful rules, for randomized comparisons.

Rows are dicts with key, ts (µs), seq and a type field; each model walks the
rows of a key in order, the way the reference's process functions do.
"""

from __future__ import annotations

from collections import defaultdict


def by_key(rows, key, order=("ts_us", "seq")):
    g = defaultdict(list)
    for r in rows:
        g[r[key]].append(r)
    for k in g:
        g[k].sort(key=lambda r: tuple(r[c] for c in order))
    return g


def fail_bursts(rows, within, min_fails=2, key="user_id"):
    out = []
    for k, evs in by_key(rows, key).items():
        burst = []
        for e in evs:
            if e["event_type"] == "fail":
                if burst and e["ts_us"] > burst[0]["ts_us"] + within:
                    if len(burst) >= min_fails:
                        out.append((k, burst[0]["ts_us"] // 1000, burst[-1]["ts_us"] // 1000, len(burst)))
                    burst = []
                burst.append(e)
            else:
                if burst and e["ts_us"] > burst[0]["ts_us"] + within and len(burst) >= min_fails:
                    out.append((k, burst[0]["ts_us"] // 1000, burst[-1]["ts_us"] // 1000, len(burst)))
                burst = []
        if len(burst) >= min_fails:
            out.append((k, burst[0]["ts_us"] // 1000, burst[-1]["ts_us"] // 1000, len(burst)))
    return sorted(out)


def consecutive_fails(rows, within, key="user_id", order=("ts_us", "seq")):
    out = []
    for k, evs in by_key(rows, key, order).items():
        last = None
        for e in evs:
            if e["event_type"] == "fail":
                if last is not None and e["ts_us"] < last["ts_us"] + within:
                    out.append((k, last["ts_us"] // 1000, e["ts_us"] // 1000))
                last = e
            else:
                last = None
    return sorted(out)


def next_fail_pairs(rows, within, key="user_id"):
    out = []
    for k, evs in by_key(rows, key).items():
        for a, b in zip(evs, evs[1:]):
            if a["event_type"] == b["event_type"] == "fail" and b["ts_us"] - a["ts_us"] < within:
                out.append((k, a["ts_us"] // 1000, b["ts_us"] // 1000))
    return sorted(out)


def order_status(rows, limit):
    first = {}
    for r in sorted(rows, key=lambda r: (r["ts_us"], r["seq"])):
        first.setdefault((r["order_id"], r["event_type"]), r["ts_us"])
    out = []
    for oid in sorted({r["order_id"] for r in rows}):
        c, p = first.get((oid, "create")), first.get((oid, "pay"))
        if c is not None and p is not None:
            out.append((oid, "payed successfully" if p < c + limit else "payed but already timeout"))
        elif p is not None:
            out.append((oid, "payed but not found create log"))
        else:
            out.append((oid, "order timeout"))
    return out


def sliding_counts(rows, keys, size, slide):
    """{(keys..., window_end_ms): count} by enumerating every window of every row."""
    out = defaultdict(int)
    for r in rows:
        start = r["ts_us"] - r["ts_us"] % slide
        for j in range(size // slide):
            s = start - j * slide
            out[(*[r[k] for k in keys], (s + size) // 1000)] += 1
    return dict(out)


def interval_pairs(left, right, key, lower, upper):
    return sorted((l["id"], r["id"]) for l in left for r in right
                  if l[key] is not None and l[key] == r[key] and l["ts_us"] + lower <= r["ts_us"] <= l["ts_us"] + upper)

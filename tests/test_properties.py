"""Property tests: operators against brute force on generated inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import models
from helpers import frame, tuples
from tidepool.operators import keyed
from tidepool.operators.joins import interval_join
from tidepool.operators.windows import sliding_count

SEC = 1_000_000
FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

events = st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 400)), min_size=1, max_size=40)


@FEW
@given(rows=events, slide=st.sampled_from([5, 10]), mult=st.integers(1, 6))
def test_sliding_change_points(spark, rows, slide, mult):
    size = slide * mult
    data = [(k, t * SEC, i) for i, (k, t) in enumerate(rows)]
    seg = sliding_count(frame(spark, data, "k string, ts_us long, seq long"), ["k"], size, slide).collect()
    got = {}
    for s in seg:
        for e in range(s["end_from"], s["end_to"], slide * 1000):
            got[(s["k"], e)] = s["cnt"]
    assert got == models.sliding_counts([dict(k=k, ts_us=t) for k, t, _ in data], ["k"], size * SEC, slide * SEC)


@FEW
@given(left=events, right=events, lo=st.integers(-20, 10), width=st.integers(0, 25))
def test_interval_join(spark, left, right, lo, width):
    L = frame(spark, [(k, t * SEC, i) for i, (k, t) in enumerate(left)], "tx string, l_us long, lid long")
    R = frame(spark, [(k, t * SEC, i) for i, (k, t) in enumerate(right)], "tx string, r_us long, rid long")
    got = interval_join(L, R, ["tx"], lo * SEC, (lo + width) * SEC, "inner", "l_us", "r_us")
    exp = models.interval_pairs([dict(tx=k, ts_us=t * SEC, id=i) for i, (k, t) in enumerate(left)],
                                [dict(tx=k, ts_us=t * SEC, id=i) for i, (k, t) in enumerate(right)],
                                "tx", lo * SEC, (lo + width) * SEC)
    assert tuples(got, ["lid", "rid"]) == exp


logins = st.lists(st.tuples(st.integers(1, 2), st.sampled_from(["fail", "fail", "success"]), st.integers(0, 3)),
                  min_size=1, max_size=40)


@FEW
@given(rows=logins, within=st.integers(1, 4))
def test_fail_bursts(spark, rows, within):
    t, data = 0, []
    for i, (u, kind, step) in enumerate(rows):
        t += step
        data.append((u, kind, t * SEC, i))
    got = keyed.fail_bursts(frame(spark, data, "user_id long, event_type string, ts_us long, seq long"),
                            "user_id", within * SEC, 2)
    exp = models.fail_bursts([dict(user_id=u, event_type=k, ts_us=ts, seq=s) for u, k, ts, s in data], within * SEC)
    assert tuples(got, ["user_id", "first_fail_ms", "last_fail_ms", "fail_count"]) == exp

"""Streams that are exact at every micro-batch against the batch operators on the rows so far."""

import os
import random

import pytest
from pyspark.sql import functions as F

from helpers import tuples
from test_streaming import _write_files
from tidepool.operators import keyed
from tidepool.plans import jobs as batch
from tidepool.sources import readers
from tidepool.streaming import exact, jobs
from tidepool.streaming.epochlog import EpochLog


@pytest.fixture()
def rocksdb(spark):
    for k, v in exact.ROCKSDB.items():
        before = spark.conf.get(k, None)
        spark.conf.set(k, v)
    yield
    spark.conf.unset(k) if before is None else spark.conf.set(k, before)


def _until_done(writer, tmp_dir, name):
    q = writer.option("checkpointLocation", os.path.join(tmp_dir, f"ck_{name}")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    assert q.exception() is None


def test_running_visitors(spark, tmp_dir, rocksdb):
    rng = random.Random(2)
    t, rows = 1_700_000_000, []
    for _ in range(300):
        t += rng.randrange(0, 60)
        rows.append((rng.choice([rng.randrange(40), rng.randrange(1 << 40), -5]), 1, 1, rng.choice(["pv", "pv", "cart"]), t))
    root = _write_files(os.path.join(tmp_dir, "ub"), rows, per_file=50)
    seen = {}
    w = exact.running_visitors_writer(readers.stream_records(spark, root, "user_behavior", max_files=1),
                                      lambda df, e: seen.__setitem__(e, {r.window_end: r.uv for r in df.collect()}), os.path.join(tmp_dir, "uv"))
    _until_done(w, tmp_dir, "uv")
    for epoch in range(6):
        so_far, now = rows[: 50 * (epoch + 1)], rows[50 * epoch: 50 * (epoch + 1)]
        want = {}
        for user, _, _, kind, ts in so_far:
            if kind == "pv":
                want.setdefault((ts // 3600 + 1) * 3_600_000, set()).add(user)
        touched = {(ts // 3600 + 1) * 3_600_000 for _, _, _, kind, ts in now if kind == "pv"}
        assert seen[epoch] == {w: len(want[w]) for w in touched}
    final = {r.window_end: r.uv for r in batch.unique_visitors(readers.read_records(spark, root, "user_behavior", seq="hash")).collect()}
    assert {w: max(s.get(w, 0) for s in seen.values()) for w in final} == final


def test_epoch_log_is_compacted_and_replays(spark, tmp_dir):
    """Folders on disk and folders read stay bounded over many epochs, and a replayed epoch gives the same rows."""
    root = os.path.join(tmp_dir, "log")
    log = EpochLog(root, lambda d: d.groupBy("k").agg(F.max("n").alias("n")), every=4)
    state, rng = {}, random.Random(1)
    for epoch in range(30):
        rows = [(rng.randrange(5), epoch * 10 + i) for i in range(3)]
        for _ in range(2 if epoch in (4, 5, 8, 12, 13) else 1):
            before, own = log.write(spark.createDataFrame(rows, "k long, n long"), epoch)
            assert dict(tuples(before, ["k", "n"])) == state and tuples(own) == sorted(rows)
        for k, n in rows:
            state[k] = max(state.get(k, -1), n)
        assert len(log.folders(epoch)) <= 5 and len(os.listdir(root)) <= 12
    with pytest.raises(Exception):
        log.before(spark, 1000, "k long, n long").collect()


def test_panes_let_go_of_closed_windows(spark, tmp_dir):
    """Merged panes: those of open windows, and the newest time of all."""
    log = jobs._PaneLog(spark.createDataFrame([("a", 10, 3, 9), ("b", 70, 1, 65), (None, 90, 0, 88)], "url string, pane long, n long, max_us long"),
                        0, os.path.join(tmp_dir, "panes"), ["url"], 40, 10, 0)
    assert tuples(log._merge(log.own), ["pane", "n", "max_us"]) == [(0, 0, 88), (70, 1, 65)] and log.closed == 80 and log.closed_before is None


@pytest.mark.parametrize("max_files", [None, 1])
def test_late_rows_by_their_own_watermark(spark, tmp_dir, max_files):
    """All in one micro-batch, or a file each: the rows that the batch operator calls late."""
    rng = random.Random(4)
    t, lines = 10 * 3600, []
    for i in range(240):
        t += rng.randrange(0, 30)
        s = max(0, t - (rng.randrange(600, 1500) if rng.random() < 0.2 else 0))
        lines.append(f"10.0.0.1 u{i} - 17/05/2015:{s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d} +0000 GET /{i}")
    root = os.path.join(tmp_dir, "log")
    os.makedirs(root)
    for i in range(0, 240, 40):
        path = os.path.join(root, f"part-{i:05d}.txt")
        with open(path, "w") as f:
            f.write("\n".join(lines[i:i + 40]))
        os.utime(path, (1_600_000_000 + i, 1_600_000_000 + i))
    on_time, late = keyed.split_late(readers.read_web_log(spark, root))
    got = {"late": [], "on": []}
    w = exact.late_split_writer(readers.parse_web_log(readers.stream_places(spark, root, max_files)),
                                lambda df, e: got["on"].extend(r.url for r in df.collect()), lambda df, e: got["late"].extend(r.url for r in df.collect()),
                                os.path.join(tmp_dir, "marks"))
    _until_done(w, tmp_dir, "late")
    assert sorted(got["late"]) == sorted(r.url for r in late.collect()) and len(got["late"]) > 5
    assert sorted(got["on"]) == sorted(r.url for r in on_time.collect())

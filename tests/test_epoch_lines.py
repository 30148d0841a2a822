"""The line sink: each epoch once, whatever is replayed, aborted or staged by failed attempts."""

import os
from collections import Counter

import pyarrow as pa

from tidepool.sources import readers, sinks
from tidepool.sources.epoch_lines import EpochLines, EpochLinesWriter, commits, committed_lines


def _batches(lines):
    return iter([pa.RecordBatch.from_arrays([pa.array(lines[i:i + 2], pa.string())], ["value"]) for i in range(0, len(lines), 2)])


def _lines(path):
    return [line for c in commits(path) for f in c["files"] for line in open(f"{path}/{f}").read().splitlines()]


def test_replay_and_abort(tmp_dir):
    w = EpochLinesWriter(tmp_dir)
    w.commit([w.write(_batches(["a", "b", None, "é"])), w.write(_batches([])), None], 0)
    again = [w.write(_batches(["a", "b"])), w.write(_batches(["é"]))]
    w.commit(again, 0)  # the epoch is replayed after a crash behind its commit
    lost = w.write(_batches(["never seen"]))
    w.abort([lost, None], 1)
    w.write(_batches(["of a task that died"]))
    w.commit([w.write(_batches(["c"]))], 1)
    assert Counter(_lines(tmp_dir)) == Counter(["a", "b", "é", "c"]) and [c["lines"] for c in commits(tmp_dir)] == [3, 1]
    assert not any(os.path.exists(f"{tmp_dir}/{f}") for m in [*again, lost] for f in m.files)


def test_stream_writes_each_line_once(spark, tmp_dir):
    src, out, place = (os.path.join(tmp_dir, d) for d in ("in", "out", "ck"))
    os.makedirs(src)
    want = []
    for i in range(4):
        lines = [f"{i},{k},pay,tx{k},15584{i}{k:03d}" for k in range(30)]
        want += lines
        with open(f"{src}/{i}.txt", "w") as f:
            f.write("\n".join(lines))
        os.utime(f"{src}/{i}.txt", (1_600_000_000 + i, 1_600_000_000 + i))
    spark.dataSource.register(EpochLines)
    lines = sinks.as_lines(readers.stream_places(spark, src, 1).select("value"))

    def run():
        q = lines.writeStream.format("epoch_lines").option("path", out).option("checkpointLocation", place).trigger(availableNow=True).start()
        q.awaitTermination(200)
        assert q.exception() is None

    run()
    assert Counter(r.value for r in committed_lines(spark, out).collect()) == Counter(want) and len(commits(out)) == 4
    # the last epoch's commit in the checkpoint is lost: it is replayed
    for name in ("commits/3", "commits/.3.crc"):
        if os.path.exists(f"{place}/{name}"):
            os.replace(f"{place}/{name}", f"{tmp_dir}/{os.path.basename(name)}-lost")
    run()
    assert Counter(r.value for r in committed_lines(spark, out).collect()) == Counter(want) and len(commits(out)) == 4


def test_nothing_written(spark, tmp_dir):
    assert committed_lines(spark, os.path.join(tmp_dir, "none")).collect() == []

"""Streaming forms against the batch operators on the same rows.

Rows are written as CSV files in arrival order (one file per micro-batch);
a far-future sentinel row closes every window and timer, and is dropped
from the comparison.
"""

import os
import random

import pytest

from helpers import tuples
from tidepool.plans import jobs as batch
from tidepool.sources import readers
from tidepool.streaming import jobs as stream

SENTINEL = 4_000_000_000  # seconds, year 2096


def _write_files(root, rows, per_file=40):
    os.makedirs(root, exist_ok=True)
    for i in range(0, len(rows), per_file):
        path = os.path.join(root, f"part-{i // per_file:05d}.csv")
        with open(path, "w") as f:
            f.write("\n".join(",".join("" if v is None else str(v) for v in r) for r in rows[i:i + per_file]))
        # the file source takes files in modification-time order: make it the arrival order
        os.utime(path, (1_600_000_000 + i, 1_600_000_000 + i))
    return root


def _run(spark, df, name, mode="append"):
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
           .trigger(availableNow=True).start())
    q.awaitTermination(240)
    out = spark.table(name)
    return out


@pytest.fixture(scope="module")
def behaviour_rows():
    rnd = random.Random(5)
    t, rows = 1_700_000_000, []
    for i in range(400):
        t += rnd.randrange(0, 40)
        rows.append((rnd.randrange(1, 30), rnd.randrange(1, 8), 1, rnd.choice(["pv", "pv", "cart"]), t))
    return rows


def test_stream_page_views_and_uv(spark, tmp_dir, behaviour_rows):
    root = _write_files(os.path.join(tmp_dir, "ub"), behaviour_rows + [(0, 0, 0, "pv", SENTINEL)])
    s = readers.stream_records(spark, root, "user_behavior", max_files=1)
    b = readers.read_records(spark, root, "user_behavior", seq="hash").where(f"ts_us < {SENTINEL}000000")
    pv = _run(spark, stream.window_counts(s.where("behavior = 'pv'"), [], "1 hour"), "s_pv")
    assert tuples(pv, ["window_end", "cnt"]) == tuples(batch.page_views(b), ["window_end", "pv"])
    uv = _run(spark, stream.unique_visitors(s), "s_uv")
    assert tuples(uv) == tuples(batch.unique_visitors(b), ["window_end", "uv"])


def test_stream_tx_match(spark, tmp_dir):
    rnd = random.Random(8)
    orders, receipts, t = [], [], 1_558_430_800
    for i in range(120):
        t += rnd.randrange(0, 4)
        tx = f"tx{rnd.randrange(40)}"
        if rnd.random() < 0.5:
            orders.append((i, "pay", tx, t))
        else:
            receipts.append((tx, rnd.choice(["wechat", "alipay"]), t))
    o_root = _write_files(os.path.join(tmp_dir, "o"), orders + [(999, "pay", "sentinel", SENTINEL)], 15)
    r_root = _write_files(os.path.join(tmp_dir, "r"), receipts + [("sentinel", "x", SENTINEL)], 15)
    so = readers.stream_records(spark, o_root, "order", max_files=1)
    sr = readers.stream_records(spark, r_root, "receipt", max_files=1)
    got = _run(spark, stream.tx_match(so, sr), "s_tx").where("tx_id != 'sentinel'")
    bo = readers.read_records(spark, o_root, "order", seq="hash").where(f"ts_us < {SENTINEL}000000")
    br = readers.read_records(spark, r_root, "receipt", seq="hash").where(f"ts_us < {SENTINEL}000000")
    exp = batch.tx_match_join(bo, br)
    assert tuples(got, ["tx_id", "pay_ms", "receipt_ms"]) == tuples(exp, ["tx_id", "pay_ms", "receipt_ms"])
    assert got.count() > 0


def test_stream_order_status(spark, tmp_dir):
    rnd = random.Random(3)
    rows, t = [], 1_558_430_000
    for oid in range(60):
        t += rnd.randrange(0, 200)
        kinds = rnd.choice([["create", "pay"], ["create"], ["pay"], ["create", "pay"]])
        for j, k in enumerate(kinds):
            rows.append((oid, k, "" if k == "create" else f"t{oid}", t + j * rnd.choice([5, 600, 1200])))
    rows.sort(key=lambda r: r[3])
    root = _write_files(os.path.join(tmp_dir, "ord"), rows + [(10**6, "create", "", SENTINEL)], 20)
    got = _run(spark, stream.order_pay_status(readers.stream_records(spark, root, "order", max_files=1)), "s_ord")
    b = readers.read_records(spark, root, "order", seq="hash").where(f"ts_us < {SENTINEL}000000")
    assert tuples(got) == tuples(batch.order_pay_status(b), ["order_id", "result"])


def test_stream_login_bursts(spark, tmp_dir):
    rnd = random.Random(4)
    rows, t = [], 1_558_430_800
    for _ in range(300):
        t += rnd.randrange(0, 2)
        rows.append((rnd.randrange(1, 5), "1.1.1.1", "fail" if rnd.random() < 0.7 else "success", t))
    root = _write_files(os.path.join(tmp_dir, "login"), rows + [(0, "0", "success", SENTINEL)], 25)
    got = _run(spark, stream.login_fail_bursts(readers.stream_records(spark, root, "login", max_files=1),
                                               "2 seconds", 2, delay="0 seconds"), "s_login")
    b = readers.read_records(spark, root, "login", seq="hash").where(f"ts_us < {SENTINEL}000000")
    cols = ["user_id", "first_fail_ms", "last_fail_ms", "fail_count", "msg"]
    assert tuples(got, cols) == tuples(batch.login_fail_burst(b, "2 seconds"), cols)


def _login_rows(seed, n=300, min_step=0):
    rnd = random.Random(seed)
    rows, t = [], 1_558_430_800
    for _ in range(n):
        t += rnd.randrange(min_step, 3)
        rows.append((rnd.randrange(1, 5), "1.1.1.1", "fail" if rnd.random() < 0.7 else "success", t))
    return rows


def _shuffle_within(rows, per_file, seed):
    rnd = random.Random(seed)
    out = []
    for i in range(0, len(rows), per_file):
        part = rows[i:i + per_file]
        rnd.shuffle(part)
        out.extend(part)
    return out


def test_stream_login_pattern_buffers_until_watermark(spark, tmp_dir):
    rows = _login_rows(11)
    root = _write_files(os.path.join(tmp_dir, "lp"), _shuffle_within(rows, 25, 1) + [(0, "0", "success", SENTINEL)], 25)
    got = _run(spark, stream.login_fail_pattern(readers.stream_records(spark, root, "login", max_files=1),
                                                "2 seconds", delay="0 seconds"), "s_lp")
    b = readers.read_records(spark, root, "login", seq="hash").where(f"ts_us < {SENTINEL}000000")
    cols = ["user_id", "first_fail_ms", "last_fail_ms", "msg"]
    exp = tuples(batch.login_fail_pattern(b, "2 seconds"), cols)
    assert tuples(got, cols) == exp and len(exp) > 5


def test_stream_login_consecutive(spark, tmp_dir):
    # arrival order = time order only without ties across files, so time strictly increases
    rows = _login_rows(12, min_step=1)
    root = _write_files(os.path.join(tmp_dir, "lc"), rows, 25)
    got = _run(spark, stream.login_fail_consecutive(readers.stream_records(spark, root, "login", max_files=1),
                                                    "2 seconds"), "s_lc")
    b = readers.read_records(spark, root, "login", seq="hash")
    cols = ["user_id", "first_fail_ms", "last_fail_ms", "msg"]
    exp = tuples(batch.login_fail_consecutive(b, "2 seconds", order=("ts_us", "seq")), cols)
    assert tuples(got, cols) == exp and len(exp) > 5


def test_stream_order_pattern(spark, tmp_dir):
    rnd = random.Random(21)
    rows, t = [], 1_558_430_000
    for _ in range(200):
        t += rnd.randrange(0, 60)
        rows.append((rnd.randrange(0, 25), rnd.choice(["create", "create", "pay"]), "", t))
    root = _write_files(os.path.join(tmp_dir, "op"), _shuffle_within(rows, 20, 2) + [(10**6, "pay", "x", SENTINEL)], 20)
    got = _run(spark, stream.order_timeout_pattern(readers.stream_records(spark, root, "order", max_files=1),
                                                   "15 minutes"), "s_op")
    b = readers.read_records(spark, root, "order", seq="hash").where(f"ts_us < {SENTINEL}000000")
    paid, timeouts = batch.order_timeout_pattern(b, "15 minutes")
    assert tuples(got.where("pay_ms IS NOT NULL"), ["order_id", "create_ms", "pay_ms"]) == \
        tuples(paid, ["order_id", "create_ms", "pay_ms"])
    assert tuples(got.where("pay_ms IS NULL"), ["order_id", "result"]) == tuples(timeouts, ["order_id", "result"])
    assert timeouts.count() > 0 and paid.count() > 0


def test_stream_click_limit(spark, tmp_dir):
    rnd = random.Random(31)
    rows, t = [], 1_511_658_000
    for _ in range(300):
        t += rnd.randrange(0, 900)
        rows.append((rnd.randrange(1, 4), rnd.randrange(1, 3), rnd.choice(["beijing", "shanghai"]), "c", t))
    root = _write_files(os.path.join(tmp_dir, "ad"), rows, 30)
    got = _run(spark, stream.click_limit(readers.stream_records(spark, root, "ad_click", max_files=1), 5), "s_ad")
    b = readers.read_records(spark, root, "ad_click", seq="hash")
    from tidepool.operators.keyed import click_limit
    passed, warnings = click_limit(b, ["user_id", "ad_id"], 5)
    assert tuples(got.where("kind = 'pass'"), ["user_id", "ad_id", "ts_ms"]) == \
        sorted((r["user_id"], r["ad_id"], r["ts_us"] // 1000) for r in passed.collect())
    assert tuples(got.where("kind = 'warn'"), ["user_id", "ad_id", "day", "ts_ms", "msg"]) == \
        tuples(warnings, ["user_id", "ad_id", "day", "ts_ms", "msg"])
    assert warnings.count() > 0


def test_labelled_sink_and_lateness_update_mode(spark, tmp_dir):
    from tidepool.sources import sinks
    lines = [f"10.0.0.1 - - 17/05/2015:10:0{m}:0{s} +0000 GET /p/{m % 2}" for m in range(3) for s in range(3)]
    # one late line, 70 s behind the newest: past the 1 s delay but within delay + 1 min lateness
    lines.append("10.0.0.1 - - 17/05/2015:10:01:00 +0000 GET /p/1")
    root = os.path.join(tmp_dir, "weblog")
    os.makedirs(root)
    for i, chunk in enumerate([lines[:9], lines[9:]]):
        p = os.path.join(root, f"part-{i}.txt")
        with open(p, "w") as f:
            f.write("\n".join(chunk))
        os.utime(p, (1_600_000_000 + i, 1_600_000_000 + i))
    raw = spark.readStream.option("maxFilesPerTrigger", 1).text(root)
    log = readers.parse_web_log(raw)
    counts = stream.page_counts_with_lateness(log, "10 minutes", "5 seconds", "1 second", "1 minute")
    q = sinks.start_labelled(counts, "count result", output_mode="update", trigger={"availableNow": True})
    q.awaitTermination(120)
    res = spark.table("count_result")
    # the late line revised windows of /p/1 that were already emitted
    ends = res.where("url = '/p/1'").groupBy("window_end").count().where("count > 1").count()
    assert ends > 0


def test_stream_tx_full_outer_keeps_unmatched(spark, tmp_dir):
    orders = [(1, "pay", "a", 100), (2, "pay", "b", 100)]
    receipts = [("a", "wechat", 103), ("c", "alipay", 104)]
    o_root = _write_files(os.path.join(tmp_dir, "o2"), orders + [(9, "pay", "sentinel", SENTINEL)], 10)
    r_root = _write_files(os.path.join(tmp_dir, "r2"), receipts + [("sentinel", "x", SENTINEL)], 10)
    j = stream.tx_match(readers.stream_records(spark, o_root, "order"), readers.stream_records(spark, r_root, "receipt"),
                        how="full_outer")
    got = _run(spark, j, "s_tx_outer").where("tx_id != 'sentinel'")
    rows = tuples(got, ["tx_id", "pay_ms", "receipt_ms"])
    assert rows == [("a", 100_000, 103_000), ("b", 100_000, None), ("c", None, 104_000)]


def test_stream_uv_estimate_update_mode(spark, tmp_dir, behaviour_rows):
    root = _write_files(os.path.join(tmp_dir, "ub3"), behaviour_rows)
    q = (stream.unique_visitors_approx(readers.stream_records(spark, root, "user_behavior", max_files=1))
               .writeStream.format("memory").queryName("s_uv_est").outputMode("update")
               .trigger(availableNow=True).start())
    q.awaitTermination(120)
    est = spark.table("s_uv_est").groupBy("window_end").agg({"uv": "max"}).collect()
    exact = dict(tuples(batch.unique_visitors(readers.read_records(spark, root, "user_behavior")),
                        ["window_end", "uv"]))
    assert {r[0] for r in est} == set(exact)
    assert all(abs(r[1] - exact[r[0]]) <= 1 for r in est)


def test_stream_hot_items_per_batch_ranking(spark, tmp_dir, behaviour_rows):
    root = _write_files(os.path.join(tmp_dir, "ub4"), behaviour_rows + [(0, 0, 0, "pv", SENTINEL)])
    out = os.path.join(tmp_dir, "top_out")
    w = stream.hot_items_writer(readers.stream_records(spark, root, "user_behavior", max_files=1),
                                lambda df, epoch: df.write.mode("append").parquet(out), n=3)
    q = w.option("checkpointLocation", os.path.join(tmp_dir, "ck_top")).trigger(availableNow=True).start()
    q.awaitTermination(240)
    b = readers.read_records(spark, root, "user_behavior", seq="hash").where(f"ts_us < {SENTINEL}000000")
    cols = ["window_end", "rnk", "item_id", "cnt"]
    assert tuples(spark.read.parquet(out), cols) == tuples(batch.hot_items(b, 3), cols)


def _expand(segments, keys, slide_ms):
    out = {}
    for r in segments:
        for e in range(r["end_from"], r["end_to"], slide_ms):
            k = (*[r[c] for c in keys], e)
            assert k not in out  # every window end is emitted once
            out[k] = r["cnt"]
    return out


def test_stream_fine_sliding_counts(spark, tmp_dir):
    from tidepool.operators.windows import sliding_count
    rnd = random.Random(17)
    rows, t = [], 1_558_400_000_000
    for _ in range(240):
        t += rnd.randrange(0, 60_000)
        rows.append((f"u{rnd.randrange(9)}", rnd.choice(["view", "download"]), rnd.choice(["weibo", "wechat"]), t))
    root = _write_files(os.path.join(tmp_dir, "mk"), rows + [("s", "view", "sentinel", SENTINEL * 1000)], 30)
    out = os.path.join(tmp_dir, "mk_out")
    w = stream.sliding_count_writer(readers.stream_records(spark, root, "market", max_files=1), ["channel"],
                                    "1 hour", "5 seconds", os.path.join(tmp_dir, "mk_state"),
                                    lambda df, epoch: df.write.mode("append").parquet(out))
    q = w.option("checkpointLocation", os.path.join(tmp_dir, "ck_mk")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    got = _expand(spark.read.parquet(out).collect(), ["channel"], 5000)
    b = readers.read_records(spark, root, "market").where(f"ts_us < {SENTINEL}000000")
    exp = _expand(sliding_count(b, ["channel"], "1 hour", "5 seconds").collect(), ["channel"], 5000)
    assert got == exp and len(exp) > 1000


def test_stream_hot_pages(spark, tmp_dir):
    rnd = random.Random(23)
    t, lines = 1431856800, []
    for _ in range(200):
        t += rnd.randrange(0, 20)
        hh, rest = divmod(t - 1431820800, 3600)
        mm, ss = divmod(rest, 60)
        lines.append(f"10.0.0.{rnd.randrange(9)} - - 17/05/2015:{hh:02d}:{mm:02d}:{ss:02d} +0000 "
                     f"{rnd.choice(['GET', 'GET', 'POST'])} /p/{rnd.randrange(6)}")
    lines.append("10.0.0.1 - - 17/05/2016:00:00:00 +0000 GET /sentinel")  # a year later: closes everything
    root = os.path.join(tmp_dir, "weblog2")
    os.makedirs(root)
    for i in range(0, len(lines), 25):
        p = os.path.join(root, f"part-{i:05d}.txt")
        with open(p, "w") as f:
            f.write("\n".join(lines[i:i + 25]))
        os.utime(p, (1_600_000_000 + i, 1_600_000_000 + i))
    out = os.path.join(tmp_dir, "hp_out")
    log = readers.parse_web_log(spark.readStream.option("maxFilesPerTrigger", 1).text(root))
    w = stream.hot_pages_writer(log, lambda df, epoch: df.write.mode("append").parquet(out),
                                os.path.join(tmp_dir, "hp_state"))
    q = w.option("checkpointLocation", os.path.join(tmp_dir, "ck_hp")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    blog = readers.read_web_log(spark, root).where("url != '/sentinel'")
    cols = ["window_end", "rnk", "url", "cnt"]
    exp = tuples(batch.hot_pages(blog, 3), cols)
    assert tuples(spark.read.parquet(out), cols) == exp and len(exp) > 100


def test_stream_ad_clicks_pipeline(spark, tmp_dir):
    rnd = random.Random(29)
    rows, t = [], 1_511_658_000
    for _ in range(300):
        t += rnd.randrange(0, 120)
        rows.append((rnd.randrange(1, 4), rnd.randrange(1, 3), rnd.choice(["beijing", "shanghai"]), "c", t))
    root = _write_files(os.path.join(tmp_dir, "ad2"), rows + [(0, 0, "sentinel", "c", SENTINEL)], 30)
    out = os.path.join(tmp_dir, "ad_out")
    passed = os.path.join(tmp_dir, "ad_passed")
    q = (stream.passed_clicks(readers.stream_records(spark, root, "ad_click", max_files=1), limit=20).writeStream.format("parquet")
         .option("path", passed).option("checkpointLocation", os.path.join(tmp_dir, "ck_pass")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    source = spark.readStream.schema(spark.read.parquet(passed).schema).option("maxFilesPerTrigger", 4).parquet(passed)
    w = stream.province_counts_writer(source, lambda df, epoch: df.write.mode("append").parquet(out),
                                      os.path.join(tmp_dir, "ad_state"), size="2 hours", delay="1 hour")
    q = w.option("checkpointLocation", os.path.join(tmp_dir, "ck_ad")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    got = _expand(spark.read.parquet(out).collect(), ["province"], 5000)
    b = readers.read_records(spark, root, "ad_click", seq="hash").where(f"ts_us < {SENTINEL}000000")
    counts, warnings = batch.ad_clicks(b, limit=20, size="2 hours")
    exp = _expand(counts.collect(), ["province"], 5000)
    assert got == exp and warnings.count() > 0


def test_stream_late_rows_go_to_side_output(spark, tmp_dir):
    day = "17/05/2015"
    batches = [[f"10.0.0.1 - - {day}:10:00:0{s} +0000 GET /a" for s in range(5)],
               [f"10.0.0.1 - - {day}:10:30:00 +0000 GET /b"],                 # watermark -> 10:29:59 - 1 min
               [f"10.0.0.1 - - {day}:10:00:07 +0000 GET /a",                  # newest window ends 10:10:10: late
                f"10.0.0.1 - - {day}:10:25:00 +0000 GET /c"],                 # still open
               [f"10.0.0.1 - - 17/05/2016:00:00:00 +0000 GET /sentinel"]]
    root = os.path.join(tmp_dir, "weblog3")
    os.makedirs(root)
    for i, b in enumerate(batches):
        p = os.path.join(root, f"part-{i}.txt")
        with open(p, "w") as f:
            f.write("\n".join(b))
        os.utime(p, (1_600_000_000 + i, 1_600_000_000 + i))
    out, late = os.path.join(tmp_dir, "hp3_out"), os.path.join(tmp_dir, "hp3_late")
    log = readers.parse_web_log(spark.readStream.option("maxFilesPerTrigger", 1).text(root))
    w = stream.hot_pages_writer(log, lambda df, e: df.write.mode("append").parquet(out), os.path.join(tmp_dir, "hp3"))
    q = w.option("checkpointLocation", os.path.join(tmp_dir, "ck_hp3")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    q = (stream.late_rows(log).writeStream.format("parquet").option("path", late)
         .option("checkpointLocation", os.path.join(tmp_dir, "ck_late3")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert tuples(spark.read.parquet(late), ["url", "ts_us"]) == [("/a", 1431856807 * 1_000_000)]
    counts = spark.read.parquet(out)
    assert counts.where("url = '/a'").agg({"cnt": "max"}).first()[0] == 5   # the late row is not counted
    assert counts.where("url = '/c'").count() > 0


def test_stream_top_n_retract_changelog(spark, tmp_dir, behaviour_rows):
    root = _write_files(os.path.join(tmp_dir, "ub5"), behaviour_rows, 40)
    out = os.path.join(tmp_dir, "chg_out")
    w = stream.hot_items_changelog_writer(readers.stream_records(spark, root, "user_behavior", max_files=1),
                                          lambda df, e: df.write.mode("append").parquet(out),
                                          os.path.join(tmp_dir, "chg_state"), n=3, delay="2 hours")
    q = w.option("checkpointLocation", os.path.join(tmp_dir, "ck_chg")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    changes = spark.read.parquet(out).collect()
    net = {}
    for r in changes:
        k = (r["window_end"], r["item_id"], r["cnt"], r["row_num"])
        net[k] = net.get(k, 0) + (1 if r["is_add"] else -1)
    final = sorted(k for k, v in net.items() for _ in range(v))
    assert all(v >= 0 for v in net.values())
    b = readers.read_records(spark, root, "user_behavior", seq="hash")
    assert final == tuples(batch.hot_items_sql(spark, b, 3), ["window_end", "item_id", "cnt", "row_num"])
    assert any(not r["is_add"] for r in changes)  # counts grew across micro-batches: ranks were retracted


def test_stream_hot_pages_fire_early_and_revise(spark, tmp_dir):
    rnd = random.Random(37)
    t, lines = 1431856800, []
    for _ in range(120):
        t += rnd.randrange(0, 30)
        hh, rest = divmod(t - 1431820800, 3600)
        mm, ss = divmod(rest, 60)
        lines.append(f"10.0.0.1 - - 17/05/2015:{hh:02d}:{mm:02d}:{ss:02d} +0000 GET /p/{rnd.randrange(4)}")
    root = os.path.join(tmp_dir, "weblog4")
    os.makedirs(root)
    for i in range(0, len(lines), 20):
        p = os.path.join(root, f"part-{i:05d}.txt")
        with open(p, "w") as f:
            f.write("\n".join(lines[i:i + 20]))
        os.utime(p, (1_600_000_000 + i, 1_600_000_000 + i))
    out = os.path.join(tmp_dir, "hp4_out")
    log = readers.parse_web_log(spark.readStream.option("maxFilesPerTrigger", 1).text(root))
    w = stream.hot_pages_changelog_writer(log, lambda df, e: df.write.mode("append").parquet(out),
                                          os.path.join(tmp_dir, "hp4_state"))
    q = w.option("checkpointLocation", os.path.join(tmp_dir, "ck_hp4")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    net = {}
    for r in spark.read.parquet(out).collect():
        k = (r["window_end"], r["row_num"], r["url"], r["cnt"])
        net[k] = net.get(k, 0) + (1 if r["is_add"] else -1)
    final = sorted(k for k, v in net.items() for _ in range(v))
    exp = tuples(batch.hot_pages(readers.read_web_log(spark, root), 3), ["window_end", "rnk", "url", "cnt"])
    assert final == exp and len(exp) > 100


def _login_disorder(seed, n=240, delay=3):
    """Rows whose arrival is up to ``delay`` seconds behind their time, across micro-batches."""
    rnd = random.Random(seed)
    rows = _login_rows(seed, n, min_step=0)
    return [r for _, r in sorted(((r[3] + rnd.random() * delay, r) for r in rows), key=lambda x: x[0])]


@pytest.mark.parametrize("arrow_rows", [10_000, 2])
def test_stream_rules_with_disorder_and_small_frames(spark, tmp_dir, arrow_rows):
    rows = _login_disorder(51)
    root = _write_files(os.path.join(tmp_dir, "dis"), rows + [(0, "0", "success", SENTINEL)], 7)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(arrow_rows))
    try:
        src = lambda: readers.stream_records(spark, root, "login", max_files=4)
        bursts = tuples(_run(spark, stream.login_fail_bursts(src(), "2 seconds", 2), f"s_dis_b{arrow_rows}"))
        pairs = tuples(_run(spark, stream.login_fail_pattern(src(), "2 seconds"), f"s_dis_p{arrow_rows}"))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    b = readers.read_records(spark, root, "login", seq="hash").where(f"ts_us < {SENTINEL}000000")
    assert bursts == tuples(batch.login_fail_burst(b, "2 seconds")) and len(bursts) > 5
    assert pairs == tuples(batch.login_fail_pattern(b, "2 seconds")) and len(pairs) > 5


@pytest.mark.parametrize("arrow_rows", [10_000, 2])
def test_stream_late_clicks_over_midnight(spark, tmp_dir, arrow_rows):
    midnight = 1_511_712_000  # 0:00 of a day in Asia/Shanghai
    rows = [(1, 9, "p", "c", midnight + d) for d in (-30, -20, 10, -10, 20, 30, -5)]  # two late ones among the next day's
    root = _write_files(os.path.join(tmp_dir, f"mid{arrow_rows}"), rows, 2)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(arrow_rows))
    try:
        got = _run(spark, stream.click_limit(readers.stream_records(spark, root, "ad_click", max_files=1), 1), f"s_mid{arrow_rows}").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    per = {(k, d): sum(1 for r in got if r.kind == k and r.day == d) for k in ("pass", "warn") for d in {r.day for r in got}}
    assert len(per) == 4 and set(per.values()) == {1}


def test_stream_unreadable_state_raises(spark, tmp_dir):
    root = _write_files(os.path.join(tmp_dir, "lost"), [("u", "view", "weibo", 1_558_400_000_000 + i * 7000) for i in range(40)], 10)
    state = os.path.join(tmp_dir, "lost_state")
    calls = []

    def writer():
        return stream.sliding_count_writer(readers.stream_records(spark, root, "market", max_files=1), ["channel"], "1 hour", "5 seconds",
                                           state, lambda df, e: calls.append(df.count()))

    w = writer().option("checkpointLocation", os.path.join(tmp_dir, "ck_lost"))
    w.trigger(availableNow=True).start().awaitTermination(200)
    assert calls
    for folder, _, files in os.walk(state):  # an earlier epoch's table is damaged
        for f in files:
            if f.endswith(".parquet"):
                with open(os.path.join(folder, f), "wb") as out:
                    out.write(b"not parquet")
    _write_files(root, [("u", "view", "weibo", 1_558_400_900_000)] * 50, 60)
    os.utime(os.path.join(root, "part-00000.csv"), (1_700_000_000, 1_700_000_000))
    os.rename(os.path.join(root, "part-00000.csv"), os.path.join(root, "part-99999.csv"))
    with pytest.raises(Exception):
        writer().option("checkpointLocation", os.path.join(tmp_dir, "ck_lost")).trigger(availableNow=True).start().awaitTermination(200)


def test_stream_subsecond_bounds(spark, tmp_dir):
    orders = [(1, "pay", "a", 100), (2, "pay", "b", 100)]
    receipts = [("a", "wechat", 100), ("b", "alipay", 101)]
    o_root = _write_files(os.path.join(tmp_dir, "o3"), orders, 10)
    r_root = _write_files(os.path.join(tmp_dir, "r3"), receipts, 10)
    j = stream.tx_match(readers.stream_records(spark, o_root, "order"), readers.stream_records(spark, r_root, "receipt"), "-500 ms", "999 ms")
    assert tuples(_run(spark, j, "s_tx_sub"), ["tx_id", "order_id", "pay_channel"]) == [("a", 1, "wechat")]


def test_stream_post_lines_advance_the_watermark(spark, tmp_dir):
    root = os.path.join(tmp_dir, "post")
    os.makedirs(root)
    for i, line in enumerate(["10:00:00 +0000 GET /a", "11:00:00 +0000 POST /b", "11:00:05 +0000 POST /b"]):
        p = os.path.join(root, f"part-{i}.txt")
        with open(p, "w") as f:
            f.write(f"10.0.0.1 - - 17/05/2015:{line}")
        os.utime(p, (1_600_000_000 + i, 1_600_000_000 + i))
    log = readers.parse_web_log(spark.readStream.option("maxFilesPerTrigger", 1).text(root))
    out = os.path.join(tmp_dir, "post_out")
    w = stream.hot_pages_writer(log, lambda df, e: df.write.mode("append").parquet(out), os.path.join(tmp_dir, "post_state"))
    w.option("checkpointLocation", os.path.join(tmp_dir, "ck_post")).trigger(availableNow=True).start().awaitTermination(200)
    assert spark.read.parquet(out).where("url = '/a'").count() == 120  # all windows of the GET line closed by POST lines

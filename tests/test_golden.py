"""Golden cases in the reference's own settings (2 s login window, 15 min
order limit, -3 s / +5 s receipts, 100 clicks a day), on a few hand-typed
rows shaped like its sample logs. Times in the files are epoch seconds."""

import os

from helpers import tuples
from tidepool.plans import jobs
from tidepool.sources import readers

T0 = 1558430840


def _csv(tmp_dir, name, rows):
    path = os.path.join(tmp_dir, name)
    with open(path, "w") as f:
        f.write("\n".join(",".join(str(v) for v in r) for r in rows))
    return path


def test_login_jobs(spark, tmp_dir):
    rows = [(5402, "83.149.11.115", "success", T0 - 25),
            (1035, "83.149.9.216", "fail", T0 + 2), (1035, "83.149.9.216", "fail", T0 + 3),
            (1035, "83.149.9.216", "fail", T0 + 4),
            (23064, "66.249.3.15", "fail", T0 + 5), (23064, "66.249.3.15", "success", T0 + 6),
            (1035, "83.149.24.26", "success", T0 + 10)]
    df = readers.read_records(spark, _csv(tmp_dir, "login.csv", rows), "login")
    burst = jobs.login_fail_burst(df, "2 seconds")
    assert tuples(burst) == [(1035, (T0 + 2) * 1000, (T0 + 4) * 1000, 3, "login fail in 2s for 3 times. ")]
    pairs = [(1035, (T0 + 2) * 1000, (T0 + 3) * 1000), (1035, (T0 + 3) * 1000, (T0 + 4) * 1000)]
    assert tuples(jobs.login_fail_consecutive(df, "2 seconds"), ["user_id", "first_fail_ms", "last_fail_ms"]) == pairs
    assert tuples(jobs.login_fail_pattern(df, "2 seconds"), ["user_id", "first_fail_ms", "last_fail_ms"]) == pairs


def test_order_jobs(spark, tmp_dir):
    rows = [(34729, "create", "", T0 + 2), (34729, "pay", "sd76f87d6", T0 + 4),
            (34756, "create", "", T0), (34756, "pay", "3hu3k2432", T0 + 1038),
            (34767, "create", "", T0 + 1), (34767, "pay", "3243hr9h9", T0 + 1073),
            (34768, "pay", "329d09f9f", T0 + 200),
            (34747, "create", "", T0 + 30), (34747, "pay", "ewr342as4", T0 + 30)]
    df = readers.read_records(spark, _csv(tmp_dir, "orders.csv", rows), "order")
    assert tuples(jobs.order_pay_status(df, "15 minutes")) == [
        (34729, "payed successfully"), (34747, "payed successfully"), (34756, "payed but already timeout"),
        (34767, "payed but already timeout"), (34768, "payed but not found create log")]
    paid, timeouts = jobs.order_timeout_pattern(df, "15 minutes")
    assert tuples(paid, ["order_id"]) == [(34729,), (34747,)]
    assert tuples(timeouts) == [(34756, f"timeout : +{(T0 + 900) * 1000}"),
                                (34767, f"timeout : +{(T0 + 901) * 1000}")]


def test_payment_match(spark, tmp_dir):
    orders = [(1, "pay", "sd76f87d6", T0 + 4), (2, "pay", "3hu3k2432", T0 + 5), (3, "pay", "3243hr9h9", T0 + 20),
              (4, "pay", "329d09f9f", T0 + 30), (5, "pay", "ewr342as4", T0 + 40), (6, "create", "", T0)]
    receipts = [("sd76f87d6", "wechat", T0 + 7), ("3hu3k2432", "alipay", T0 + 8),
                ("3243hr9h9", "wechat", T0 + 17), ("329d09f9f", "alipay", T0 + 30),
                ("8fdsfae83", "alipay", T0 + 50)]
    o = readers.read_records(spark, _csv(tmp_dir, "o.csv", orders), "order")
    r = readers.read_records(spark, _csv(tmp_dir, "r.csv", receipts), "receipt")
    matched, lonely_pays, lonely_receipts = jobs.tx_match(o, r)
    assert tuples(matched, ["tx_id"]) == [("3243hr9h9",), ("329d09f9f",), ("3hu3k2432",), ("sd76f87d6",)]
    assert tuples(lonely_pays, ["tx_id"]) == [("ewr342as4",)]
    assert tuples(lonely_receipts, ["tx_id"]) == [("8fdsfae83",)]
    assert tuples(jobs.tx_match_join(o, r), ["tx_id"]) == tuples(matched, ["tx_id"])


def test_ad_blacklist(spark, tmp_dir):
    rows = [(937166, 1715, "beijing", "beijing", 1511658000 + 30 * i) for i in range(121)]
    rows += [(543462, 1715, "guangdong", "guangzhou", 1511658000 + 7), (543462, 1715, "guangdong", "shenzhen", 1511658100)]
    df = readers.read_records(spark, _csv(tmp_dir, "ad.csv", rows), "ad_click")
    counts, warnings = jobs.ad_clicks(df, limit=100, expand=True)
    assert tuples(warnings, ["user_id", "ad_id", "ts_ms", "msg"]) == [
        (937166, 1715, (1511658000 + 30 * 100) * 1000, "Click ad over 100 times today.")]
    # the last window holding every passed click counts 100 for beijing and 2 for guangdong
    best = {p: max(c for (pp, c) in tuples(counts, ["province", "cnt"]) if pp == p) for p in ("beijing", "guangdong")}
    assert best == {"beijing": 100, "guangdong": 2}


def test_command_line_runner(spark, tmp_dir):
    from tidepool.plans import run
    rows = [(1035, "83.149.9.216", "fail", T0 + 2), (1035, "83.149.9.216", "fail", T0 + 3)]
    src = _csv(tmp_dir, "login2.csv", rows)
    out = os.path.join(tmp_dir, "out")
    run.main(["login-fail-cep", src, "--out", out])
    assert tuples(spark.read.parquet(os.path.join(out, "warning")), ["user_id", "first_fail_ms"]) == \
        [(1035, (T0 + 2) * 1000)]


def test_window_text_in_reference_layout(spark, tmp_dir):
    rows = [("u1", "view", "weibo", 1558430842123)]
    df = readers.read_records(spark, _csv(tmp_dir, "m.csv", rows), "market")
    got = jobs.market_by_channel(df, size="10 seconds", slide="5 seconds", expand=True, text_zone="Asia/Shanghai")
    assert tuples(got, ["window_start_text", "window_end_text", "cnt"]) == [
        ("2019-05-21 17:27:15.0", "2019-05-21 17:27:25.0", 1), ("2019-05-21 17:27:20.0", "2019-05-21 17:27:30.0", 1)]


def test_every_cli_job_runs(spark, tmp_dir):
    from tidepool.plans import run
    ub = _csv(tmp_dir, "ub.csv", [(1, 10, 1, "pv", T0), (2, 10, 1, "pv", T0 + 5), (2, 11, 1, "cart", T0 + 9)])
    ad = _csv(tmp_dir, "ad.csv", [(1, 5, "beijing", "beijing", T0), (1, 5, "beijing", "beijing", T0 + 1)])
    mk = _csv(tmp_dir, "mk.csv", [("u1", "view", "weibo", T0 * 1000), ("u2", "install", "wechat", T0 * 1000 + 7)])
    lg = _csv(tmp_dir, "lg.csv", [(1, "1.1.1.1", "fail", T0), (1, "1.1.1.1", "fail", T0 + 1)])
    od = _csv(tmp_dir, "od.csv", [(7, "create", "", T0), (7, "pay", "t7", T0 + 3)])
    rc = _csv(tmp_dir, "rc.csv", [("t7", "wechat", T0 + 4)])
    web = os.path.join(tmp_dir, "web.log")
    with open(web, "w") as f:
        f.write("83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /a\n83.149.9.216 - - 17/05/2015:10:05:04 +0000 GET /b")
    inputs = {"hot-pages": web, "ad-clicks": ad, "market": mk, "login-fail": lg, "login-fail-advance": lg,
              "login-fail-cep": lg, "order-timeout": od, "order-timeout-without-cep": od, "tx-match": od,
              "tx-match-join": od}
    for job in run.JOBS:
        out = os.path.join(tmp_dir, "cli", job)
        args = [job, inputs.get(job, ub), "--out", out]
        if job.startswith("tx-match"):
            args += ["--receipts", rc]
        run.main(args)
        assert os.listdir(out), job

"""Run a job on record files, as the reference's job mains do.

    python -m tidepool.plans.run hot-items behaviour.csv
    python -m tidepool.plans.run ad-clicks clicks.csv --out /data/out --format parquet
    python -m tidepool.plans.run tx-match orders.csv --receipts receipts.csv

Each output of a job (the reference's main result and its side outputs) is
shown, or written under ``--out/<name>``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.plans import jobs
from tidepool.session import get_session
from tidepool.sources import readers


def _outputs(job: str, spark, a) -> dict[str, DataFrame]:
    rec = lambda kind: readers.read_records(spark, a.input, kind, mode=a.mode)
    if job == "hot-items":
        return {"hot_items": jobs.hot_items_report(rec("user_behavior"), a.top or 5, a.zone)}
    if job == "hot-items-sql":
        return {"hot_items": jobs.hot_items_sql(spark, rec("user_behavior"), a.top or 5)}
    if job == "page-views":
        return {"pv": jobs.page_views(rec("user_behavior"))}
    if job == "page-views-salted":
        return {"pv": jobs.page_views_salted(rec("user_behavior"))}
    if job in ("unique-visitors", "uv-bits", "uv-bitmap", "uv-hll"):
        method = {"unique-visitors": "exact", "uv-bits": "bits", "uv-bitmap": "bitmap", "uv-hll": "hll"}[job]
        return {"uv": jobs.unique_visitors(rec("user_behavior"), method=method)}
    if job == "uv-running":
        return {"uv": jobs.unique_visitors_running(rec("user_behavior"))}
    if job == "hot-pages":
        log = readers.read_web_log(spark, a.input, a.zone, a.mode)
        _, late = jobs.late_pages(log)
        return {"hot_pages": jobs.hot_pages_report(log, a.top or 3, a.zone, drop_late=True), "late": late}
    if job == "ad-clicks":
        counts, warnings = jobs.ad_clicks(rec("ad_click"), a.limit or 100, zone=a.zone, expand=a.expand,
                                          text_zone=a.zone)
        return {"count_result": counts, "warning": warnings}
    if job == "market":
        return {"market": jobs.market_by_channel(rec("market"), expand=a.expand, text_zone=a.zone)}
    if job == "login-fail":
        return {"warning": jobs.login_fail_burst(rec("login"))}
    if job == "login-fail-advance":
        return {"warning": jobs.login_fail_consecutive(rec("login"))}
    if job == "login-fail-cep":
        return {"warning": jobs.login_fail_pattern(rec("login"))}
    if job == "order-timeout":
        paid, timeouts = jobs.order_timeout_pattern(rec("order"))
        return {"payed": paid, "timeout": timeouts}
    if job == "order-timeout-without-cep":
        return {"result": jobs.order_pay_status(rec("order"))}
    if job in ("tx-match", "tx-match-join"):
        rc = readers.read_records(spark, a.receipts, "receipt", mode=a.mode)
        if job == "tx-match-join":
            return {"matched": jobs.tx_match_join(rec("order"), rc)}
        m, up, ur = jobs.tx_match(rec("order"), rc)
        return {"matched": m, "unmatched_pays": up, "unmatched_receipts": ur}
    raise SystemExit(f"unknown job {job!r}")


JOBS = ("hot-items", "hot-items-sql", "page-views", "page-views-salted", "unique-visitors", "uv-bits", "uv-bitmap",
        "uv-hll", "uv-running", "hot-pages", "ad-clicks", "market", "login-fail", "login-fail-advance",
        "login-fail-cep", "order-timeout", "order-timeout-without-cep", "tx-match", "tx-match-join")


def main(argv=None) -> None:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("job", choices=JOBS)
    p.add_argument("input")
    p.add_argument("--receipts", help="receipt log for tx-match jobs")
    p.add_argument("--out", help="folder for outputs; shown on the console when absent")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    p.add_argument("--mode", default="FAILFAST", choices=["FAILFAST", "PERMISSIVE", "DROPMALFORMED"])
    p.add_argument("--zone", help="zone of printed times, UTC if not given (ad clicks: of the day reset, Asia/Shanghai if not given)")
    p.add_argument("--top", type=int)
    p.add_argument("--limit", type=int)
    p.add_argument("--expand", action="store_true", help="one row per sliding window, not change points")
    p.add_argument("--master")
    a = p.parse_args(argv)
    a.zone = a.zone or ("Asia/Shanghai" if a.job == "ad-clicks" else "UTC")
    spark = get_session(a.master, app=f"tidepool {a.job}")
    for name, df in _outputs(a.job, spark, a).items():
        if a.out:
            if a.format == "csv":  # places in the input are structs
                df = df.select(*[F.to_json(c).alias(c) if isinstance(df.schema[c].dataType, T.StructType) else c for c in df.columns])
            df.write.mode("overwrite").format(a.format).save(f"{a.out}/{name}")
        else:
            print(f"== {name}")
            df.show(50, truncate=False)


if __name__ == "__main__":
    main()

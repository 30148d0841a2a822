"""Results do not depend on the session time zone."""

import duckdb

from __spark_entry__ import oracle_sql, queries
from conftest import SF_SMALL
from tidepool.sources.views import TABLES


def test_queries_in_another_session_zone(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        for name in ("hot_items_sql", "hot_items_report", "ad_blacklist", "order_pay_status", "uv_hourly"):
            df = queries()[name](spark, SF_SMALL)
            res = con.execute(oracle_sql()[name])
            cols = [d[0] for d in res.description]
            got = sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())
            idx = [cols.index(c) for c in sorted(cols)]
            exp = sorted(tuple(r[i] for i in idx) for r in res.fetchall())
            assert got == exp, name
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)

"""The streaming daily roll-up equals the batch roll-up on finalized days."""

import duckdb
from pyspark.sql import functions as F

from cartograph.streaming.daily import daily_activity_stream, run_available_now, transactions_stream

SF = "/root/testdata/sf0.001"


def test_stream_matches_batch_on_finalized_days(spark):
    tx = transactions_stream(spark, SF)
    vol, cust = daily_activity_stream(tx, "30 days")
    p1 = run_available_now(vol, "test-vol")
    p2 = run_available_now(cust, "test-cust")
    got = {r["t_dat"]: (r["transaction_count"], r["unique_customers"]) for r in
           spark.read.parquet(p1).join(spark.read.parquet(p2), "t_dat").collect()}
    expect = dict(((d, (n, c)) for d, n, c in duckdb.sql(f"""
        SELECT CAST(o_orderdate AS DATE) d, count(*), count(DISTINCT o_custkey)
        FROM '{SF}/lineitem.parquet' l JOIN '{SF}/orders.parquet' o ON l.l_orderkey = o.o_orderkey
        WHERE o_orderdate < (SELECT max(o_orderdate) - INTERVAL 30 DAY FROM '{SF}/orders.parquet')
        GROUP BY 1""").fetchall()))
    assert got == expect
    assert F is not None

"""Time the five jobs cold, each once in a fresh session, over small CSV sources.

The sources are the customers and orders at ``BENCH_SF_DIR`` (default sf0.001)
as CSV. Prints one JSON line with the seconds of each step.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from pathlib import Path

import pyarrow.csv
import pyarrow.parquet

from loadwarden import LoadConfig, Source, build_session
from loadwarden.plans import (
    analytics_job,
    load_pipeline,
    monitoring_job,
    quality_job,
    show_results,
    unit_test_job,
)

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.001")
CPUS = os.environ.get("BENCH_CPUS", "8")

EXPECTED_COLUMNS = (
    ("c_custkey", "int"),
    ("c_name", "string"),
    ("c_nationkey", "int"),
    ("c_acctbal", "double"),
    ("c_mktsegment", "string"),
    ("o_orderkey", "int"),
    ("o_orderstatus", "string"),
    ("o_totalprice", "double"),
    ("o_orderdate", "timestamp"),
    ("o_orderpriority", "string"),
    ("batch_id", "string"),
    ("load_date", "string"),
)
ANALYTICS = """
    SELECT c_mktsegment, count(*) AS orders, max(o_totalprice) AS largest,
        rank() OVER (ORDER BY count(*) DESC) AS place
    FROM ${db_name}.${table_name} WHERE c_acctbal > 0 GROUP BY c_mktsegment;
    SELECT t.c_custkey, t.o_totalprice
    FROM ${db_name}.${table_name} t
    JOIN (SELECT c_custkey, max(o_totalprice) AS most FROM ${db_name}.${table_name} GROUP BY c_custkey) m
        ON t.c_custkey = m.c_custkey AND t.o_totalprice = m.most
    ORDER BY t.o_totalprice DESC LIMIT 20;
"""


def main() -> None:
    root = tempfile.mkdtemp(prefix="loadwarden-bench-")
    rows = {}
    for name in ("customer", "orders"):
        table = pyarrow.parquet.read_table(f"{SF_DIR}/{name}.parquet")
        rows[name] = table.num_rows
        pyarrow.csv.write_csv(table, f"{root}/{name}.csv")
    config = LoadConfig(
        left=Source(f"{root}/customer.csv"),
        right=Source(f"{root}/orders.csv", rename={"o_custkey": "c_custkey"}),
        join_on=["c_custkey"],
        database="loadwarden_bench",
        table="customer_orders",
        target_path=f"{root}/customer_orders",
        results_path=f"{root}/monitoring",
        ledger_path=f"{root}/monitoring/load_status",
        key_columns=["o_orderkey"],
        expected_columns=EXPECTED_COLUMNS,
    )
    seconds = {}

    def step(name, action):
        start = time.perf_counter()
        result = action()
        seconds[name] = round(time.perf_counter() - start, 3)
        return result

    conf = {"spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false"}
    spark = step("session", lambda: build_session("jobs", master=f"local[{CPUS}]", conf=conf))
    spark.sparkContext.setLogLevel("ERROR")
    step("load", lambda: load_pipeline(spark, config))
    step("analytics", lambda: show_results(analytics_job(spark, config, ANALYTICS)))
    step("unit_test", lambda: unit_test_job(spark, config))
    step("quality", lambda: quality_job(spark, config))
    step("monitor", lambda: monitoring_job(spark, config).collect())
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "cold_jobs", "value": total, "rows": rows, "seconds": seconds}))


if __name__ == "__main__":
    main()

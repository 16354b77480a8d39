"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. Each query runs to the
end into the no-op sink. One untimed query starts the JVM's code paths; the stored silver and gold tables that later
queries read are built once each and timed as `store_<table>`.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bizpulse.session import build_session  # noqa: E402
from checks import catalog  # noqa: E402

HEADLINE = [
    "silver_business", "silver_user", "silver_review", "silver_checkin", "silver_tip", "silver_date_slice",
    "popularity_inputs", "business_popularity", "business_popularity_all_months",
    "fact_review_tip_daily", "fact_review_tip_monthly", "fact_all_days",
    "partition_overwrite", "upsert_by_key", "upsert_unpartitioned", "replace_slice", "checked_write",
    "top_businesses_by_city", "latest_review_metrics", "monthly_business_summary", "monthly_trend", "review_growth",
    "top_cities", "city_comparison", "city_dashboard", "city_time_series",
    "dq_duplicate_keys", "dq_missing_fields", "dq_constraint_violations", "table_row_counts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {
        "spark__ui__enabled": "false",
        "spark__ui__showConsoleProgress": "false",
        "spark__sql__shuffle__partitions": cpus,
        "spark__driver__memory": "16g",
    }
    spark = build_session("bench", master=f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()

    def finish(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    finish(queries["silver_user"](spark, sf_dir))
    seconds: dict[str, float] = {}
    for table in ("business", "user", "review", "checkin", "tip", "fact", "popularity"):
        began = time.perf_counter()
        catalog.stored(spark, sf_dir, table)
        seconds[f"store_{table}"] = round(time.perf_counter() - began, 3)
    began = time.perf_counter()
    catalog.monthly_gold(spark, sf_dir)
    seconds["store_monthly"] = round(time.perf_counter() - began, 3)
    for name in HEADLINE:
        began = time.perf_counter()
        finish(queries[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - began, 3)

    scale = re.search(r"sf([0-9.]+)", sf_dir)
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else sf_dir,
    }
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()

"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR``: folder of the tables; ``BENCH_CPUS``: cores; ``BENCH_RUNS``: timed runs
per query after one warm run (the median counts); ``BENCH_ALL=1``: every query.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog.queries import CATALOG  # noqa: E402
from txlens.session import build_session  # noqa: E402

HEADLINE = (
    "cleaning_report", "cleaned_lines", "featured_lines", "revenue_by_country",
    "product_summary", "top_products", "headline_kpis", "revenue_delta", "daily_revenue",
    "weekday_hour_heatmap", "customer_rfm", "customer_segments", "customer_behavior",
    "customer_features", "frequency_encoding", "anomaly_summary", "anomaly_rate_by_country",
    "daily_returns", "total_price_histogram", "price_box_summary", "numeric_description",
    "column_profile", "correlation_matrix", "sampled_transactions", "positional_join",
    "pinned_forest_scores", "isolation_forest_lines",
)


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = list(CATALOG) if os.environ.get("BENCH_ALL") else HEADLINE
    spark = build_session("bench", f"local[{cores}]", **{
        "spark.sql.shuffle.partitions": str(cores), "spark.driver.memory": "8g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            CATALOG[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total warm wall-clock of the headline queries",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

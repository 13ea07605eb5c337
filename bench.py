"""Time the headline queries and print one JSON line.

Every query runs once to warm up, then ``BENCH_REPEATS`` times; the median
counts. Results go to the no-op sink, so all rows and columns are produced.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cardlens.session import session_builder  # noqa: E402
from checks.queries import QUERIES  # noqa: E402

HEADLINE = (
    "score_transactions",
    "score_transactions_stored_inputs",
    "run_daily_batch",
    "risk_level_distribution",
    "rule_precision",
    "daily_fraud_breakdown",
    "fraud_hotspots",
    "fraud_hotspots_all_txns",
    "overall_alignment",
    "risk_fraud_crosstab",
    "card_stats_per_row",
    "txns_per_card_hour",
    "amount_quantile",
    "rule_amount_rolling",
    "card_previous_txn",
    "card_hour_distribution",
    "state_change_gap_distribution",
    "amount_by_label",
    "year_fraud_profile_total",
    "pick_fraud_window",
    "extract_window",
    "sample_keep_fraud",
    "clean_source",
    "read_raw_transactions",
    "write_curated",
)


def timed(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = (
        session_builder("bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        query = QUERIES[name]
        timed(query, spark, sf_dir)
        runs = [timed(query, spark, sf_dir) for _ in range(repeats)]
        seconds[name] = round(statistics.median(runs), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

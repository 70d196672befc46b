"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from normwatch.plans.catalog import QUERIES
from normwatch.session import local_session

HEADLINE = [
    "q02_parquet_round_trip",
    "q05_parquet_by_date",
    "q12_band_concepts",
    "q16_absolute_bands",
    "q20_alarm_report",
    "q20_alarm_report_sql",
    "q22_alarms_extended",
    "q27_constraint_report",
    "q29_merged_alarms",
    "q31_expanded_triples",
    "q34_framed_observations",
    "q35_framed_alarms_json",
    "q38_class_members",
    "q39_inferred_types",
    "q40_price_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "normwatch-bench")
    spark.sparkContext.setLogLevel("ERROR")
    # Start executors and the code generator before the clock.
    QUERIES["q20_alarm_report"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    line = {
        "metric": "headline queries, total wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()

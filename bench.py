"""Time the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run to the end with every output column computed (the noop sink).
A short run over the smallest tables first warms the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidestar.registry import QUERIES
from tidestar.session import build_session

HEADLINES = [
    "scan_parquet",
    "filter_non_negative",
    "check_constraints",
    "pk_duplicates",
    "dedup_rows",
    "datetime_hash",
    "total_amount",
    "enrich_trips",
    "dim_datetime",
    "fact_trips",
    "star_join",
    "star_payment_summary",
    "latest_per_key",
    "merge_insert",
    "cdc_unwrap",
    "cdc_current_state",
    "cdc_star_fact",
    "diff_changes",
    "apply_diff",
    "update_where_in",
    "delete_where_in",
    "batch_star_day",
    "stream_replica",
    "stream_star_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str, path: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, path).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    names = sys.argv[1:] or HEADLINES
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    for name in names:
        if os.path.isdir(warm) and not name.startswith(("stream", "batch")):
            seconds(name, warm)
    times = {name: seconds(name, sf_dir) for name in names}
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()

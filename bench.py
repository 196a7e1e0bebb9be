"""Times the headline queries: ``BENCH_SF_DIR``, ``BENCH_CPUS`` and ``BENCH_RUNS`` set the scene.

Prints one JSON line. A batch query is run once cold and then ``BENCH_RUNS`` times; its figure is
the median of the warm runs, each to the last row of a full write to the ``noop`` sink. A stream
starts from an empty checkpoint every time and is timed in the same way until its result is read.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from brooklet.plans.queries import QUERIES
from brooklet.session import local_session

HEADLINE = [
    "valid_transactions",
    "invalid_transactions",
    "undecided_transactions",
    "validation_flags",
    "transaction_routes",
    "customer_orphans",
    "vendor_orphans",
    "customers_enriched",
    "transactions_enriched_simple",
    "ops_metadata_1min",
    "ops_metadata_rich",
    "table_count_audit",
    "json_parse",
    "json_roundtrip",
    "csv_payload",
    "nth_field",
    "keyword_lang_filter",
    "upsert_latest",
    "transaction_lifecycle",
    "registry_latest",
    "envelope_split",
    "decode_user_v3",
    "valid_transactions_stream",
    "customer_orphans_stream",
    "ops_metadata_stream",
    "shared_pass_stream",
    "message_files_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session("bench", cpus)
    warm, cold = {}, {}
    for name in names:
        seconds = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - started)
        cold[name] = round(seconds[0], 3)
        warm[name] = round(statistics.median(seconds[1:] or seconds), 3)
    report = {
        "metric": "warm_total",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": sf_dir.rpartition("/sf")[2],
        "cpus": cpus,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()

"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (sum of query seconds), "unit",
"queries": {name: seconds}, "sf", ...}. Each query is run to completion
(every row computed) by writing its result to a no-op sink.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from stagecraft import catalog  # noqa: E402
from stagecraft.session import build_session, work_dir  # noqa: E402
from stagecraft.sources.stage import unload  # noqa: E402

HEADLINE = [
    "route_files",        # O11 routing over the listing
    "build_manifest",     # O02 listing -> control table
    "duplicate_check",    # O21
    "plan_batches",       # O32 the whole claim loop as one query
    "claim_next",         # O29 one claim
    "load_stats",         # O23 path-key join + aggregate
    "load_log",           # O19 path-key join
    "progress_eta",       # O28
    "size_profile",       # O26
    "unload_roundtrip",   # O06 unload orders to CSV and read back
    "lineitem_roundtrip", # O06 + O01 + O03: unload lineitem, list, load back with error capture
    "load_files",         # O03 CSV load with bad-row capture
    "load_history",       # O05 per-file history of three targets
    "ingest_job",         # O35 the whole cycle
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", app="stagecraft-bench", shuffle_partitions=int(cpus) * 2)
    # Warm-up (not timed): JVM start, first codegen and file-system caches.
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        fn = catalog.QUERIES[name]
        t0 = time.perf_counter()
        try:
            df = fn(spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
        except Exception as e:  # noqa: BLE001 - report and go on: one JSON line always
            errors[name] = f"{type(e).__name__}: {str(e).splitlines()[0][:300]}"
            continue
        times[name] = round(time.perf_counter() - t0, 3)
    # Pure unloads (O06), the one kind of figure the original publishes
    # (rows per second per core, to compare with its TPC-H unload timings).
    extra = {}
    if not sys.argv[1:]:
        for table in ("orders", "lineitem"):
            df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
            n = df.count()
            t0 = time.perf_counter()
            unload(df, work_dir(spark, f"bench-unload-{table}"), "csv")
            times[f"unload_{table}"] = round(time.perf_counter() - t0, 3)
            extra[f"unload_{table}_rows_per_sec_per_core"] = round(n / times[f"unload_{table}"] / int(cpus))
            # Input splits bound the writer tasks (one CSV file per task).
            extra[f"unload_{table}_tasks"] = df.rdd.getNumPartitions()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    if "lineitem_roundtrip" in times:
        n = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
        extra["lineitem_roundtrip_rows_per_sec_per_core"] = round(n / times["lineitem_roundtrip"] / int(cpus))
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        **extra,
        **({"errors": errors} if errors else {}),
    }))


if __name__ == "__main__":
    main()

"""Benchmark: headline operators at $BENCH_SF_DIR on local[$BENCH_CPUS].

1. ingest: derive the retail tables from the provided parquet files and write
   them once as catalog tables in the shared work folder, orders and order
   items bucketed and sorted by order_id (timed separately);
2. run every headline operator over the lake, forcing full execution with the
   ``noop`` sink (no driver collect); 1 cold + (repeat-1) warm runs, median.

Prints ONE JSON line on stdout; progress goes to stderr.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE_PREFIXES = ("q", "dq_run_all", "b28_brief_row", "al_outstanding", "heal_order_totals",
                     "fix_verified_flag", "dq_c", "rule_foreign_key")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    from martlens.params import Params
    from martlens.plans.tables import RetailTables
    from martlens.registry import operators
    from martlens.session import get_session, work_dir
    from martlens.sources import lake

    spark = get_session("martlens-bench", master=f"local[{cpus}]", shuffle_partitions=cpus * 2,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    p = Params.fixture()

    tag = uuid.uuid4().hex[:10]
    root = work_dir(spark, f"bench-lake-{tag}")
    database = f"martlens_bench_{tag}"
    t0 = time.time()
    lake.write_catalog(RetailTables.from_fixture(spark, sf_dir), database, root,
                       n_buckets=int(os.environ.get("BENCH_BUCKETS", str(cpus * 2))))
    ingest = time.time() - t0
    print(f"ingest {ingest:.2f}s -> {root}", file=sys.stderr)

    ops = {k: v for k, v in operators().items()
           if (k[0] == "q" and k[1:3].isdigit()) or k in HEADLINE_PREFIXES}
    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    for key, op in ops.items():
        runs = []
        for _ in range(repeat):
            t = RetailTables.from_catalog(spark, database)
            s = time.time()
            op(t, p).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - s)
        times[key] = round(statistics.median(runs), 3)
        cold[key] = round(runs[0], 3)
        print(f"{key} {times[key]:.3f}s (cold {runs[0]:.3f}s)", file=sys.stderr)

    # table scans in the full heal + 18-check plan (static plan, AQE off)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    plan = ops["dq_run_all"](RetailTables.from_catalog(spark, database), p)._jdf.queryExecution() \
        .executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    dq_scans = plan.count("FileScan ")
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "sum_median_query_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "cold": cold, "dq_run_all_table_scans": dq_scans, "ingest_sec": round(ingest, 3), "sf": sf, "cpus": cpus, "repeat": repeat}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

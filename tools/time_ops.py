"""Time operators over a parquet lake (written once per sf): python tools/time_ops.py sf_dir lake_dir key..."""

import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    sf_dir, root, keys = sys.argv[1], sys.argv[2], sys.argv[3:]
    from martlens.params import Params
    from martlens.plans.tables import RetailTables
    from martlens.registry import operators
    from martlens.session import get_session
    from martlens.sources import lake
    spark = get_session("time", master="local[8]", shuffle_partitions=16,
                        extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    if not os.path.exists(os.path.join(root, "orders")):
        lake.write_lake(RetailTables.from_fixture(spark, sf_dir), root)
    ops = operators()
    extra = {}
    from martlens.operators import quality
    extra["dq_run_all_by_check"] = quality.dq_run_all_by_check
    p = Params.fixture()
    for k in keys:
        op = ops.get(k) or extra[k]
        runs = []
        for _ in range(3):
            t = RetailTables.from_lake(spark, root)
            s = time.time()
            op(t, p).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - s)
        print(f"{k}: median {statistics.median(runs):.3f}s runs {[round(r, 2) for r in runs]}", flush=True)


if __name__ == "__main__":
    main()

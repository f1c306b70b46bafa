"""Sizing rules and the cleaner of intermediate tables."""

import os
import time

from martlens import session


def test_only_old_work_is_removed(spark):
    old, new = (session.work_dir(spark, f"clean-test-{n}") for n in ("old", "new"))
    for path in (old, new):
        spark.range(3).write.mode("overwrite").parquet(path)
    day_ago = time.time() - 86_400
    os.utime(old.removeprefix("file:"), (day_ago, day_ago))
    gone = session.clean_work(spark, older_than_hours=12)
    assert "clean-test-old" in gone and "clean-test-new" not in gone
    assert not os.path.exists(old.removeprefix("file:")) and spark.read.parquet(new).count() == 3


def test_buckets_grow_with_the_table():
    assert session.bucket_count(1 << 30) == 8 and session.bucket_count(100 << 40) == 131072

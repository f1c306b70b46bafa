"""Numbered commits: two writers, killed writers, open readers, and the nightly job's ids."""

import datetime as dt
import os
import threading

import pytest
from pyspark.errors import AnalysisException

from martlens.operators import dq_job
from martlens.params import Params
from martlens.plans.tables import RetailTables
from martlens.sources import lake, versions

P = Params.fixture()
SF = "/root/testdata/sf0.001"
NIGHT = dt.datetime(2001, 7, 15, 12, 55)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture()
def root(tmp_path):
    return f"file:{tmp_path}/table"


def test_one_of_many_writers_gets_a_number(spark, root):
    got, start = [], threading.Barrier(12)

    def write(k):
        start.wait()
        got.append(versions.create_if_absent(spark, f"{root}/_versions/one", f"{k}\n"))
    threads = [threading.Thread(target=write, args=(k,)) for k in range(12)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(got) == [False] * 11 + [True]


def test_concurrent_commits_all_count(spark, root):
    """Twelve writers each add 1..n to a counter: no two commits hand out one range."""
    def write(n):
        versions.commit(spark, root, lambda last: {"first": (last or {"last": 0})["last"] + 1, "last": (last or {"last": 0})["last"] + n})
    threads = [threading.Thread(target=write, args=(n,)) for n in range(1, 13)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    found = versions.committed(spark, root)
    assert [e["version"] for e in found] == list(range(1, 13)) and found[-1]["last"] == sum(range(1, 13))
    assert all(a["last"] + 1 == b["first"] for a, b in zip(found, found[1:]))


def test_a_loser_commits_again_after_the_winner(spark, root):
    seen = []

    def build(last):
        seen.append(last and last["x"])
        if len(seen) == 1:  # another writer is faster between the look and the commit
            versions.commit(spark, root, lambda _: {"x": "other"})
        return {"x": "own"}
    assert versions.commit(spark, root, build)["version"] == 2 and seen == [None, "other"]


def test_a_commit_cut_short_is_skipped_and_its_number_not_reused(spark, root, tmp_path):
    versions.commit(spark, root, lambda _: {"x": 1})
    for number, text in ((2, ""), (3, '{"x": 9')):
        (tmp_path / "table" / "_versions" / f"{number:020d}.json").write_text(text)
    assert versions.current(spark, root)["x"] == 1
    assert versions.commit(spark, root, lambda last: {"x": last["x"] + 1})["version"] == 4
    assert [e["x"] for e in versions.committed(spark, root)] == [1, 2]


def test_an_open_reader_and_a_killed_replace_see_the_old_table(spark, root, monkeypatch):
    with pytest.raises(AnalysisException):
        versions.read_table(spark, root)
    lake.wipe_replace(spark.createDataFrame([(7, "a"), (9, "b")], "id bigint, v string"), root, order_cols=["v"])
    reader = versions.read_table(spark, root)
    old = rows(reader)
    assert old == [(1, "a"), (2, "b")]
    with monkeypatch.context() as m:  # killed between the data and the commit
        m.setattr(versions, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            lake.wipe_replace(spark.createDataFrame([(1, "x")], "id bigint, v string"), root)
    # killed while it writes: a task fails
    bad = spark.range(10).selectExpr("id", "if(id = 9, raise_error('lost'), 'y') as v")
    with pytest.raises(Exception):
        lake.wipe_replace(bad, root)
    assert rows(versions.read_table(spark, root)) == old and rows(reader) == old
    assert lake.wipe_replace(spark.createDataFrame([(5, "c")], "id bigint, v string"), root) == 2
    assert rows(reader) == old and rows(versions.read_table(spark, root)) == [(1, "c")] and rows(versions.read_table(spark, root, 1)) == old
    assert lake.wipe_replace(spark.createDataFrame([], "id bigint, v string"), root) == 3
    assert versions.read_table(spark, root).columns == ["id", "v"] and versions.read_table(spark, root).count() == 0
    assert len(versions.expire(spark, root, keep=2)) == 1 and versions.expire(spark, root, keep=2) == []
    assert rows(versions.read_table(spark, root, 2)) == [(1, "c")]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("nightly"))
    lake.write_lake(RetailTables.from_fixture(spark, SF), folder)
    return RetailTables.from_lake(spark, folder)


def assert_unique_ids(spark, root, tables, n_runs):
    snap = dq_job.current_snapshot(spark, root, tables)
    for name, key in (("dq_issues", "id"), ("data_fix_audit", "audit_id")):
        ids = sorted(r[key] for r in snap[name].select(key).collect())
        assert ids == list(range(1, len(ids) + 1)) and len(ids) % n_runs == 0


def test_back_dated_runs_get_new_ids(spark, tables, root):
    days = [2, 1, 3]
    for d in days:
        dq_job.run_data_quality_job(spark, tables, P, root, run_at=NIGHT + dt.timedelta(days=d))
    assert_unique_ids(spark, root, tables, 3)
    snap = dq_job.current_snapshot(spark, root, tables)
    by_day = {r.detected_at.day: r["min(id)"] for r in snap.dq_issues.groupBy("detected_at").agg({"id": "min"}).collect()}
    assert sorted(by_day, key=by_day.get) == [NIGHT.day + d for d in days]


def test_concurrent_runs_get_unique_ids(spark, tables, root):
    errors = []

    def run(d, run_id):
        try:
            dq_job.run_data_quality_job(spark, tables, P, root, run_at=NIGHT + dt.timedelta(days=d), run_id=run_id)
        except Exception as e:  # noqa: BLE001
            errors.append(e)
    # three nights at once, and one of them started twice
    threads = [threading.Thread(target=run, args=(d, f"night-{d}")) for d in (1, 2, 3, 3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert errors == [] and sorted(e["run_id"] for e in dq_job.published(spark, root)) == ["night-1", "night-2", "night-3"]
    assert_unique_ids(spark, root, tables, 3)


def test_a_killed_attempt_leaves_no_trace_in_what_readers_see(spark, tables, root, tmp_path, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(versions, "create_if_absent", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            dq_job.run_data_quality_job(spark, tables, P, root, run_at=NIGHT)
    assert dq_job.current_snapshot(spark, root, tables) is tables and len(os.listdir(tmp_path / "table")) == 1
    dq_job.run_data_quality_job(spark, tables, P, root, run_at=NIGHT)
    assert_unique_ids(spark, root, tables, 1)

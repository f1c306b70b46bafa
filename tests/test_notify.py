"""The notification channel and the monitor of published runs: kill, restart and replay."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from martlens.operators import dq_job, quality
from martlens.params import Params
from martlens.plans.tables import RetailTables
from martlens.sources import lake
from martlens.streaming import dq_monitor, notify

P = Params.fixture()
SF = "/root/testdata/sf0.001"
NIGHT = dt.datetime(2001, 7, 15, 12, 55)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("notify-lake"))
    lake.write_lake(RetailTables.from_fixture(spark, SF), folder)
    return RetailTables.from_lake(spark, folder)


@pytest.fixture(scope="module")
def job(spark, tables, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("notify-job"))
    for d in range(3):
        dq_job.run_data_quality_job(spark, tables, P, root, run_at=NIGHT + dt.timedelta(days=d))
    return root


def published(spark, root):
    return sorted((e["run_id"], r.payload) for e in dq_job.published(spark, root)
                  for r in spark.read.parquet(f"{root}/{e['data']}/dq_notifications").collect())


def received(spark, path):
    return sorted((r.run_id, r.payload) for r in notify.delivered(spark, path).collect())


def test_a_killed_consumer_loses_and_doubles_nothing(spark, job, tmp_path):
    table, checkpoint = str(tmp_path / "delivered"), str(tmp_path / "checkpoint")
    write, calls = notify.table_receiver(table), []

    def dies_after_writing(payloads):
        write(payloads)
        calls.append(payloads.select(F.max("version")).first()[0])
        if len(calls) == 2:  # delivered, but the batch is not committed
            raise RuntimeError("killed")
    with pytest.raises(Exception):
        notify.start_consumer(spark, job, checkpoint, dies_after_writing, runs_per_batch=1).awaitTermination()
    assert calls == [1, 2] and len(received(spark, table)) < len(published(spark, job))
    again = []
    notify.start_consumer(spark, job, checkpoint, lambda x: (again.append(x.select(F.max("version")).first()[0]), write(x)), runs_per_batch=1).awaitTermination()
    assert again == [2, 3]  # from its own place on: at least once
    assert received(spark, table) == published(spark, job)
    # a commit that is lost: the last batch comes again and changes nothing
    last = max(int(n) for n in os.listdir(tmp_path / "checkpoint" / "commits") if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(tmp_path / "checkpoint" / "commits" / name):
            os.remove(tmp_path / "checkpoint" / "commits" / name)
    notify.start_consumer(spark, job, checkpoint, write, runs_per_batch=1).awaitTermination()
    assert received(spark, table) == published(spark, job)


def test_consumers_have_their_own_places_and_see_new_runs_only(spark, tables, job, tmp_path):
    seen = {}
    for name in ("a", "b"):
        seen[name] = []
        listen = lambda name=name: notify.start_consumer(
            spark, job, str(tmp_path / name), lambda x, name=name: seen[name].append(sorted({r.run_id for r in x.collect()}))).awaitTermination()
        listen()
        if name == "a":
            dq_job.run_data_quality_job(spark, tables, P, job, run_at=NIGHT + dt.timedelta(days=9))
            listen()
            listen()
    runs = [e["run_id"] for e in dq_job.published(spark, job)]
    assert seen["a"] == [runs[:-1], runs[-1:]] and seen["b"] == [runs]


def test_the_monitor_streams_published_runs_where_they_are(spark, tables, tmp_path):
    root, sink, checkpoint = (str(tmp_path / n) for n in ("job", "sink", "checkpoint"))
    for d in range(2):
        dq_job.run_data_quality_job(spark, tables, P, root, run_at=NIGHT + dt.timedelta(days=d))
    files = lambda: sorted(os.path.join(d, n) for d, _, names in os.walk(root) for n in names)
    before = files()
    dq_monitor.start_run_monitor(spark, root, sink, checkpoint, P).awaitTermination()
    assert files() == before  # nothing is copied or written beside the runs
    snap = dq_job.current_snapshot(spark, root, tables)
    one = {(r.check_name, r.row_count) for r in quality.summarize(snap, P, [quality.BY_LETTER[x] for x in "hkr"]).collect()}
    got = dq_monitor.monitor_issues(spark, sink).collect()
    assert {r.batch_id for r in got} == {0, 1} and all({(r.check_name, r.row_count) for r in got if r.batch_id == b} == one for b in (0, 1))
    os.remove(os.path.join(checkpoint, "commits", "1"))
    if os.path.exists(os.path.join(checkpoint, "commits", ".1.crc")):
        os.remove(os.path.join(checkpoint, "commits", ".1.crc"))
    dq_monitor.start_run_monitor(spark, root, sink, checkpoint, P).awaitTermination()
    assert sorted(map(tuple, dq_monitor.monitor_issues(spark, sink).collect()), key=str) == sorted(map(tuple, got), key=str)


def test_stored_tables_are_streamed_without_a_copy(spark, tables, monkeypatch):
    sources = []
    start = dq_monitor.start_dq_monitor
    monkeypatch.setattr(dq_monitor, "start_dq_monitor", lambda s, table, path, *a, **k: sources.append((table, path)) or start(s, table, path, *a, **k))
    got = {(r.check_name, r.row_count) for r in dq_monitor.stream_dq_monitor(tables, P).collect()}
    assert sources == [(n, tables.paths[n]) for n in dq_monitor.RULE_COLUMNS]
    letters = [x for own in dq_monitor.ROW_RULES.values() for x in own]
    assert got == {(r.check_name, r.row_count) for r in quality.summarize(tables, P, [quality.BY_LETTER[x] for x in sorted(letters)]).collect()}

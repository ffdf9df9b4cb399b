"""The run journal: folds, lookups by key, times in UTC."""

import datetime as dt
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.runlog import EVENT_SCHEMA, RunJournal, run_state


def _events(seed, n):
    r, t0 = random.Random(seed), dt.datetime(2018, 1, 1)
    out = []
    for k in range(n):
        at = t0 + dt.timedelta(seconds=r.randint(0, 10 ** 6))
        out.append((f"{r.getrandbits(64):016x}" if k % 5 else out[-1][0] if out else "x", r.choice(["start", "end"]), at,
                    f"s{r.randint(0, 3)}-{k}"))
    return out


def _files(journal):
    return len(journal._event_files())


def _all(df):
    return sorted(map(repr, df.collect()))


def test_folds_equal_the_plain_state(spark, workdir):
    journal, rows = RunJournal(spark, f"{workdir}/logs/events"), []
    assert journal.state().collect() == []
    for n in range(3):
        more = _events(n, 300) + rows[:20]  # more events of known runs
        rows += more
        journal.add(spark.createDataFrame(more, EVENT_SCHEMA).repartition(6))
        assert _all(journal.state()) == _all(run_state(spark.createDataFrame(rows, EVENT_SCHEMA)))
        if n < 2:
            journal.compact()
            assert _files(journal) == 0 and journal.events().isEmpty()
            assert _all(journal.state()) == _all(run_state(spark.createDataFrame(rows, EVENT_SCHEMA)))
    wanted = [rows[3][0], rows[400][0], "unknown"]
    assert _all(journal.runs(wanted)) == _all(run_state(spark.createDataFrame(rows, EVENT_SCHEMA)).where(
        F.col("log_id").isin(wanted)))


def test_thousands_of_events_become_a_few_files(spark, workdir):
    journal = RunJournal(spark, f"{workdir}/logs/many")
    journal.add(spark.createDataFrame(_events(5, 6000), EVENT_SCHEMA).repartition(60))
    assert _files(journal) > 40
    journal.compact(row_group_bytes=1 << 14)
    _, folder, _ = journal._fold()
    state = spark.read.parquet(f"{folder}/state")
    assert len(state.inputFiles()) <= 8
    key = state.orderBy("log_id").limit(1000).collect()[-1]["log_id"]
    found = state.where(F.col("log_id") == key)
    assert len(found.collect()) == 1
    plan = found._jdf.queryExecution().executedPlan()
    scan = plan.collectLeaves().head()
    read = scan.metrics().apply("numOutputRows").value()
    assert 1 <= read < state.count() / 3  # the other row groups were skipped
    assert f"EqualTo(log_id,{key})" in plan.toString()


@pytest.mark.parametrize("at", ["state", "files"])
def test_a_broken_compaction_leaves_the_old_state(spark, workdir, monkeypatch, at):
    journal = RunJournal(spark, f"{workdir}/logs/broken-{at}")
    rows = _events(9, 200)
    journal.add(spark.createDataFrame(rows[:100], EVENT_SCHEMA))
    journal.compact()
    journal.add(spark.createDataFrame(rows[100:], EVENT_SCHEMA))
    expected = _all(journal.state())
    if at == "files":  # the fold's list of files stands, its state does not
        number, _, held = journal._fold()
        spark.createDataFrame([(f,) for f in journal._event_files()], "file string").write.parquet(
            f"{journal._folds}/fold={number + 1}/files")
    else:  # the fold is whole, the events it holds were not removed
        names = journal._event_files()
        journal.compact()
        spark.createDataFrame([rows[100]], EVENT_SCHEMA).coalesce(1).write.parquet(f"{workdir}/one-{at}")
        one = [f for f in os.listdir(f"{workdir}/one-{at}".removeprefix("file:")) if f.endswith(".parquet")][0]
        os.link(f"{workdir}/one-{at}".removeprefix("file:") + f"/{one}", journal.path.removeprefix("file:") + f"/{names[0]}")
    assert _all(journal.state()) == expected
    journal.compact()
    assert _all(journal.state()) == expected


def test_times_are_utc_whatever_the_host(spark, workdir, monkeypatch):
    journal = RunJournal(spark, f"{workdir}/logs/utc")
    try:
        for zone in ("Pacific/Kiritimati", "Pacific/Pago_Pago"):  # 25 hours apart
            monkeypatch.setenv("TZ", zone)
            time.tzset()
            journal.start(zone)
    finally:
        monkeypatch.undo()
        time.tzset()
    times = [r.event_time for r in journal.events().collect()]
    assert max(times) - min(times) < dt.timedelta(minutes=5)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert all(abs(now - t) < dt.timedelta(minutes=5) for t in times)

"""A versioned warehouse through all jobs, and the removal of its old versions."""

import datetime as dt

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from ledgerline.__main__ import main
from ledgerline.plans import pipelines as pl
from ledgerline.plans.queries import Model, write_landing
from ledgerline.sources.publish import Release, Releases

NOW = dt.timedelta(0)


def _folders(workdir, name):
    return {p.name for p in (workdir / name / "_runs").iterdir()}


def test_old_versions_go_shared_folders_stay(spark, tmp_path):
    root = f"{tmp_path}/wh"
    rows = spark.range(6).withColumn("part", (F.col("id") % 3).cast("int"))
    for n in range(4):  # part=2 stays in the first run's folder, part=0 is written by every run
        release = Release(spark, root)
        release.write_parts(rows.where("true" if n == 0 else "part = 0").withColumn("n", F.lit(n)), "t", ["part"],
                            lambda p: p == "part=0")
        if n == 1:
            release.write(rows, "whole")
        release.publish()
    broken_off = Release(spark, root)
    broken_off.write(rows, "t")
    reader = Release(spark, root)
    before, folders = sorted(map(tuple, reader.read("t").collect())), _folders(tmp_path, "wh")
    assert len(folders) == 6
    assert Releases(spark, root).expire(keep=2) == ([1, 2], [])  # nothing is old enough
    assert Releases(spark, root).expire(keep=2, longest_run=NOW)[0] == []
    left = _folders(tmp_path, "wh")
    # gone: part=0 of the second run, and the run that was never published
    assert len(left) == 4 and broken_off.run.split("/")[1] not in left
    assert sorted(map(tuple, Release(spark, root).read("t").collect())) == before
    assert Release(spark, root).read("whole").count() == 6
    assert Releases(spark, root).numbers() == [3, 4]
    again = Release(spark, root)
    again.write(rows, "t")
    assert again.publish() == 5  # numbers go on
    with pytest.raises(ValueError, match="last version"):
        Releases(spark, root).expire(keep=0)


def test_broken_off_between_manifest_and_folders(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/wh"
    for n in range(3):
        release = Release(spark, root)
        release.write(spark.range(n + 1), "t")
        release.publish()
    monkeypatch.setattr("ledgerline.sources.publish.RUNS", "_none")  # folders are not found: as if killed before
    assert Releases(spark, root).expire(keep=1, longest_run=NOW) == ([1, 2], [])
    monkeypatch.undo()
    assert Release(spark, root).read("t").count() == 3
    assert len(Releases(spark, root).expire(keep=1, longest_run=NOW)[1]) == 2
    assert Release(spark, root).read("t").count() == 3


def test_all_jobs_over_a_versioned_warehouse(spark, tmp_path):
    m = Model(spark, SF_SMALL)
    landing, root, out = f"{tmp_path}/landing", f"{tmp_path}/wh", f"{tmp_path}/out"
    write_landing(m, landing)
    job = ["--warehouse", root, "--versioned"]
    assert main(["fill", "--landing", landing, "--month", "1998-01", *job]) == 0
    assert main(["extract", "--out", out, *job]) == 0
    assert main(["load-report", "--csv", out, *job]) == 0
    assert main(["load-report", "--csv", out, *job]) == 0
    assert main(["load-report", "--csv", out, "--append", *job]) == 0
    wh = pl.VersionedWarehouse(spark, root)
    n = wh.read("dm", pl.REPORT_TABLE).count()
    v2 = wh.read("dm", pl.REPORT_V2)
    assert v2.count() == 2 * n and v2.distinct().count() == n > 0
    assert wh.release.number == 4
    # a restatement without late postings leaves the marts as they were
    balances = sorted(map(repr, pl._balance_mart(wh).collect()))
    assert main(["restate", "--landing", landing, "--month", "1998-01", "--since", "1998-01-20", *job]) == 0
    assert main(["expire", "--warehouse", root, "--keep", "1"]) == 0
    wh = pl.VersionedWarehouse(spark, root)
    assert sorted(map(repr, pl._balance_mart(wh).collect())) == balances
    assert Releases(spark, root).numbers() == [5] and wh.read("dm", pl.REPORT_V2).count() == 2 * n
    with pytest.raises(ValueError, match="not in the period"):
        pl.run_restatement(spark, landing, root, m.period, dt.date(1998, 2, 1), versioned=True)

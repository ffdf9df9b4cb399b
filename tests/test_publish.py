"""A run is published as a whole or not at all."""

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from ledgerline.model import Period
from ledgerline.plans import pipelines as pl
from ledgerline.plans.queries import Model, write_landing
from ledgerline.sources.publish import PublishRefused, Release, Releases


def _rows(df):
    return sorted(map(repr, df.collect()))


def _state(spark, root):
    """Everything readers see."""
    wh = pl.VersionedWarehouse(spark, root)
    if not wh.release.number:
        return None
    return {name: _rows(pl._balance_mart(wh) if name == f"dm/{pl.BALANCE_MART}" else wh.release.read(name))
            for name in wh.release.tables}


def test_killed_between_any_two_writes(spark, workdir, monkeypatch):
    m = Model(spark, SF_SMALL)
    landing, root = f"{workdir}/landing", f"{workdir}/wh"
    write_landing(m, landing)
    pl.run_fill_procedure(spark, landing, root, m.period, versioned=True)
    old = _state(spark, root)
    assert len(old) > 10 and old[f"dm/{pl.BALANCE_MART}"]
    february = Period.month(1998, 2)
    writes = 0
    plain = {name: getattr(Release, name) for name in ("write", "write_parts")}
    publish = Releases.publish

    def counted(name, stop):
        def run(self, *args):
            nonlocal writes
            plain[name](self, *args)  # the write itself is done
            writes += 1
            if writes == stop:
                raise RuntimeError("killed")
        return run

    stop = 0
    while True:
        stop, writes = stop + 1, 0
        for name in plain:
            monkeypatch.setattr(Release, name, counted(name, stop))
        wh = pl.VersionedWarehouse(spark, root)
        try:
            # the steps of a run without the ingest of files, which is one of its writes per table
            wh.refresh(wh.read("ds", "ft_posting_f").limit(10), "ds", "ft_posting_f")
            pl.fill_turnover(wh, february)
            pl.fill_opening(wh, february)
            pl.fill_balance(wh, february)
            pl.fill_report(wh, february)
            pl.report_unmatched(wh, february)
            break
        except RuntimeError as e:
            assert "killed" in str(e)
            if stop in (1, 3, 5):
                assert _state(spark, root) == old
    assert stop >= 8  # writes of a run
    assert _state(spark, root) == old

    # killed while publishing: before the pointer stands
    monkeypatch.undo()
    monkeypatch.setattr(Releases, "_name", lambda self, n: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        wh.publish()
    monkeypatch.undo()
    assert Releases.publish is publish and _state(spark, root) == old
    wh.publish()
    new = _state(spark, root)
    assert new != old and {"dm/" + pl.BALANCE_MART, "dm/" + pl.REPORT_TABLE} <= set(new)
    # January's days and report are still there, February's came
    days = {r[0] for r in pl._balance_mart(pl.VersionedWarehouse(spark, root)).select("on_date").distinct().collect()}
    assert {m.period.opening, m.period.start, m.period.end} <= days
    periods = pl.VersionedWarehouse(spark, root).read("dm", pl.REPORT_TABLE).select("from_date").distinct().collect()
    assert m.period.start in {r[0] for r in periods}


def test_one_of_two_writers_is_refused(spark, workdir):
    root = f"{workdir}/two"
    rows = spark.range(5).withColumn("part", F.col("id") % 2)
    first, second = Release(spark, root), Release(spark, root)
    first.write(rows, "t")
    second.write(rows.where("id > 2"), "t")
    assert first.publish() == 1
    with pytest.raises(PublishRefused):
        second.publish()
    assert Release(spark, root).read("t").count() == 5
    again = Release(spark, root)  # begins with the version read now
    again.write(rows.where("id > 2"), "t")
    assert again.publish() == 2 and Release(spark, root).read("t").count() == 2
    # a reader that opened the version before goes on reading it
    assert first.read("t").count() == 5


def test_parts_replaced_dropped_and_kept(spark, workdir):
    root = f"{workdir}/parts"
    rows = spark.range(12).withColumn("part", (F.col("id") % 3).cast("int"))
    a = Release(spark, root)
    a.write_parts(rows, "t", ["part"], lambda p: True)
    a.publish()
    b = Release(spark, root)
    b.write_parts(rows.where("part = 1 AND id > 5"), "t", ["part"], lambda p: p in ("part=1", "part=2"))
    assert sorted(r.id for r in b.read("t").collect()) == [0, 3, 6, 7, 9, 10]
    b.write_parts(rows.where("part = 1 AND id > 8"), "t", ["part"], lambda p: p == "part=1")  # a second write of the run
    assert sorted(r.id for r in b.read("t").collect()) == [0, 3, 6, 9, 10]
    assert Release(spark, root).read("t").count() == 12
    b.write_parts(rows.limit(0), "t", ["part"], lambda p: True)
    assert b.read("t", "id bigint, part int").count() == 0


def test_versioned_and_plain_warehouse_agree(spark, workdir):
    m = Model(spark, SF_SMALL)
    write_landing(m, f"{workdir}/landing-agree")
    for versioned in (False, True):
        pl.run_fill_procedure(spark, f"{workdir}/landing-agree", f"{workdir}/wh-{versioned}", m.period, versioned=versioned)
    plain, kept = pl.Warehouse(spark, f"{workdir}/wh-False"), pl.VersionedWarehouse(spark, f"{workdir}/wh-True")
    assert _rows(pl._balance_mart(plain)) == _rows(pl._balance_mart(kept))
    columns = plain.read("dm", pl.REPORT_TABLE).columns
    assert _rows(plain.read("dm", pl.REPORT_TABLE)) == _rows(kept.read("dm", pl.REPORT_TABLE).select(*columns))

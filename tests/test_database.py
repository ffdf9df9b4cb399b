"""Databases (embedded Derby): even reads of skewed keys, appends that survive retries, the report there and back."""

import uuid

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from ledgerline.model import Period
from ledgerline.plans import pipelines as pl
from ledgerline.plans.queries import Model
from ledgerline.sources import jdbc
from ledgerline.sources.specs import REPORT


@pytest.fixture
def derby():
    return f"jdbc:derby:memory:ll{uuid.uuid4().hex[:8]};create=true", {
        "driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def _sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


def test_a_skewed_key_is_read_evenly(spark, derby):
    url, props = derby
    # nine tenths of the rows in a hundredth of the key range, and rows without a key
    rows = spark.range(20_000).selectExpr(
        "CASE WHEN id % 1000 = 7 THEN NULL WHEN id % 10 < 9 THEN id % 2000 ELSE id * 10 END AS k", "id AS v")
    jdbc.refresh_table(rows, url, "SKEWED", props)
    plain = jdbc.read_table(spark, url, "SKEWED", props, "k", 0, 200_000, 8)
    assert max(_sizes(plain)) > 4 * 20_000 / 8
    found = jdbc.read_evenly(spark, url, "SKEWED", "k", 8, props)
    assert found.rdd.getNumPartitions() == 8
    sizes = _sizes(found)
    assert sum(sizes) == 20_000 and max(sizes) <= 2 * 20_000 / 8
    assert sorted(r.v for r in found.collect()) == list(range(20_000))
    one = found.where(F.col("v") == 11)
    assert "EqualTo(v,11)" in one._jdf.queryExecution().executedPlan().toString()


def test_even_reads_of_odd_tables(spark, derby):
    url, props = derby
    jdbc.refresh_table(spark.range(0), url, "NOTHING", props)
    assert jdbc.split_points(spark, url, "NOTHING", "id", 4, props) == []
    assert jdbc.read_evenly(spark, url, "NOTHING", "id", 4, props).count() == 0
    jdbc.refresh_table(spark.range(50).selectExpr("CAST(7 AS BIGINT) AS id"), url, "SAME", props)
    assert jdbc.read_evenly(spark, url, "SAME", "id", 4, props).count() == 50


def _values(spark, url, table, props):
    return sorted(r.v for r in jdbc.read_table(spark, url, table, props).collect())


def test_append_with_a_failing_task_doubles_no_row(spark, derby, monkeypatch):
    url, props = derby
    rows = spark.range(0, 400, 1, 4).selectExpr("id AS v", "CAST(id AS STRING) AS t")
    assert jdbc.append_once(rows.where("v < 100"), url, "MART", "b1", props)
    stage = jdbc._stage

    def half(df, *rest):
        stage(df.where("v < 250"), *rest)  # some tasks have written their rows, another one failed
        raise RuntimeError("task failed")

    monkeypatch.setattr(jdbc, "_stage", half)
    with pytest.raises(RuntimeError, match="task failed"):
        jdbc.append_once(rows.where("v >= 100"), url, "MART", "b2", props)
    assert _values(spark, url, "MART", props) == list(range(100))

    def twice(df, url_, staging, *rest):
        stage(df, url_, staging, *rest)
        jdbc.append_table(df.where("v % 3 = 0"), url_, staging, props)  # a task whose rows stayed was repeated

    monkeypatch.setattr(jdbc, "_stage", twice)
    assert jdbc.append_once(rows.where("v >= 100"), url, "MART", "b2", props)
    monkeypatch.undo()
    assert _values(spark, url, "MART", props) == list(range(400))
    assert not jdbc.append_once(rows.where("v >= 100"), url, "MART", "b2", props)  # a driver that asks again
    assert _values(spark, url, "MART", props) == list(range(400))


def test_a_move_that_breaks_off_leaves_the_table(spark, derby, monkeypatch):
    url, props = derby
    rows = spark.range(50).selectExpr("id AS v")
    stage, run = jdbc._stage, jdbc._Transaction.run
    monkeypatch.setattr(jdbc, "_stage", lambda df, *rest: stage(df.where("v <> 7"), *rest))
    with pytest.raises(RuntimeError, match="49 of 50"):  # a lost row
        jdbc.append_once(rows, url, "MOVED", "b", props)
    monkeypatch.undo()
    assert _values(spark, url, "MOVED", props) == []

    def killed(self, sql, *values):
        if "_batches (batch_id" in sql and sql.startswith("INSERT"):
            raise RuntimeError("killed before the commit")
        return run(self, sql, *values)

    monkeypatch.setattr(jdbc._Transaction, "run", killed)
    with pytest.raises(RuntimeError, match="killed"):
        jdbc.append_once(rows, url, "MOVED", "b", props)
    monkeypatch.undo()
    assert _values(spark, url, "MOVED", props) == []
    assert jdbc.append_once(rows, url, "MOVED", "b", props)
    equal = spark.range(3).selectExpr("CAST(1 AS BIGINT) AS v")  # equal rows are rows of their own
    assert jdbc.append_once(equal, url, "MOVED", "c", props)
    assert _values(spark, url, "MOVED", props) == sorted([*range(50), 1, 1, 1])


def test_report_from_and_to_a_database(spark, workdir, derby):
    url, props = derby
    m = Model(spark, SF_SMALL)
    report = m.form101()
    narrow = report.select(*[F.col(c).cast("decimal(31,8)").alias(c) if t.startswith("decimal") else F.col(c)
                             for c, t in report.dtypes])
    jdbc.refresh_table(narrow, url, "DM_F101", props)
    journal = pl.Warehouse(spark, f"{workdir}/wh").journal()
    pl.extract_report_from_database(spark, url, "DM_F101", props, f"{workdir}/out", journal)
    sent = sorted(map(repr, pl.read_report_csv(spark, f"{workdir}/out").collect()))
    assert len(sent) == 12 and sent == sorted(map(repr, report.select(
        *[F.col(f.name).cast(f.dataType) for f in pl.read_report_csv(spark, f"{workdir}/out").schema]).collect()))

    load = lambda batch, **o: pl.load_report_to_database(
        spark, f"{workdir}/out", url, "F101_V2", props, batch, journal, **o)
    count = lambda: jdbc.read_table(spark, url, "F101_V2", props).count()
    assert load("monday") and count() == 12
    assert not load("monday") and count() == 12
    assert load("tuesday") and count() == 12                   # its period replaced
    assert load("wednesday", mode="append") and count() == 24  # the source system's way
    back = jdbc.read_table(spark, url, "F101_V2", props)
    assert {c.lower() for c in back.columns} == set(REPORT.columns)
    assert jdbc.read_table(spark, url, "F101_V2_rejects", props).count() == 0
    states = {r.status for r in journal.state().collect()}
    assert states == {"Finished_extract_to_csv", "Finished_load_to_pg"}
    assert Period.month(1998, 1).start in {r[0] for r in back.select("from_date").distinct().collect()}

"""Sinks (S6-S11), JDBC through embedded in-memory Derby (no server, no
port), the run journal (L1, L2, A6) and the streaming landing ingest."""

import datetime as dt
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.runlog import RunJournal, run_state
from ledgerline.sources import jdbc, sinks
from ledgerline.sources.csv import to_source_layout, write_delimited
from ledgerline.sources.specs import POSTING
from ledgerline.streaming import stream_ingest


def test_full_refresh_twice_equals_once(spark, workdir):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    sinks.full_refresh(df, f"{workdir}/t")
    sinks.full_refresh(df, f"{workdir}/t")
    assert spark.read.parquet(f"{workdir}/t").count() == 10


def test_partition_refresh_replaces_only_present_days(spark, workdir):
    days = [dt.date(2018, 1, d) for d in (1, 2, 3)]
    first = spark.createDataFrame([(d, 1) for d in days] * 2, "on_date date, v int")
    sinks.refresh_partitions(first, f"{workdir}/m", ["on_date"])
    again = spark.createDataFrame([(days[1], 5)], "on_date date, v int")
    sinks.refresh_partitions(again, f"{workdir}/m", ["on_date"])
    back = spark.read.schema("v int, on_date date").parquet(f"{workdir}/m")
    got = sorted((r.on_date.day, r.v) for r in back.collect())
    assert got == [(1, 1), (1, 1), (2, 5), (3, 1), (3, 1)]


def test_replace_days_clears_days_without_rows(spark, workdir):
    days = [dt.date(2018, 1, d) for d in (1, 2, 3)]
    first = spark.createDataFrame([(d, 1) for d in days], "on_date date, v int")
    sinks.refresh_partitions(first, f"{workdir}/r", ["on_date"])
    # re-run of days 2..3 where day 3 has no rows any more; day 4 is outside
    again = spark.createDataFrame([(days[1], 7), (dt.date(2018, 1, 4), 9)], "on_date date, v int")
    sinks.replace_days(again, f"{workdir}/r", "on_date", days[1], days[2])
    sinks.replace_days(again, f"{workdir}/r", "on_date", days[1], days[2])  # idempotent
    back = spark.read.schema("v int, on_date date").parquet(f"{workdir}/r")
    assert sorted((r.on_date.day, r.v) for r in back.collect()) == [(1, 1), (2, 7)]


def test_csv_export_can_run_twice(spark, workdir):
    df = spark.createDataFrame([(1, "a")], "k int, s string")
    write_delimited(df, f"{workdir}/e", sep=",")
    write_delimited(df, f"{workdir}/e", sep=",")
    assert spark.read.option("header", True).csv(f"{workdir}/e").count() == 1


@pytest.fixture
def derby():
    return f"jdbc:derby:memory:ll{uuid.uuid4().hex[:8]};create=true", {
        "driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def test_jdbc_refresh_append_and_partitioned_read(spark, derby):
    url, props = derby
    df = spark.range(1, 101).selectExpr("CAST(id AS INT) AS log_id", "CAST(id * 1.5 AS DOUBLE) AS v")
    jdbc.refresh_table(df, url, "T101", props)
    jdbc.refresh_table(df, url, "T101", props)          # truncate, not duplicate
    jdbc.append_table(df.where("log_id <= 10"), url, "T101", props)
    back = jdbc.read_table(spark, url, "T101", props, partition_column="LOG_ID",
                           lower=1, upper=100, num_partitions=4)
    assert back.rdd.getNumPartitions() == 4
    assert back.count() == 110
    one = back.where(F.col("LOG_ID") == 7)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "*EqualTo(log_id,7)" in plan and "numPartitions=4" in plan  # filter runs in the database
    assert one.count() == 2


def test_run_journal_success_failure_and_state(spark, workdir):
    j = RunJournal(spark, f"{workdir}/logs")
    with j.step("Start_fill_dm_account_turnover", "Finished_fill_dm_account_turnover") as ok_id:
        pass
    with pytest.raises(RuntimeError):
        with j.step("Start_fill_account_balance", "Finished_fill_account_balance"):
            raise RuntimeError("boom")
    running = j.start("Started_etl_process")
    state = {r.log_id: r for r in j.state().collect()}
    assert state[ok_id].status == "Finished_fill_dm_account_turnover" and state[ok_id].end_time is not None
    failed = [r for r in state.values() if r.status.startswith("Failed_")]
    assert len(failed) == 1 and failed[0].status == "Failed_Start_fill_account_balance"
    assert state[running].end_time is None and state[running].status == "Started_etl_process"
    one = j.run(ok_id)
    assert [r.status for r in one.collect()] == ["Finished_fill_dm_account_turnover"]
    assert "PushedFilters: [IsNotNull(log_id), EqualTo(log_id," in \
        one._jdf.queryExecution().executedPlan().toString()


def test_run_state_end_wins_ties(spark):
    t = dt.datetime(2024, 7, 15, 10, 0)
    ev = spark.createDataFrame([("a", "start", t, "S"), ("a", "end", t, "E")],
                               "log_id string, kind string, event_time timestamp_ntz, status string")
    r = run_state(ev).first()
    assert (r.start_time, r.end_time, r.status) == (t, t, "E")


def test_stream_ingest_takes_each_file_once(spark, workdir):
    rows = [(dt.date(2018, 1, d), 1, 2, Decimal(10), Decimal(10)) for d in (1, 2, 3)]
    df = spark.createDataFrame(rows, "oper_date date, credit_account_rk bigint, debet_account_rk bigint, "
                                     "credit_amount decimal(18,2), debet_amount decimal(18,2)")
    landing, table, ckpt = f"{workdir}/landing", f"{workdir}/ds", f"{workdir}/_ckpt"
    write_delimited(to_source_layout(df, POSTING).coalesce(1), f"{landing}/a", sep=";", mode="overwrite")
    stream_ingest(spark, POSTING, f"{landing}/*", table, ckpt).awaitTermination()
    stream_ingest(spark, POSTING, f"{landing}/*", table, ckpt).awaitTermination()  # nothing new
    assert spark.read.parquet(table).count() == 3
    write_delimited(to_source_layout(df.limit(1), POSTING).coalesce(1), f"{landing}/b", sep=";")
    stream_ingest(spark, POSTING, f"{landing}/*", table, ckpt).awaitTermination()
    back = spark.read.parquet(table)
    assert back.count() == 4
    assert dict(back.dtypes)["oper_date"] == "date"


def test_stream_ingest_keeps_rejected_rows(spark, workdir):
    landing = f"{workdir}/landing"
    spark.sparkContext.parallelize(["h", "05-01-2018;1;2;10;10", "2018-01-05;1;2;10;10", "05-01-2018;;2;1;1"],
                                   1).saveAsTextFile(f"{landing}/a")
    q = stream_ingest(spark, POSTING, f"{landing}/*", f"{workdir}/ds", f"{workdir}/_ckpt",
                      rejects_dir=f"{workdir}/rejects")
    q.awaitTermination()
    assert spark.read.parquet(f"{workdir}/ds").count() == 1
    reasons = sorted(r._reject_reason for r in spark.read.parquet(f"{workdir}/rejects").collect())
    assert reasons == ["bad_date:oper_date", "missing:credit_account_rk"]

"""Delivered files: known ones are not loaded again, columns are found by their names."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.conform import conform
from ledgerline.sources import headers
from ledgerline.sources import register as reg
from ledgerline.sources.specs import EXCHANGE_RATE, POSTING

HEADER = "OPER_DATE;CREDIT_ACCOUNT_RK;DEBET_ACCOUNT_RK;CREDIT_AMOUNT;DEBET_AMOUNT"


def _file(folder, name, *lines, header=HEADER):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")


def _line(day, credit, debit=1, amount="5.00"):
    return f"{day:02d}-01-2018;{credit};{debit};{amount};{amount}"


def _rows(spark, warehouse):
    return sorted(tuple(r)[:3] for r in reg.read_loaded(spark, warehouse, POSTING).collect())


def test_a_file_is_loaded_once_under_any_name(spark, tmp_path):
    landing, wh = tmp_path / "landing", str(tmp_path / "wh")
    lines = [_line(d, c) for d in (1, 2, 2) for c in (10, 11)]
    _file(landing, "ft_posting_f.a.csv", *lines)
    assert reg.ingest_new(spark, str(landing), wh, "one")["ft_posting_f"].count() == 1
    _file(landing, "ft_posting_f.b.csv", *lines[::-1])          # the same rows in another order
    _file(landing, "ft_posting_f.c.csv", *lines, _line(3, 12))  # one row more
    _file(landing, "ft_posting_f.d.csv", *lines, _line(3, 12))  # twice in one delivery
    _file(landing, "ft_posting_f.e.csv")                        # a header only
    taken = reg.ingest_new(spark, str(landing), wh, "two")["ft_posting_f"].collect()
    assert [r.file.rsplit("/", 1)[1] for r in taken] == ["ft_posting_f.c.csv"]
    got = _rows(spark, wh)
    assert len(got) == 13 and got.count((dt.date(2018, 1, 2), 10, 1)) == 4  # equal postings of two files both count
    assert reg.ingest_new(spark, str(landing), wh, "three")["ft_posting_f"].isEmpty()
    assert _rows(spark, wh) == got


def test_a_broken_load_is_repeated_without_loss(spark, tmp_path, monkeypatch):
    landing, wh = tmp_path / "landing", str(tmp_path / "wh")
    _file(landing, "ft_posting_f.a.csv", _line(1, 10), "bad;line")
    monkeypatch.setattr(reg.DeliveryRegister, "record", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        reg.ingest_new(spark, str(landing), wh, "one")
    monkeypatch.undo()
    assert reg.DeliveryRegister(spark, f"{wh}/register/deliveries").entries().isEmpty()
    for _ in range(2):  # the load again, and once more under its name
        reg.ingest_new(spark, str(landing), wh, "one")
        assert _rows(spark, wh) == [(dt.date(2018, 1, 1), 10, 1)]
        assert spark.read.parquet(f"{wh}/rejects/ft_posting_f").count() == 1


def test_digest_tells_contents_apart(spark, tmp_path):
    folder = tmp_path / "landing"
    contents = {"a": [_line(1, 10), _line(1, 10)], "b": [_line(1, 11), _line(1, 11)], "c": [_line(1, 10)],
                "d": ["x;y"], "e": ["y;x"], "f": [_line(1, 10, amount="5.01"), _line(1, 10, amount="4.99")]}
    for name, lines in contents.items():
        _file(folder, f"ft_posting_f.{name}.csv", *lines)
    rows = reg.read_typed(spark, str(folder), POSTING).withColumn(reg.FILE, F.col("_metadata.file_path"))
    found = reg.file_digests(rows, POSTING.columns).collect()
    assert len({r.digest for r in found}) == len(contents)


def test_stream_and_batch_share_the_register(spark, tmp_path):
    from ledgerline.streaming.landing import stream_new

    landing, wh = tmp_path / "landing", str(tmp_path / "wh")
    _file(landing, "ft_posting_f.a.csv", _line(1, 10))
    reg.ingest_new(spark, str(landing), wh, "batch")
    stream_dir = tmp_path / "incoming"
    _file(stream_dir, "x.csv", _line(1, 10))
    _file(stream_dir, "y.csv", _line(2, 20))
    for _ in range(2):
        stream_new(spark, POSTING, str(stream_dir), wh, str(tmp_path / "ckpt"), "stream").awaitTermination()
        shutil.copy(stream_dir / "y.csv", stream_dir / "z.csv")
    assert _rows(spark, wh) == [(dt.date(2018, 1, 1), 10, 1), (dt.date(2018, 1, 2), 20, 1)]


def test_columns_are_matched_by_name(spark, tmp_path):
    folder = tmp_path / "landing"
    _file(folder, "ft_posting_f.1.csv", _line(1, 10))
    _file(folder, "ft_posting_f.2.csv", '20;"note; with sep";02-01-2018;7.5;2;8.5',
          header='credit_account_rk;Note;"Oper_Date";DEBET_AMOUNT;debet_account_rk;credit_amount')
    _file(folder, "ft_posting_f.3.csv", "03-01-2018;30;3;1.5", header="﻿oper_date;credit_account_rk;debet_account_rk;debet_amount")
    _file(folder, "ft_posting_f.4.csv", "40;4;1;1", header="credit_account_rk;debet_account_rk;credit_amount;debet_amount")
    _file(folder, "ft_posting_f.5.csv", "05-01-2018;50;5;1;1;6", "05-01-2018;51;5;1;1", "x;y",
          header=HEADER + ";OPER_DATE")
    (folder / "ft_posting_f.6.csv").write_text("")
    c = conform(headers.read_aligned(spark, str(folder), POSTING), POSTING)
    got = sorted((r.oper_date.day, r.credit_account_rk, r.debet_account_rk, r.credit_amount, r.debet_amount)
                 for r in c.table.collect())
    assert [[None if x is None else float(x) for x in r] for r in got] == [
        [1, 10, 1, 5, 5], [2, 20, 2, 8.5, 7.5], [3, 30, 3, None, 1.5], [5, 50, 5, 1, 1]]
    # a file without a required column; a line with a field less, and one that is none
    reasons = sorted(r._reject_reason for r in c.rejects.collect())
    assert len(reasons) == 3 and reasons[-1] == "missing:oper_date" and all(r.startswith("bad_value") for r in reasons[:2])
    found = {(r.file.rsplit(".", 2)[1], r.kind, r.column) for r in headers.report(spark, str(folder), POSTING).collect()}
    assert {("2", "extra", "note"), ("3", "missing", "credit_amount"), ("4", "missing", "oper_date"),
            ("5", "repeated", "oper_date"), ("2", "moved", "credit_account_rk")} <= found
    assert not any(f == "1" for f, _, _ in found)


def test_header_of_a_file_with_several_splits(spark, tmp_path):
    folder = tmp_path / "landing"
    lines = [f"{k};x;2018-01-01;1.5;2018-01-31" for k in range(4000)]
    _file(folder, "md_exchange_rate_d.csv", *lines,
          header="currency_rk;code_iso_num;data_actual_date;reduced_cource;data_actual_end_date")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        c = conform(headers.read_aligned(spark, str(folder), EXCHANGE_RATE), EXCHANGE_RATE)
        assert c.staged.rdd.getNumPartitions() > 4
        assert c.accepted.count() == 4000 and c.rejects.isEmpty()
        assert {r.currency_rk for r in c.accepted.collect()} == set(range(4000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_no_file_gives_no_rows(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "ft_posting_f.csv").write_text("")
    assert headers.read_aligned(spark, str(tmp_path / "landing"), POSTING).collect() == []


def test_header_scan_does_not_sort_lines(spark, tmp_path):
    folder = tmp_path / "landing"
    _file(folder, "ft_posting_f.1.csv", *[_line(1, n) for n in range(3000)])
    _file(folder, "ft_posting_f.2.csv", "1;2", header="debet_account_rk;credit_account_rk")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        found = headers.header_lines(spark, str(folder))
        got = {r.file.rsplit("/", 1)[1]: r.header for r in found.collect()}
        assert got == {"ft_posting_f.1.csv": HEADER, "ft_posting_f.2.csv": "debet_account_rk;credit_account_rk"}
        assert "Sort" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)

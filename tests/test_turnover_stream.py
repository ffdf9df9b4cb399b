"""Turnover from a stream: equal to the batch, also after breaks, late files and folding."""

import random
from decimal import Decimal

import pytest
from helpers import POSTINGS, D, frame

from ledgerline.operators.turnover import daily_turnover
from ledgerline.streaming import turnover as st

HEADER = "oper_date;credit_account_rk;debet_account_rk;credit_amount;debet_amount"


def _deliver(folder, name, rows):
    folder.mkdir(exist_ok=True)
    lines = [f"{d.strftime('%d-%m-%Y')};{c};{b};{x};{y}" for d, c, b, x, y in rows]
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")


def _postings(seed, n):
    r = random.Random(seed)
    return [(D(2018, r.randint(1, 4), r.randint(1, 28)), r.randint(1, 9), r.randint(1, 9), Decimal(r.randint(1, 99)),
             Decimal(r.randint(1, 99))) for _ in range(n)]


def _sums(df):
    return sorted((r.on_date, r.account_rk, r.credit_amount, r.debet_amount) for r in df.collect())


def _expected(spark, *parts):
    return _sums(daily_turnover(frame(spark, POSTINGS, [r for p in parts for r in p])))


def _run(spark, tmp_path, **options):
    return st.stream_turnover(spark, str(tmp_path / "landing"), str(tmp_path / "mart"), str(tmp_path / "ckpt"), **options)


def test_stream_equals_batch_with_late_files_and_folds(spark, tmp_path):
    parts = [_postings(n, 60) for n in range(5)]
    mart = str(tmp_path / "mart")
    for n, rows in enumerate(parts):
        _deliver(tmp_path / "landing", f"{n}.csv", rows)
        _run(spark, tmp_path).awaitTermination()
        assert _sums(st.read_turnover(spark, mart)) == _expected(spark, *parts[:n + 1])
        if n in (1, 3):  # January and February are quiet, but files for them still come
            before = st.folders(spark, mart)
            st.compact(spark, mart, n, D(2018, 3, 1))
            after = st.folders(spark, mart)
            assert len(after) < len(before) and after == st.live_folders(after)
            assert [x for x in after if x[0] >= D(2018, 3, 1)] == [x for x in before if x[0] >= D(2018, 3, 1)]
            assert _sums(st.read_turnover(spark, mart)) == _expected(spark, *parts[:n + 1])


def test_a_batch_that_breaks_off_is_repeated(spark, tmp_path, monkeypatch):
    first, second = _postings(7, 80), _postings(8, 80)
    mart, write = str(tmp_path / "mart"), st._write
    _deliver(tmp_path / "landing", "1.csv", first)
    _run(spark, tmp_path).awaitTermination()
    _deliver(tmp_path / "landing", "2.csv", second)

    def half(sums, *rest):
        write(sums.where("on_date < DATE'2018-03-01'"), *rest)  # some months stand, the others do not
        raise RuntimeError("killed in the middle of a batch")

    monkeypatch.setattr(st, "_write", half)
    with pytest.raises(Exception, match="killed"):
        _run(spark, tmp_path).awaitTermination()
    monkeypatch.undo()
    _run(spark, tmp_path).awaitTermination()
    assert _sums(st.read_turnover(spark, mart)) == _expected(spark, first, second)
    _run(spark, tmp_path).awaitTermination()  # nothing new
    assert _sums(st.read_turnover(spark, mart)) == _expected(spark, first, second)


def test_left_overs_of_a_broken_fold_do_not_count(spark, tmp_path, monkeypatch):
    parts = [_postings(n, 40) for n in (11, 12)]
    mart = str(tmp_path / "mart")
    for n, rows in enumerate(parts):
        _deliver(tmp_path / "landing", f"{n}.csv", rows)
        _run(spark, tmp_path).awaitTermination()

    class NoDelete:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            if name == "delete":
                raise RuntimeError("killed before the removal")
            return getattr(self.fs, name)

    real = st._fs
    monkeypatch.setattr(st, "_fs", lambda *a: (NoDelete(real(*a)[0]), real(*a)[1]))
    with pytest.raises(RuntimeError, match="killed"):
        st.compact(spark, mart, 1, D(2018, 5, 1))
    monkeypatch.undo()
    found = st.folders(spark, mart)
    assert found != st.live_folders(found)
    assert _sums(st.read_turnover(spark, mart)) == _expected(spark, *parts)
    st.compact(spark, mart, 1, D(2018, 5, 1))
    assert _sums(st.read_turnover(spark, mart)) == _expected(spark, *parts)

"""Run the jobs from a shell or a scheduler task (spark-submit works too):

    python -m ledgerline fill        --landing DIR --warehouse DIR --month 2018-01
    python -m ledgerline restate     --landing DIR --warehouse DIR --month 2018-01 --since 2018-01-20
    python -m ledgerline load-db     --landing DIR --url JDBC_URL [--driver CLASS]
    python -m ledgerline extract     --warehouse DIR --out DIR
    python -m ledgerline load-report --warehouse DIR --csv PATH [--append]
    python -m ledgerline expire      --warehouse DIR [--keep 3]

With ``--versioned`` (fill, restate, extract, load-report) the warehouse is one
whose runs are published as a whole; ``expire`` removes its old versions.

The session comes from ``SparkSession.builder.getOrCreate()``, so master,
memory and ``spark.checkpoint.dir`` are whatever the submitter configured.
Database credentials are read from the environment variables named by
``--user-env`` / ``--password-env``, never from the command line.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys

from pyspark.sql import SparkSession

from ledgerline.model import Period
from ledgerline.plans import pipelines as pl
from ledgerline.sources.publish import Releases


def _period(text: str) -> Period:
    year, month = (int(x) for x in text.split("-"))
    return Period.month(year, month)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="ledgerline")
    sub = ap.add_subparsers(dest="cmd", required=True)
    f = sub.add_parser("fill", help="D1: ingest, turnover, opening, balance, report")
    f.add_argument("--landing", required=True)
    f.add_argument("--warehouse", required=True)
    f.add_argument("--month", required=True, type=_period, help="YYYY-MM")
    s = sub.add_parser("restate", help="D1 after a late delivery: ingest, marts restated from a day on")
    s.add_argument("--landing", required=True)
    s.add_argument("--warehouse", required=True)
    s.add_argument("--month", required=True, type=_period, help="YYYY-MM")
    s.add_argument("--since", required=True, type=dt.date.fromisoformat, help="first day with late postings")
    d = sub.add_parser("load-db", help="D2: landing CSVs into database tables")
    d.add_argument("--landing", required=True)
    d.add_argument("--url", required=True)
    d.add_argument("--driver")
    d.add_argument("--schema", default="ds")
    d.add_argument("--user-env", default="LEDGERLINE_DB_USER")
    d.add_argument("--password-env", default="LEDGERLINE_DB_PASSWORD")
    e = sub.add_parser("extract", help="D3: report table to CSV")
    e.add_argument("--warehouse", required=True)
    e.add_argument("--out", required=True)
    r = sub.add_parser("load-report", help="D4: edited report CSV into the _v2 table")
    r.add_argument("--warehouse", required=True)
    r.add_argument("--csv", required=True)
    r.add_argument("--append", action="store_true", help="add rows instead of replacing the period")
    x = sub.add_parser("expire", help="old versions of a versioned warehouse go")
    x.add_argument("--warehouse", required=True)
    x.add_argument("--keep", type=int, default=3, help="versions that stay")
    for p in (f, s, e, r):
        p.add_argument("--versioned", action="store_true", help="the run's tables are published together at its end")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"ledgerline-{args.cmd}").getOrCreate()
    if args.cmd == "fill":
        run_id = pl.run_fill_procedure(spark, args.landing, args.warehouse, args.month, args.versioned)
        print(run_id)
    elif args.cmd == "restate":
        print(pl.run_restatement(spark, args.landing, args.warehouse, args.month, args.since, args.versioned))
    elif args.cmd == "expire":
        for name in Releases(spark, args.warehouse).expire(args.keep)[1]:
            print(name)
    elif args.cmd == "load-db":
        props = {k: v for k, v in (("driver", args.driver),
                                   ("user", os.environ.get(args.user_env)),
                                   ("password", os.environ.get(args.password_env))) if v}
        for name, table in sorted(pl.load_to_database(spark, args.landing, args.url, props,
                                                      schema=args.schema).items()):
            print(name, table)
    elif args.cmd == "extract":
        wh = pl.open_warehouse(spark, args.warehouse, args.versioned)
        pl.extract_report(spark, wh.read("dm", pl.REPORT_TABLE), args.out, wh.journal())
    else:
        wh = pl.open_warehouse(spark, args.warehouse, args.versioned)
        pl.load_report(spark, args.csv, wh, wh.journal(),
                       mode="append" if args.append else "replace_period")
    return 0


if __name__ == "__main__":
    sys.exit(main())

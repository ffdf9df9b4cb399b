"""Oracle SQL (DuckDB dialect) for every registered query.

The banking views are restated as CTEs over the driver tables, the same
rules as ``sources/fixtures.py``; each query then computes its result the
plain, unoptimised way (full account x day grid, window over everything),
so agreement checks the Spark plan's shortcuts too.
"""

from __future__ import annotations

from ledgerline.model import ACTIVE, DEFAULT_PERIOD, PASSIVE, Period
from ledgerline.sources.fixtures import (LONG_RATE_QUOTES, LONG_RATE_START, LONG_RATE_STEP,
                                         MARKET_SEGMENTS)


def _d(x) -> str:
    return f"DATE '{x.isoformat()}'"


def _versioned(p: Period) -> str:
    """The account view of the queries on several account versions."""
    at = [_d(p.start.fromordinal(p.start.toordinal() + n)) for n in (14, 15, 20)]
    split = f"account_rk % 15 = 0 AND data_actual_date = {_d(p.start)}"
    return f""",
account AS (
  SELECT * FROM account_once WHERE NOT ({split})
  UNION ALL
  SELECT * REPLACE ({at[0]} AS data_actual_end_date) FROM account_once WHERE {split}
  UNION ALL
  SELECT * REPLACE (CASE WHEN account_rk % 2 = 0 THEN {at[2]} ELSE {at[1]} END AS data_actual_date,
                    CASE WHEN account_rk % 45 = 0 THEN '30302' || substr(account_number, 6)
                         ELSE account_number END AS account_number)
  FROM account_once WHERE {split}
)"""


def _overlapping(p: Period) -> str:
    """The account view cut out of overlapping versions: the winner of every day, then runs of days."""
    at = {n: _d(p.start.fromordinal(p.start.toordinal() + n)) for n in (4, 7, 9, 11, 19)}
    several = f"account_rk % 15 = 0 AND data_actual_date = {_d(p.start)}"
    other = f"CASE WHEN char_type = '{ACTIVE}' THEN '{PASSIVE}' ELSE '{ACTIVE}' END"
    return f""",
delivered AS (
  SELECT * FROM account_once
  UNION ALL SELECT * REPLACE ({at[4]} AS data_actual_end_date, '30301' || substr(account_number, 6) AS account_number)
  FROM account_once WHERE {several}
  UNION ALL SELECT * REPLACE ({at[7]} AS data_actual_date, {at[19]} AS data_actual_end_date,
                              '30302' || substr(account_number, 6) AS account_number)
  FROM account_once WHERE {several}
  UNION ALL SELECT * REPLACE ({at[9]} AS data_actual_date, {at[11]} AS data_actual_end_date, {other} AS char_type)
  FROM account_once WHERE {several}
),
delivered_day AS (
  SELECT v.*, CAST(g.d AS DATE) AS day,
         row_number() OVER (PARTITION BY account_rk, g.d ORDER BY data_actual_date DESC, data_actual_end_date,
                            account_number DESC, char_type DESC, currency_rk DESC, currency_code DESC) AS rank
  FROM delivered v, LATERAL (SELECT unnest(generate_series(CAST(v.data_actual_date AS TIMESTAMP),
                             CAST(v.data_actual_end_date AS TIMESTAMP), INTERVAL 1 DAY)) AS d) g
),
account AS (
  SELECT min(day) AS data_actual_date, max(day) AS data_actual_end_date, account_rk, account_number, char_type,
         currency_rk, currency_code
  FROM (SELECT *, day - CAST(row_number() OVER (PARTITION BY account_rk, data_actual_date, data_actual_end_date,
                      account_number, char_type ORDER BY day) AS INTEGER) AS run
        FROM delivered_day WHERE rank = 1) r
  GROUP BY account_rk, account_number, char_type, currency_rk, currency_code, data_actual_date, data_actual_end_date, run
)"""


def views(p: Period, versions: str | None = None) -> str:
    seg = " ".join(f"WHEN '{s}' THEN {30101 + i}" for i, s in enumerate(MARKET_SEGMENTS))
    ccy = "CASE {k} WHEN 0 THEN '643' WHEN 1 THEN '810' ELSE CAST({k} + 100 AS VARCHAR) END"
    prev_end = p.opening.fromordinal(p.opening.toordinal() - 1)
    return f"""
acc_parts AS (
  SELECT c_custkey * 3 AS account_rk, CAST(c_nationkey AS INTEGER) AS currency_rk,
         CASE c_mktsegment {seg} END AS ledger_account,
         CASE WHEN c_acctbal < 0 THEN {_d(p.previous_month_start)} ELSE {_d(p.start)} END AS data_actual_date,
         CASE WHEN c_acctbal < 0 THEN {_d(p.opening)} ELSE {_d(p.end)} END AS data_actual_end_date,
         CAST(c_acctbal AS DECIMAL(18,2)) AS opening_amount
  FROM customer
  UNION ALL
  SELECT s_suppkey * 3 + 1, CAST(s_nationkey AS INTEGER), CAST(30201 + s_nationkey % 5 AS INTEGER),
         {_d(p.start)}, {_d(p.end)}, CAST(s_acctbal AS DECIMAL(18,2))
  FROM supplier
  UNION ALL
  SELECT CAST(n_nationkey AS BIGINT) * 3 + 2, CAST(n_nationkey AS INTEGER),
         CASE WHEN n_nationkey <= 1 THEN 30301 ELSE 30302 END,
         {_d(p.start)}, {_d(p.end)}, CAST((n_nationkey + 1) * 1000 AS DECIMAL(18,2))
  FROM nation
),
{'account_once' if versions else 'account'} AS (
  SELECT data_actual_date, data_actual_end_date, account_rk,
         CAST(ledger_account AS VARCHAR) || code || lpad(CAST(account_rk AS VARCHAR), 12, '0') AS account_number,
         CASE WHEN ledger_account % 2 = 1 THEN '{ACTIVE}' ELSE '{PASSIVE}' END AS char_type,
         currency_rk, code AS currency_code
  FROM (SELECT *, {ccy.format(k='currency_rk')} AS code FROM acc_parts) t
){ {None: lambda p: '', 'versions': _versioned, 'overlapping': _overlapping}[versions](p)},
balance AS (
  SELECT {_d(p.opening)} AS on_date, account_rk, currency_rk, opening_amount AS balance_out
  FROM acc_parts
),
posting AS (
  SELECT CAST(l_shipdate AS DATE) AS oper_date, o_custkey * 3 AS credit_account_rk,
         l_suppkey * 3 + 1 AS debet_account_rk,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS credit_amount,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS debet_amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
rate_raw AS (
  SELECT iv.d0 AS data_actual_date, iv.d1 AS data_actual_end_date, q.k AS currency_rk,
         CAST(CAST((10 + (q.k * 7 + month(iv.d0)) % 50) * 10 + (q.s_suppkey % 4) * 25 AS DECIMAL(10,4)) / 100
              AS DECIMAL(10,4)) AS reduced_cource,
         {ccy.format(k='q.k')} AS code_iso_num
  FROM (SELECT CAST(s_nationkey AS INTEGER) AS k, s_suppkey FROM supplier
        WHERE s_nationkey >= 2 AND s_nationkey % 5 <> 4) q
  CROSS JOIN (VALUES ({_d(p.previous_month_start)}, {_d(prev_end)}),
                     ({_d(p.opening)}, {_d(p.opening)}),
                     ({_d(p.start)}, {_d(p.end)})) iv(d0, d1)
),
rate AS (
  SELECT data_actual_date, data_actual_end_date, currency_rk, reduced_cource, code_iso_num
  FROM (SELECT *, row_number() OVER (PARTITION BY data_actual_date, currency_rk
                                     ORDER BY data_actual_end_date NULLS FIRST,
                                              reduced_cource NULLS FIRST,
                                              code_iso_num NULLS FIRST) AS rn
        FROM rate_raw) r
  WHERE rn = 1
),
ledger AS (
  SELECT DISTINCT ledger_account, 'А' AS chapter,
         CASE WHEN ledger_account % 2 = 1 THEN '{ACTIVE}' ELSE '{PASSIVE}' END AS characteristic
  FROM (SELECT CASE c_mktsegment {seg} END AS ledger_account FROM customer
        UNION ALL SELECT CAST(30201 + n_nationkey % 5 AS INTEGER) FROM nation
        UNION ALL SELECT CASE WHEN n_nationkey <= 1 THEN 30301 ELSE 30302 END FROM nation) l
  WHERE ledger_account IS NOT NULL
),
opening AS (
  SELECT {_d(p.opening)} AS on_date, b.account_rk, b.balance_out,
         b.balance_out * coalesce(er.reduced_cource, 1) AS balance_out_rub
  FROM balance b
  LEFT JOIN rate er ON er.currency_rk = b.currency_rk AND er.data_actual_date = {_d(p.opening)}
  WHERE b.on_date = {_d(p.opening)}
),
valid_account AS (
  SELECT *, greatest(data_actual_date, {_d(p.start)}) AS first_day,
         least(data_actual_end_date, {_d(p.end)}) AS last_day,
         row_number() OVER (PARTITION BY account_rk ORDER BY data_actual_date) = 1 AS is_first,
         row_number() OVER (PARTITION BY account_rk ORDER BY data_actual_date DESC) = 1 AS is_last
  FROM account
  WHERE data_actual_date <= {_d(p.end)} AND data_actual_end_date >= {_d(p.start)}
),
moves AS (
  SELECT oper_date AS on_date, credit_account_rk AS account_rk, credit_amount,
         CAST(0 AS DECIMAL(18,2)) AS debet_amount FROM posting
  UNION ALL
  SELECT oper_date, debet_account_rk, CAST(0 AS DECIMAL(18,2)), debet_amount FROM posting
),
turnover_fx AS (
  SELECT t.on_date, t.account_rk, t.credit_amount,
         t.credit_amount * coalesce(r.reduced_cource, 1) AS credit_amount_rub,
         t.debet_amount, t.debet_amount * coalesce(r.reduced_cource, 1) AS debet_amount_rub
  FROM (SELECT on_date, account_rk, sum(credit_amount) AS credit_amount,
               sum(debet_amount) AS debet_amount
        FROM moves WHERE on_date BETWEEN {_d(p.start)} AND {_d(p.end)}
        GROUP BY on_date, account_rk) t
  JOIN account a ON a.account_rk = t.account_rk
               AND t.on_date BETWEEN a.data_actual_date AND a.data_actual_end_date
  LEFT JOIN rate r ON r.currency_rk = a.currency_rk
               AND t.on_date BETWEEN r.data_actual_date AND coalesce(r.data_actual_end_date, DATE '9999-12-31')
),
spine AS (
  SELECT a.account_rk, a.char_type, CAST(g.d AS DATE) AS on_date
  FROM valid_account a,
       LATERAL (SELECT unnest(generate_series(CAST(a.first_day AS TIMESTAMP),
                                              CAST(a.last_day AS TIMESTAMP), INTERVAL 1 DAY)) AS d) g
),
daily_balance AS (
  SELECT s.on_date, s.account_rk,
         coalesce(o.balance_out, 0) + sum(
           CASE WHEN s.char_type = '{ACTIVE}'
                THEN coalesce(t.debet_amount, 0) - coalesce(t.credit_amount, 0)
                ELSE coalesce(t.credit_amount, 0) - coalesce(t.debet_amount, 0) END)
           OVER (PARTITION BY s.account_rk ORDER BY s.on_date
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS balance_out,
         coalesce(o.balance_out_rub, 0) + sum(
           CASE WHEN s.char_type = '{ACTIVE}'
                THEN coalesce(t.debet_amount_rub, 0) - coalesce(t.credit_amount_rub, 0)
                ELSE coalesce(t.credit_amount_rub, 0) - coalesce(t.debet_amount_rub, 0) END)
           OVER (PARTITION BY s.account_rk ORDER BY s.on_date
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS balance_out_rub
  FROM spine s
  LEFT JOIN opening o ON o.account_rk = s.account_rk
  LEFT JOIN turnover_fx t ON t.account_rk = s.account_rk AND t.on_date = s.on_date
),
form101 AS (
  SELECT {_d(p.start)} AS from_date, {_d(p.end)} AS to_date, l.chapter,
         CAST(l.ledger_account AS VARCHAR) AS ledger_account, l.characteristic,
         {_class_sums('o.balance_out_rub', 'balance_in')},
         {_class_sums('t.deb', 'turn_deb')},
         {_class_sums('t.cre', 'turn_cre')},
         {_class_sums('CASE WHEN a.is_last THEN c.balance_out_rub ELSE 0 END', 'balance_out')}
  FROM valid_account a
  JOIN ledger l ON l.ledger_account = CAST(substr(a.account_number, 1, 5) AS INTEGER)
  LEFT JOIN opening o ON o.account_rk = a.account_rk AND a.is_first
  LEFT JOIN (SELECT v.account_rk, v.first_day, sum(f.debet_amount_rub) AS deb, sum(f.credit_amount_rub) AS cre
             FROM turnover_fx f JOIN valid_account v
               ON v.account_rk = f.account_rk AND f.on_date BETWEEN v.first_day AND v.last_day
             GROUP BY v.account_rk, v.first_day) t
    ON t.account_rk = a.account_rk AND t.first_day = a.first_day
  LEFT JOIN daily_balance c ON c.account_rk = a.account_rk AND c.on_date = a.last_day
  GROUP BY l.chapter, l.ledger_account, l.characteristic
)"""


def _class_sums(v: str, prefix: str) -> str:
    dom = "a.currency_code IN ('643', '810')"
    return (f"CAST(sum(CASE WHEN {dom} THEN {v} ELSE 0 END) AS DOUBLE) AS {prefix}_rub, "
            f"CAST(sum(CASE WHEN NOT ({dom}) THEN {v} ELSE 0 END) AS DOUBLE) AS {prefix}_val, "
            f"CAST(sum({v}) AS DOUBLE) AS {prefix}_total")


FORM101_COLUMNS = (
    "from_date, to_date, chapter, ledger_account, characteristic, "
    "balance_in_rub, balance_in_val, balance_in_total, turn_deb_rub, turn_deb_val, turn_deb_total, "
    "turn_cre_rub, turn_cre_val, turn_cre_total, balance_out_rub, balance_out_val, balance_out_total")


#: Queries over the account view with several versions.
VERSIONED = {"account_versions_balance": "versions", "form101_versions": "versions",
             "account_versions_disjoint": "overlapping", "overlapping_versions_balance": "overlapping"}


def _bodies(p: Period) -> dict[str, str]:
    mid = p.start.replace(day=15)
    return {
        "opening_balance": """
            SELECT on_date, account_rk, CAST(balance_out AS DOUBLE) AS balance_out,
                   CAST(balance_out_rub AS DOUBLE) AS balance_out_rub FROM opening""",
        "opening_balance_as_of": f"""
            SELECT b.on_date, b.account_rk, CAST(b.balance_out AS DOUBLE) AS balance_out,
                   CAST(b.balance_out * coalesce(r.reduced_cource, 1) AS DOUBLE) AS balance_out_rub
            FROM balance b
            LEFT JOIN rate r ON r.currency_rk = b.currency_rk
                 AND b.on_date BETWEEN r.data_actual_date
                                   AND coalesce(r.data_actual_end_date, DATE '9999-12-31')
            WHERE b.on_date = {_d(p.opening)}""",
        "dedupe_rates": """
            SELECT currency_rk, data_actual_date, data_actual_end_date,
                   CAST(reduced_cource AS DOUBLE) AS reduced_cource, code_iso_num FROM rate""",
        "csv_typed_scan": "SELECT * FROM account",
        "csv_string_scan": """
            SELECT strftime(oper_date, '%d-%m-%Y') AS oper_date,
                   CAST(credit_account_rk AS VARCHAR) AS credit_account_rk,
                   CAST(debet_account_rk AS VARCHAR) AS debet_account_rk,
                   CAST(credit_amount AS VARCHAR) AS credit_amount,
                   CAST(debet_amount AS VARCHAR) AS debet_amount FROM posting""",
        "parse_dates": """
            SELECT credit_account_rk, debet_account_rk, oper_date AS d_iso,
                   oper_date AS d_dotted, oper_date AS d_dashed FROM posting""",
        "ingest_row_counts": """
            SELECT 'ft_balance_f' AS table_name, count(*) AS rows_in, count(*) AS rows_out,
                   CAST(0 AS BIGINT) AS rows_rejected FROM balance
            UNION ALL SELECT 'ft_posting_f', count(*), count(*), 0 FROM posting
            UNION ALL SELECT 'md_account_d', count(*), count(*), 0 FROM account
            UNION ALL SELECT 'md_currency_d', count(*), count(*), 0 FROM nation
            UNION ALL SELECT 'md_exchange_rate_d', (SELECT count(*) FROM rate_raw), count(*), 0 FROM rate
            UNION ALL SELECT 'md_ledger_account_s', count(*), count(*), 0 FROM ledger""",
        "ingest_rejects": """
            SELECT 'ft_posting_f' AS table_name, reason, count(*) AS n
            FROM (SELECT CASE (credit_account_rk // 3) % 50
                           WHEN 0 THEN 'bad_date:oper_date' WHEN 1 THEN 'bad_value,missing:credit_account_rk'
                           WHEN 2 THEN 'bad_value' WHEN 3 THEN 'bad_value' WHEN 4 THEN 'bad_value'
                           WHEN 5 THEN 'missing:credit_account_rk' END AS reason FROM posting) p
            WHERE reason IS NOT NULL GROUP BY reason
            UNION ALL
            SELECT 'md_account_d', 'bad_code:char_type', count(*) FROM account
            WHERE account_rk % 21 = 0 HAVING count(*) > 0
            UNION ALL SELECT 'notes.csv', 'unknown_file', 1""",
        "full_refresh": "SELECT * FROM account",
        "dedupe_rows": "SELECT DISTINCT * FROM (SELECT * FROM account UNION ALL SELECT * FROM account) u",
        "mart_day_refresh": f"""
            SELECT on_date, count(*) AS n_rows,
                   CAST(sum(credit_amount) AS DOUBLE) AS credit_amount,
                   CAST(sum(credit_amount_rub) AS DOUBLE) AS credit_amount_rub,
                   CAST(sum(debet_amount) AS DOUBLE) AS debet_amount,
                   CAST(sum(debet_amount_rub) AS DOUBLE) AS debet_amount_rub
            FROM turnover_fx GROUP BY on_date
            -- day {mid.isoformat()} is first written wrong; the opening date's folder ends empty""",
        "date_spine": "SELECT account_rk, on_date FROM spine",
        "daily_turnover": """
            SELECT on_date, account_rk, CAST(sum(credit_amount) AS DOUBLE) AS credit_amount,
                   CAST(sum(debet_amount) AS DOUBLE) AS debet_amount
            FROM moves GROUP BY on_date, account_rk""",
        "turnover_fx": """
            SELECT on_date, account_rk, CAST(credit_amount AS DOUBLE) AS credit_amount,
                   CAST(credit_amount_rub AS DOUBLE) AS credit_amount_rub,
                   CAST(debet_amount AS DOUBLE) AS debet_amount,
                   CAST(debet_amount_rub AS DOUBLE) AS debet_amount_rub FROM turnover_fx""",
        "daily_balance": """
            SELECT on_date, account_rk, CAST(balance_out AS DOUBLE) AS balance_out,
                   CAST(balance_out_rub AS DOUBLE) AS balance_out_rub FROM daily_balance""",
        "ledger_assign": """
            SELECT a.account_rk, l.ledger_account, l.chapter, l.characteristic
            FROM account a JOIN ledger l
              ON l.ledger_account = CAST(substr(a.account_number, 1, 5) AS INTEGER)""",
        "turnover_unmatched": f"""
            SELECT t.on_date, t.account_rk, CAST(t.credit_amount AS DOUBLE) AS credit_amount,
                   CAST(t.debet_amount AS DOUBLE) AS debet_amount
            FROM (SELECT on_date, account_rk, sum(credit_amount) AS credit_amount,
                         sum(debet_amount) AS debet_amount FROM moves
                  WHERE on_date BETWEEN {_d(p.start)} AND {_d(p.end)} GROUP BY on_date, account_rk) t
            WHERE NOT EXISTS (SELECT 1 FROM account a WHERE a.account_rk = t.account_rk
                              AND t.on_date BETWEEN a.data_actual_date AND a.data_actual_end_date)""",
        "accounts_without_ledger": """
            SELECT a.account_rk, a.account_number FROM valid_account a
            WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.ledger_account <> 30103
                              AND CAST(l.ledger_account AS VARCHAR) = substr(a.account_number, 1, 5))""",
        "orphan_balances": f"""
            SELECT b.account_rk, b.currency_rk, CAST(b.balance_out AS DOUBLE) AS balance_out
            FROM balance b
            WHERE b.on_date = {_d(p.opening)}
              AND NOT EXISTS (SELECT 1 FROM valid_account a WHERE a.account_rk = b.account_rk)""",
        "account_versions_balance": """
            SELECT on_date, account_rk, CAST(balance_out AS DOUBLE) AS balance_out,
                   CAST(balance_out_rub AS DOUBLE) AS balance_out_rub FROM daily_balance""",
        "overlapping_versions_balance": """
            SELECT on_date, account_rk, CAST(balance_out AS DOUBLE) AS balance_out,
                   CAST(balance_out_rub AS DOUBLE) AS balance_out_rub FROM daily_balance""",
        "account_versions_disjoint": "SELECT * FROM account",
        # what a full rebuild from all postings gives
        "balance_restated": """
            SELECT on_date, account_rk, CAST(balance_out AS DOUBLE) AS balance_out,
                   CAST(balance_out_rub AS DOUBLE) AS balance_out_rub FROM daily_balance""",
        "turnover_fx_long_rates": f"""
            SELECT t.on_date, t.account_rk, a.currency_rk, CAST(r.reduced_cource AS DOUBLE) AS rate,
                   CAST(t.credit_amount * coalesce(r.reduced_cource, 1) AS DOUBLE) AS credit_amount_rub,
                   CAST(t.debet_amount * coalesce(r.reduced_cource, 1) AS DOUBLE) AS debet_amount_rub
            FROM (SELECT on_date, account_rk, sum(credit_amount) AS credit_amount, sum(debet_amount) AS debet_amount
                  FROM moves GROUP BY on_date, account_rk) t
            JOIN acc_parts a ON a.account_rk = t.account_rk
            LEFT JOIN (
              SELECT k, d0, reduced_cource, coalesce(least(d1, lead(d0) OVER (PARTITION BY k ORDER BY d0) - 1), d1) AS d1
              FROM (SELECT k, d0, coalesce(d1, DATE '9999-12-31') AS d1, reduced_cource,
                           row_number() OVER (PARTITION BY k, d0 ORDER BY d1 NULLS FIRST, reduced_cource) AS rank
                    FROM (SELECT CAST(s_nationkey AS INTEGER) AS k,
                                 DATE '{LONG_RATE_START}' + CAST(n * {LONG_RATE_STEP} + s_suppkey % 2 * 7 AS INTEGER) AS d0,
                                 CASE WHEN n < {LONG_RATE_QUOTES - 1} THEN DATE '{LONG_RATE_START}'
                                   + CAST(n * {LONG_RATE_STEP} + s_suppkey % 2 * 7 + CASE WHEN n % 10 = 9 THEN 5 ELSE 30 END
                                          AS INTEGER) END AS d1,
                                 CAST(CAST((10 + (s_nationkey * 7 + n) % 50) * 10 + (s_suppkey % 4) * 25 AS DECIMAL(10,4))
                                      / 100 AS DECIMAL(10,4)) AS reduced_cource
                          FROM supplier, range({LONG_RATE_QUOTES}) AS q(n)
                          WHERE s_nationkey >= 2 AND s_nationkey % 5 <> 4) quotes) ranked
              WHERE rank = 1) r ON r.k = a.currency_rk AND t.on_date BETWEEN r.d0 AND r.d1""",
        "form101": f"SELECT {FORM101_COLUMNS} FROM form101",
        "landing_redelivered": """
            SELECT oper_date, credit_account_rk, debet_account_rk, CAST(credit_amount AS DOUBLE) AS credit_amount,
                   CAST(debet_amount AS DOUBLE) AS debet_amount FROM posting""",
        "ingest_reordered": """
            SELECT oper_date, credit_account_rk, debet_account_rk,
                   CASE WHEN debet_account_rk % 4 <> 3 THEN CAST(credit_amount AS DOUBLE) END AS credit_amount,
                   CAST(debet_amount AS DOUBLE) AS debet_amount FROM posting""",
        "turnover_stream": """
            SELECT on_date, account_rk, CAST(sum(credit_amount) AS DOUBLE) AS credit_amount,
                   CAST(sum(debet_amount) AS DOUBLE) AS debet_amount
            FROM moves GROUP BY on_date, account_rk""",
        "report_reload": f"SELECT {FORM101_COLUMNS}, CAST(2 AS BIGINT) AS n_rows FROM form101",
        "run_lookup": """
            SELECT CAST(o_orderkey AS VARCHAR) AS log_id, o_orderdate AS start_time,
                   CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY END AS end_time,
                   CASE WHEN o_orderstatus = 'F' THEN 'Finished_etl_process'
                        ELSE 'Started_etl_process' END AS status
            FROM orders WHERE o_orderkey IN (SELECT unnest(range(1, 1000, 7)))""",
        "balance_two_months": f"""
            SELECT s.on_date, s.account_rk,
              CAST(coalesce(o.balance_out, 0) + sum(CASE WHEN s.char_type = '{ACTIVE}'
                THEN coalesce(t.debet_amount, 0) - coalesce(t.credit_amount, 0)
                ELSE coalesce(t.credit_amount, 0) - coalesce(t.debet_amount, 0) END) OVER w AS DOUBLE) AS balance_out,
              CAST(coalesce(o.balance_out_rub, 0) + sum(coalesce(t.rate, 1) * CASE WHEN s.char_type = '{ACTIVE}'
                THEN coalesce(t.debet_amount, 0) - coalesce(t.credit_amount, 0)
                ELSE coalesce(t.credit_amount, 0) - coalesce(t.debet_amount, 0) END) OVER w AS DOUBLE) AS balance_out_rub
            FROM (SELECT account_rk, char_type, CAST(g.d AS DATE) AS on_date FROM valid_account,
                  LATERAL (SELECT unnest(generate_series(CAST({_d(p.start)} AS TIMESTAMP), CAST({_d(p.end)} AS TIMESTAMP)
                           + INTERVAL 28 DAY, INTERVAL 1 DAY)) AS d) g) s
            LEFT JOIN opening o ON o.account_rk = s.account_rk
            LEFT JOIN (SELECT m.on_date, m.account_rk, sum(m.credit_amount) AS credit_amount,
                              sum(m.debet_amount) AS debet_amount, any_value(r.reduced_cource) AS rate
                       FROM moves m JOIN account a ON a.account_rk = m.account_rk
                       LEFT JOIN rate r ON r.currency_rk = a.currency_rk
                            AND m.on_date BETWEEN r.data_actual_date AND r.data_actual_end_date
                       GROUP BY m.on_date, m.account_rk) t
              ON t.account_rk = s.account_rk AND t.on_date = s.on_date
            WINDOW w AS (PARTITION BY s.account_rk ORDER BY s.on_date)""",
        "form101_from_marts": f"SELECT {FORM101_COLUMNS} FROM form101",
        "form101_versions": f"SELECT {FORM101_COLUMNS} FROM form101",
        "report_roundtrip": f"SELECT {FORM101_COLUMNS} FROM form101",
        "run_log_status": """
            SELECT o_orderkey AS log_id, o_orderdate AS start_time,
                   CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY END AS end_time,
                   CASE WHEN o_orderstatus = 'F' THEN 'Finished_etl_process'
                        ELSE 'Started_etl_process' END AS status
            FROM orders""",
        "posting_stream_ingest": """
            SELECT oper_date, credit_account_rk, debet_account_rk,
                   CAST(credit_amount AS DOUBLE) AS credit_amount,
                   CAST(debet_amount AS DOUBLE) AS debet_amount FROM posting""",
    }


def oracle_queries(p: Period = DEFAULT_PERIOD) -> dict[str, str]:
    return {k: f"WITH {views(p, VERSIONED.get(k)).strip()}\n{body.strip()}" for k, body in _bodies(p).items()}

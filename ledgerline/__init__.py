"""ledgerline: a bank-ledger data mart built on Spark DataFrames.

Layers
------
* ``sources``   – declared-schema delimited scans, JDBC, sinks, the table
  registry and the banking views over the driver tables.
* ``functions`` – column-level helpers (date parsing, ledger code, sign
  rule, currency class).
* ``operators`` – DataFrame -> DataFrame building blocks (conform, dedupe,
  FX lookup, turnover, balance roll-forward, form 101, run journal).
* ``plans``     – the composed jobs (pipelines) and the query registry.
* ``streaming`` – incremental ingest of a landing folder.
"""

from ledgerline.model import Period

__all__ = ["Period"]

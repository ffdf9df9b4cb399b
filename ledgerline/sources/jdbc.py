"""JDBC scan and sinks (S5, S6, S7 for databases).

The scan reads in parallel when a numeric ``partition_column`` and its bounds
are given, or evenly without bounds (``read_evenly``); otherwise one task reads
the table, which is only acceptable for small tables. Equality filters on the
result are pushed into the database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import shared_dir


def read_table(spark: SparkSession, url: str, table: str, properties: dict | None = None,
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    props = dict(properties or {})
    if partition_column is not None:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                               upperBound=upper, numPartitions=num_partitions,
                               properties=props)
    return spark.read.jdbc(url, table, properties=props)


# A database takes far fewer concurrent writers than a cluster has tasks:
# Spark coalesces the write to this many connections, each inserting in
# batches.
WRITE_CONNECTIONS = 16
BATCH_ROWS = 10000


def _write_props(properties: dict | None, connections: int, batch_rows: int) -> dict:
    props = dict(properties or {})
    props.setdefault("numPartitions", str(connections))
    props.setdefault("batchsize", str(batch_rows))
    return props


def append_table(df: DataFrame, url: str, table: str, properties: dict | None = None,
                 connections: int = WRITE_CONNECTIONS, batch_rows: int = BATCH_ROWS) -> None:
    df.write.jdbc(url, table, mode="append",
                  properties=_write_props(properties, connections, batch_rows))


def refresh_table(df: DataFrame, url: str, table: str, properties: dict | None = None,
                  connections: int = WRITE_CONNECTIONS, batch_rows: int = BATCH_ROWS) -> None:
    """Full refresh: empty the table and load ``df`` in one Spark write.
    ``truncate`` keeps the table definition (grants, constraints)."""
    (df.write.mode("overwrite").option("truncate", True)
     .jdbc(url, table, properties=_write_props(properties, connections, batch_rows)))


# --- even reads ---------------------------------------------------------------

def split_points(spark: SparkSession, url: str, table: str, column: str, num_partitions: int,
                 properties: dict | None = None, accuracy: int = 10_000) -> list:
    """Keys that cut the table into ``num_partitions`` parts of about equal numbers of rows, in order.

    The smallest and the largest key come from the database; the key column
    alone is then read in equal ranges and its quantiles are taken from a
    sketch that combines across tasks. A key with many rows is one cut, so
    there may be fewer than ``num_partitions - 1``; none for an empty table.
    """
    key = _dialect(spark, url).quoteIdentifier(column)
    ends = spark.read.jdbc(url, f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}) ends",
                           properties=dict(properties or {})).toDF("lo", "hi").first()
    if ends["lo"] is None or num_partitions < 2:
        return []
    keys = read_table(spark, url, table, properties, column, int(ends["lo"]), int(ends["hi"]) + 1, num_partitions)
    shares = [n / num_partitions for n in range(1, num_partitions)]
    found = keys.agg(F.percentile_approx(F.col(column), shares, accuracy).alias("q")).first()["q"]
    return sorted({q for q in found if q < ends["hi"]})


def read_evenly(spark: SparkSession, url: str, table: str, column: str, num_partitions: int,
                properties: dict | None = None) -> DataFrame:
    """The table, read in parallel by ranges of a numeric key that hold about equal numbers of rows.

    Equal-width ranges send most rows of a skewed key to one task; here the
    caller needs no bounds either. Rows without a key are in the first range.
    """
    key = _dialect(spark, url).quoteIdentifier(column)
    cuts = split_points(spark, url, table, column, num_partitions, properties)
    if not cuts:
        return read_table(spark, url, table, properties)
    ranges = [f"{key} <= {cuts[0]} OR {key} IS NULL"]
    ranges += [f"{key} > {a} AND {key} <= {b}" for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    ranges.append(f"{key} > {cuts[-1]}")
    return spark.read.jdbc(url, table, predicates=ranges, properties=dict(properties or {}))


# --- appends that survive retries ---------------------------------------------

ROW = "ledgerline_row"


def _dialect(spark: SparkSession, url: str):
    return spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)


class _Transaction:
    """A database connection of the driver, for statements only; committed as a whole or not at all."""

    def __init__(self, spark: SparkSession, url: str, properties: dict | None):
        jvm = spark.sparkContext._jvm
        props = jvm.java.util.Properties()
        for k, v in (properties or {}).items():
            props.setProperty(k, str(v))
        if (properties or {}).get("driver"):
            jvm.java.lang.Class.forName(properties["driver"])
        self.connection = jvm.java.sql.DriverManager.getConnection(url, props)
        self.connection.setAutoCommit(False)

    def __enter__(self):
        return self

    def __exit__(self, kind, *_):
        try:
            self.connection.commit() if kind is None else self.connection.rollback()
        finally:
            self.connection.close()

    def run(self, sql: str, *values: str) -> int:
        statement = self.connection.prepareStatement(sql)
        try:
            for n, v in enumerate(values, 1):
                statement.setString(n, v)
            return statement.executeUpdate()
        finally:
            statement.close()

    def number(self, sql: str, *values: str) -> int:
        statement = self.connection.prepareStatement(sql)
        try:
            for n, v in enumerate(values, 1):
                statement.setString(n, v)
            found = statement.executeQuery()
            found.next()
            return found.getLong(1)
        finally:
            statement.close()

    def has_table(self, table: str) -> bool:
        schema, _, name = table.upper().rpartition(".")
        found = self.connection.getMetaData().getTables(None, schema or None, name, None)
        try:
            return found.next()
        finally:
            found.close()


def _registered(spark: SparkSession, url: str, register: str, properties: dict | None) -> None:
    with _Transaction(spark, url, properties) as t:
        if not t.has_table(register):
            t.run(f"CREATE TABLE {register} (batch_id VARCHAR(200) NOT NULL PRIMARY KEY, n_rows BIGINT NOT NULL)")


def append_once(df: DataFrame, url: str, table: str, batch: str, properties: dict | None = None,
                replace: tuple[str, ...] = (), connections: int = WRITE_CONNECTIONS,
                batch_rows: int = BATCH_ROWS) -> bool:
    """Append ``df`` to a table as batch ``batch``, exactly once; False if that batch is in it already.

    The rows get numbers and are stored, then Spark writes them to a staging
    table; a task that is repeated may write some of them twice there. The move
    into the table is one transaction of the database: it takes every numbered
    row once, checks that all have arrived and enters the batch into
    ``<table>_batches``, whose key refuses a second entry. Whatever breaks off
    before the commit leaves the table as it was, and the call is repeated
    under the same name. With ``replace`` the rows of the table whose values of
    these columns occur in the batch are removed in the same transaction.
    """
    spark = df.sparkSession
    staging, register = f"{table}_staging", f"{table}_batches"
    _registered(spark, url, register, properties)
    with _Transaction(spark, url, properties) as t:
        if t.number(f"SELECT COUNT(*) FROM {register} WHERE batch_id = ?", batch):
            return False
    path = shared_dir(spark, "jdbc-batch")
    df.withColumn(ROW, F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    expected = rows.count()
    append_table(df.limit(0), url, table, properties)  # creates the table where there is none
    _stage(rows, url, staging, properties, connections, batch_rows)
    quote = _dialect(spark, url).quoteIdentifier
    columns = ", ".join(quote(c) for c in df.columns)
    with _Transaction(spark, url, properties) as t:
        once = f"(SELECT DISTINCT {columns}, {quote(ROW)} FROM {staging})"
        if replace:
            same = " AND ".join(f"s.{quote(c)} = {table}.{quote(c)}" for c in replace)
            t.run(f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {staging} s WHERE {same})")
        moved = t.run(f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {once} once")
        if moved != expected:
            raise RuntimeError(f"{moved} of {expected} rows of batch {batch} are in {staging}")
        t.run(f"INSERT INTO {register} (batch_id, n_rows) VALUES (?, {moved})", batch)
    with _Transaction(spark, url, properties) as t:
        t.run(f"DROP TABLE {staging}")
    return True


def _stage(rows: DataFrame, url: str, staging: str, properties: dict | None, connections: int, batch_rows: int) -> None:
    """Write the numbered rows to the staging table, in place of what an earlier attempt left there.

    Texts get a bounded type of the longest one's length: the move compares rows, and some databases cannot
    compare large objects.
    """
    texts = [c for c, t in rows.dtypes if t == "string"]
    writer = rows.write.mode("overwrite")
    if texts:
        longest = rows.agg(*[F.coalesce(F.max(F.length(c)), F.lit(0)).alias(c) for c in texts]).first()
        writer = writer.option("createTableColumnTypes", ", ".join(f"`{c}` VARCHAR({max(1, longest[c])})" for c in texts))
    writer.jdbc(url, staging, properties=_write_props(properties, connections, batch_rows))

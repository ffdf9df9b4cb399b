"""Register of delivered files: a file that was loaded before, under any name, is not loaded again.

A file is known by its content: the number of its rows and two sums of hashes
over them, which neither the order of rows nor the way a file is split into
tasks changes. The digests are one aggregation that combines map-side, so a
file of any size is never in one task. The register is a table with a folder
per load; a load that is repeated under its name replaces its own entries.
Batch and stream share it.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.conform import REJECT_REASON, accept, reject, stage
from ledgerline.sources.csv import read_typed
from ledgerline.sources.ingest import deliveries
from ledgerline.sources.sinks import _fs, table_path
from ledgerline.sources.specs import RAW_LINE, REGISTRY, TableSpec

#: Column with the file a row came from; partition column of loaded tables.
FILE, LOAD = "_file", "_load"
_ENTRY = "table_name string, file string, digest string, n_rows bigint"


def file_digests(rows: DataFrame, columns: list[str]) -> DataFrame:
    """file, digest, n_rows of every ``FILE`` among rows as read (``columns`` and ``RAW_LINE``)."""
    content = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in (*columns, RAW_LINE)]
    hashed = rows.select(F.col(FILE).alias("file"), F.spark_partition_id().alias("_task"),
                         *[F.xxhash64(F.lit(seed), *content).alias(name) for seed, name in ((1, "a"), (2, "b"))])
    # exact sums in 64 bits: the halves of each hash apart, per file and task of the scan; decimals only across tasks
    halves = {f"{name}_high": F.shiftright(name, 32) for name in "ab"} | {
        f"{name}_low": F.col(name).bitwiseAND(0xFFFFFFFF) for name in "ab"}
    tasks = hashed.groupBy("file", "_task").agg(
        F.count("*").alias("n_rows"), *[F.sum(half).alias(name) for name, half in halves.items()])
    wide = lambda name: F.col(name).cast("decimal(20,0)")
    total = lambda name: F.sum((wide(f"{name}_high") * F.lit(1 << 32).cast("decimal(10,0)") + wide(f"{name}_low"))
                               .cast("decimal(38,0)"))
    found = tasks.groupBy("file").agg(F.sum("n_rows").alias("n_rows"), total("a").alias("a"), total("b").alias("b"))
    return found.select("file", F.concat_ws("-", *[F.col(c).cast("string") for c in ("n_rows", "a", "b")]).alias("digest"),
                        "n_rows")


class DeliveryRegister:
    """The table of loaded files at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def entries(self) -> DataFrame:
        """table_name, file, digest, n_rows and the load that took the file."""
        fs, make = _fs(self.spark, self.path)
        schema = f"{_ENTRY}, {LOAD} string"
        if not fs.exists(make(self.path)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def new_files(self, found: DataFrame, table: str, load: str) -> DataFrame:
        """The rows of ``found`` (file, digest, n_rows) no other load has taken for the table; of files with one
        content among them the first by name."""
        taken = self.entries().where((F.col("table_name") == table) & (F.col(LOAD) != load)).select(
            F.col("digest").alias("_taken"))
        fresh = found.join(taken, F.col("digest") == F.col("_taken"), "left_anti")
        return fresh.groupBy("digest").agg(F.min(F.struct("file", "n_rows")).alias("f")).select(
            "f.file", "digest", "f.n_rows")

    def record(self, files: DataFrame, table: str, load: str) -> None:
        """Enter the files as taken by the load; entering them again replaces them."""
        entry = files.select(F.lit(table).alias("table_name"), "file", "digest", "n_rows")
        entry.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{LOAD}={load}.{table}")


def _write(df: DataFrame, path: str, load: str) -> None:
    df.write.mode("overwrite").parquet(f"{path}/{LOAD}={load}")


def take_new(rows: DataFrame, spec: TableSpec, warehouse: str, load: str) -> DataFrame:
    """Load the rows (as read, with ``FILE``) of files not loaded before; returns those files, stored.

    The rows are parsed once, into a staging folder; digests, accepted and
    rejected rows come from there. Every write replaces the load's own folder
    and the register is written last, so a load that broke off is repeated
    under its name without loss or repetition.
    """
    spark, key = rows.sparkSession, f"{load}.{spec.name}"
    register = DeliveryRegister(spark, table_path(warehouse, "register", "deliveries"))
    staging = table_path(warehouse, "staging", spec.name)
    _write(rows.select(*spec.columns, RAW_LINE, FILE), staging, key)
    raw = spark.read.parquet(f"{staging}/{LOAD}={key}")
    found = register.new_files(file_digests(raw, spec.columns), spec.name, key)
    listed = table_path(warehouse, "staging", f"{spec.name}_files")
    _write(found, listed, key)
    files = spark.read.parquet(f"{listed}/{LOAD}={key}")
    fresh = stage(raw.join(files.select(F.col("file").alias("_new")), F.col(FILE) == F.col("_new"), "left_semi"), spec)
    # independent jobs, submitted together: one fills the cores the other's last tasks leave
    writes = [(accept(fresh, spec), table_path(warehouse, spec.layer, spec.name), load),
              (reject(fresh).select(*spec.columns, RAW_LINE, FILE, REJECT_REASON),
               table_path(warehouse, "rejects", spec.name), load)]
    with ThreadPoolExecutor(max_workers=len(writes)) as pool:
        for f in [pool.submit(_write, *w) for w in writes]:
            f.result()
    register.record(files, spec.name, load)
    fs, make = _fs(spark, staging)
    fs.delete(make(f"{staging}/{LOAD}={key}"), True)
    return files


def read_loaded(spark: SparkSession, warehouse: str, spec: TableSpec) -> DataFrame:
    """The rows of all loads of a table, typed."""
    found = spark.read.parquet(table_path(warehouse, spec.layer, spec.name))
    return found.select(*spec.columns)


def ingest_new(spark: SparkSession, folder: str, warehouse: str, load: str,
               registry: dict[str, TableSpec] = REGISTRY) -> dict[str, DataFrame]:
    """Load what is new in a landing folder; the files taken, by table."""
    paths, _ = deliveries(spark, folder, registry)
    specs = {s.name: s for s in registry.values()}
    out = {}
    for name, found in sorted(paths.items()):
        rows = read_typed(spark, found, specs[name]).withColumn(FILE, F.col("_metadata.file_path"))
        out[name] = take_new(rows, specs[name], warehouse, load)
    return out

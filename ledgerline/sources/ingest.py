"""Folder-driven multi-table ingest.

Every file in the landing folder whose stem names a registered table is
read with that table's declared schema and conformed by its rules. Files
with unknown stems are reported, not fatal. Nothing is read on the driver:
each table is one lazy plan, and the row-count report is one aggregation.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.conform import REJECT_REASON, Conformed, conform
from ledgerline.sources.csv import read_typed
from ledgerline.sources.files import file_stem, list_folder
from ledgerline.sources.specs import REGISTRY, TableSpec


@dataclass
class IngestResult:
    tables: dict[str, Conformed] = field(default_factory=dict)
    unknown: list[str] = field(default_factory=list)

    def counts(self) -> DataFrame:
        """table_name, rows_in, rows_out, rows_rejected (bigint).

        One pass over each file; a table with a dedupe rule needs a second
        pass over its deduped output to count what is kept.
        """
        parts = []
        for name, c in sorted(self.tables.items()):
            rejected = (F.col(REJECT_REASON) != "").cast("bigint")
            deduped = c.spec.drop_identical_rows or bool(c.spec.dedupe_keys)
            kept = F.lit(0).cast("bigint") if deduped else 1 - rejected
            parts.append(c.staged.select(F.lit(name).alias("table_name"),
                                         F.lit(1).cast("bigint").alias("rows_in"),
                                         kept.alias("rows_out"), rejected.alias("rows_rejected")))
            if deduped:
                parts.append(c.table.select(F.lit(name).alias("table_name"),
                                            F.lit(0).cast("bigint").alias("rows_in"),
                                            F.lit(1).cast("bigint").alias("rows_out"),
                                            F.lit(0).cast("bigint").alias("rows_rejected")))
        marks = reduce(DataFrame.unionByName, parts)
        return marks.groupBy("table_name").agg(
            F.sum("rows_in").alias("rows_in"), F.sum("rows_out").alias("rows_out"),
            F.sum("rows_rejected").alias("rows_rejected"))

    def reject_counts(self, spark: SparkSession) -> DataFrame:
        """table_name, reason, n (bigint): rejected rows by reason, and each
        file of no known table with the reason ``unknown_file``."""
        parts = [c.staged.where(F.col(REJECT_REASON) != "").select(
            F.lit(name).alias("table_name"), F.col(REJECT_REASON).alias("reason"))
            for name, c in sorted(self.tables.items())]
        parts += [spark.range(1).select(F.lit(entry).alias("table_name"), F.lit("unknown_file").alias("reason"))
                  for entry in self.unknown]
        return reduce(DataFrame.unionByName, parts).groupBy("table_name", "reason").agg(F.count("*").alias("n"))


def deliveries(spark: SparkSession, folder: str,
               registry: dict[str, TableSpec] = REGISTRY) -> tuple[dict[str, list[str]], list[str]]:
    """Paths by table name, and the entries that belong to no table. All
    files and folders with a table's stem are deliveries of that table."""
    paths: dict[str, list[str]] = {}
    unknown = []
    for entry in list_folder(spark, folder):
        spec = registry.get(file_stem(entry))
        if spec is None:
            unknown.append(entry)
        else:
            paths.setdefault(spec.name, []).append(f"{folder.rstrip('/')}/{entry}")
    return paths, unknown


def ingest_folder(spark: SparkSession, folder: str,
                  registry: dict[str, TableSpec] = REGISTRY) -> IngestResult:
    paths, unknown = deliveries(spark, folder, registry)
    specs = {s.name: s for s in registry.values()}
    return IngestResult({n: conform(read_typed(spark, p, specs[n]), specs[n]) for n, p in paths.items()}, unknown)


def load_detail_store(result: IngestResult, write: Callable[[DataFrame, str, str], None]) -> list[str]:
    """Full refresh of every ingested table and of its reject table, by
    ``write(rows, layer, name)``; the tables written. The writes are
    independent jobs and are submitted together: small dimension loads then
    share the cluster instead of queueing."""
    writes = [w for name, c in result.tables.items()
              for w in ((c.table, c.spec.layer, name), (c.rejects, "rejects", name))]
    with ThreadPoolExecutor(max_workers=max(1, min(len(writes), 8))) as pool:
        for f in [pool.submit(write, *w) for w in writes]:
            f.result()
    return list(result.tables)

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import shared_dir

#: A separator is one of space, \t, \n, \v, \f, \r; a word is a run of anything else.
SPACES = r"[\x20\x09-\x0D]"
#: Runs that differ from a single space; replacing only these equals replacing every run.
_ODD_SPACES = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"


def one_space(text: Column) -> Column:
    """The text with every run of separators replaced by one space; NULL counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _ODD_SPACES, " ")


def word_count(text: Column) -> Column:
    """Number of words, as bigint; 0 for NULL and for texts of separators only."""
    clean = F.trim(one_space(text))
    spaces = F.length(clean) - F.length(F.replace(clean, F.lit(" "), F.lit("")))
    return F.when(clean == "", F.lit(0)).otherwise(spaces + 1).cast("bigint")


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; -1 for a NULL id (it is in no fold)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds, F.lit(-1))


def stored(df: DataFrame, purpose: str, *partition_by: str) -> DataFrame:
    """The frame written as Parquet under the shared checkpoint folder and read back.

    Cuts the lineage with files every executor can read, and gives Spark the
    real size of the result, so later joins are planned by it.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(table: DataFrame) -> None:
    """Remove the files of a table that ``stored`` returned and nothing reads any more."""
    spark = table.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table._stored_at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def numbered(docs: DataFrame, row_col: str, *columns: Column) -> DataFrame:
    """``columns`` of ``docs`` (default: all) with a number per row, stored.

    The number is a column of the files. Numbering each scan anew would not do:
    how a scan is split depends on the cores there are when it is planned.
    """
    return stored(docs.select(*(columns or ["*"]), F.monotonically_increasing_id().alias(row_col)), "numbered")


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores behind it until no column of the frame has it (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor, once per application.

    The archive is a driver's file that Spark itself serves to the executors,
    as ``--py-files`` does; it holds code, no data.
    """
    sc = spark.sparkContext
    if getattr(sc, "_ledgerline_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="ledgerline-code-"), "ledgerline.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(archive)
    sc._ledgerline_shipped = True

"""Folder listing through the session's Hadoop file system (local, HDFS, S3...)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def list_folder(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries directly inside ``folder`` (files and folders),
    hidden entries (``_``/``.``) skipped. Metadata only: no data is read."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(path)]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def file_stem(name: str) -> str:
    """Table name of a landed file: the part before the first dot."""
    return name.split(".", 1)[0]

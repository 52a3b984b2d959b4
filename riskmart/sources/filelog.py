"""Which raw files have been taken in: each is parsed once, and again only when it has changed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.sources import readers, writers

LOG_SCHEMA = "table string, file string, length bigint, modified bigint"
# The raw file a landed row comes from.
SOURCE = "source_file"


@dataclass(frozen=True)
class RawFile:
    """A file, or a folder of part files, with what tells its states apart."""

    path: str
    length: int
    modified: int


def listed(spark: SparkSession, pattern: str) -> list[RawFile]:
    """The files a path or glob names; a folder stands for the files in it. No file is opened."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in system.globStatus(path) or []:
        parts = list(system.listStatus(status.getPath())) if status.isDirectory() else [status]
        hidden = ("_", ".")
        data = [p for p in parts if p.isFile() and not p.getPath().getName().startswith(hidden)]
        if data:
            length = sum(p.getLen() for p in data)
            found.append(RawFile(status.getPath().toString(), length, max(p.getModificationTime() for p in data)))
    return sorted(found, key=lambda f: f.path)


def changed(spark: SparkSession, log: str, table: str, files: Sequence[RawFile]) -> list[RawFile]:
    """Those of ``files`` that ``table`` has not taken in as they are now."""
    rows = readers.read_table(spark, log, LOG_SCHEMA).where(F.col("table") == table)
    known = {(r["file"], r["length"], r["modified"]) for r in rows.collect()}
    return [f for f in files if (f.path, f.length, f.modified) not in known]


def record(spark: SparkSession, log: str, table: str, files: Sequence[RawFile]) -> None:
    """Note files as taken in; written after their rows, so that a lost run takes them again."""
    rows = spark.createDataFrame([(table, f.path, f.length, f.modified) for f in files], LOG_SCHEMA)
    writers.append_rows(rows.coalesce(1), log)


def with_source(df: DataFrame) -> DataFrame:
    """The rows of a file scan with the file each comes from."""
    return df.withColumn(SOURCE, F.col("_metadata.file_path"))

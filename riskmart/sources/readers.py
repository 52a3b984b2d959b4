"""Readers of raw extracts, partitioned tables and one-file-per-month folders."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.schemas import MONTH


def read_text_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, multiline: bool = False
) -> DataFrame:
    """CSV with a header, every column as text; quotes inside a value are doubled.

    With a ``schema`` the header is checked against its names. ``multiline`` allows line breaks
    inside values; such a file is read by one task, so it is off by default.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on whatever file system the path names."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def beside(path: str, mark: str) -> str:
    """Where a table that replaces the one at ``path``, or was replaced, lies for the time being."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{mark}_{name}"


def settle(spark: SparkSession, path: str) -> None:
    """Finish the switch of a table that a lost driver left half done.

    The old table is moved away only when the new one is whole, so the new one takes its place.
    """
    old, new, here = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (beside(path, "old"), beside(path, "new"), path))
    system = here.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(old):
        return
    if not system.exists(here) and not system.rename(new, here):
        raise OSError(f"cannot move {new} to {here}")
    system.delete(old, True)


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame | None:
    """A Parquet table; when it is absent or has no files an empty frame of ``schema``, or None without one."""
    settle(spark, path)
    if path_exists(spark, path):
        try:
            return spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
    return None if schema is None else spark.createDataFrame([], schema)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a table's first partition column, from the names of its folders; no file is opened."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    names = [s.getPath().getName() for s in system.listStatus(folder) if s.isDirectory()]
    return sorted(n.removeprefix(f"{column}=") for n in names if n.startswith(f"{column}="))


def month_partitions(spark: SparkSession, path: str) -> list[dt.date]:
    """Months a partitioned table holds, from the names of its folders; no file is opened."""
    return [dt.date.fromisoformat(d) for d in partition_values(spark, path, MONTH) if d[:1].isdigit()]


def latest_month(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of a partitioned table's latest month; None when it has none. Other months are not read."""
    months = month_partitions(spark, path)
    return in_months(spark.read.parquet(path), months[-1:]) if months else None


def in_months(df: DataFrame, months: Sequence[dt.date]) -> DataFrame:
    """Rows of the listed months, as literals, so that only their partitions are read."""
    return df.where(F.col(MONTH).isin(list(months)) if months else F.lit(False))


def read_month_files(spark: SparkSession, folder: str, prefix: str, paths: Sequence[str] = ()) -> DataFrame:
    """Files named ``<prefix>YYYY_MM_DD.parquet`` as one table with ``snapshot_date``; only ``paths``, if given.

    Files whose name holds no date are left out.
    """
    files = spark.read.parquet(*(paths or [f"{folder.rstrip('/')}/{prefix}*.parquet"]))
    tag = F.regexp_extract(F.col("_metadata.file_path"), rf"{prefix}(\d{{4}}_\d{{2}}_\d{{2}})\.parquet", 1)
    dated = files.withColumn(MONTH, F.try_to_date(tag, "yyyy_MM_dd"))
    return dated.where(F.col(MONTH).isNotNull())

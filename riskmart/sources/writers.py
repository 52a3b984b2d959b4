"""Writers: monthly partitions, static tables and append-only logs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.schemas import MONTH
from riskmart.sources.readers import beside, path_exists, settle

# Partition column of tables by model version; its text is never taken for a number.
VERSION_KEY = "version_key"


def write_months(df: DataFrame, path: str, month: str = MONTH) -> None:
    """Write monthly partitions, replacing only the months that are in ``df``.

    The rebalance hint gathers small months into few files and lets adaptive execution
    split a large month over several tasks.
    """
    (
        df.hint("rebalance", month)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(month)
        .parquet(path)
    )


def write_version(df: DataFrame, path: str, version: str) -> None:
    """Write all rows of one model version, replacing those of an earlier training of that version."""
    rows = df.withColumns({"model_version": F.lit(version), VERSION_KEY: F.concat(F.lit("version "), F.lit(version))})
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(VERSION_KEY)
        .parquet(path)
    )


def write_version_months(df: DataFrame, path: str, version: str, month: str = MONTH) -> None:
    """Write months of one model version, replacing only those."""
    rows = df.withColumns({"model_version": F.lit(version), VERSION_KEY: F.concat(F.lit("version "), F.lit(version))})
    (
        rows.hint("rebalance", month)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(VERSION_KEY, month)
        .parquet(path)
    )


def switch(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Replace what is at ``path`` by what ``write`` puts into the folder it is given.

    The new table is written whole beside the old one and then takes its place by two renames. A driver
    lost before them leaves the old table; one lost between them leaves a switch that ``settle``
    finishes. Needs a file system that renames folders at once, such as HDFS or a local one.
    """
    settle(spark, path)
    write(beside(path, "new"))
    old, new, here = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (beside(path, "old"), beside(path, "new"), path))
    system = here.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(here) and not system.rename(here, old):
        raise OSError(f"cannot move {here} to {old}")
    if not system.rename(new, here):
        raise OSError(f"cannot move {new} to {here}")
    system.delete(old, True)


def write_static(df: DataFrame, path: str, if_absent: bool = False, by: Sequence[str] = ()) -> bool:
    """Write a whole table, switched in at once; with ``if_absent`` an existing one is kept. Says if it wrote."""
    spark = df.sparkSession
    settle(spark, path)
    if if_absent and path_exists(spark, path):
        return False
    switch(spark, path, lambda new: df.write.mode("overwrite").partitionBy(*by).parquet(new))
    return True


def append_new(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Append the rows whose keys are not in the table yet, so a rerun adds nothing."""
    spark = df.sparkSession
    fresh = df.dropDuplicates(list(keys))
    if path_exists(spark, path):
        fresh = fresh.join(spark.read.parquet(path).select(*keys), list(keys), "left_anti")
    fresh.write.mode("append").parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Append to a log."""
    df.write.mode("append").parquet(path)


def write_json_document(df: DataFrame, path: str) -> None:
    """A small frame as JSON lines, one file, switched in at once."""
    switch(df.sparkSession, path, lambda new: df.coalesce(1).write.mode("overwrite").json(new))

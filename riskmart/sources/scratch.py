"""Intermediate tables in the shared folder: written once, read by any executor, dropped when done.

A table cut from its lineage this way survives the loss of executors and is read back with
column pruning. Everything an application has left is removed when its driver ends.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

_folders: dict[str, str] = {}
_open: list[list[DataFrame]] = []


def shared_folder(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``; a temporary one only in local mode."""
    context = spark.sparkContext
    application = context.applicationId
    if application not in _folders:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            root = tempfile.mkdtemp(prefix="riskmart-")
        _folders[application] = f"{root.rstrip('/')}/riskmart-{application}"
        atexit.register(_remove_at_exit, spark, _folders[application])
    return _folders[application]


@contextmanager
def temporary():
    """Drop what is kept in this block when it ends, but for tables kept as ``lasting``."""
    _open.append([])
    try:
        yield
    finally:
        drop(*_open.pop())


def keep(df: DataFrame, name: str = "table", lasting: bool = False) -> DataFrame:
    """Compute ``df`` once, write it as Parquet and continue from there.

    A lasting table belongs to the block around the innermost ``temporary`` one.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._scratch_path = path
    scopes = _open[:-1] if lasting else _open
    if scopes:
        scopes[-1].append(kept)
    return kept


def drop(*tables: DataFrame) -> None:
    """Remove tables made by ``keep`` that no later result reads; again does nothing."""
    for table in tables:
        remove_folder(table.sparkSession, table._scratch_path)


def remove_folder(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    try:
        remove_folder(spark, path)
    except (Py4JError, OSError, AttributeError):
        pass  # the session has ended before the interpreter

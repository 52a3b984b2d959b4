"""Session settings the plans are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The JVM never compiles a method above 8000 bytes of bytecode, so a generated stage beyond
# it would be interpreted. With this limit Spark splits such a stage into smaller methods.
JIT_METHOD_LIMIT = 8000

RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": str(JIT_METHOD_LIMIT),
    # Batches for Python workers: rows may hold whole texts.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; results do not depend on them."""
    for name, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(name) != value:
            spark.conf.set(name, value)
    return spark

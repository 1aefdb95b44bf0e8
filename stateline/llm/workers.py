"""What Python workers need: this package on their path, and batches that fit their memory."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

#: Texts reach the workers in Arrow batches of at most this many bytes, or one row.
BATCH_BYTES = 8 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Memory that large arrays leave goes back to the system at once: workers live long and are many.
MEMORY = {"MALLOC_MMAP_THRESHOLD_": "262144", "MALLOC_TRIM_THRESHOLD_": "262144", "MALLOC_ARENA_MAX": "2", "ARROW_DEFAULT_MEMORY_POOL": "system"}

ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> SparkSession:
    """Prepares a session for the operators: bounds its batches and the workers' memory, and adds the package to their path.

    On a cluster ship the package (``--py-files``) or install it; the folder is then merely not there.
    """
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), ROOT])
    for name, value in MEMORY.items():
        env.setdefault(name, value)
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    return spark

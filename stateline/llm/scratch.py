"""Tables in the scratch folder whose making leaves no shuffle files behind."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stateline.session import scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def landed(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the scratch folder: what made it runs once, whatever reads it later.

    Lost executors cost a re-read. The shuffle files of the run are deleted at its end, when nothing
    needs them any more, instead of whenever the driver happens to collect its garbage: disks hold one
    step of a chain at a time.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)

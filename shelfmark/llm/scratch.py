"""Tables that cut lineage, written below the folder the cluster shares in ``spark.checkpoint.dir``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by the session; unset is an error, since no local folder is safe on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and every executor share")
    return folder.rstrip("/")


def _folder(spark: SparkSession) -> str:
    """This application's own part of the shared folder."""
    return f"{shared_dir(spark)}/shelfmark-llm/{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, path: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return the written rows: lost executors can neither recompute nor change them.

    What was shuffled for the write is garbage afterwards; the driver collects it at once, so that jobs do not add up on disk."""
    spark = df.sparkSession
    path = f"{_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    spark.sparkContext._jvm.System.gc()
    written = spark.read.schema(df.schema).parquet(path)
    written._staged_at = path
    return written


def discard(*written: DataFrame) -> None:
    """Delete staged tables whose last reader has itself been written; only the frames that ``stage`` returned can be given."""
    for df in written:
        _delete(df.sparkSession, df._staged_at)


def clear(spark: SparkSession) -> None:
    """Delete every staged table of this application; call it when a job's own output has been written."""
    _delete(spark, _folder(spark))

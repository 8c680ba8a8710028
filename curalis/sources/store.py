"""Intermediate tables in a folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """A new folder in ``spark.checkpoint.dir``; only where that is unset and all runs on this machine, one of this
    machine.  It goes when the driver's JVM ends."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if not shared and master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    at = f"{shared.rstrip('/')}/files-{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix="curalis-")
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(where)
    store.deleteOnExit(where)
    return at


def written(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet and read back: what it took is not computed again, and a row has a place
    (``_metadata.file_name`` and ``_metadata.row_index``) that every reader sees alike."""
    path = f"{folder(df.sparkSession)}/rows.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

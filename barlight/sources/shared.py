"""New paths in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_path(spark: SparkSession) -> str:
    """A path of its own below spark.checkpoint.dir. Where that is unset: on one machine a temporary folder; a cluster must name one."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="barlight-")
    return f"{folder}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder, for what is read more than once; the job clears the folder when it ends."""
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, path: str) -> None:
    """Removes a table in the shared folder that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)

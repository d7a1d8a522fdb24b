"""Cutting lineage in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: A bucket of hashes stands for so many bytes of documents; there are 2 ** LEAST_BITS at least.
BUCKET_BYTES, LEAST_BITS, MOST_BITS = 1 << 16, 12, 26


def bucket_bits(docs: DataFrame) -> int:
    """Bits that number the buckets which docs are dealt to: their count follows the size of docs as planned."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size >= 1 << 60:  # rows of the session itself: not known, and few
        return LEAST_BITS
    return min(max((size // BUCKET_BYTES).bit_length(), LEAST_BITS), MOST_BITS)


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Where it is unset: a folder of our own, on one machine; a cluster must name one."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir")
    if not folder:
        if sc.getCheckpointDir() is None:
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="barlight-"))
        folder = sc.getCheckpointDir()
    return folder


def kept(df: DataFrame, *partitions: str) -> DataFrame:
    """df computed now, as Parquet in the shared folder: read from there when executors are lost. partitions: columns to write it by.

    Unlike a checkpoint of rows this is read by column, and its size, which joins are planned by, is
    the real one, however many steps led to it. The folder is the job's to clear when it ends.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.partitionBy(*partitions).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Tables written between the rounds of iterative operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share; our own where it is unset on one machine, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp" if os.path.isdir("/tmp") else None)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write and read again, so that a round's plan doesn't hold all earlier rounds and a lost executor costs one round."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def discard(df: DataFrame) -> None:
    """Remove a stored() table that nothing reads any more, as a round's when the next one is written."""
    path = vars(df).pop("stored_path", None)
    if path:
        spark = df.sparkSession
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)

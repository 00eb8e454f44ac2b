"""Tables that cut lineage, in the folder that the cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not top:
        import tempfile

        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")

        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lattix-"))
        top = spark.sparkContext.getCheckpointDir()
    return f"{top.rstrip('/')}/lattix-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The frame, computed once; it outlives the loss of any executor. Its folder goes when the session ends."""
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).deleteOnExit(path)
    return df.sparkSession.read.schema(df.schema).parquet(folder)

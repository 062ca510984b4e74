"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``; a temporary one only where that is unset on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        context = spark.sparkContext._jsc.sc()
        if context.getCheckpointDir().isEmpty():
            if not re.match(r"local(\[|$)", spark.sparkContext.master):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="offerloom-"))
        found = context.getCheckpointDir().get()
    return found.rstrip("/")


def materialize(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read back: lineage ends here, so a
    lost executor costs no recomputation. The folder is removed when the application ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/offerloom-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", codec).parquet(path)
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path.getParent())
    return spark.read.schema(df.schema).parquet(path)

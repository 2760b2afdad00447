"""Intermediate tables in the shared checkpoint folder of the cluster."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where it is unset, a new temporary folder
    is taken and set if driver and executors are one process, and else that is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        done = spark.sparkContext._jsc.sc().getCheckpointDir()
        if done.isDefined():
            path = done.get()
        else:
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            path = tempfile.mkdtemp(prefix="warpline-")
            spark.sparkContext.setCheckpointDir(path)
            path = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return path.rstrip("/")


def shared_table(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Write df as Parquet to the shared folder and read it again.  That cuts
    the lineage, and the files outlive any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/warpline-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_shared(df: DataFrame) -> None:
    """Delete the files of a table that shared_table() made, once no plan reads it."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/warpline-" in name:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)

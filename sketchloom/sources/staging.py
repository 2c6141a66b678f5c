"""Tables written between the steps of an operator, and small inputs dealt to all cores."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset a folder of our own on a local master, else an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        kept = spark.sparkContext._jsc.sc().getCheckpointDir()
        if kept.isDefined():
            path = kept.get()
        elif re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            path = tempfile.mkdtemp(prefix="sketchloom-")
            spark.sparkContext.setCheckpointDir(path)
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return path.rstrip("/")


def staged(df: DataFrame, name: str, spent: bool = False) -> DataFrame:
    """df as a table in the shared folder, so that several readers compute it once. With `spent` the shuffle files of its plan go when it is written."""
    spark, key = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path = f"{shared_dir(spark)}/sketchloom/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(key, None)
    if spent:
        spark.conf.set(key, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if spent:
            spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes tables of `staged` that nothing reads any more."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table._staged_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def dealt(df: DataFrame, small: int = 1 << 30) -> DataFrame:
    """df dealt to all cores where its files are smaller than `small` bytes; larger inputs stay as they are split.

    A small table often is one row group, which one task would read and work on alone.
    """
    if df.isStreaming:
        return df
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size < small else df

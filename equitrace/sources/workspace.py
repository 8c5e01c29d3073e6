"""Shared folder for tables that cut a plan in two."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    Where that is unset, a local session takes a folder in its warehouse; on a cluster a folder that
    only one machine sees would lose rows, so the job stops instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"
    return base.rstrip("/")


def session_dir(spark: SparkSession) -> str:
    """Where this session's staged tables lie; drop_staged removes it."""
    return f"{shared_dir(spark)}/equitrace/{spark.conf.get('spark.app.id', 'app')}"


def drop_staged(spark: SparkSession) -> None:
    """Remove every table this session has staged; call it when no result that reads them is left."""
    path = spark._jvm.org.apache.hadoop.fs.Path(session_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder once and read it back.

    Used where a costly table is read more than once: the scan behind it runs one time, its
    readers prune columns, and Spark knows its size when it picks a join. The files outlive
    any executor.
    """
    spark = df.sparkSession
    path = f"{session_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

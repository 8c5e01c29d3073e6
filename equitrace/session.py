"""Session settings: what a cluster job and the local tests share."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Adaptive plans with skew splitting; UTC dates; Arrow between JVM and Python."""
    return (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )


def local_session(name: str, cores: int = 8) -> SparkSession:
    """One JVM for tests and the benchmark; its Python workers find this library from any folder."""
    spark = (
        configure(SparkSession.builder.master(f"local[{cores}]").appName(name))
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "8g")
        .config("spark.executorEnv.PYTHONPATH", str(Path(__file__).resolve().parent.parent))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark

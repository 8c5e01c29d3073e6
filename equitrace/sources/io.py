"""Readers and writers of a refresh."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# One folder per stage of a refresh.
STAGES = (
    "raw_input_data",
    "processed_input_data",
    "data_prep",
    "cfa",
    "weights_model",
    "pillar_creation",
    "trend_pillar",
    "importance_model",
    "scaled_scores",
    "pillar_importances",
    "scorecard",
    "updated_scorecard",
)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header and a declared schema: no inference pass, no type drift."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_harmonised(
    spark: SparkSession, grain: str, views: dict[str, str], database: str | None = None
) -> DataFrame:
    """The harmonised metric view of a grain; the caller names the view of each grain."""
    view = views[grain]
    return spark.table(f"{database}.{view}" if database else view)


def load_and_clean(
    df: DataFrame,
    date_cols: Sequence[str] = (),
    drop_cols: Sequence[str] = (),
    year_col: str | None = None,
    month_col: str | None = None,
) -> DataFrame:
    """Drop listed columns where present, build `date` from year and month, parse dates."""
    out = df.drop(*drop_cols)
    if year_col in out.columns and month_col in out.columns:
        out = out.withColumn(
            "date", F.make_date(F.col(year_col).cast("int"), F.col(month_col).cast("int"), F.lit(1))
        )
    return out.withColumns({c: F.to_date(F.col(c)) for c in date_cols})


def iso_date(df: DataFrame, col: str = "date") -> DataFrame:
    """ISO timestamps as text: keep what stands before the 'T'."""
    return df.withColumn(col, F.to_date(F.split_part(F.col(col).cast("string"), F.lit("T"), F.lit(1))))


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def refresh_month(today: dt.date) -> dt.date:
    """A refresh is filed under the first of its month."""
    return today.replace(day=1)


def write_stage(
    df: DataFrame,
    root: str,
    stage: str,
    table: str,
    refresh: dt.date,
    partition_by: Sequence[str] = ("category",),
) -> str:
    """One folder per stage and table, partitioned by refresh date and then by `partition_by`."""
    if stage not in STAGES:
        raise ValueError(f"unknown stage {stage!r}")
    path = f"{root}/{stage}/{table}"
    (
        df.withColumn("refresh_date", F.lit(refresh.isoformat()).cast("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("refresh_date", *partition_by)
        .parquet(path)
    )
    return path


def read_stage(spark: SparkSession, root: str, stage: str, table: str, refresh: dt.date) -> DataFrame:
    """One refresh of a stage table; only that refresh's folder is listed and read."""
    return (
        spark.read.parquet(f"{root}/{stage}/{table}")
        .where(F.col("refresh_date") == F.lit(refresh))
        .drop("refresh_date")
    )


def read_stored_weights(spark: SparkSession, root: str, refresh: dt.date) -> DataFrame:
    """Weights sheet of an earlier refresh, for scoring without learning."""
    return read_stage(spark, root, "pillar_creation", "weights_sheet", refresh).select(
        "category", "pillar", "metric", "weight"
    )

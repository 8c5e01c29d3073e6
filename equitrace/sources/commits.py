"""Refreshes that appear whole or not at all.

Every run of a refresh writes its tables to folders of its own, `<root>/<stage>/<table>/refresh_date=D/attempt=A`,
and at its end appends one row to `<root>/commits` that names them all. Readers look up that row first, so

* a run that dies leaves the refresh as the run before it committed it, never a mix of two;
* a category that a re-run no longer has is gone, since nothing of an older attempt is read;
* the schema is declared from the row: no inference, no type drift of partition values, and a table of no
  rows reads as a table of no rows.

One run at a time is meant to commit a refresh. If two do, one of them wins with all its tables.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from equitrace.sources.io import STAGES

COMMIT = "refresh_date date, seq long, attempt string, tables map<string, struct<path: string, schema: string>>"


def commits(spark: SparkSession, root: str) -> DataFrame:
    """All committed attempts, one row each; an empty table before the first commit."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/commits")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], COMMIT)
    return spark.read.schema(COMMIT).parquet(f"{root}/commits")


def current(spark: SparkSession, root: str, refresh: dt.date):
    """The row that a refresh stands by (one row, as long as the list of tables), or None."""
    return (
        commits(spark, root)
        .where(F.col("refresh_date") == F.lit(refresh))
        .orderBy(F.desc("seq"), F.desc("attempt"))
        .first()
    )


@dataclass
class Attempt:
    """One run of a refresh; nothing it writes is seen before `commit`."""

    spark: SparkSession
    root: str
    refresh: dt.date
    name: str = field(default_factory=lambda: uuid.uuid4().hex[:12])
    tables: dict[str, tuple[str, str]] = field(default_factory=dict)

    def write(self, df: DataFrame, stage: str, table: str, partition_by: Sequence[str] = ("category",)) -> DataFrame:
        """Write a table of this attempt and read it back."""
        if stage not in STAGES:
            raise ValueError(f"unknown stage {stage!r}")
        if f"{stage}/{table}" in self.tables:
            raise ValueError(f"{stage}/{table} is already written")
        path = f"{self.root}/{stage}/{table}/refresh_date={self.refresh.isoformat()}/attempt={self.name}"
        df.write.mode("error").partitionBy(*partition_by).parquet(path)
        self.tables[f"{stage}/{table}"] = (path, df.schema.json())
        return _open(self.spark, path, df.schema)

    def commit(self, carry_over: bool = False) -> None:
        """Make the attempt the refresh. `carry_over` keeps the tables of the attempt before that it did not write."""
        before = current(self.spark, self.root, self.refresh)
        tables = dict(self.tables)
        if before is not None and carry_over:
            tables = {name: (t["path"], t["schema"]) for name, t in before["tables"].items()} | tables
        seq = 1 if before is None else before["seq"] + 1
        row = self.spark.createDataFrame([(self.refresh, seq, self.name, tables)], COMMIT)
        # one row, so one file, and a file appears whole
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/commits")

    def discard(self) -> None:
        """Remove what an attempt wrote that is not to be committed."""
        named = commits(self.spark, self.root).select(F.explode(F.map_values("tables")).alias("t")).select("t.path")
        if not named.where(F.col("path").isin([path for path, _ in self.tables.values()])).isEmpty():
            raise ValueError("the attempt is committed")
        for path, _ in self.tables.values():
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        self.tables.clear()


def _open(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_table(spark: SparkSession, root: str, stage: str, table: str, refresh: dt.date) -> DataFrame:
    """A table of the committed attempt of a refresh; only that attempt's folder is listed."""
    row = current(spark, root, refresh)
    if row is None:
        raise LookupError(f"no committed refresh {refresh.isoformat()}")
    if f"{stage}/{table}" not in row["tables"]:
        raise LookupError(f"refresh {refresh.isoformat()} has no table {stage}/{table}")
    found = row["tables"][f"{stage}/{table}"]
    return _open(spark, found["path"], StructType.fromJson(json.loads(found["schema"])))

"""Neighbours in the order of a key over a whole table, without one global window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from equitrace.sources.workspace import stage

#: rows a range should hold
RANGE_ROWS = 20_000


def next_below(ids: DataFrame, key: str, values: list[str]) -> DataFrame:
    """key, values and next_<value> of the row with the next smaller key; the smallest gets the largest's.

    Rows are range-partitioned by key and numbered within their range; only the edge rows of the ranges
    meet in one window, so that window grows with the number of ranges and not with the rows. Nulls are
    the smallest keys; equal keys follow each other in the order of the values.
    """
    n = ids.count()
    ranges = max(1, -(-n // RANGE_ROWS))
    sort = [F.col(key).desc_nulls_last(), *[F.col(v).desc_nulls_last() for v in values]]
    placed = stage(
        ids.select(key, *values).repartitionByRange(ranges, *sort).withColumn("part", F.spark_partition_id()), "order"
    )
    here = Window.partitionBy("part").orderBy(*sort)
    line = F.struct(key, *values)
    rows = placed.withColumn("below", F.lead(line).over(here)).withColumn("first", F.row_number().over(here) == 1)
    rows = stage(rows, "order-lead")
    tops = rows.where("first").select("part", line.alias("top"))
    ring = Window.orderBy("part")
    head = F.first("top").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    edge = tops.select("part", F.coalesce(F.lead("top").over(ring), head).alias("up"))
    out = rows.where("below is not null").drop("part", "first").unionByName(
        rows.where("below is null").join(edge, "part").select(key, *values, F.col("up").alias("below"))
    )
    return out.select(key, *values, *[F.col("below")[v].alias(f"next_{v}") for v in [key, *values]])

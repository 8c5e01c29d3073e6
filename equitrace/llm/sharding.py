"""Extendible hashing: a directory over hash-prefix bits in which only oversized buckets split.

A row's key hash gives its first 60 bits; rows of one key that still exceed the limit split on 60
more bits of a hash of the whole row, and rows that are alike in every column are dealt out by their
running bytes. A shard exceeds the limit only if a single row does, and then holds that row alone or
with rows of no bytes. Null keys hash as one key, null texts have no bytes. An empty table gives no shard.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equitrace.llm.text import text_of
from equitrace.sources.workspace import stage

BITS = 60
#: more bits than the mean needs, so that one aggregate holds the splits of nearly all buckets
SPARE_BITS = 4
#: bits by which one more round splits what is still too large
ROUND_BITS = 12


def bits60(text: Column) -> Column:
    """60 hash bits of a string, as a number."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _binary(number: Column) -> Column:
    return F.lpad(F.conv(number.cast("string"), 10, 2), BITS, "0")


def _split(rows: DataFrame, start: int, deep: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Rows with the first depth in (start, start + deep] at which their bucket fits, and the rest.

    Bytes are summed by the deepest prefix first; its few sums then give those of every shorter one.
    """
    cells = rows.groupBy(F.substring("bits", 1, start + deep).alias("cell")).agg(F.sum("bytes").alias("bytes"))
    cells = stage(cells, "shard-cells")
    first = 0 if start == 0 else start + 1
    levels = cells.select("cell", "bytes", F.explode(F.sequence(F.lit(first), F.lit(start + deep))).alias("depth"))
    levels = levels.withColumn("prefix", F.expr("substring(cell, 1, depth)"))
    sums = levels.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"))
    fitting = sums.where(F.col("bytes") <= limit).select("depth", "prefix")
    depths = (
        levels.join(fitting, ["depth", "prefix"], "left_semi").groupBy("cell").agg(F.min("depth").alias("depth"))
    )
    placed = stage(
        rows.withColumn("cell", F.substring("bits", 1, start + deep)).join(depths, "cell", "left").drop("cell"),
        "shard-placed",
    )
    return placed.where("depth is not null"), placed.where("depth is null").drop("depth")


def _pages(rows: DataFrame, limit: int) -> DataFrame:
    """Rows alike in all 120 bits, dealt into pages: equal rows have equal bytes, so a page holds a fixed
    number of them. Running numbers come from counts of small parts, never from one window over a group."""
    parts = stage(rows.withColumn("part", F.spark_partition_id()), "shard-parts")
    parts = stage(
        parts.withColumn("at", F.row_number().over(Window.partitionBy("bits", "part").orderBy("id"))), "shard-numbered"
    )
    counts = parts.groupBy("bits", "part").agg(F.count("*").alias("n"), F.max("bytes").alias("most"))
    before = Window.partitionBy("bits").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "bits", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
        F.max("most").over(Window.partitionBy("bits")).alias("most"),
    )
    each = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.col("most"), F.lit(1))))
    page = F.floor((F.col("at") - 1 + F.col("offset")) / each).cast("long")
    return (
        parts.join(counts, ["bits", "part"])
        .withColumn("page", page)
        .drop("part", "at", "offset", "most")
        .withColumn("depth", F.lit(2 * BITS))
    )


def assign_shards(
    docs: DataFrame, limit_bytes: int, key_cols: tuple[str, ...] = ("doc_id",), id_col: str = "doc_id",
    text_col: str = "text", all_cols: tuple[str, ...] = (),
) -> DataFrame:
    """One row per input row: id, n_bytes, depth, shard (its prefix bits, and a page where needed)."""
    if limit_bytes < 1:
        raise ValueError("limit_bytes must be positive")
    key = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in key_cols])
    whole = F.concat_ws(
        "\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in all_cols or (id_col, text_col)]
    )
    rows = stage(
        docs.select(
            F.col(id_col).alias("id"),
            F.octet_length(text_of(text_col)).cast("long").alias("bytes"),
            bits60(key).alias("first"),
            F.xxhash64(whole).alias("second"),
        ),
        "shard-rows",
    )
    total, largest = rows.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.max("bytes"), F.lit(0))).first()
    deep = min(BITS, max(1, math.ceil(math.log2(max(1, total / limit_bytes))) + SPARE_BITS))
    second = _binary(F.pmod("second", F.lit(2**BITS)))
    rest = rows.select("id", "bytes", F.concat(_binary(F.col("first")), second).alias("bits"))
    done, start, out = [], 0, None
    while start < 2 * BITS:
        placed, rest = _split(rest, start, min(deep, 2 * BITS - start), limit_bytes)
        done.append(placed.withColumn("page", F.lit(0).cast("long")))
        start += min(deep, 2 * BITS - start)
        deep = ROUND_BITS
        if rest.isEmpty():
            rest = None
            break
    if rest is not None:
        done.append(_pages(rest, limit_bytes))
    for part in done:
        out = part if out is None else out.unionByName(part)
    name = F.expr("substring(bits, 1, depth)")
    return out.select(
        F.col("id").alias(id_col),
        F.col("bytes").alias("n_bytes"),
        F.col("depth").cast("int").alias("depth"),
        F.when(F.col("depth") == 2 * BITS, F.concat(name, F.lit("-"), F.col("page").cast("string")))
        .otherwise(name)
        .alias("shard"),
    )


def directory(shards: DataFrame) -> DataFrame:
    """Per shard: depth, rows and bytes."""
    return shards.groupBy("shard", "depth").agg(F.count("*").alias("n_rows"), F.sum("n_bytes").alias("n_bytes"))

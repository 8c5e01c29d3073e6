"""Group helpers that stay balanced when one group holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equitrace.functions.exprs import draw_key

PANEL_KEY = ("brand", "category", "date")
SERIES = ("brand", "category")


def with_group_stats(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """Attach group aggregates to every row.

    Aggregate, then join back, in place of a window: the aggregate combines on the map side
    and the join can be broadcast or split at run time, so a group with a third of all rows
    never has to fit one task. Keys are non-null by contract.
    """
    stats = df.groupBy(*keys).agg(*aggs)
    return df.join(stats, list(keys), "left")


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mapping tables: a duplicate key must not multiply the rows it is joined to."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    picked = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return picked.select(*keys, "_row.*")


def by_date(*keys: str) -> Window:
    """Window over one series; a series has one row per date, so its size is the calendar."""
    return Window.partitionBy(*keys).orderBy("date")


def seeded_sample(
    df: DataFrame,
    keys: Sequence[str],
    pct: int,
    seeds: Sequence[int],
    scope: Sequence[str] = (),
) -> DataFrame:
    """Exactly floor(pct % of n) of the distinct keys per scope and seed, with `taken` flags.

    The rows with the lowest seeded hashes are taken. A global rank would sort a whole scope in
    one task, so the hash space is cut into 65536 buckets: whole buckets are decided from their
    counts alone, and only the one bucket that holds the cut is ranked row by row.
    """
    group = [*scope, "seed"]
    rows = (
        df.select(*dict.fromkeys([*scope, *keys]))
        .distinct()
        .withColumn("seed", F.explode(F.array(*[F.lit(s) for s in seeds])))
        .withColumn("draw", draw_key(list(keys), F.col("seed")))
        .withColumn("bucket", F.substring("draw", 1, 4))
    )
    counts = rows.groupBy(*group, "bucket").agg(F.count("*").alias("n_bucket"))
    sizes = counts.groupBy(*group).agg(
        F.floor(F.sum("n_bucket") * F.lit(pct) / F.lit(100)).alias("n_take")
    )
    before = Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    plan = (
        counts.withColumn("n_before", F.coalesce(F.sum("n_bucket").over(before), F.lit(0)))
        .join(sizes, group)
        .select(*group, "bucket", "n_before", "n_take", "n_bucket")
    )
    placed = rows.join(plan, [*group, "bucket"])
    is_cut = (F.col("n_before") < F.col("n_take")) & (
        F.col("n_before") + F.col("n_bucket") > F.col("n_take")
    )
    decided = placed.where(~is_cut).withColumn("taken", F.col("n_before") < F.col("n_take"))
    in_bucket = Window.partitionBy(*group, "bucket").orderBy("draw")
    ranked = placed.where(is_cut).withColumn(
        "taken", F.row_number().over(in_bucket) + F.col("n_before") <= F.col("n_take")
    )
    out = [*group, *[k for k in keys if k not in scope], "taken"]
    return decided.select(*out).unionByName(ranked.select(*out))

"""Temperature mixing of sources, realised as budgeted block permutations.

Source s has a share p(s) of all tokens and gets the weight p(s) ** a, normalised. The exponent a is the
largest in [0, 1] whose weights reach the target entropy (a part of the most that so many sources can
have), unless a source would then be repeated more often than allowed: then it is the smallest that keeps
the limit. Both are found by bisection over the small table of shares. The budget is the size at which
the source that shrinks most is read exactly once, so no row is lost; others are read e(s) >= 1 times.

Each source's rows lie in blocks by hash. A pass of a source is a permutation: its blocks in the order of a
hash of (source, pass, block), inside a block the rows by a hash of (row, pass); `position` counts from 1. The
last, partial pass takes the rows that start inside its budget and ends there.

A null source is a source of its own; null and empty texts have no tokens and come with every whole
pass and with a partial one as far as it reaches. A source without tokens is read once. Repeated rows
are rows of their own where a column tells them apart, else they share their fate in the partial pass; they
are counted, and become rows again at the end, so that one id with many rows fills no window. An empty table
gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equitrace.llm.text import text_of, word_count
from equitrace.sources.workspace import stage

#: part of the largest possible entropy that the weights should have
TARGET_ENTROPY = 0.9
#: passes over one source at most
MAX_PASSES = 4.0
#: halvings of the exponent's interval
STEPS = 30
#: decimal places to which a number of passes is rounded
PLACES = 6
#: rows of a block, and blocks of a range of turns, about
BLOCK_ROWS = 4096
#: equal rows that are written out at once
PAGE = 65536


def _hash(*parts: Column) -> Column:
    """The same 60 bits on every engine."""
    key = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def source_shares(rows: DataFrame) -> DataFrame:
    """source, n_rows, tokens, share of tokens; one row per source. A row stands for `times` equal ones."""
    tokens = F.sum(F.col("tokens") * F.col("times"))
    sums = rows.groupBy("source").agg(F.sum("times").alias("n_rows"), tokens.alias("tokens"))
    total = sums.agg(F.sum("tokens")).first()[0] or 0
    share = F.col("tokens") / F.lit(float(total)) if total else F.lit(0.0)
    return sums.select("source", "n_rows", "tokens", share.alias("share"))


def _bisect(shares: DataFrame, meets, low: float = 0.0, high: float = 1.0) -> tuple[float, float]:
    """Halves [low, high]; meets(exponent) is an aggregate that is true where the exponent may go up."""
    for _ in range(STEPS):
        mid = (low + high) / 2
        if shares.agg(meets(mid).alias("ok")).first()["ok"]:
            low = mid
        else:
            high = mid
    return low, high


def _entropy(a: float) -> Column:
    """Entropy of the weights share ** a: ln Z - sum(x ln x) / Z for x = share ** a."""
    x = F.pow(F.col("share"), F.lit(a))
    return F.log(F.sum(x)) - F.sum(x * F.lit(a) * F.log("share")) / F.sum(x)


def _passes(a: float) -> Column:
    """How often the most repeated source is read where the least repeated one is read once."""
    return F.max(F.pow(F.col("share"), F.lit(a - 1.0))) / F.min(F.pow(F.col("share"), F.lit(a - 1.0)))


def find_exponent(shares: DataFrame, target_entropy: float, max_passes: float) -> float:
    """The exponent; 1 where the shares already reach the entropy, 0 where nothing can."""
    live = shares.where("share > 0").select("share")
    n, most = live.agg(F.count("*"), _entropy(1.0)).first()
    if n < 2:
        return 1.0
    goal = target_entropy * math.log(n)
    exponent = 1.0
    if most < goal:
        exponent = _bisect(live, lambda a: _entropy(a) >= goal)[0]
    if live.agg(_passes(exponent)).first()[0] > max_passes:
        exponent = _bisect(live, lambda a: _passes(a) > max_passes, exponent)[1]
    return exponent


def plan_sources(shares: DataFrame, exponent: float) -> DataFrame:
    """source, n_rows, tokens, weight, passes, whole passes, budget of the partial pass in tokens."""
    live = F.col("share") > 0
    raw = shares.withColumn("raw", F.when(live, F.pow("share", F.lit(exponent))).otherwise(0.0))
    lift = F.when(live, F.pow("share", F.lit(exponent - 1.0)))
    z, least = raw.agg(F.sum("raw"), F.min(lift)).first()
    raw = raw.withColumn("passes", F.coalesce(F.round(lift / F.lit(least or 1.0), PLACES), F.lit(1.0)))
    return raw.select(
        "source", "n_rows", "tokens",
        (F.col("raw") / F.lit(z or 1.0)).alias("weight"),
        "passes",
        F.floor("passes").cast("long").alias("whole"),
        F.floor((F.col("passes") - F.floor("passes")) * F.col("tokens")).cast("long").alias("partial"),
    )


def _ahead(blocks: DataFrame) -> DataFrame:
    """Adds the rows and tokens of the blocks that come before in the same pass of a source.

    Sums over ranges of turns first, then inside a range: no window holds all blocks of a hot source.
    """
    ranges = F.ceil(F.col("blocks") / F.lit(BLOCK_ROWS)).cast("long")
    blocks = blocks.withColumn("range", F.shiftright(F.shiftright("turn", 40) * ranges, 20))
    line = Window.partitionBy("key", "pass").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("key", "pass", "range").orderBy("turn", "block")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.groupBy("key", "pass", "range").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"))
    totals = totals.select(
        "key", "pass", "range", *[F.coalesce(F.sum(c).over(line), F.lit(0)).alias(f"{c}_base") for c in ("n", "sum")]
    )
    blocks = blocks.withColumns({f"{c}_in": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in ("n", "sum")})
    blocks = blocks.join(totals, ["key", "pass", "range"])
    return blocks.withColumns({f"{c}_ahead": F.col(f"{c}_base") + F.col(f"{c}_in") for c in ("n", "sum")})


def mixture(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    target_entropy: float = TARGET_ENTROPY, max_passes: float = MAX_PASSES,
) -> tuple[DataFrame, DataFrame]:
    """Copies (id, source, tokens, pass, block, position in the pass) and the plan per source.

    A hot source is never one group: it is spread over its blocks, whose sums are small rows.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_of(text_col)).alias("tokens")
    )
    rows = stage(rows.groupBy("id", "source", "tokens").agg(F.count("*").alias("times")), "mix-rows")
    shares = stage(source_shares(rows), "mix-shares")
    plan = stage(plan_sources(shares, find_exponent(shares, target_entropy, max_passes)), "mix-plan")
    # a null source has a key of its own, so that joins and windows share one partitioning
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("key")
    per_source = plan.select(
        key, "whole", F.when(F.col("partial") > 0, F.col("partial")).alias("partial"),
        F.ceil(F.col("n_rows") / F.lit(BLOCK_ROWS)).cast("long").alias("blocks"),
    )
    placed = rows.select("*", key).join(per_source, "key")
    placed = placed.withColumn("block", F.pmod(_hash(F.lit("block"), F.col("id")), F.col("blocks")))
    last = F.col("whole") + F.when(F.col("partial").isNull(), 0).otherwise(1)
    each_pass = F.explode(F.sequence(F.lit(1).cast("long"), last)).alias("pass")
    sums = placed.groupBy("key", "source", "whole", "partial", "blocks", "block").agg(
        F.sum("times").alias("n"), F.sum(F.col("tokens") * F.col("times")).alias("sum")
    )
    turn = _hash(F.lit("turn"), F.col("source"), F.col("pass"), F.col("block"))
    left = F.when(F.col("pass") > F.col("whole"), F.col("partial") - F.col("sum_ahead"))
    sums = _ahead(sums.select("*", each_pass).withColumn("turn", turn))
    sums = sums.select("key", "pass", "block", "n_ahead", left.alias("left")).where("left is null or left > 0")
    copies = placed.select("key", "id", "source", "tokens", "times", "block", each_pass)
    copies = copies.join(sums, ["key", "pass", "block"])
    copies = copies.withColumn("rank", _hash(F.lit("rank"), F.col("id"), F.col("pass")))
    here = Window.partitionBy("key", "pass", "block").orderBy("rank", "id", "tokens")
    before = F.sum("times").over(here.rowsBetween(Window.unboundedPreceding, -1))
    upto = F.sum(F.col("tokens") * F.col("times")).over(here.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    copies = copies.withColumns({"before": F.col("n_ahead") + F.coalesce(before, F.lit(0)), "upto": upto})
    copies = copies.where("left is null or upto - tokens < left")
    page = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(times - 1) div {PAGE}"))).alias("page")
    copies = copies.select("*", page).withColumn("before", F.col("before") + F.col("page") * PAGE)
    some = F.sequence(F.col("before") + 1, F.col("before") + F.least(F.lit(PAGE), F.col("times") - F.col("page") * PAGE))
    return copies.select(F.col("id").alias(id_col), "source", "tokens", "pass", "block", F.explode(some).alias("position")), plan

"""SimHash fingerprints and the search for all fingerprints within a Hamming radius.

The terms of a text are its five-word shingles, and a term weighs as often as it occurs; a text of one to
four words has its whole word sequence as its one term. Each term's 64-bit hash votes +weight or -weight
on every bit; a bit is set where the votes are above 0. A null text is empty; a text without words has
no votes and the fingerprint 0. Equal texts have equal fingerprints. Votes are counted
by keys that tell all rows apart: the chunks of two rows under the same keys would share byte counters. A very long text is a longer array in its own row; nothing is cut. An
empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equitrace.llm.text import text_of, words

SHINGLE = 5
BITS = 64
#: bits apart at which fingerprints count as near
RADIUS = 3
#: vote counters are bytes, eight to a long; chunks of so many terms fill at most seven of a byte's bits
CHUNK = 127
LANES = 8


def with_terms(docs: DataFrame, body: str, terms: str, first: str | None = None) -> DataFrame:
    """Adds the shingle hashes of a text column, those from number `first` (a column) on where it is given.

    Each step is a column of its own, so that no lambda computes an array anew for each of its elements.
    """
    hashes, count = f"{terms}_words", f"{terms}_count"
    docs = docs.withColumn(hashes, F.transform(words(F.col(body)), lambda w: F.xxhash64(w)))
    docs = docs.withColumn(count, F.greatest(F.size(hashes) - (SHINGLE - 1), F.least(F.size(hashes), F.lit(1))))
    start = F.lit(0) if first is None else F.col(first)
    starts = F.when(F.col(count) > start, F.sequence(start, F.col(count) - 1)).otherwise(F.array().cast("array<int>"))
    return docs.withColumn(
        terms, F.transform(starts, lambda i: F.xxhash64(*[F.get(F.col(hashes), i + k) for k in range(SHINGLE)]))
    ).drop(hashes, count)


def count_votes(docs: DataFrame, keys: list[str], terms: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """keys, chunk, n, v0 .. v7 and the largest of each carried number: votes of each chunk of terms.

    Counter v_j holds in its bytes how many terms set bits j, j + 8, ... j + 56. Terms are exploded and
    summed inside generated code and combine where they arise; a row without terms keeps one row.
    """
    mask = F.lit(sum(1 << (8 * k) for k in range(8)))
    rows = docs.select(*keys, *carry, F.posexplode_outer(terms).alias("at", "term"))
    chunk = F.floor(F.coalesce("at", F.lit(0)) / CHUNK).cast("int").alias("chunk")
    votes = [F.sum(F.shiftrightunsigned("term", j).bitwiseAND(mask)).alias(f"v{j}") for j in range(LANES)]
    return rows.groupBy(*keys, chunk).agg(F.count("term").alias("n"), *[F.max(c).alias(c) for c in carry], *votes)


def _majority(name: str) -> str:
    """Bits that more than half of the terms set; sum j, l holds those of bits j + 8 l and j + 8 l + 32."""
    halves = []
    for shift in (0, 32):
        count = f"(shiftrightunsigned({name}_%d, {shift}) & 2147483647L)"
        halves.append(" + ".join(f"if(2 * {count % b} > {name}_n, {1 << b}L, 0L)" for b in range(BITS // 2)))
    return f"shiftleft({halves[1]}, 32) | ({halves[0]})"


def fingerprints(
    votes: DataFrame, keys: list[str], parts: dict[str, str] | None = None, carry: tuple[str, ...] = ()
) -> DataFrame:
    """keys, carried numbers and fingerprints (long): one over all vote rows, or one for each named part.

    A part is a condition on the keys of the votes. The sums are written as SQL text: that many column
    objects take seconds to build.
    """
    parts = parts or {"fingerprint": "true"}
    pair = (255 << 32) | 255
    sums = []
    for name, member in parts.items():
        sums.append(f"sum(if({member}, n, 0L)) as {name}_n")
        for b in range(BITS // 2):
            both = f"shiftrightunsigned(v{b % LANES}, {8 * (b // LANES)}) & {pair}L"
            sums.append(f"coalesce(sum(if({member}, {both}, 0L)), 0L) as {name}_{b}")
    grouped = votes.groupBy(*keys).agg(*[F.max(c).alias(c) for c in carry], *[F.expr(s) for s in sums])
    return grouped.select(*keys, *carry, *[F.expr(f"{_majority(name)} as {name}") for name in parts])


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)).cast("int")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1.0 - distance(a, b) / F.lit(float(BITS))


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def _blocks(radius: int) -> list[int]:
    """Masks of the permuted tables: two fingerprints within the radius agree on all bits of at least one.

    The bits fall into radius + 2 blocks; whatever bits differ, two blocks are untouched.
    """
    parts = radius + 2
    edges = [BITS * k // parts for k in range(parts + 1)]
    blocks = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(parts)]
    return [a | b for a, b in combinations(blocks, 2)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def near_pairs(prints: DataFrame, radius: int = RADIUS, queries: DataFrame | None = None) -> DataFrame:
    """(fingerprint, other, distance): all distinct fingerprints within the radius of each distinct query.

    Without queries each pair of the table comes once, the smaller number first. Membership (which
    documents have a fingerprint) stays in `prints`, so copies are never expanded into pairs. Every
    permuted table is one equi-join on its masked bits, which adaptive execution splits at hot keys.
    """
    if not 0 <= radius <= 8:
        raise ValueError("radius must be 0 to 8")
    table = prints.select("fingerprint").where("fingerprint is not null").distinct()
    asked = table if queries is None else queries.select("fingerprint").where("fingerprint is not null").distinct()
    masks = F.array(*[F.struct(F.lit(k).alias("t"), F.lit(_signed(m)).alias("m")) for k, m in enumerate(_blocks(radius))])

    def keyed(rows: DataFrame, name: str) -> DataFrame:
        rows = rows.select(F.col("fingerprint").alias(name), F.explode(masks).alias("x"))
        return rows.select(name, F.col("x.t").alias("t"), F.col(name).bitwiseAND(F.col("x.m")).alias("key"))

    pairs = keyed(asked, "fingerprint").join(keyed(table, "other"), ["t", "key"])
    pairs = pairs.where(F.col("fingerprint") < F.col("other") if queries is None else F.lit(True))
    pairs = pairs.select("fingerprint", "other", distance(F.col("fingerprint"), F.col("other")).alias("distance"))
    return pairs.where(F.col("distance") <= radius).distinct()

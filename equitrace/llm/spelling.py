"""Spelling variants by pivotal grams: words that differ by one code point, and the form each stands for.

One edit destroys at most one of two disjoint bigrams. All bigrams have one order, rarest first.

1. A word's prefix is its three rarest bigrams, with all others that tie with the third. Two disjoint ones
   of them with the least total frequency, found by dynamic programming over their places, are its pivots.
2. Of two near words, the one whose prefix ends earlier in the order has a pivot that survives the edit,
   and that pivot is in the other's prefix. So pivots look up prefixes, never prefixes prefixes.
3. Position limits: the edit is either behind a surviving bigram, so that the words agree up to its end and
   it has the same place, or before it, so that they agree from its start on and it has the same place from
   the end. The index key is the bigram with that side's whole part of the word, so only words that agree
   there meet. Where that part is short, the key also takes half of the other part: of two halves one edit
   spares one, so either the first or the last letters of the other parts agree as well.
4. Lengths that differ by more than one are dropped, and the rest is verified by edit distance.

Words come from `letter_runs`. The frequency table has one row for a bigram of the alphabet of 90 letters:
at most 8,100 rows are read by the driver and broadcast.

Odd rows: a null text has no words. A null doc_id is written as empty in the edited runs' hash. Repeated
rows count as often as they occur. An empty table gives an empty result. Columns beside id and text are
ignored. Every distinct word is one row, so ties and repeats meet in counts alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equitrace.llm.text import lower_ascii, text_of
from equitrace.sources.workspace import stage

LETTERS = "([A-Za-zÀ-ÿ]+)"
#: code points of a word at least, so that three bigrams hold two disjoint ones
LEAST_LENGTH = 4

#: code points of an agreeing part from which on it is a key by itself
LONG_PART = 6

def letter_runs(docs: DataFrame, least: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, run: every maximal run of letters of at least so many code points, A-Z in lower case."""
    runs = F.regexp_extract_all(text_of(text_col), F.lit(LETTERS), 1)
    runs = docs.select(F.col(id_col).alias("doc_id"), F.explode(runs).alias("run"))
    return runs.where(F.char_length("run") >= least).select("doc_id", lower_ascii(F.col("run")).alias("run"))


def count_words(words: DataFrame, least_length: int, least_count: int) -> DataFrame:
    """word, n of the words (one row an occurrence) that are long and frequent enough."""
    counted = words.where(F.char_length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least_count)


def choose_pivots(grams: list[str], rank: dict[str, int], weight: dict[str, int]) -> tuple[list[int], tuple[int, int], int]:
    """Places of the prefix and of the two pivots, and the rank at which the prefix ends."""
    ranks = [rank[g] for g in grams]
    last = sorted(ranks)[2]
    prefix = [p for p, r in enumerate(ranks) if r <= last]
    # best[k]: the lightest of the first k prefix bigrams; a pair ends at j and starts two places before
    best, pair, start = [], None, 0
    for j, p in enumerate(prefix):
        while start < j and prefix[start] <= p - 2:
            start += 1
        if start:
            light = best[start - 1]
            total = weight[grams[light]] + weight[grams[p]]
            if pair is None or total < pair[0]:
                pair = (total, light, p)
        best.append(p if not best or weight[grams[p]] < weight[grams[best[-1]]] else best[-1])
    return prefix, pair[1:], last


def with_pivots(words: DataFrame) -> DataFrame:
    """Adds prefix and pivots, places of bigrams, and last, the rank at which the prefix ends."""
    grams = words.select(
        F.explode(F.transform(F.sequence(F.lit(1), F.char_length("word") - 1), lambda k: F.substr("word", k, F.lit(2)))).alias("gram")
    )
    weight = {r["gram"]: r["n"] for r in grams.groupBy("gram").agg(F.count("*").alias("n")).collect()}
    order = sorted(weight, key=lambda g: (weight[g], g))
    told = words.sparkSession.sparkContext.broadcast((weight, {g: k for k, g in enumerate(order)}))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, rank = told.value
        places = pa.list_(pa.int32())
        for batch in batches:
            out = [
                choose_pivots([word[k : k + 2] for k in range(len(word) - 1)], rank, weight)
                for word in batch.column(0).to_pylist()
            ]
            columns = [pa.array([x[k] for x in out], t) for k, t in enumerate((places, places, pa.int32()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=["word", "n", "prefix", "pivots", "last"])

    return words.select("word", "n").mapInArrow(
        choose, "word string, n bigint, prefix array<int>, pivots array<int>, last int"
    )


def index_entries(words: DataFrame, places: str) -> DataFrame:
    """key, word, n, last: one row for each bigram at the places, side that agrees and half of the other."""
    word, place = F.col("word"), F.col("place")
    rows = words.select("word", "n", "last", F.explode(places).alias("place"))
    sides = [
        F.struct(F.lit(0).alias("side"), F.left(word, place + 2).alias("part"), F.substr(word, place + 3).alias("rest")),
        F.struct(F.lit(1).alias("side"), F.substr(word, place + 1).alias("part"), F.left(word, place).alias("rest")),
    ]
    rows = rows.select("word", "n", "last", F.inline(F.array(*sides)))
    keys = []
    for less in (0, 1):  # halves by the shorter of two words, which this or the other may be
        half = F.floor(F.greatest(F.char_length("rest") - less, F.lit(0)) / 2).cast("int")
        keys.append(F.xxhash64("side", "part", half, F.lit(0), F.left("rest", half)))
        keys.append(F.xxhash64("side", "part", half, F.when(half > 0, 1).otherwise(0), F.right("rest", half)))
    whole = F.char_length("part") >= LONG_PART
    keys = F.when(whole, F.array(F.xxhash64("side", "part"))).otherwise(F.array_distinct(F.array(*keys)))
    return rows.select(F.explode(keys).alias("key"), "word", "n", "last")


def near_words(words: DataFrame) -> DataFrame:
    """word, n, near, near_n: every word with each word one code point away, in both directions."""
    placed = stage(with_pivots(words.where(F.char_length("word") >= LEAST_LENGTH)), "spelling-pivots")
    names = ("word", "n", "last")
    asked = index_entries(placed, "pivots").select("key", *[F.col(c).alias(f"{c}_a") for c in names])
    held = index_entries(placed, "prefix").select("key", *[F.col(c).alias(f"{c}_b") for c in names])
    fits = (F.abs(F.char_length("word_a") - F.char_length("word_b")) <= 1) & (F.col("last_a") <= F.col("last_b"))
    pairs = asked.join(held, "key").where(fits & (F.col("word_a") != F.col("word_b")))
    pairs = pairs.where(F.levenshtein("word_a", "word_b", 1) == 1)
    ends = [F.struct(F.col(f"word_{s}").alias("word"), F.col(f"n_{s}").alias("n")) for s in "ab"]
    both = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in (ends, ends[::-1])])
    both = pairs.select(F.explode(both).alias("e"))
    both = both.select("e.x.word", "e.x.n", F.col("e.y.word").alias("near"), F.col("e.y.n").alias("near_n"))
    return both.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """word, root of the words that have a form. A form is at least `times` as frequent, so chains are
    short (18 steps for 64-bit counts at ten times) and doubling ends after five rounds."""
    roots = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = roots.join(ahead, "root", "left")
        moved = stage(moved.select("word", F.coalesce("further", "root").alias("root"), "further"), "spelling-roots")
        if moved.where("further is not null").isEmpty():
            return moved.select("word", "root")
        roots = moved.select("word", "root")


def group_variants(words: DataFrame, times: int = 10) -> DataFrame:
    """One row per word (word, n): form, root, n_near, form_n.

    The form is the near word of largest n (ties: the first by code points) if that is `times` the word's.
    """
    words = stage(words, "spelling-words")
    near = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("top")
    )
    rows = words.join(near, "word", "left")
    counts = F.when(-F.col("top.less") >= times * F.col("n"), -F.col("top.less"))
    rows = rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), counts.alias("form_n"),
        F.when(counts.isNotNull(), F.col("top.near")).alias("form"),
    )
    rows = stage(rows, "spelling-forms")
    roots = _roots(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def worn_runs(runs: DataFrame, one_in: int = 31) -> DataFrame:
    """word: the runs, where the crc32 of `<doc_id>:<run>` is divisible, without the code point it points at."""
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    h = runs.select("run", F.crc32(F.encode(name, "UTF-8")).alias("h"))
    at: Column = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return h.select(F.when(F.col("h") % one_in == 0, cut).otherwise(F.col("run")).alias("word"))

"""Repeated lines across documents, by a filter of lines seen once and one of lines seen twice.

A line's key is the line without white space at its ends, A-Z in lower case. Keys of at least `least_chars`
code points that `least_docs` documents hold lose all their lines except in the largest doc_id.

1. Every document gives the distinct 64-bit hashes of its long enough keys, once each.
2. Every builder task runs its hashes through two Bloom filters of its own: a hash that the first has
   already goes to the second, else to the first. Filters of different tasks are merged slice by slice, by
   the same rule: what two first filters share goes to the second. A filter never loses a hash, so every
   key of two documents is in the merged second filter.
3. Only lines whose hash is in the second filter are suspects. They alone are shuffled, as a 256-bit digest
   and the document's place, for the exact count and the choice of the document that keeps them.

The filter has BITS_PER_LINE bits for each hash, at most MAX_BITS, whatever the table: that bounds what is
broadcast (its second filter, 32 MB) and what a builder task holds. A fuller filter only lets more lines
pass as suspects; the result is exact in any case.

Odd rows: a null or empty text is one empty line, which is never long enough. A null doc_id is smaller than
any other. Every row is a document of its own: of rows that share the largest doc_id, the last in the files
keeps the line. A line repeated inside a document counts once, and stays or goes as a whole. An empty table
gives an empty result. Columns beside id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equitrace.llm.text import lower_ascii, text_of
from equitrace.sources.workspace import stage

#: bits of a filter for each hash, and at most; bits that a hash sets, all in one slice
BITS_PER_LINE, MAX_BITS, PROBES = 16, 1 << 28, 2
#: bits at most of the map of rows that may lose lines
MAX_ROW_BITS = 1 << 26
#: bits of a slice of a filter
SLICE_BITS = 1 << 16
#: tasks that build filters, at most
BUILDERS = 4096

WHITE = " \t\n\x0b\x0c\r"


def keys_of(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(WHITE))
    plain = F.octet_length(bare) == F.char_length(bare)
    return F.when(plain, F.lower(bare)).otherwise(lower_ascii(bare))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _places(hashes: np.ndarray, slices: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Slice of each hash and the bits it sets in there."""
    bits = hashes.view(np.uint64)
    at = ((bits >> np.uint64(40)) % np.uint64(slices)).astype(np.int64)
    return at, [((bits >> np.uint64(16 * k)) % np.uint64(SLICE_BITS)).astype(np.int64) for k in range(PROBES)]


class TwoFilters:
    """Bit maps of what was seen once and twice, one byte a bit while a task fills them."""

    def __init__(self, slices: int):
        self.slices = slices
        self.once = np.zeros(slices * SLICE_BITS // 8, dtype=np.uint8)
        self.twice = np.zeros_like(self.once)

    @staticmethod
    def _has(bitmap: np.ndarray, places: list[np.ndarray]) -> np.ndarray:
        return np.logical_and.reduce([bitmap[p >> 3] >> (p & 7).astype(np.uint8) & 1 for p in places])

    @staticmethod
    def _set(bitmap: np.ndarray, places: list[np.ndarray]) -> None:
        for p in places:
            np.bitwise_or.at(bitmap, p >> 3, np.left_shift(1, p & 7).astype(np.uint8))

    def add(self, hashes: np.ndarray) -> None:
        hashes, seen = np.unique(hashes, return_counts=True)
        at, bits = _places(hashes, self.slices)
        places = [at * SLICE_BITS + b for b in bits]
        again = (seen > 1) | self._has(self.once, places)
        self._set(self.twice, [p[again] for p in places])
        self._set(self.once, places)

    def rows(self) -> Iterator[tuple[int, bytes, bytes]]:
        size = SLICE_BITS // 8
        for k in range(self.slices):
            once = self.once[k * size : (k + 1) * size]
            if once.any():
                yield k, once.tobytes(), self.twice[k * size : (k + 1) * size].tobytes()


FILTER_SCHEMA = pa.schema([("slice", pa.int64()), ("once", pa.binary()), ("twice", pa.binary())])


def _fill(hashes: DataFrame, slices: int) -> DataFrame:
    """slice, once, twice of every builder task."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = TwoFilters(slices)
        for batch in batches:
            filters.add(batch.column(0).flatten().to_numpy(zero_copy_only=False))
        for row in filters.rows():
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, FILTER_SCHEMA, strict=True)], schema=FILTER_SCHEMA)

    return hashes.select("hashes").coalesce(BUILDERS).mapInArrow(build, "slice bigint, once binary, twice binary")


def _merge(parts: DataFrame) -> DataFrame:
    """slice, words: the merged second filter, as longs; slices stream through two maps of one slice each."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, once, twice = None, None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int64()), pa.array([twice.view(np.int64).tolist()], pa.list_(pa.int64()))], names=["slice", "words"]
            )

        for batch in batches:
            for k, a, b in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
                if k != at:
                    if at is not None and twice.any():
                        yield done()
                    at, once, twice = k, a.copy(), b.copy()
                else:
                    twice |= b | (once & a)
                    once |= a
        if at is not None and twice.any():
            yield done()

    ordered = parts.repartition("slice").sortWithinPartitions("slice")
    return ordered.mapInArrow(fold, "slice bigint, words array<bigint>")


def seen_twice(hashes: DataFrame) -> tuple[DataFrame, int]:
    """The second filter over a column `hashes` (an array of distinct longs a document), and its slices."""
    lines = hashes.agg(F.coalesce(F.sum(F.size("hashes")), F.lit(0))).first()[0]
    slices = max(1, min(MAX_BITS, lines * BITS_PER_LINE) // SLICE_BITS)
    return stage(_merge(_fill(hashes, slices)), "lines-filter"), slices


def _suspects(rows: DataFrame, twice: DataFrame, slices: int) -> DataFrame:
    """Rows (hash, ...) whose hash is in the second filter; what is broadcast is bounded by MAX_BITS."""
    rows = rows.withColumn("slice", F.pmod(F.shiftrightunsigned("hash", 40), F.lit(slices)))
    rows = rows.join(F.broadcast(twice), "slice")
    for k in range(PROBES):
        bit = F.shiftrightunsigned("hash", 16 * k).bitwiseAND(F.lit(SLICE_BITS - 1)).cast("int")
        rows = rows.where(F.getbit(F.get("words", F.shiftright(bit, 6)), bit.bitwiseAND(F.lit(63))) == 1)
    return rows.drop("slice", "words")


def _maybe_in(rows: DataFrame, few: DataFrame) -> DataFrame:
    """Adds maybe: false for rows (file, row) that are surely not among the few, by a bounded bit map."""
    n = few.count()
    words = max(1, min(MAX_ROW_BITS, n * BITS_PER_LINE) // 64)
    place = F.xxhash64("file", "row")
    word, bit = F.pmod(place, F.lit(words)), F.shiftrightunsigned(place, 58).cast("int")
    bits = few.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bits"))
    bits = bits.groupBy("word").agg(F.bit_or("bits").alias("bits"))
    joined = rows.withColumn("word", word).join(F.broadcast(bits), "word", "left")
    return joined.withColumn("maybe", F.coalesce(F.getbit("bits", bit) == 1, F.lit(False))).drop("word", "bits")


def _without(split: Column, gone: Column) -> Column:
    """The lines but those at the (sorted) places gone, joined; runs between them are copied once."""
    cuts = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(split)))
    runs = F.transform(
        F.sequence(F.lit(1), F.size(gone) + 1),
        lambda k: F.slice(split, F.get(cuts, k - 1) + 2, F.get(cuts, k) - F.get(cuts, k - 1) - 1),
    )
    return F.array_join(F.flatten(runs), "\n")


def drop_repeated_lines(
    docs: DataFrame, least_docs: int = 3, least_chars: int = 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of a Parquet table: id, n_lines, n_dropped, kept (the lines that stay, joined)."""
    rows = docs.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
        F.col(id_col).alias("id"), text_of(text_col).alias("text"),
    )
    split = _lines(F.col("text"))
    long_keys = F.filter(F.transform(split, keys_of), lambda k: F.char_length(k) >= least_chars)
    hashes = F.array_distinct(F.transform(long_keys, lambda k: F.xxhash64(k)))
    twice, slices = seen_twice(stage(rows.select(hashes.alias("hashes")), "lines-hashes"))

    # keys are made inside the array, so that each is made once
    numbered = F.transform(split, lambda line, i: F.struct(i.alias("at"), keys_of(line).alias("key")))
    lines = rows.select("file", "row", "id", F.inline(F.filter(numbered, lambda x: F.char_length(x["key"]) >= least_chars)))
    lines = lines.withColumn("hash", F.xxhash64("key"))
    lines = _suspects(lines, twice, slices).withColumn("key", F.unhex(F.sha2(F.encode("key", "UTF-8"), 256)))
    lines = lines.groupBy("file", "row", "id", "key").agg(F.collect_list("at").alias("at"))
    lines = stage(lines, "lines-suspects")

    repeated = lines.groupBy("key").agg(F.count("*").alias("docs"), F.max(F.struct("id", "file", "row")).alias("keeper"))
    repeated = stage(repeated.where(F.col("docs") >= least_docs).select("key", "keeper"), "lines-repeated")
    gone = lines.join(repeated, "key").where(~F.struct("id", "file", "row").eqNullSafe(F.col("keeper")))
    gone = gone.groupBy("file", "row").agg(F.array_sort(F.flatten(F.collect_list("at"))).alias("gone"))
    gone = stage(gone, "lines-gone")

    # only texts that may lose lines travel to the places of these, at any size of the table
    parted = _maybe_in(rows, gone)
    changed = parted.where("maybe").join(gone.hint("shuffle_merge"), ["file", "row"], "left")
    changed = changed.withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    out = parted.where("not maybe").select("id", "text", F.lit(0).alias("n_gone"), F.col("text").alias("kept"))
    out = out.unionByName(changed.select("id", "text", F.size("gone").alias("n_gone"), _without(split, F.col("gone")).alias("kept")))
    return out.select(
        F.col("id").alias(id_col), F.size(split).cast("long").alias("n_lines"), F.col("n_gone").cast("long").alias("n_dropped"), "kept"
    )

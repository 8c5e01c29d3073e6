"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Rows: a null text is empty, so null and empty texts are copies of each other. Of equal texts the row
with the largest id stays; rows that also share the id (repeated rows) keep exactly one. A null id is
smaller than any other. An empty table gives an empty result. Input columns other than id and text
never meet the operator's own names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equitrace.llm.text import lower_ascii, text_of
from equitrace.sources.workspace import stage

#: code points that the second level hashes
PREFIX_CHARS = 256


def normal_text(name: str = "text") -> Column:
    """What two copies share: the text with A-Z in lower case."""
    return lower_ascii(text_of(name))


def text_digest(name: str = "text") -> Column:
    return F.sha2(F.encode(normal_text(name), "UTF-8"), 256)


def _size(name: str) -> Column:
    return F.octet_length(text_of(name)).cast("long")


def _head(name: str, chars: int) -> Column:
    return F.xxhash64(lower_ascii(F.left(text_of(name), F.lit(chars))))


def _crowded(narrow: DataFrame) -> DataFrame:
    """(size, head) pairs that more than one row has; lengths that only one row has go first.

    Counts combine on the map side, so a hot length or a hot text arrives as one row a task; the join
    back to the narrow rows is a plain equi-join that adaptive execution splits where a length is hot.
    """
    lengths = narrow.groupBy("size").agg(F.count("*").alias("n")).where("n > 1").select("size")
    return (
        narrow.select("size", "head")
        .join(lengths, "size", "left_semi")
        .groupBy("size", "head")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select("size", "head")
    )


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix_chars: int = PREFIX_CHARS,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, and the carried columns.

    Length and prefix hash come from one scan, since Parquet reads a whole text for either; full
    content is hashed only for rows whose length and prefix hash another row shares. No text is
    shuffled but those of the surviving rows' join.
    """
    carried = carry or {}
    base = docs.select(
        F.col(id_col).alias("id"),
        _size(text_col).alias("size"),
        _head(text_col, prefix_chars).alias("head"),
        *[c.alias(f"carry_{k}") for k, c in carried.items()],
    )
    narrow = stage(base, "dedup-narrow")
    crowded = stage(_crowded(narrow), "dedup-crowded")
    alone = narrow.join(crowded, ["size", "head"], "left_anti").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        *[f"carry_{k}" for k in carried],
    )
    full = (
        docs.select(
            F.col(id_col).alias("id"),
            _size(text_col).alias("size"),
            _head(text_col, prefix_chars).alias("head"),
            text_of(text_col).alias("body"),
            *[c.alias(f"carry_{k}") for k, c in carried.items()],
        )
        .join(crowded, ["size", "head"], "left_semi")
        .withColumn("full", F.sha2(F.encode(lower_ascii(F.col("body")), "UTF-8"), 256))
        .drop("body")
        .withColumn("row", F.monotonically_increasing_id())
    )
    full = stage(full, "dedup-full")
    groups = full.groupBy("full").agg(
        F.count("*").alias("group_size"), F.max(F.struct("id", "row")).alias("top")
    )
    together = full.join(groups, "full").select(
        "id",
        F.col("top.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("top.row")).alias("kept"),
        *[f"carry_{k}" for k in carried],
    )
    out = alone.unionByName(together)
    return out.select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", *[F.col(f"carry_{k}").alias(k) for k in carried]
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns; one row of each group of equal texts.

    Only rows that share length and prefix hash with another are grouped by full hash; the group's row
    is picked by an aggregate that combines on the map side, so a hot group sends one row a task. The row of
    the largest id stays; of rows of one id, the one with the largest hash of its columns.
    """
    narrow = stage(
        docs.select(_size(text_col).alias("size"), _head(text_col, PREFIX_CHARS).alias("head")), "dedup-narrow"
    )
    crowded = stage(_crowded(narrow), "dedup-crowded")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("line"),
        F.col(id_col).alias("id"),
        _size(text_col).alias("size"),
        _head(text_col, PREFIX_CHARS).alias("head"),
        text_digest(text_col).alias("full"),
    )
    alone = rows.join(crowded, ["size", "head"], "left_anti").select("line")
    kept = (
        rows.join(crowded, ["size", "head"], "left_semi")
        .groupBy("full")
        .agg(F.max_by("line", F.struct(F.coalesce("id", F.lit(-(2**63))), F.xxhash64(F.to_json("line")))).alias("line"))
        .select("line")
    )
    return alone.unionByName(kept).select("line.*")

"""What the token operators share: reading a tokenizer's file, the byte alphabet, and bounded caches."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: words whose tokens a Python worker keeps; beyond, it starts again from those of the batch at hand
CACHE_WORDS = 250_000
#: texts handled at a time
SLICE_ROWS = 128


@lru_cache(maxsize=1)
def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: itself where it is one, else one from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


@lru_cache(maxsize=4)
def read_model(content: str) -> dict:
    """vocab, merges as pairs of strings, special (content, id) pairs."""
    model = json.loads(content)
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["model"]["merges"]]
    special = {t["content"]: t["id"] for t in model["added_tokens"]}
    return {"vocab": model["model"]["vocab"], "merges": merges, "special": special}


def file_broadcast(spark: SparkSession, path: str):
    """A tokenizer's file, read once by the driver; one to two megabytes for any input."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def map_texts(
    docs: DataFrame, keep: list[str], text_col: str, make: Callable[[], Callable[[list[str]], list[tuple]]], schema: str
) -> DataFrame:
    """The kept columns and those that a per-slice function returns for each text; null texts are empty.

    Rows stay in their partition and arrive in Arrow batches; `make` builds the function once a task.
    """
    added = StructType.fromDDL(schema).fields
    text = F.col(f"`{text_col}`").cast("string")
    kept = [docs.schema[c] for c in keep]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], *([] if text_col in keep else [text]))
    at = keep.index(text_col) if text_col in keep else len(keep)
    schema_out = StructType([*kept, *added])
    arrow = to_arrow_schema(schema_out)
    kinds = arrow.types[len(kept) :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handle = make()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                out = zip(*handle([t or "" for t in part.column(at).to_pylist()]), strict=True)
                columns = [part.column(k) for k in range(len(keep))]
                columns += [pa.array(list(c), type=k) for c, k in zip(out, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=arrow.names)

    return rows.mapInArrow(run, schema_out)


class WordCache(dict):
    """Word -> result, filled for all words of a slice at once and bounded."""

    def __init__(self, compute: Callable[[str], object], limit: int = CACHE_WORDS):
        super().__init__()
        self.compute, self.limit = compute, limit

    def fill(self, words: set[str]) -> None:
        missing = words - self.keys()
        if len(self) + len(missing) > self.limit:
            kept = {w: self[w] for w in words & self.keys()}
            self.clear()
            self.update(kept)
        for word in missing:
            self[word] = self.compute(word)

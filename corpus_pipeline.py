"""A training corpus from raw documents: five stages, each written as Parquet and read again.

Every stage works on all that its predecessor kept. All but the last return the columns of documents.
Null texts are empty; extra columns are carried along. Rows are told apart by their place in the files that
a stage reads, so null and repeated ids neither lose nor multiply rows. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equitrace.llm import bpe, dedup, jaccard, mixing, toxicity
from equitrace.sources.workspace import session_dir

#: near copies: five-word shingles, similar at 80 of 100
NEAR_RULE = jaccard.Rule(5, 80, 100)
#: a document goes from this score on
TOXIC_SCORE = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model accepts; it learns from the labels of the data folder."""
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs, model, docs.columns, name="_toxicity")
    return scored.where(F.col("_toxicity") < TOXIC_SCORE).drop("_toxicity")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id."""
    return dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies: the one of least id."""
    rows = jaccard.on_files(docs)
    groups = jaccard.near_components(rows, NEAR_RULE)
    gone = groups.where("not keeper").select(F.col("place").alias("_place"))
    return rows.withColumn("_place", jaccard.place()).join(gone, "_place", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: every row once, those of small sources again as planned."""
    rows = jaccard.on_files(docs).withColumn("_place", jaccard.place())
    copies, _ = mixing.mixture(rows.select(F.col("_place").alias("doc_id"), "source", "text"))
    copies = copies.select(F.col("doc_id").alias("_place"))
    return rows.join(copies, "_place").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode_texts(docs, path, decoded=False).select("doc_id", "n_tokens", "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: the stages learn weights and encode tokens, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{session_dir(spark)}/corpus-{uuid.uuid4().hex[:12]}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""Licences of files by sparse TF-IDF cosine to templates, then inheritance from the nearest directory.

Units of a file are each line, each block between blank lines, and the whole text; words are runs of
a-z and 0-9 after lowering A-Z. A word's idf is ln((N + 1) / (df + 1)) + 1 over all N files, whether it is in
a template or not. A file's own licence is that of its most similar unit, if the cosine reaches the
limit (ties: the smaller licence name). A file whose whole text reaches the limit, or which bears one of
the given names and has an own licence, is a licence file for its directory and all below; a file without
an own licence takes that of the nearest ancestor directory that has one.

Only units with an anchor word can reach the limit: the lightest words of a template that together stay
below the limit's part of its norm cannot do so without another. So the filter loses nothing.

Null texts have no units, null paths no directory. Rows are decided each by itself: repeated rows get the
same result. Without templates or files the result has no licences, or no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from equitrace.llm.text import lower_ascii, text_of
from equitrace.sources.workspace import stage

#: cosine from which a unit counts as a licence
LIMIT = 0.6
WORD = "[a-z0-9]+"
#: file names that make a file with a licence the licence of its directory
LICENCE_NAMES = ("license", "licence", "copying", "notice", "license.txt", "license.md", "copying.txt")

#: fixed values: notices by licence name
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("proprietary", "All rights reserved."),
)


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    return spark.createDataFrame([(k, *t) for k, t in enumerate(templates)], "template int, licence string, text string")


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))


def _template_weights(templates: DataFrame, idf: DataFrame) -> DataFrame:
    """template, licence, word, weight, norm, anchor; a few hundred rows at most."""
    terms = templates.select("template", "licence", F.explode(words_of(F.col("text"))).alias("word"))
    terms = terms.groupBy("template", "licence", "word").agg(F.count("*").alias("tf"))
    terms = terms.join(F.broadcast(idf), "word").withColumn("weight", F.col("tf") * F.col("idf"))
    whole = Window.partitionBy("template")
    up = whole.orderBy("weight", "word").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    square = F.col("weight") * F.col("weight")
    norm = F.sqrt(F.sum(square).over(whole))
    # the margin keeps rounding from costing an anchor
    light = F.sqrt(F.sum(square).over(up)) < LIMIT * (1 - 1e-9) * norm
    return terms.select("template", "licence", "word", "weight", norm.alias("norm"), (~light).alias("anchor"))


def _units(files: DataFrame) -> DataFrame:
    """id, unit (number in the file, 0 the whole text), body."""
    lines = F.split("text", "\n")
    blocks = F.split("text", "\n[ \t\r]*\n")
    bodies = F.concat(F.array("text"), lines, blocks)
    return files.select("id", F.posexplode(bodies).alias("unit", "body"))


def own_licences(files: DataFrame, templates: DataFrame) -> DataFrame:
    """id, licence, score, whole for the files (id, text) that have a unit similar to a template.

    The vocabulary of the templates, its idf and the anchors are bounded by the templates, which are a
    parameter; they alone are broadcast or collected. Texts are scanned, never shuffled. The files are counted
    for every word, first where they lie; unit terms meet these counts in an equi-join.
    """
    vocabulary = sorted(r["word"] for r in templates.select(F.explode(words_of(F.col("text"))).alias("word")).distinct().collect())
    words = files.select(F.explode(F.array_distinct(words_of(F.col("text")))).alias("word"))
    seen = stage(words.groupBy("word").agg(F.count("*").alias("df")), "licence-df")
    known = {r["word"]: r["df"] for r in seen.where(F.col("word").isin(vocabulary)).collect()}
    n = files.count()
    spark = files.sparkSession

    def weighed(counts: DataFrame) -> DataFrame:
        return counts.select("word", (F.log(F.lit(n + 1.0) / (F.col("df") + 1)) + 1).alias("idf"))

    idf = weighed(spark.createDataFrame([(w, known.get(w, 0)) for w in vocabulary], "word string, df bigint"))
    weights = stage(_template_weights(templates, idf), "licence-weights")
    anchors = [r["word"] for r in weights.where("anchor").select("word").distinct().collect()]
    anchored = F.arrays_overlap(words_of(F.col("body")), F.array(*[F.lit(w) for w in anchors])) if anchors else F.lit(False)
    likely = files.select("id", "text", F.col("text").alias("body")).where(anchored)
    units = _units(likely).where(anchored)
    tf = units.select("id", "unit", F.explode(words_of(F.col("body"))).alias("word"))
    tf = tf.groupBy("id", "unit", "word").agg(F.count("*").alias("tf"))
    # every word of a unit is one of its file's, so none is lost
    tf = tf.join(weighed(seen), "word").withColumn("w", F.col("tf") * F.col("idf"))
    tf = stage(tf.select("id", "unit", "word", "w"), "licence-terms")
    norms = tf.groupBy("id", "unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    dots = tf.join(F.broadcast(weights.select("template", "licence", "word", "weight", "norm")), "word")
    dots = dots.groupBy("id", "unit", "template", "licence", "norm").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    scores = dots.join(norms, ["id", "unit"]).withColumn("score", F.round(F.col("dot") / (F.col("length") * F.col("norm")), 6))
    scores = scores.where(F.col("score") >= LIMIT)
    top = scores.groupBy("id").agg(F.max("score").alias("score"), F.max(F.col("unit") == 0).alias("whole"))
    names = scores.select("id", "score", "licence").join(top, ["id", "score"]).groupBy("id", "score", "whole")
    return names.agg(F.min("licence").alias("licence")).select("id", "licence", "score", "whole")


def ancestors(directory: Column) -> Column:
    """The directory itself and all above it, as (depth, path); the root is the empty path at depth 0."""
    parts = F.split(directory, "/")
    above = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, F.lit(1), k), "/").alias("path")),
    )
    root = F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("path")))
    return F.when(directory == "", root).otherwise(F.concat(root, above))


def _directory(path: Column) -> Column:
    above = F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.lit(""))
    return F.when(path.isNotNull(), above)


def scan_licences(files: DataFrame, templates: DataFrame, id_col: str, path: Column, text_col: str = "text") -> DataFrame:
    """One row per file: id, licence, origin (own, inherited, none), score of an own licence.

    Directories are joined once each, not per file; a directory has one licence row, so a hot directory
    is the larger side of a plain equi-join.
    """
    base = files.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), path.alias("path"))
    own = stage(own_licences(base.select("id", "text"), templates), "licence-own")
    places = base.select("id", "path", _directory(F.col("path")).alias("dir"))
    name = lower_ascii(F.regexp_extract("path", "[^/]*$", 0))
    named = places.join(own, "id")
    givers = named.where(F.col("whole") | name.isin(*LICENCE_NAMES))
    best = givers.groupBy("dir").agg(F.max("score").alias("score"))
    giving = givers.join(best, ["dir", "score"]).groupBy("dir").agg(F.min("licence").alias("given"))
    above = places.where("dir is not null").select("dir").distinct().select("dir", F.explode(ancestors(F.col("dir"))).alias("up"))
    above = above.join(giving.withColumnRenamed("dir", "at"), F.col("up.path") == F.col("at"))
    nearest = above.groupBy("dir").agg(F.max(F.struct(F.col("up.depth").alias("depth"), "given")).alias("best"))
    nearest = nearest.select("dir", F.col("best.given").alias("given"))
    out = places.join(own, "id", "left").join(nearest, "dir", "left")
    origin = F.when(F.col("licence").isNotNull(), "own").when(F.col("given").isNotNull(), "inherited").otherwise("none")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("licence", "given").alias("licence"),
        origin.alias("origin"),
        "score",
    )

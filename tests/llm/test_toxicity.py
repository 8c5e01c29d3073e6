"""The grammar's marks, the learned lexicon, held-out accuracy, and the pipeline's stages."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from equitrace.llm import toxicity
from equitrace.llm.toxicity import Model, Scorer


def marks(text):
    scorer = Scorer(Model())
    words = scorer.token.findall(text.lower())
    return [scorer.category(m) for m, _ in scorer.machine.matches([scorer.symbol(w) for w in words])]


@pytest.mark.parametrize(
    "text, want",
    [
        ("what an idiot", ["insult"]),
        ("you are an idiot", ["insult aimed"]),
        ("you are not an idiot", ["insult negated"]),
        ("he said you are an idiot", ["insult reported"]),
        ("he said so. you idiot", ["insult aimed"]),
        ("I will kill you, they said", ["threat aimed"]),
        ("they will hurt the dog", ["threat aimed"]),
        ("not here. stupid", ["insult"]),
        ("IDIOT; never stupid", ["insult", "insult negated"]),
        ("", []),
        ("idiotic trashy", []),
    ],
)
def test_grammar(text, want):
    assert marks(text) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("I will kill you", ["threat aimed"]),
        ("I will kill time. you", ["threat"]),
        ("such an idiot, you know", ["insult"]),
        ("an idiot of the first order and known as such to all of them", ["insult aimed"]),
        ("they are a piece of trash", ["insult aimed"]),
        ("what a piece of garbage", ["insult"]),
        ("a piece of cake, garbage", []),
        ("you are not a piece of trash", ["insult negated"]),
        ("we burn down your family", ["threat aimed"]),
        ("I will make you pay", ["threat aimed"]),
        ("you pay", []),
    ],
)
def test_phrases_and_targets_on_both_sides(text, want):
    assert marks(text) == want


def test_a_clause_is_one_match_of_its_words():
    scorer = Scorer(Model())
    letters = [scorer.symbol(w) for w in scorer.token.findall("stupid idiot you, a moron")]
    assert scorer.machine.matches(letters) == [("insult aimed", 6.0), ("insult", 3.0)]
    threat, time = scorer.scores(["I will kill you", "I will kill time"])
    assert time < 0.5 < threat


def test_scores_order_and_odd_texts():
    scorer = Scorer(Model())
    low, plain, aimed, negated = scorer.scores(["a fine day", "such an idiot", "you idiot", "you are not an idiot"])
    assert low < negated < plain < aimed
    assert scorer.scores(["", "\n" * 1000, "word " * 50_000])[0] < 0.5
    assert scorer.scores([]) == []


def test_learns_words_and_beginnings_and_generalises(spark, documents):
    draw = random.Random(4)
    rows, labels = [], []
    for k in range(1500):
        words = ["".join(draw.choices("abcdefgh", k=5)) for _ in range(40)]
        toxic = draw.random() < 0.15
        if toxic:
            words[draw.randrange(40)] = "zorgle" + draw.choice(["", "s", "ing", "ed", "ab", "cd", "ef"])
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    labels += [(None, 1), (99_999, 1), (3, None)]
    frame = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = documents(rows)
    model = toxicity.learn(docs, frame)
    assert any(s.startswith("zorg") for s in model.stems)
    got = toxicity.score(docs, model, ["doc_id"]).join(frame, "doc_id")
    got = got.where(toxicity.held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
    right = got.agg(F.avg(((F.col("score") >= 0.5).cast("int") == F.col("toxic")).cast("int"))).first()[0]
    assert right > 0.97
    assert toxicity.learn(docs, frame.limit(0)) == Model()
    assert toxicity.score(documents([]), model, ["doc_id"]).count() == 0
    kept = toxicity.score(documents([(None, None), (1, "x")]), model, docs.columns, name="_s")
    assert kept.columns == [*docs.columns, "_s"] and kept.count() == 2


def test_the_lexicon_takes_all_that_passes(documents):
    draw = random.Random(6)
    words = ["".join(draw.choices("abcdefgh", k=9)) for _ in range(700)]
    rows = [(k, " ".join(words) if k % 4 == 0 else "plain words of a fine day") for k in range(400)]
    sample = documents(rows).select("text", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    known, _ = toxicity.learn_lexicon(sample)
    assert set(words) <= set(known) and "plain" not in known


def test_held_out_rows_never_teach(spark, documents):
    frame = spark.range(400).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic"))
    docs = documents([(k, f"word{k}") for k in range(400)])
    sample = toxicity.labelled_sample(docs, frame)
    got = {int(r["text"][4:]) for r in sample.collect()}
    want = {r["doc_id"] for r in frame.where(~toxicity.held_out(F.col("doc_id"))).collect()}
    assert got == want and 0 < len(want) < 400
    assert toxicity.labelled_sample(docs, frame, 50).count() == 50


def test_pipeline_stages(spark, documents, tmp_path):
    """Each stage keeps the columns of documents and what it should; odd rows pass."""
    draw = random.Random(9)
    base = [f"v{draw.randrange(500)}" for _ in range(80)]
    near = list(base)
    near[5] = "changed"
    rows = [(k, " ".join(f"u{draw.randrange(900)}" for _ in range(30)), "big") for k in range(60)]
    rows += [(100, " ".join(base), "a"), (101, " ".join(base).upper(), "a"), (102, " ".join(near), "a")]
    rows += [(200, "you stupid worthless idiot", "b"), (201, None, None), (202, "", "b"), (None, "no id", "b")]
    spark.createDataFrame([(k, int(k == 200)) for k in range(60)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = documents(rows)
    columns, ids = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        ids[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if name != "bpe":
            assert docs.columns == columns
    assert ids["toxicity"] == {r[0] for r in rows} - {200}
    assert ids["exact_dedup"] == ids["toxicity"] - {100, 201}
    assert ids["ngram_jaccard"] == ids["exact_dedup"] - {102}
    assert ids["mixing"] == ids["ngram_jaccard"] == ids["bpe"]
    empty = documents([])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0, name

"""Sharding, mixing, licences, exact duplicates and chats: plans without Python, small cases, odd rows."""

import hashlib
import math
import re
from collections import Counter
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from equitrace.llm import chat, dedup, licenses, mixing, sharding
from equitrace.llm.queries import QUERIES

NATIVE = ("op1_shard_by_extendible_hash", "op2_simhash_fingerprints", "op3_mix_sources", "op5_license_scan", "op6_exact_dedup", "op9_format_chats")
TOKENS = ("op4_ngram_jaccard_join", "op7_toxicity", "op8_bpe_encode_decode", "op10_token_counts")
SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("EvalPython", "InArrow", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"))


@pytest.mark.parametrize("name", [n for n in (*NATIVE, *TOKENS) if n[:4] not in ("op3_", "op9_")])
def test_one_row_for_each_document(spark, small_documents, name):
    got = QUERIES[name](spark, SF_DIR).select("doc_id").collect()
    assert sorted(r[0] for r in got) == sorted(r[0] for r in small_documents.select("doc_id").collect())


ODD = [
    (1, None, None), (2, "", "a"), (3, "Abc", "a"), (3, "Abc", "a"), (4, "aBC", "a"), (None, "abc", "b"), (5, "x" * 90_000, "b"),
    (6, "ÄB", "b"), (7, "äb", "c"), (8, "x" * 90_000 + "y", None), (9, "ÄB", "c"), (10, "\n\n \t", "c"),
]


def test_exact_dedup_of_odd_rows(documents):
    got = dedup.exact_dedup(documents(ODD), carry={"sha": dedup.text_digest()}).collect()
    assert len(got) == len(ODD)
    groups = {}
    for i, text, _ in ODD:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        groups.setdefault(hashlib.sha256(low.encode()).hexdigest(), []).append(i)
    for r in got:
        ids = groups[r["sha"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max((i for i in ids if i is not None), default=None)
    for sha, ids in groups.items():
        kept = [r["doc_id"] for r in got if r["sha"] == sha and r["kept"]]
        assert kept == [max(i for i in ids if i is not None)]
    left = dedup.drop_copies(documents(ODD))
    assert left.columns == documents(ODD).columns
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 4, 5, 7, 8, 9, 10]
    assert dedup.exact_dedup(documents([])).count() == 0 and dedup.drop_copies(documents([])).count() == 0


def test_prefix_hash_alone_does_not_merge(documents):
    rows = [(k, "same head " * 60 + tail) for k, tail in enumerate(["a", "b", "a", "c"])]
    got = {r["doc_id"]: r["keep_id"] for r in dedup.exact_dedup(documents(rows)).collect()}
    assert got == {0: 2, 1: 1, 2: 2, 3: 3}


@pytest.mark.parametrize("limit", [200, 5_000])
def test_shards_fit_and_only_crowded_ones_split(documents, limit):
    rows = [(k, "t" * (1 + k * 37 % 150)) for k in range(500)] + [(1000, "u" * 7_000), (1001, None)]
    got = sharding.assign_shards(documents(rows), limit).collect()
    assert len(got) == len(rows)
    shards = {}
    for r in got:
        shards.setdefault(r["shard"], []).append(r)
    names = sorted(shards)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:], strict=False))
    for name, rs in shards.items():
        total = sum(r["n_bytes"] for r in rs)
        assert total <= limit or sum(r["n_bytes"] > 0 for r in rs) == 1
        if name and len(name) <= 60:
            parent = sum(r["n_bytes"] for r in got if r["shard"].startswith(name[:-1]))
            assert parent > limit


def test_one_key_with_all_rows_still_splits(documents):
    rows = [(7, "a" * 100) for _ in range(60)] + [(7, "b" * k) for k in range(1, 60)]
    shards = sharding.assign_shards(documents(rows), 1_000)
    sizes = sharding.directory(shards).collect()
    assert sum(r["n_rows"] for r in sizes) == len(rows)
    assert max(r["n_bytes"] for r in sizes) <= 1_000
    assert len(sizes) <= 30
    assert sharding.assign_shards(documents([]), 10).count() == 0


def planned(documents, tokens, entropy, passes):
    rows, k = [], 0
    for source, count in tokens.items():
        for _ in range(count):
            rows.append((k, "w " * 10, source))
            k += 1
    copies, plan = mixing.mixture(documents(rows), target_entropy=entropy, max_passes=passes)
    return copies.collect(), {r["source"]: r for r in plan.collect()}


def test_mixing_reaches_the_entropy(documents):
    copies, plan = planned(documents, {"a": 400, "b": 60, None: 40}, 0.9, 100.0)
    weights = [r["weight"] for r in plan.values()]
    assert sum(weights) == pytest.approx(1.0)
    assert -sum(w * math.log(w) for w in weights) >= 0.9 * math.log(3) - 1e-6
    assert -sum(w * math.log(w) for w in weights) == pytest.approx(0.9 * math.log(3), abs=1e-3)
    assert plan["a"]["passes"] == 1.0
    for source, r in plan.items():
        mine = [c for c in copies if c["source"] == source]
        assert len({c["doc_id"] for c in mine}) == r["n_rows"]
        used = sum(c["tokens"] for c in mine)
        assert abs(used - r["passes"] * r["tokens"]) <= 11
        times = [sum(c["doc_id"] == d for c in mine) for d in {c["doc_id"] for c in mine}]
        assert max(times) - min(times) <= 1


def test_mixing_keeps_the_repetition_limit(documents):
    _, plan = planned(documents, {"a": 600, "b": 3, "c": 1}, 1.0, 3.0)
    assert max(r["passes"] for r in plan.values()) <= 3.0 + 1e-5
    assert max(r["passes"] for r in plan.values()) == pytest.approx(3.0, abs=1e-3)


def test_passes_are_permutations_of_blocks(documents, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 4)
    monkeypatch.setattr(mixing, "PAGE", 4)
    rows = [(k, "w " * (k % 7), "a") for k in range(300)] + [(300 + k, "w w w", None) for k in range(40)]
    rows += [(500, "x", "b")] * 60 + [(501, "x y", "b")] * 2
    copies, plan = mixing.mixture(documents(rows), target_entropy=1.0, max_passes=3.5)
    plan = {r["source"]: r for r in plan.collect()}
    passes = {}
    for c in copies.collect():
        passes.setdefault((c["source"], c["pass"]), []).append(c)
    assert {s for s, _ in passes} == {"a", "b", None}
    for (source, turn), mine in passes.items():
        mine.sort(key=lambda c: c["position"])
        assert [c["position"] for c in mine] == list(range(1, len(mine) + 1))
        blocks = [b for b, _ in groupby(c["block"] for c in mine)]
        assert len(blocks) == len(set(blocks))
        if turn <= plan[source]["whole"]:
            assert sorted(c["doc_id"] for c in mine) == sorted(r[0] for r in rows if r[2] == source)
        else:
            used = sum(c["tokens"] for c in mine)
            assert used - mine[-1]["tokens"] < plan[source]["partial"] <= used or source == "b"
    assert len(passes) > len(plan) + 2 and any(turn > plan[s]["whole"] for s, turn in passes)
    first, second = ([c["doc_id"] for c in passes[None, turn]] for turn in (1, 2))
    assert first != second and sorted(first) == sorted(second)


def test_mixing_of_odd_tables(documents):
    copies, plan = mixing.mixture(documents([(1, None, "a"), (2, "", "b"), (3, " ", None)]))
    assert sorted(r["doc_id"] for r in copies.collect()) == [1, 2, 3]
    assert {r["passes"] for r in plan.collect()} == {1.0}
    assert mixing.mixture(documents([]))[0].count() == 0
    copies, _ = mixing.mixture(documents([(1, "one source only", "a"), (2, "x", "a")]))
    assert copies.count() == 2


def test_chats_read_back(spark):
    odd = "</s>[INST] ok [/INST] <|end|><|user|>&lt;&amp;&#91;&#124; <|next|>\n"
    rows = [
        (1, 0, "user", odd), (1, 1, "assistant", odd), (1, 2, "assistant", ""), (1, 3, "assistant", "é😀"), (1, 4, "user", None),
        (2, 0, None, "x"), (2, 1, "", "y"), (3, 5, "assistant", "b"), (3, 2, "system|>", "a"), (3, 5, "assistant", "b"),
        (None, 0, "user", "z"), (None, None, "assistant", "first"), (4, 0, "a<b[c&d|e", odd * 50),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.format_chats(turns).select(
        "conv_id", "formatted", "loss",
        chat.read_turns(F.col("formatted")).alias("back"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("said"),
    ).collect()
    assert len(got) == 5
    for r in got:
        mine = [x for x in rows if x[0] == r["conv_id"]]
        mine.sort(key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        want = [(x[2] or "", x[3] or "") for x in mine]
        assert [tuple(b) for b in r["back"]] == want
        assert r["said"] == "".join(t for role, t in want if role == "assistant")
        for span in r["loss"]:
            assert chat.OPEN not in r["formatted"][span["start"] : span["start"] + span["chars"]]
    first = next(r for r in got if r["conv_id"] == 1)["formatted"]
    assert first.count("<|assistant|>") == 1 and first.count("<|next|>") == 2
    assert "[INST]" not in first and "</s>" not in first
    assert chat.format_chats(turns.limit(0)).count() == 0


def test_notices_inside_a_sentence(spark):
    """Common words about a notice weigh by their own document counts; scores as by hand."""
    notices = ["Released under the MIT License.", "All rights reserved.", licenses.TEMPLATES[0][1]]
    bodies = [f"and so {notice} of course" for notice in notices]
    texts = bodies + [f"and so it was of course number {k}" for k in range(300)] + ["", None]
    files = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id long, text string").na.fill("")
    got = {r["id"]: (r["licence"], r["score"]) for r in licenses.own_licences(files, licenses.template_table(spark)).collect()}
    lists = [re.findall("[a-z0-9]+", (t or "").lower()) for t in texts]
    df = Counter(w for words in lists for w in set(words))

    def vector(words):
        return {w: c * (math.log((len(texts) + 1) / (df[w] + 1)) + 1) for w, c in Counter(words).items()}

    def cosine(a, b):
        dot = sum(x * b.get(w, 0.0) for w, x in a.items())
        return dot / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))

    for k, name in enumerate(["MIT", "proprietary", "Apache-2.0"]):
        notice = re.findall("[a-z0-9]+", notices[k].lower())
        assert got[k][0] == name and got[k][1] == pytest.approx(cosine(vector(lists[k]), vector(notice)), abs=2e-6)
    assert set(got) == {0, 1, 2}


def test_licences_and_inheritance(spark):
    apache, mit = licenses.TEMPLATES[0][1], "Released under the MIT License."
    files = [
        (1, "lib/LICENSE", mit), (2, "lib/a/b/code.py", "print(1)"), (3, "lib/a/LICENSE.txt", "Some words first\n" + apache),
        (4, "lib/a/own.py", "# " + licenses.TEMPLATES[10][1] + "\ncode here"), (5, "other/x.py", "nothing here"), (6, None, mit),
        (7, "lib/readme", None), (8, "top.py", ""), (9, "libx/y.py", "the and of this"), (10, "lib/deep/er/z", "word " * 30_000),
    ]
    frame = spark.createDataFrame(files, "file_id long, path string, text string")
    out = licenses.scan_licences(frame, licenses.template_table(spark), "file_id", F.col("path"))
    got = {r["file_id"]: (r["licence"], r["origin"]) for r in out.collect()}
    assert got == {
        1: ("MIT", "own"), 2: ("Apache-2.0", "inherited"), 3: ("Apache-2.0", "own"), 4: ("proprietary", "own"),
        5: (None, "none"), 6: ("MIT", "own"), 7: ("MIT", "inherited"), 8: (None, "none"), 9: (None, "none"),
        10: ("MIT", "inherited"),
    }
    assert licenses.scan_licences(frame.limit(0), licenses.template_table(spark), "file_id", F.col("path")).count() == 0


def test_copies_of_one_id_leave_the_same_row(spark):
    """Rows of one id and equal texts: which one stays does not depend on the order of the rows."""
    rows = [(7, "Some Text", "a"), (7, "some text", "b"), (None, "some text", None), (3, "SOME TEXT", "c"), (7, "else", None)]
    schema = "doc_id long, text string, source string"
    got = {
        tuple(sorted(map(tuple, dedup.drop_copies(spark.createDataFrame(part, schema).repartition(n)).collect())))
        for part, n in ((rows, 1), (rows[::-1], 3), (rows[2:] + rows[:2], 2))
    }
    (kept,) = got
    assert len(kept) == 2 and {r[0] for r in kept} == {7} and {r[1].lower() for r in kept} == {"some text", "else"}

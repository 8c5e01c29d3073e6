"""Near-duplicate joins, fingerprints and components against brute force."""

import hashlib
import random
from itertools import combinations

import pytest

from equitrace.llm import jaccard, order, simhash
from equitrace.llm.components import connected_components
from equitrace.llm.queries import QUERIES


def shingles(text, k):
    words = (text or "").encode().lower().split()
    size = min(k, len(words))
    return frozenset(tuple(words[j : j + size]) for j in range(len(words) - size + 1)) if words else frozenset()


def components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def expected(rows, rule):
    sets = {i: shingles(t, rule.words) for i, t in rows}
    links = [
        (a, b)
        for a, b in combinations(sorted(sets), 2)
        if sets[a] and rule.den * len(sets[a] & sets[b]) >= rule.num * len(sets[a] | sets[b])
    ]
    return {i: (len(sets[i]), c) for i, c in components(list(sets), links).items()}


def near_copies(seed, bases, copies, length, edits, vocabulary=400):
    draw = random.Random(seed)
    rows, i = [], 0
    line = "a line that very many of the documents have in common with each other today"
    for _ in range(bases):
        base = [f"w{draw.randrange(vocabulary)}" for _ in range(length)]
        for _ in range(draw.randint(1, copies)):
            words = list(base)
            for _ in range(draw.randint(0, edits)):
                words[draw.randrange(length)] = f"e{draw.randrange(10**6)}"
            text = " ".join(words) + ("\n" + line if draw.random() < 0.5 else "")
            rows.append((i * 7 % 10_007, text.upper() if draw.random() < 0.1 else text))
            i += 1
    return rows


CASES = {
    "few large groups": near_copies(1, 3, 60, 60, 6),
    "many small groups": near_copies(2, 40, 4, 40, 4),
    "short texts": near_copies(3, 30, 6, 4, 1, 6),
    "one hot group": near_copies(5, 2, 120, 50, 3),
    "few words": [(i, " ".join(random.Random(i).choices("ab", k=i % 9))) for i in range(120)],
    "long texts": near_copies(6, 3, 6, 900, 90, 100_000),
}


def all_cases():
    """Every case in one table: words and ids of different cases never meet."""
    return [(k * 100_000 + i, " ".join(f"{w}.{k}" for w in (t or "").split())) for k, c in enumerate(CASES) for i, t in CASES[c]]


def near(documents, rows, rule):
    got = jaccard.near_components(documents(rows), rule).collect()
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}


@pytest.mark.parametrize("rule", [jaccard.Rule(3, 90, 100), jaccard.Rule(5, 80, 100)], ids=["3-90", "5-80"])
def test_components_against_brute_force(documents, rule):
    rows = all_cases()
    assert near(documents, rows, rule) == expected(rows, rule)


@pytest.mark.parametrize("frequent, long_set, rounds", [(2, 512, 2), (3, 8, 2), (2, 8, 0)])
def test_frequent_classes_lose_no_link(documents, monkeypatch, frequent, long_set, rounds):
    """With nearly all shingles frequent, combinations, centres and (without centres) the second index carry the join."""
    monkeypatch.setattr(jaccard, "CENTRE_ROUNDS", rounds)
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "LONG_SET", long_set)
    rule = jaccard.Rule(3, 80, 100)
    rows = near_copies(8, 3, 40, 25, 4, 60) + [(i + 5000, t) for i, t in CASES["short texts"]]
    assert near(documents, rows, rule) == expected(rows, rule)


def test_odd_rows(documents, spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "two words"), (7, "two  WORDS"), (7, "two words")]
    got = [tuple(r)[:3] for r in jaccard.near_components(documents(rows), jaccard.Rule(3, 90, 100)).collect()]
    assert sorted(got) == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 1, 6), (7, 1, 6)]
    assert jaccard.near_components(documents([])).count() == 0


def test_rows_of_null_and_repeated_ids(documents):
    """Every row is a document: none is lost, and rows of one id may be in different components."""
    a, b = "first text of many words here", "second one with other words in it"
    rows = [(0, b), (1, a), (1, b), (2, a), (None, a), (None, "alone without any id"), (None, "alone without any id"), (3, "x")]
    got = jaccard.near_components(documents(rows), jaccard.Rule(3, 90, 100)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2] is None, r[2] or 0, r[1])
    want = [(0, 5, 0), (1, 4, 1), (1, 5, 0), (2, 4, 1), (None, 4, 1), (None, 2, None), (None, 2, None), (3, 1, 3)]
    assert sorted([tuple(r)[:3] for r in got], key=key) == sorted(want, key=key)
    # four components of several rows or one: each keeps one row
    assert sum(r["keeper"] for r in got) == 4 and len({r["place"] for r in got}) == len(rows)


def test_crowd_that_shares_most_of_a_template(documents):
    """Many texts that share a long passage and are not similar: linked only where their own words agree."""
    draw = random.Random(11)
    passage = [f"p{k}" for k in range(60)]
    rows = []
    for i in range(150):
        own = [f"o{draw.randrange(10**6)}" for _ in range(12)]
        words = passage + own if i % 2 else own + passage
        rows.append((i, " ".join(words)))
        if i % 10 == 0:
            rows.append((1000 + i, " ".join([*words, "end"])))
    rule = jaccard.Rule(3, 90, 100)
    assert near(documents, rows, rule) == expected(rows, rule)


@pytest.mark.parametrize("sketched", [20, 1])
def test_crowd_of_sets_that_are_not_similar_enough_makes_few_pairs(documents, monkeypatch, sketched):
    """Texts of one template that choose among few variants meet often; only near ones become pairs."""
    made, real = [], jaccard._plausible
    monkeypatch.setattr(jaccard, "_plausible", lambda pairs, *a: made.append(pairs.count()) or real(pairs, *a))
    monkeypatch.setattr(jaccard, "SKETCHED", sketched, raising=False)
    draw, rows = random.Random(12), []
    for i in range(150):
        words = [f"p{k}" for k in range(100)]
        for k in range(5, 100, 12):
            words[k] = f"v{k}.{draw.randrange(3)}"
        rows.append((i, " ".join(words)))
    rule = jaccard.Rule(3, 90, 100)
    assert near(documents, rows, rule) == expected(rows, rule)
    assert sum(made) < 5 * len(rows)


def test_group_of_near_copies_costs_its_size(documents, monkeypatch):
    """Copies of one text are compared with a centre: pairs and links grow with the copies, not with their square."""
    made, real = [], jaccard._verified
    monkeypatch.setattr(jaccard, "_verified", lambda pairs, *a: made.append(pairs.count()) or real(pairs, *a))
    draw, base, rows = random.Random(13), [f"w{k}" for k in range(120)], []
    for i in range(150):
        words = list(base)
        words[draw.randrange(120)] = f"e{i}"
        rows.append((i, " ".join(words)))
    rule = jaccard.Rule(3, 90, 100)
    assert near(documents, rows, rule) == expected(rows, rule)
    assert 0 < sum(made) < 5 * len(rows)


@pytest.mark.parametrize("sketched", [20, 1])
def test_components_by_centres_and_by_sketches(documents, monkeypatch, sketched):
    """Large groups give the same components whether centres or all pairs of sketches join them."""
    monkeypatch.setattr(jaccard, "SKETCHED", sketched)
    rows, rule = CASES["one hot group"] + [(i + 50_000, t) for i, t in CASES["few large groups"]], jaccard.Rule(3, 80, 100)
    assert near(documents, rows, rule) == expected(rows, rule)


@pytest.mark.parametrize("edits", [6, 14])
def test_long_near_copies_that_are_not_similar_enough_make_few_pairs(documents, monkeypatch, edits):
    """Long sets of one template outgrow small sketches; what each has of its own and finer sketches keep them apart."""
    made, real = [], jaccard._crossing
    monkeypatch.setattr(jaccard, "_crossing", lambda *a: made.append((pairs := real(*a)).count()) or pairs)
    draw, rows = random.Random(14), []
    for i in range(60):
        words = [f"p{k}" for k in range(400)]
        for k in draw.sample(range(400), edits):
            words[k] = f"e{i}.{k}"
        rows.append((i, " ".join(words)))
    rows += [(100, rows[0][1] + " end"), (101, rows[7][1].replace(" p3 ", " q3 "))]
    rule = jaccard.Rule(5, 80, 100)
    assert near(documents, rows, rule) == expected(rows, rule)
    assert made and sum(made) < 2 * len(rows)


def test_groups_of_a_key_have_a_set_of_its_own_class(documents, monkeypatch):
    """Sets of one class of size meet by the keys for it, not again by those for the next."""
    made, real = [], jaccard._index
    monkeypatch.setattr(jaccard, "_index", lambda *a: made.append(real(*a)) or made[-1])
    base = [f"w{k}" for k in range(120)]
    rows = [(i, " ".join([*base[:i], f"e{i}", *base[i + 1 :]])) for i in range(10, 110, 20)]
    rule = jaccard.Rule(3, 90, 100)
    assert near(documents, rows, rule) == expected(rows, rule)
    apart = rule.most_apart(rule.size_classes(118)[-2])
    assert made[0].select("key").distinct().count() <= apart + 1 + apart // jaccard.SPARE_PART


def test_sketches_differ_no_more_than_their_sets(spark):
    draw, rows, rule = random.Random(4), [], jaccard.Rule(3, 90, 100)
    for n in (1, 5, 60, 400, 3000):
        base = [draw.getrandbits(60) for _ in range(n)]
        for change in (0, 1, n // 25, n // 10, n):
            other = {*base[change:], *[draw.getrandbits(60) for _ in range(change)]}
            a, b = (jaccard.np.array(sorted(x), dtype=jaccard.np.int64) for x in (set(base), other))
            near = 100 * len(other & set(base)) >= 90 * len(other | set(base))
            rows.append((len(a), jaccard._parities(a), len(b), jaccard._parities(b), near))
    frame = spark.createDataFrame(rows, "n int, x array<bigint>, m int, y array<bigint>, near boolean")
    got = frame.select("n", "m", "near", jaccard._sketches_fit("n", "x", "m", "y", rule).alias("fits")).collect()
    assert all(r["fits"] for r in got if r["near"]) and sum(r["near"] for r in got) >= 5
    assert not any(r["fits"] for r in got if not r["near"] and 5 < r["n"] <= 400)


def test_connected_components(spark):
    draw = random.Random(3)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(400, 480)]
    links += [(1000, k) for k in range(1001, 1100)]
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["label"] for r in connected_components(frame).collect()}
    want = components(sorted({x for e in links for x in e}), links)
    assert all(want[n] == label for n, label in got.items())
    assert all(n in got or want[n] == n for n in want)
    assert connected_components(frame.limit(0)).count() == 0


def test_next_below(spark, monkeypatch):
    monkeypatch.setattr(order, "RANGE_ROWS", 7)
    ids = random.Random(1).sample(range(1000), 100)
    frame = spark.createDataFrame([(i, i * 2) for i in ids], "doc_id long, n long")
    got = {r["doc_id"]: (r["next_doc_id"], r["next_n"]) for r in order.next_below(frame, "doc_id", ["n"]).collect()}
    down = sorted(ids, reverse=True)
    assert got == {a: (b, 2 * b) for a, b in zip(down, [*down[1:], down[0]], strict=True)}
    one = order.next_below(frame.limit(1), "doc_id", ["n"]).first()
    assert one["doc_id"] == one["next_doc_id"]
    assert order.next_below(frame.limit(0), "doc_id", ["n"]).count() == 0


def prints_of(documents, rows):
    docs = simhash.with_terms(documents(rows).select("doc_id", "text").na.fill(""), "text", "terms")
    votes = simhash.count_votes(docs, ["doc_id"], "terms")
    return {r["doc_id"]: r["fingerprint"] for r in simhash.fingerprints(votes, ["doc_id"]).collect()}


def test_fingerprint_is_the_majority_vote(documents, spark):
    rows = [(k, t) for k, t in enumerate([r[1] for r in near_copies(9, 6, 4, 30, 4)])]
    rows += [(900, None), (901, ""), (902, "one"), (903, " one "), (904, "x y z"), (905, "v " * 700), (906, "a b c d e f " * 300)]
    got = prints_of(documents, rows)
    docs = simhash.with_terms(documents(rows).select("doc_id", "text").na.fill(""), "text", "terms")
    for r in docs.select("doc_id", "terms").collect():
        want = 0
        for b in range(64):
            if 2 * sum(t >> b & 1 for t in r["terms"]) > len(r["terms"]):
                want |= 1 << b
        assert got[r["doc_id"]] % 2**64 == want
    assert got[900] == got[901] == 0 and got[902] == got[903]


@pytest.mark.parametrize("radius", [0, 1, 3, 5])
def test_near_pairs_against_brute_force(spark, radius):
    draw = random.Random(radius)
    base = [draw.getrandbits(64) for _ in range(12)]
    prints = {b ^ sum(1 << p for p in draw.sample(range(64), draw.randint(0, 6))) for b in base for _ in range(12)}
    signed = sorted(p - 2**64 if p >> 63 else p for p in prints)
    frame = spark.createDataFrame([(p,) for p in [*signed, signed[0]]] + [(None,)], "fingerprint long")
    got = {(r["fingerprint"], r["other"]): r["distance"] for r in simhash.near_pairs(frame, radius).collect()}
    apart = {(a, b): (a ^ b).bit_count() if (a ^ b) >= 0 else ((a ^ b) % 2**64).bit_count() for a, b in combinations(signed, 2)}
    assert got == {k: d for k, d in apart.items() if d <= radius}
    asked = spark.createDataFrame([(signed[0],)], "fingerprint long")
    some = {r["other"] for r in simhash.near_pairs(frame, radius, asked).collect()}
    assert some == {b for b in signed if ((signed[0] ^ b) % 2**64).bit_count() <= radius}


def test_fingerprints_of_null_and_repeated_ids(spark, documents, tmp_path):
    """Each row gives one row; equal texts have equal fingerprints; the ring has no gap."""
    long = " ".join(f"w{k}" for k in range(400))
    rows = [(1, "one two three four five six"), (2, long), (2, long), (2, long), (2, long), (2, "other words here")]
    rows += [(3, long), (None, "no id at all"), (None, long), (4, None), (5, long + " tail")]
    documents(rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op2_simhash_fingerprints"](spark, str(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows)
    prints = [r["fingerprint"] for r in got if r["n_chars"] == len(long)]
    assert len(prints) == 6 and len(set(prints)) == 1
    # ring: by falling id, nulls last, longer texts first, then from the end to the start
    line = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, len(r[1] or "")), reverse=True)
    want = []
    for k, (doc_id, text) in enumerate(line):
        text, following = text or "", line[(k + 1) % len(line)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        want.append((str(doc_id), len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in got) == sorted(want)


def test_links_do_not_depend_on_the_sample_of_the_order(documents, monkeypatch):
    """Frequency classes only order the shingles: classes of one text in many give the links of brute force."""
    rows, rule = CASES["many small groups"], jaccard.Rule(3, 80, 100)
    monkeypatch.setattr(jaccard, "SAMPLE_DOCS", 1)
    assert near(documents, rows, rule) == expected(rows, rule)


def test_order_counts_the_shingles_of_all_texts(documents, monkeypatch):
    """A shingle's class tells how many of all texts have it, wherever they stand, not how many of a part of them."""
    monkeypatch.setattr(jaccard, "SAMPLE_DOCS", 20)
    rows = [(i, f"x{i} y{i} z{i} in every text" + " a common passage" * (0 < i % 30 < 7)) for i in range(600)]
    texts = documents(rows).selectExpr("doc_id as id", "text").repartition(2)
    shingler = jaccard.Shingler(3, jaccard._shingle_order(texts, jaccard.Rule(3, 90, 100)).value)
    kinds = [int(shingler(t)[0] >> (64 - jaccard.CLASS_BITS)) for t in ("x1 y1 z1", "a common passage", "in every text")]
    # in 1, 120 and 600 of 600 texts, so in less than 1, in 4 and in 20 of 20
    assert kinds == [0, 2, 4]

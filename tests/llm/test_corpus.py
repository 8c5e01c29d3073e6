"""Spelling variants, conversation tries and repeated lines against brute force, on odd rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from equitrace.llm import linededup, spelling, trie
from equitrace.llm.queries import QUERIES

A_TO_Z = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- lines


def dedup_slowly(docs, least_docs=3, least_chars=20):
    """Rows (place, id, text); a later place is larger where ids are equal."""

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(A_TO_Z)

    holders = defaultdict(list)
    for place, doc_id, text in docs:
        for k in {key(x) for x in (text or "").split("\n")}:
            holders[k].append((doc_id is not None, doc_id or 0, place))
    out = []
    for place, doc_id, text in docs:
        lines, me = (text or "").split("\n"), (doc_id is not None, doc_id or 0, place)
        gone = [
            len(key(x)) >= least_chars and len(holders[key(x)]) >= least_docs and max(holders[key(x)]) != me for x in lines
        ]
        kept = "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)
        out.append((doc_id, len(lines), sum(gone), kept))
    return sorted(out, key=repr)


LINES = ["a line that many of the documents hold", "\ta LINE that many of the documents hold \r", "short", "", "Émile was there, and É is not folded here",
         "éMile was there, and é is not folded here", "exactly twenty chars", "exactly nineteen ch", "x" * 300, "　wide blank is no white space here"]


@pytest.mark.parametrize("bits", [None, 1 << 16])
def test_lines_against_brute_force(spark, documents, tmp_path, monkeypatch, bits):
    """A filter far too small lets more lines pass as suspects and changes no result."""
    if bits:
        monkeypatch.setattr(linededup, "MAX_BITS", bits)
    draw = random.Random(4)
    docs = []
    for place in range(150):
        lines = [draw.choice([*LINES, f"own line number {draw.random()} of a text"]) for _ in range(draw.randint(0, 12))]
        docs.append((place, None if place in (3, 8) else place * 7 % 140, "\n".join(lines) if place % 9 else None))
    docs.append((150, 9999, "\n".join([LINES[0], *[f"line {k} of a very long text with many" for k in range(3000)], LINES[0]])))
    documents([d[1:] for d in docs]).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert rows_of(linededup.drop_repeated_lines(table)) == dedup_slowly(docs)


def test_lines_of_empty_and_repeated_rows(spark, documents, tmp_path):
    documents([]).write.parquet(f"{tmp_path}/none")
    assert linededup.drop_repeated_lines(spark.read.parquet(f"{tmp_path}/none")).count() == 0
    documents([(5, LINES[0])] * 3 + [(None, LINES[0])]).coalesce(1).write.parquet(f"{tmp_path}/same")
    got = rows_of(linededup.drop_repeated_lines(spark.read.parquet(f"{tmp_path}/same")))
    assert got == sorted([(5, 1, 1, ""), (5, 1, 1, ""), (5, 1, 0, LINES[0]), (None, 1, 1, "")], key=repr)


def test_filters_lose_no_repeat(spark):
    """Every hash of two documents is in the merged second filter, whatever task it was seen by."""
    draw = random.Random(2)
    sets = [[draw.randrange(-(2**63), 2**63) for _ in range(50)] for _ in range(40)]
    shared = sets[0][:20]
    frame = spark.createDataFrame([(s + shared * (k in (3, 39)),) for k, s in enumerate(sets)], "hashes array<long>")
    twice, slices = linededup.seen_twice(frame.repartition(7))
    every = spark.createDataFrame([(h,) for s in sets for h in s], "hash long")
    found = {r["hash"] for r in linededup._suspects(every, twice, slices).collect()}
    assert set(shared) <= found and len(found) < 200


# --- conversations


def trie_slowly(seqs):
    """Nodes of {conv_id: [(role, text)]}."""
    members = defaultdict(list)
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    kids = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for node, cs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += (len(cs) - 1) * len(node[-1][1].encode()) if node else 0
    out = []
    for node, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(seqs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(cs), len(node), parent, len(cs), kids[node], leaves[node], saved[node], digest))
    return sorted(out, key=repr)


def ordered(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(ts)] for c, ts in convs.items()}


TURNS = "conv_id long, turn long, role string, text string, u long, depth string"


def nodes_of(spark, rows):
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS)
    placed = trie.turn_ids(trie.place_turns(table))
    return rows_of(trie.prefix_trie(placed, placed.select("conv_id").distinct()))


def conversations(seed, n):
    draw = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(draw.choice([1, 2, 3, 7, 8, 9, 16, 17, 30])):
            role = ["user", "assistant", None][t % 2 if draw.random() < 0.9 else 2]
            rows.append((c, t, role, draw.choice(["yes", "é", "", None]) if draw.random() < 0.25 else "the same"))
    return rows


@pytest.mark.parametrize("ranges", [None, (4, 2, 5)])
def test_trie_against_brute_force(spark, monkeypatch, ranges):
    """Also with ranges of few turns, blocks and ids, so that every step has two levels."""
    if ranges:
        for name, size in zip(("TURN_RANGE", "BLOCK_RANGE", "ID_RANGE"), ranges, strict=True):
            monkeypatch.setattr(trie, name, size)
    rows = conversations(1, 60)
    # null and negative turn numbers, ties, a repeated row, no id, negative ids, one long conversation
    rows += [(70, None, "user", "b"), (70, None, "user", "a"), (70, -3, "user", "c"), (70, -3, "user", "c"), (None, 1, "user", "x")]
    rows += [(-7, 0, "user", "the same"), (80, 5, "ab", "c"), (81, 5, "a", "bc"), *[(90, t, "user", str(t)) for t in range(150)]]
    rows += [(91, t, "user", str(t)) for t in range(149)]
    draw = random.Random(1)
    draw.shuffle(rows)
    assert nodes_of(spark, rows) == trie_slowly(ordered(rows))


def test_trie_of_an_empty_table(spark):
    assert nodes_of(spark, []) == []


def test_rebuilt_conversations(spark, tmp_path):
    rows = [(c * 3 % 101 if c != 4 else None, t, r, x) for c, t, r, x in conversations(3, 120)]
    rows += [(c, 0, "user", "alone") for c in range(201, 215) if c % 5]  # their groups have no first conversation
    spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    own, seqs = ordered(rows), {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        seqs[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    assert [] in seqs.values()
    assert rows_of(QUERIES["op12_conversation_trie"](spark, str(tmp_path))) == trie_slowly(seqs)


# --- words


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants_slowly(counts, times=10):
    near = {w: [x for x in counts if one_apart(w, x)] for w in counts}
    form = {}
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= times * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), form[w] and counts[form[w]]))
    return sorted(out, key=repr)


def vocabulary(seed, letters, bases, length):
    draw = random.Random(seed)
    counts = {}
    for _ in range(bases):
        word, n = "".join(draw.choices(letters, k=draw.randint(4, length))), 10**6
        for _ in range(6):
            counts.setdefault(word, draw.choice([n, n, 3]))
            k, n = draw.randrange(len(word)), max(2, n // draw.choice([5, 10, 20]))
            word = draw.choice([word[:k] + word[k + 1 :], word[:k] + draw.choice(letters) + word[k:], word[:k] + draw.choice(letters) + word[k + 1 :]])
            word = word if len(word) >= 4 else word + "aaaa"
    return counts


@pytest.mark.parametrize("letters, bases, length, whole", [("ab", 60, 8, 6), ("abcdeé", 80, 7, 3), ("abcdefghijklmnopqrstuvwxyzß", 60, 14, 6), ("abc", 60, 12, 99)])
def test_variants_against_brute_force(spark, monkeypatch, letters, bases, length, whole):
    monkeypatch.setattr(spelling, "LONG_PART", whole)
    counts = vocabulary(7, letters, bases, length)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(spelling.group_variants(words)) == variants_slowly(counts)


def test_spelling_query(spark, documents, tmp_path):
    """Runs, worn runs, counts and chains of forms, with null ids and texts and repeated rows."""
    draw = random.Random(5)
    bases = ["spelling", "Straßenbahn", "ÉCOLIERS", "sevenxx", "letterings", "letterines"]
    rows = [(i if i % 50 else None, " ".join(draw.choices(bases, k=draw.randint(0, 60))) + "; it's 9abcdefgh1", "s") for i in range(250)]
    rows += [(7, None), (7, ""), (9, "spelling " * 400), (9, "spelling " * 400), (11, "speling spellings spelings")]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    counts = Counter()
    for row in rows:
        doc_id, text = "" if row[0] is None else row[0], row[1] or ""
        runs = "".join(c if c.isascii() and c.isalpha() or "À" <= c <= "ÿ" else " " for c in text).split()
        for run in runs:
            run = run.translate(A_TO_Z)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    got = rows_of(QUERIES["op11_spelling_variants"](spark, str(tmp_path)))
    assert got == variants_slowly(counts) and any(r[1] for r in got)


def test_no_words(spark, documents):
    words = spelling.count_words(spelling.worn_runs(spelling.letter_runs(documents([(1, None), (2, "a b")]), 7)), 7, 2)
    assert spelling.group_variants(words).count() == 0


def test_pivots_are_the_lightest_disjoint_pair():
    draw = random.Random(6)
    for _ in range(500):
        word = "".join(draw.choices("abcd", k=draw.randint(4, 10)))
        grams = [word[k : k + 2] for k in range(len(word) - 1)]
        weight = {g: draw.randint(1, 9) for g in grams}
        rank = {g: k for k, g in enumerate(sorted(weight, key=lambda g: (weight[g], g)))}
        prefix, (p, q), last = spelling.choose_pivots(grams, rank, weight)
        assert last == sorted(rank[g] for g in grams)[2] and prefix == [k for k, g in enumerate(grams) if rank[g] <= last]
        pairs = [weight[grams[a]] + weight[grams[b]] for a in prefix for b in prefix if b >= a + 2]
        assert q >= p + 2 and weight[grams[p]] + weight[grams[q]] == min(pairs)

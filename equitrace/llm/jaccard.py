"""Similarity join of word-shingle sets by Jaccard, with keys of set parts.

A set of n shingles that is similar to another shares at least o = ceil(t n) with it, and the two differ in
few shingles. With all sets in one order of shingles, similar sets share a shingle among their first n - o + 1
(the prefix). Shingles are ordered from rare to frequent: a class of frequency, then a hash. The class tells in how
many texts of the whole table a shingle is found: every shingle of every text is counted, in COUNTERS counters by its
hash, so that counting takes the same memory whatever the table. Shingles that share a counter share a class; any
fixed order gives the same links, so that costs none.

1. Each set gives its head: its prefix and some shingles more (the slack). A shingle counts as shared if
   two heads have it. A set whose head holds a prefix of shingles of its own, and no more shared ones
   than the slack of the smallest set it may be similar to, has no similar set: had it one, all but
   n - o of that one's head would be in its own head. Such sets leave here, most of a corpus.
2. The rest, equal sets once, is indexed by parts. A hash deals the shingles to more parts than similar sets of
   these sizes may differ in shingles, so similar sets agree in one whole part at least. Sizes are cut into
   classes so that similar sets are of one class or of neighbours; a set is dealt for its own class and for
   the next. A part holds several shingles (about (1 + t) / (2 - 2 t)), so common words or passages do not
   bring sets together, copies do. Long sets have some parts to spare: as they agree in that many parts more, parts that
   say little (empty, or few shingles and all frequent) are no keys, unless a set has too many of them.
3. Each set has a sketch: the parity of its shingles in each of SKETCH_BITS buckets, by which sets differ in at
   most as many bits as in shingles. Pairs of an index group are made only where sketches and then heads
   differ no more than similar sets may; those that are left are verified on the whole sets. In every group each
   set is compared with a centre, again with other centres while sets of one group are in different components.
   In groups that then still hold several components, sets leave that share too few of their shingles with other
   components. The rest compares finer sketches of all pairs across components, or, where it is large, is indexed
   anew by the rarest of the shingles that heads share with other components. So a group of copies costs its
   size, and no link between components is missed.

Null texts are empty; without words the set is empty and linked with nothing; a text of fewer words than
a shingle has is one shingle. Every row is a document of its own, told apart by its place in the files (a
64-bit hash; a table that is no plain scan of files is written first), whatever its id: repeated ids and
null ids are rows like others. A component is named by its least id that is not null, or null where it has
none. An empty table gives an empty result. Columns beside id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equitrace.llm.components import connected_components
from equitrace.llm.vocab import map_texts
from equitrace.sources.workspace import stage

#: the largest group whose open pairs are all compared by their sketches: SKETCHED times FREQUENT
FREQUENT, SKETCHED = 24, 20
#: shingles of a set from which it has parts to spare: one in SPARE_PART
LONG_SET, SPARE_PART = 64, 8
#: frequent shingles that make a part worth a key
TELLING = 3
#: a head's slack: a part of its prefix and some more
SLACK_PART, LEAST_SLACK = 8, 8
#: ids that may be broadcast to pick texts (some megabytes); more of them are joined by a shuffle
BROADCAST_IDS = 500_000
#: rounds with new centres at most, before the rest is verified pair by pair
CENTRE_ROUNDS = 2
#: open pairs per index entry at which the rest is verified pair by pair at once
FEW_PAIRS = 4
#: a class of frequency tells in how many of so many texts a shingle is found; all texts are counted, however many
SAMPLE_DOCS = 10_000
#: counters of shingles, and those of one row that carries them; tasks that count, at most
COUNTERS, SLICE_COUNTERS, BUILDERS = 1 << 22, 1 << 12, 4096
#: bits of a set's sketch, and of the finer one by which pairs are compared across components
SKETCH_BITS, FINE_BITS = 256, 1024
#: low bits of a hash that give way to the class of frequency
CLASS_BITS = 4
#: known words of a Python task; beyond, the table starts anew
CACHE_WORDS = 300_000

M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
SHIFT = np.uint64(31)


@dataclass(frozen=True)
class Rule:
    """Shingles of `words` words; similar at num / den or more."""

    words: int = 5
    num: int = 80
    den: int = 100

    @property
    def threshold(self) -> Fraction:
        return Fraction(self.num, self.den)

    def least_overlap(self, n: str = "n") -> str:
        """ceil(t n), in whole numbers."""
        return f"(({n} * {self.num} + {self.den - 1}) div {self.den})"

    def prefix(self, n: str = "n") -> str:
        return f"({n} - {self.least_overlap(n)} + 1)"

    def most_apart(self, n: int) -> int:
        """Shingles that only one of two similar sets has, of at most n shingles each."""
        return 2 * n * (self.den - self.num) // (self.den + self.num)

    def size_classes(self, n: int) -> list[int]:
        """The largest sizes of the classes, until one is beyond that of n; similar sets are at most one class apart."""
        least, tops = 1, []
        while len(tops) < 2 or tops[-2] < n:
            following = max(least + 1, (least - 1) * self.den // self.num + 1)
            tops.append(following - 1)
            least = following
        return tops

    def slack(self, n: str = "n") -> str:
        """Shingles of a head beyond its prefix; grows with n."""
        return f"({self.prefix(n)} div {SLACK_PART} + {LEAST_SLACK})"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> SHIFT)) * M2
    return x ^ (x >> SHIFT)


class Shingler:
    """Sorted distinct 64-bit shingle hashes of texts; bytes.lower and bytes.split know exactly A-Z and
    the six white-space characters that part words."""

    def __init__(self, words: int, classes: np.ndarray | None = None):
        self.words, self.known, self.classes = words, {}, classes

    def ordered(self, hashes: np.ndarray) -> np.ndarray:
        """Distinct shingles as numbers in the common order: class of frequency first, then the hash."""
        plain = np.unique(hashes >> np.uint64(CLASS_BITS)).view(np.int64)
        if self.classes is None:
            return plain
        kind = self.classes[plain & (len(self.classes) - 1)].astype(np.int64)
        return np.sort(plain | kind << (63 - CLASS_BITS + 1))

    def __call__(self, text: str) -> np.ndarray:
        parts = text.encode("utf-8").lower().split()
        if not parts:
            return np.zeros(0, dtype=np.int64)
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in set(parts).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        hashes = np.fromiter(map(known.__getitem__, parts), dtype=np.uint64, count=len(parts))
        size = min(self.words, len(parts))
        with np.errstate(over="ignore"):
            out = np.full(len(parts) - size + 1, size, dtype=np.uint64)
            for k in range(size):
                out = _mix(out * M1 + hashes[k : len(parts) - size + 1 + k])
        return self.ordered(out)


def _parities(items: np.ndarray, bits: int = SKETCH_BITS) -> list[int]:
    """For each of so many buckets of hashes, whether it holds an odd number of the set's shingles."""
    odd = np.bincount(items & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _map_sets(
    rows: DataFrame, words: int, order, fields: str, emit: Callable[[np.ndarray], tuple], keep: tuple[str, ...] = ("id",)
) -> DataFrame:
    """rows (id, text) -> id and what emit gives for the text's set, in an order that was broadcast."""

    def make():
        shingler = Shingler(words, order.value if order else None)
        return lambda texts: [emit(shingler(t)) for t in texts]

    return map_texts(rows, list(keep), "text", make, fields)


COUNTS_SCHEMA = pa.schema([("slice", pa.int32()), ("counts", pa.binary())])


def _packed(slices: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    """Counters by slice, each slice as the smallest whole numbers that hold it."""
    data = [c.astype(np.min_scalar_type(int(c.max()))).tobytes() for _, c in slices]
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in slices], pa.int32()), pa.array(data, pa.binary())], schema=COUNTS_SCHEMA)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=f"u{len(data) // SLICE_COUNTERS}")


def _task_counts(rows: DataFrame, words: int) -> DataFrame:
    """slice, counts of every task: for each counter, the task's texts that have a shingle of it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counts = Shingler(words), np.zeros(COUNTERS, dtype=np.uint32)
        for batch in batches:
            for text in batch.column(0):
                counts[shingler(text.as_py() or "") & (COUNTERS - 1)] += 1
        yield _packed([(k, c) for k, c in enumerate(counts.reshape(-1, SLICE_COUNTERS)) if c.any()])

    return rows.select("text").coalesce(BUILDERS).mapInArrow(count, "slice int, counts binary")


def _sum_counts(parts: DataFrame) -> DataFrame:
    """slice, counts: those of all tasks together; slices stream through one sum."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        for batch in batches:
            for k, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if k != at:
                    if at is not None:
                        yield _packed([(at, total)])
                    at, total = k, np.zeros(SLICE_COUNTERS, dtype=np.uint64)
                total += _unpacked(data)
        if at is not None:
            yield _packed([(at, total)])

    return parts.repartition("slice").sortWithinPartitions("slice").mapInArrow(fold, "slice int, counts binary")


def _shingle_order(rows: DataFrame, rule: Rule):
    """The class of each counter, by the shingles of all texts; the driver gets the counters alone, at most eight bytes each."""
    n = rows.count()
    found = _sum_counts(_task_counts(rows, rule.words)).toArrow()
    counts = np.zeros((COUNTERS // SLICE_COUNTERS, SLICE_COUNTERS), dtype=np.int64)
    for k, data in zip(*[c.to_pylist() for c in found.columns], strict=True):
        counts[k] = _unpacked(data)
    counts = counts.ravel()
    # less what the other shingles of a counter add on average; of so many texts twice, four times, ...: one class each
    seen = (counts - counts.sum() // COUNTERS) * min(1, SAMPLE_DOCS / max(n, 1))
    classes = np.minimum(np.log2(np.maximum(seen, 1)), 2 ** (CLASS_BITS - 1) - 1).astype(np.uint8)
    return rows.sparkSession.sparkContext.broadcast(classes)


def _heads(rows: DataFrame, rule: Rule, order) -> DataFrame:
    """id, name, n, digest, head: the smallest hashes of the set, its prefix and the slack; bits: its sketch."""
    num, den, words, part, least = rule.num, rule.den, rule.words, SLACK_PART, LEAST_SLACK

    def emit(items: np.ndarray):
        n = len(items)
        prefix = n - -(-n * num // den) + 1
        digest = xxhash.xxh3_128_digest(items.tobytes())
        return n, digest, items[: prefix + prefix // part + least].tolist(), _parities(items)

    fields = "n int, digest binary, head array<bigint>, bits array<bigint>"
    return _map_sets(rows, words, order, fields, emit, ("id", "name"))


def _whole_sets(rows: DataFrame, rule: Rule, order) -> DataFrame:
    def emit(items: np.ndarray):
        return len(items), items.tolist(), _parities(items, FINE_BITS)

    return _map_sets(rows, rule.words, order, "n int, items array<bigint>, bits array<bigint>", emit)


def _open_nodes(heads: DataFrame, rule: Rule) -> DataFrame:
    """digest, n, node (the least id), head, bits of the distinct sets that may have a similar or equal one."""
    tokens = heads.select("id", F.explode("head").alias("token"))
    counts = tokens.groupBy("token").agg(F.count("*").alias("heads")).where("heads > 1").select("token")
    shared = tokens.join(stage(counts, "jaccard-shared"), "token", "left_semi")
    shared = stage(shared.groupBy("id").agg(F.count("*").alias("shared")), "jaccard-open")
    some = F.expr(f"size(head) - shared < {rule.prefix()} or shared > {rule.slack(rule.least_overlap())}")
    open_heads = heads.join(shared, "id").where(some)
    same = [F.first(c).alias(c) for c in ("head", "bits")]
    return open_heads.groupBy("digest", "n").agg(F.min("id").alias("node"), *same)


def _part_keys(items: np.ndarray, rule: Rule) -> tuple[list[int], list[int]]:
    """The keys of a set's parts, for the class of its size, and more for the next: hashes of class, part and shingles."""
    n, keys = len(items), ([], [])
    frequent = items >> (63 - CLASS_BITS + 1) > 0
    for k, top in enumerate(rule.size_classes(n)[-2:]):
        apart = rule.most_apart(top)
        if not apart:  # only equal sets are similar
            continue
        spare = apart // SPARE_PART if top > LONG_SET else 0
        with np.errstate(over="ignore"):
            hashes = _mix(items.view(np.uint64) * M1 + np.uint64(top))
            parts = hashes % np.uint64(apart + 1 + spare)
            by_part = parts.argsort(kind="stable")
            parts, starts, sizes = np.unique(parts[by_part], return_index=True, return_counts=True)
            sums = np.add.reduceat(_mix(hashes[by_part] * M2), starts)
            found = _mix(_mix(sums + parts * M1) + np.uint64(top) * M2).view(np.int64)
        little = np.logical_and.reduceat(frequent[by_part], starts) & (sizes < TELLING)
        empty = apart + 1 + spare - len(parts)
        if little.sum() + empty <= spare:
            found = found[~little]
        elif empty > spare:  # similar sets may agree in empty parts alone, yet share a shingle of their prefixes
            found = np.append(found, items[: n - -(-n * rule.num // rule.den) + 1])
        keys[k].extend(found.tolist())
    return list(set(keys[0])), list(set(keys[1]).difference(keys[0]))


def _index(nodes: DataFrame, texts: DataFrame, rule: Rule, order) -> DataFrame:
    """(key, node, n, own, members): the index entries that several nodes have, one at least for its own class of size.

    Sets of one class meet by the keys for it, sets of neighbours by those for the larger, so of two sets that meet
    one has the key as its own.
    """
    kept = texts.join(_picked(nodes.select(F.col("node").alias("id"))), "id", "left_semi")
    fields = "n int, keys array<bigint>, more array<bigint>"
    keys = _map_sets(kept, rule.words, order, fields, lambda items: (len(items), *_part_keys(items, rule)))
    both = F.expr("concat(transform(keys, k -> struct(k as key, true as own)), transform(more, k -> struct(k as key, false as own)))")
    entries = stage(keys.select(F.inline(both), F.col("id").alias("node"), "n"), "jaccard-entries")
    members = entries.groupBy("key").agg(F.count("*").alias("members"), F.max("own").alias("met")).where("members > 1 and met").drop("met")
    return stage(entries.join(members, "key"), "jaccard-groups")


def _picked(ids: DataFrame) -> DataFrame:
    """Staged ids, broadcast where they are few."""
    ids = stage(ids, "jaccard-busy")
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _asked(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows of nodes that staged pairs (a, b) name."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return rows.join(_picked(ids), "node", "left_semi")


def _plausible(pairs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs whose heads differ no more than similar sets may in all.

    Up to the smaller of their last hashes, two heads hold all shingles of their sets, so what differs
    there differs between the sets. Heads are short, and unrelated sets differ in nearly all of them.
    """
    end = F.when(F.size("head") < F.col("n"), F.element_at("head", -1)).otherwise(F.lit(2**63 - 1))
    pairs = stage(pairs, "jaccard-tries")
    rows = _asked(nodes, pairs).select("node", "n", "head", end.alias("end"))
    for side in ("a", "b"):
        named = rows.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("n", "head", "end")])
        pairs = pairs.join(named, side)
    upto = F.least("end_a", "end_b")
    pairs = pairs.withColumn("x", F.filter("head_a", lambda v: v <= upto)).withColumn("y", F.filter("head_b", lambda v: v <= upto))
    differ = F.size("x") + F.size("y") - 2 * F.size(F.array_intersect("x", "y"))
    allowed = (F.col("n_a") + F.col("n_b")) * (rule.den - rule.num)
    return pairs.where(differ * (rule.den + rule.num) <= allowed).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Those of the pairs (a, b) whose whole sets are similar enough; only the sets that they ask for are moved."""
    sets = _asked(sets.select("node", "items"), pairs)
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - F.col("shared")
    both = pairs.join(left, "a").join(right, "b").withColumn("shared", shared)
    return both.where(F.col("shared") * rule.den >= union * rule.num).select("a", "b").distinct()


def _may_fit(a: tuple[str, str], b: tuple[str, str], rule: Rule) -> Column:
    """Whether sets of (size, most that it can share) may be similar."""
    return F.least(a[1], b[1]) * (rule.num + rule.den) >= (F.col(a[0]) + F.col(b[0])) * rule.num


def _sketches_fit(n_a: str, bits_a: str, n_b: str, bits_b: str, rule: Rule, bits: int = SKETCH_BITS) -> Column:
    """Whether the sketches differ no more than similar sets may.

    A shingle that only one of two sets has turns one parity, so the sketches differ in at most as many bits as
    the sets in shingles.
    """
    words = [F.bit_count(F.col(bits_a)[k].bitwiseXOR(F.col(bits_b)[k])) for k in range(bits // 64)]
    differ = reduce(Column.__add__, words)
    return differ * (rule.den + rule.num) <= (F.col(n_a) + F.col(n_b)) * (rule.den - rule.num)


def _reindexed(large: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """(key, node, n, label): the open groups' nodes by the rarest shingles that their heads share with other components.

    Heads of similar sets have at least `need` shingles in common (both are counted up to the end of the
    shorter head). In the order of exact counts among these heads, two such sets meet in the first
    m - need + 1 of the m shingles that a head shares; a set that shares fewer than needed leaves.
    """
    crowd = nodes.join(large.select("node", "label").distinct(), "node")
    tokens = crowd.select("node", "n", "label", F.explode("head").alias("token"))
    kinds = tokens.groupBy("token").agg(F.count("*").alias("sets"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    shared = tokens.join(kinds.where("lo <> hi").select("token", "sets"), "token")
    heads = shared.groupBy("node", "n", "label").agg(F.sort_array(F.collect_list(F.struct("sets", "token"))).alias("h"))
    need = f"least({rule.slack(rule.least_overlap())} + 1, {rule.least_overlap(rule.least_overlap())})"
    heads = heads.withColumn("first", F.expr(f"cast(size(h) - {need} + 1 as int)")).where("first > 0")
    return heads.select(F.explode(F.slice("h.token", F.lit(1), F.col("first"))).alias("key"), "node", "n", "label")


def _spares(open_rows: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The rows with spare: the shingles of a set that sets of other components among these have, too.

    A set that has too few of them to be similar to any leaves. In a crowd of near copies that are not near enough, this
    sees what each has of its own. It reads whole sets, so it is asked only for groups that centres have not closed.
    """
    crowd = sets.join(open_rows.select("node", "label").distinct(), "node")
    tokens = crowd.select("node", "label", F.explode("items").alias("token"))
    kinds = tokens.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("token")
    shared = tokens.select("node", "token").join(kinds, "token").groupBy("node").agg(F.count("*").cast("int").alias("spare"))
    return open_rows.join(shared, "node").where(F.expr(f"spare >= {rule.least_overlap()}"))


def _crossing(groups: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of a group's nodes in different components whose sketches are near, each once."""
    groups = groups.join(sets.select("node", "bits"), "node")
    x = groups.select("key", *[F.col(c).alias(f"{c}_a") for c in ("node", "n", "own", "spare", "label", "bits")])
    y = groups.select("key", *[F.col(c).alias(f"{c}_b") for c in ("node", "n", "own", "spare", "label", "bits")])
    apart = (F.col("node_a") < F.col("node_b")) & (F.col("label_a") != F.col("label_b")) & (F.col("own_a") | F.col("own_b"))
    near = _sketches_fit("n_a", "bits_a", "n_b", "bits_b", rule, FINE_BITS)
    near = _may_fit(("n_a", "spare_a"), ("n_b", "spare_b"), rule) & near
    pairs = x.join(y, "key").where(apart & near)
    return pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def _link_nodes(groups: DataFrame, nodes: DataFrame, texts: DataFrame, rule: Rule, order) -> DataFrame:
    """(node, label) of all nodes that have a link."""
    busy = _picked(groups.select(F.col("node").alias("id")).distinct())
    sets = _whole_sets(texts.join(busy, "id", "left_semi"), rule, order)
    sets = stage(sets.withColumnRenamed("id", "node"), "jaccard-sets")
    bits = nodes.select("node", "bits")
    few_members = F.col("members") <= FREQUENT * SKETCHED
    links = groups.select(F.col("node").alias("a"), F.col("node").alias("b")).where("false")
    labels = links.select(F.col("a").alias("node"), F.col("b").alias("label"))

    def labelled(rows: DataFrame) -> DataFrame:
        return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))

    def mixed(rows: DataFrame) -> DataFrame:
        """Groups that still hold several components."""
        open_keys = rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
        return rows.join(open_keys.select("key"), "key", "left_semi")

    def sized(rows: DataFrame) -> DataFrame:
        return rows.join(rows.groupBy("key").agg(F.count("*").alias("members")), "key")

    fruitless, rows = False, groups.select("key", "node", "n", "own")
    for turn in range(CENTRE_ROUNDS + 1):
        rows = labelled(rows.select("key", "node", "n", "own"))
        if turn:
            rows = stage(mixed(rows), "jaccard-open-groups")
        kinds = rows.groupBy("key", "label").agg(F.count("*").alias("m"))
        pairs = kinds.groupBy("key").agg(((F.sum("m") * F.sum("m") - F.sum(F.col("m") * F.col("m"))) / 2).alias("open"))
        open_pairs = pairs.agg(F.coalesce(F.sum("open"), F.lit(0))).first()[0]
        if not open_pairs:
            break
        last = fruitless or turn == CENTRE_ROUNDS or turn and open_pairs <= FEW_PAIRS * rows.count()
        if last:
            rows = stage(sized(mixed(_spares(rows, sets, rule))), "jaccard-last-groups")
            few, crowds = rows.where(few_members), rows.where(~few_members)
            if not crowds.isEmpty():
                again = stage(mixed(_reindexed(crowds, nodes, rule)), "jaccard-new-groups")
                again = again.join(crowds.select("node", "spare").distinct(), "node").withColumn("own", F.lit(True))
                few = few.drop("members").unionByName(again)
            tries = _crossing(few, sets, rule)
        else:
            place = F.struct(F.xxhash64("node", F.lit(turn)).alias("at"), "node", "n", "label")
            centres = rows.groupBy("key").agg(F.min(place).alias("c")).select("key", "c.node", "c.n", "c.label")
            centres = centres.join(bits, "node").select("key", *[F.col(c).alias(f"{c}_a") for c in ("node", "n", "label", "bits")])
            centres = centres.withColumnRenamed("node_a", "a")
            fits = _may_fit(("n", "n"), ("n_a", "n_a"), rule) & _sketches_fit("n", "bits", "n_a", "bits_a", rule)
            tries = rows.join(bits, "node").join(centres, "key").where((F.col("label") != F.col("label_a")) & fits)
            tries = tries.select("a", F.col("node").alias("b")).distinct()
        tries = stage(_plausible(tries, nodes, rule), "jaccard-pairs")
        found = stage(_verified(tries, sets, rule), "jaccard-links")
        fruitless = found.isEmpty()
        if not fruitless:
            links = links.unionByName(found)
            labels = connected_components(links)
        if last:
            break
    return labels


def on_files(docs: DataFrame) -> DataFrame:
    """The table itself where it is a scan of files, whose rows have a place; else written and read back."""
    try:
        docs.select("_metadata.row_index")
        return docs
    except AnalysisException:
        return stage(docs, "jaccard-rows")


def place() -> Column:
    """A hash of a row's place in its files."""
    return F.xxhash64("_metadata.file_path", "_metadata.row_index")


def near_components(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the least id that links reach), place (the row's
    key) and keeper (whether the row stands for its component: the one of least id, nulls last, then place)."""
    rows = on_files(docs).select(place().alias("id"), F.col(id_col).alias("name"), F.col(text_col).cast("string").alias("text"))
    texts = rows.select("id", "text")
    order = _shingle_order(texts, rule)
    heads = stage(_heads(rows, rule, order), "jaccard-heads")
    nodes = stage(_open_nodes(heads, rule), "jaccard-nodes")
    groups = _index(nodes, texts, rule, order)
    labels = _link_nodes(groups, nodes.select("node", "n", "head", "bits"), texts, rule, order)
    # of equal sets, then of a component, the first row; combined on the map side
    first = F.min(F.struct(F.col("name").isNull().alias("none"), "name", F.col("id").alias("place")))
    firsts = heads.where("n > 0").groupBy("digest", "n").agg(first.alias("first"))
    named = nodes.select("digest", "n", "node").join(labels, "node", "left").join(firsts, ["digest", "n"])
    named = stage(named.select("digest", "n", F.coalesce("label", "node").alias("label"), "first"), "jaccard-named")
    heads_of = named.groupBy("label").agg(F.min("first").alias("first"))
    named = named.drop("first").join(heads_of, "label").select("digest", "n", "first")
    out = heads.select("id", "name", "n", "digest").join(named, ["digest", "n"], "left")
    return out.select(
        F.col("name").alias(id_col),
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("first").isNull(), F.col("name")).otherwise(F.col("first.name")).alias("component_id"),
        F.col("id").alias("place"),
        F.coalesce(F.col("first.place") == F.col("id"), F.lit(True)).alias("keeper"),
    )

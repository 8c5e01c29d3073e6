"""Toxicity by a weighted finite-state grammar over clauses.

Words become letters. Three transducers of phrases read a clause's letters and mark where an insult, a threat
or a target of one or several words ends; three more mark matches that are negated or reported, and tell at the
clause's end whether it had a target. Composed into one machine, they let every match wait until the clause
ends, so that a target counts on either side of it. A matched clause gives, per category, the sum of its
matches' weights, and a text the sum over its clauses; a logistic model over that evidence gives the score.

Insults are a short fixed list and what labelled rows teach: words and word beginnings that occur far
more often in toxic texts, weighed by log-odds. The categories' weights are fitted on labelled rows too,
drawn towards fixed ones, so that categories without examples keep a sensible weight. Both fits use a
sample of at most SAMPLE_ROWS labelled rows in hash order; scoring covers every whole text.

Null and empty texts score by the model's base rate. Rows of labels without a document, or with a null
label or id, teach nothing; of several labels of one document the highest counts. Without any labelled
row the fixed weights and the fixed list alone score. Repeated rows get the same score; an empty table none.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import product
from typing import NamedTuple

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equitrace.llm.vocab import WordCache, map_texts
from equitrace.sources.workspace import stage

#: labelled rows that the fits read at most
SAMPLE_ROWS = 20_000
#: lengths of word beginnings that may be learned
STEMS = (4, 5, 6, 7, 8)
#: a learned entry's log-odds, their certainty in standard errors, and the share of toxic texts it needs
LEAST_ODDS, LEAST_CERTAINTY, LEAST_SHARE = 2.0, 4.0, 0.5
#: log-odds of the fixed words
FIXED_WEIGHT = 3.0

#: the fixed word lists
INSULTS = (
    "idiot idiots moron morons stupid trash worthless scum clown loser losers pathetic disgusting bastard imbecile "
    "dumb vermin filth arschloch dummkopf abschaum salaud connard crétin imbécile estúpido basura"
).split()
THREATS = "kill hurt destroy murder beat stab shoot töten schlagen tuer frapper matar golpear".split()
TARGETS = "you your yourself he she they them him her du dich ihr euch sie tu toi vous te vosotros usted".split()
NEGATIONS = "not no never nor neither without isn't aren't don't nicht kein nie ne pas jamais nunca".split()
REPORTS = "said says say claimed claims reported quoted wrote writes sagte schrieb dit écrit dijo escribió".split()

#: patterns of several words; a set in braces stands for each of its words
INSULT_PHRASES = (
    "piece of {trash garbage filth dirt crap shit}", "son of a bitch", "waste of {space air oxygen}", "good for nothing",
    "lowest of the low", "brain dead", "stück {dreck scheisse}", "hijo de puta", "pedazo de {basura mierda}", "fils de pute",
)
THREAT_PHRASES = (
    "blow up", "burn down", "hunt down", "cut up", "tear apart", "drop dead", "make {you him her them} pay",
    "break {your his her their} {neck legs arms bones}", "watch your back", "put a bullet", "slit {your his her their} throat",
    "bringe {dich euch sie} um", "mach dich kalt", "faire la peau", "romper la cara",
)
TARGET_PHRASES = (
    "all of {you them us}", "{you those these} people", "people like {you them}", "{your his their my our} {family kind children}",
    "ihr alle", "deine familie", "vous tous", "ta famille", "todos ustedes", "tu familia",
)

#: roles of words and marks of the grammar
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = "other insult threat target negation report end".split()
#: words that a negation reaches forward
NEGATION_REACH = 3
#: categories of matches and the weights they are drawn towards
CATEGORIES = {
    "insult": 1.5, "insult aimed": 2.0, "insult negated": 0.7, "insult reported": 0.7,
    "threat": 0.3, "threat aimed": 1.5, "threat negated": 0.1, "threat reported": 0.3,
}
BASE, DENSITY = -3.0, 0.5


def _patterns(phrases: tuple[str, ...]) -> list[tuple[str, ...]]:
    """The word sequences that the phrases stand for."""
    out = []
    for phrase in phrases:
        parts = [part.strip("{}").split() for part in regex.findall(r"\{[^}]*\}|\S+", phrase)]
        out.extend(product(*parts))
    return out


LISTS = {INSULT: INSULTS, THREAT: THREATS, TARGET: TARGETS, NEGATION: NEGATIONS, REPORT: REPORTS}
PATTERNS = {INSULT: _patterns(INSULT_PHRASES), THREAT: _patterns(THREAT_PHRASES), TARGET: _patterns(TARGET_PHRASES)}
ROLES = {word: role for role, words in LISTS.items() for word in words}
#: words of phrases are letters of their own; others stand for their role
OWN_LETTERS = {word for patterns in PATTERNS.values() for pattern in patterns for word in pattern}
LONGEST = max(len(pattern) for patterns in PATTERNS.values() for pattern in patterns)


def letter_name(word: str) -> str:
    return word if word in OWN_LETTERS else ROLES.get(word, OTHER)


#: names of the letters that have a role by themselves
NAMES = {role: frozenset(letter_name(w) for w in words if ROLES[w] == role) for role, words in LISTS.items()}


class Mark(NamedTuple):
    """A match that ends at a letter: its kind, its length in words, whether a fixed pattern has it, its note."""

    kind: str
    words: int
    fixed: bool
    note: str = ""


class Letter(NamedTuple):
    """A word as the transducers see it, and the marks that they wrote on it."""

    name: str
    learned: bool = False
    marks: tuple[Mark, ...] = ()


@dataclass(frozen=True)
class Transducer:
    """step(state, letter) -> (state, letter written); letters it does not know pass unchanged."""

    start: object
    step: object

    def then(self, other: Transducer) -> Transducer:
        """Composition: other reads what this one writes."""

        def both(state, letter):
            a, middle = self.step(state[0], letter)
            b, written = other.step(state[1], middle)
            return (a, b), written

        return Transducer((self.start, other.start), both)


def _phrases(kind: str) -> Transducer:
    """Marks where a pattern of the kind ends; of several that end there, the longest.

    The state is the longest end of what was read that begins a pattern.
    """
    patterns = {(name,) for name in NAMES[kind]} | set(PATTERNS[kind])
    begins = {pattern[:n] for pattern in patterns for n in range(len(pattern) + 1)}

    def step(read: tuple[str, ...], letter: Letter) -> tuple[tuple[str, ...], Letter]:
        if letter.name == END:
            return (), letter
        read = (*read, letter.name)
        while read not in begins:
            read = read[1:]
        words = next((len(read) - k for k in range(len(read)) if read[k:] in patterns), 0)
        if words:
            return read, letter._replace(marks=(*letter.marks, Mark(kind, words, True)))
        if kind == INSULT and letter.learned:
            return read, letter._replace(marks=(*letter.marks, Mark(kind, 1, False)))
        return read, letter

    return Transducer((), step)


def _noted(letter: Letter, note: str, holds) -> Letter:
    """Notes the matches of which it holds; the first note stays."""
    return letter._replace(marks=tuple(m._replace(note=note) if m.kind != TARGET and not m.note and holds(m) else m for m in letter.marks))


def _negated() -> Transducer:
    """Notes matches whose first word is at most so many words after a negation; the state counts them."""

    def step(after: int, letter: Letter) -> tuple[int, Letter]:
        if letter.name == END:
            return 0, letter
        if after and letter.marks:
            letter = _noted(letter, "negated", lambda m: 1 <= after - m.words + 1 <= NEGATION_REACH)
        if letter.name in NAMES[NEGATION]:
            return 1, letter
        return (after + 1 if 0 < after < NEGATION_REACH + LONGEST else 0), letter

    return Transducer(0, step)


def _reported() -> Transducer:
    """Notes matches after a word of reporting until the clause ends."""

    def step(said: bool, letter: Letter) -> tuple[bool, Letter]:
        if letter.name == END:
            return False, letter
        if said and letter.marks:
            letter = _noted(letter, "reported", lambda m: True)
        return said or letter.name in NAMES[REPORT], letter

    return Transducer(False, step)


def _aimed() -> Transducer:
    """Remembers a target until the clause ends, and writes it on the end."""

    def step(target: bool, letter: Letter) -> tuple[bool, Letter]:
        if letter.name == END:
            return False, letter._replace(marks=(Mark(TARGET, 0, True),) if target else ())
        return target or any(m.kind == TARGET for m in letter.marks), letter

    return Transducer(False, step)


def grammar() -> Transducer:
    """Phrases first; negation takes a match before reported speech, and the target comes last."""
    return _phrases(INSULT).then(_phrases(THREAT)).then(_phrases(TARGET)).then(_negated()).then(_reported()).then(_aimed())


class Machine:
    """The composed transducer as a table that fills as states are met; its states are few."""

    def __init__(self):
        self.rules = grammar()
        self.table: dict = {}
        #: names of the letters at which a match can end
        self.ends = NAMES[INSULT] | NAMES[THREAT] | {p[-1] for k in (INSULT, THREAT) for p in PATTERNS[k]}

    def matches(self, letters: list[tuple[Letter, float]]) -> list[tuple[str, float]]:
        """The categories that each clause matches, with the sum of their matches' weights."""
        state, out, waiting = self.rules.start, [], {}
        for letter, weight in [*letters, (Letter(END), 0.0)]:
            key = state, letter
            if key not in self.table:
                self.table[key] = self.rules.step(state, letter)
            state, written = self.table[key]
            if letter.name == END:
                aim = " aimed" if written.marks else ""
                out.extend((f"{kind} {note}" if note else kind + aim, total) for (kind, note), total in waiting.items())
                waiting = {}
            elif written.marks:
                for mark in written.marks:
                    if mark.kind != TARGET:
                        match = mark.kind, mark.note
                        waiting[match] = waiting.get(match, 0.0) + (max(weight, FIXED_WEIGHT) if mark.fixed else weight)
        return out


@dataclass(frozen=True)
class Model:
    """Learned entries (word -> weight; stem -> weight) and the weights of base, categories and density."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    weights: tuple[float, ...] = (BASE, *CATEGORIES.values(), DENSITY)


class Scorer:
    """Evidence and scores of texts under one model; built once in a Python worker."""

    def __init__(self, model: Model):
        self.model, self.machine = model, Machine()
        self.token = regex.compile(r"\p{L}+(?:'\p{L}+)?|[.!?;:,\n]")
        self.known = WordCache(self.symbol)

    def symbol(self, word: str) -> tuple[Letter, float]:
        """The word's letter and its learned weight; words of the fixed lists are not learned."""
        if not word[0].isalpha():
            return Letter(END), 0.0
        if word in ROLES:
            return Letter(letter_name(word)), 0.0
        weight = max([self.model.words.get(word, 0.0), *(self.model.stems.get(word[:n], 0.0) for n in STEMS if len(word) >= n)])
        return Letter(letter_name(word), weight > 0), weight

    def evidence(self, texts: list[str]) -> list[list[float]]:
        """Per text: 1, log(1 + sum of its clauses' weights) of each category, and the weight per hundred words."""
        lists = [self.token.findall(text.lower()) for text in texts]
        self.known.fill(set().union(*lists))
        known, names, ends, out = self.known, list(CATEGORIES), self.machine.ends, []
        for words in lists:
            sums = dict.fromkeys(names, 0.0)
            letters = [known[w] for w in words]
            if any(letter.learned or letter.name in ends for letter, _ in letters):
                for category, weight in self.machine.matches(letters):
                    sums[self.category(category)] += weight
            total = sum(sums.values())
            density = 100.0 * total / max(len(words), 20)
            out.append([1.0, *(float(np.log1p(sums[n])) for n in names), float(np.log1p(density))])
        return out

    @staticmethod
    def category(written: str) -> str:
        """A match's kind and its note; a negated or reported match is not also an aimed one."""
        return " ".join(written.split()[:2])

    def scores(self, texts: list[str]) -> list[float]:
        x = np.array(self.evidence(texts)).reshape(-1, len(self.model.weights))
        return (1.0 / (1.0 + np.exp(-np.clip(x @ np.array(self.model.weights), -30, 30)))).tolist()


def held_out(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string")) % 5 == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """text, toxic of the labelled rows that may teach, at most sample_rows documents of them.

    The ids drawn are at most sample_rows short rows, so they may be broadcast: no text is shuffled.
    """
    teach = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    teach = teach.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    drawn = teach.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(sample_rows)
    drawn = stage(drawn.select(F.col("doc_id").alias("drawn_id"), "toxic"), "toxic-drawn")
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("drawn_id"))
    return stage(rows.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), "toxic"), "toxic-sample")


def learn_lexicon(sample: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Words and word beginnings that mark toxic texts, with their log-odds.

    Texts are counted per word first; beginnings then sum over the small table of words. All entries that pass
    the three tests of evidence are taken; the sample bounds their number.
    """
    n, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not toxic or toxic == n:
        return {}, {}
    pieces = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))
    counts = sample.select("toxic", F.explode(pieces).alias("word")).groupBy("word")
    counts = stage(counts.agg(F.sum("toxic").alias("hit"), F.count("*").alias("n")).where("length(word) > 3"), "toxic-words")
    forms = [F.struct(F.lit(0).alias("stem"), F.col("word").alias("form"))]
    forms += [F.struct(F.lit(k).alias("stem"), F.left("word", F.lit(k)).alias("form")) for k in STEMS]
    stats = counts.select("hit", "n", F.inline(F.array(*forms))).where("stem = 0 or length(form) = stem")
    stats = stats.groupBy("stem", "form").agg(F.sum("hit").alias("hit"), F.sum("n").alias("n"))
    miss = F.col("n") - F.col("hit")
    odds = F.log((F.col("hit") + 0.5) / (toxic + 1.0)) - F.log((miss + 0.5) / (n - toxic + 1.0))
    error = F.sqrt(1.0 / (F.col("hit") + 0.5) + 1.0 / (miss + 0.5))
    stats = stats.withColumn("odds", odds).withColumn("sure", odds / error)
    stats = stats.where((F.col("odds") >= LEAST_ODDS) & (F.col("sure") >= LEAST_CERTAINTY))
    stats = stats.where(F.col("hit") >= LEAST_SHARE * F.col("n"))
    best = stats.orderBy(F.desc("sure"), "form", "stem").collect()
    words = {r["form"]: float(min(r["odds"], 6.0)) for r in best if not r["stem"]}
    stems = {r["form"]: float(min(r["odds"], 6.0)) for r in best if r["stem"]}
    return words, stems


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> tuple[float, ...]:
    """Logistic weights by Newton steps, drawn towards the fixed ones."""
    prior = np.array((BASE, *CATEGORIES.values(), DENSITY))
    w = prior.copy()
    pull = ridge * np.eye(len(w))
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + pull @ (w - prior)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull, gradient)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Lexicon and weights from labelled rows; what reaches the driver is bounded by the sample."""
    sample = labelled_sample(docs, labels, sample_rows)
    words, stems = learn_lexicon(sample)
    model = Model(words, stems)

    def make():
        scorer = Scorer(model)
        return lambda texts: [(e,) for e in scorer.evidence(texts)]

    rows = map_texts(sample, ["toxic"], "text", make, "evidence array<double>").groupBy("evidence", "toxic").count().collect()
    if not rows:
        return model
    x = np.array([r["evidence"] for r in rows])
    y = np.array([float(r["toxic"]) for r in rows])
    times = np.array([r["count"] for r in rows])
    return Model(words, stems, fit_weights(np.repeat(x, times, axis=0), np.repeat(y, times)))


def score(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text", name: str = "score") -> DataFrame:
    """The kept columns and the score of every row's text."""

    def make():
        scorer = Scorer(model)
        return lambda texts: [(s,) for s in scorer.scores(texts)]

    return map_texts(docs, keep, text_col, make, f"`{name}` double")

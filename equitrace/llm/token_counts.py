"""Exact token counts at every prefix of a text, by prefix dynamic programming over a byte-level BPE.

Inside a piece (what the tokenizer's pattern cuts out of a text) let last(i) be the last token of the
encoding of the first i bytes. It is the one token t that ends there, is itself what its bytes encode to,
and whose pair with last(i - len(t)) survives encoding; then count(i) = count(i - len(t)) + 1. Whether a
pair survives follows from the merges alone: no symbol on the right edge of the first token may merge
with a symbol on the left edge of the second while both exist.

A text's count at a prefix adds the counts of the whole pieces before it. Where cutting a text changes
its pieces (white space at the cut, a contraction or a special token cut in two) the pieces at the cut
are formed anew. Null texts are empty and have no tokens; a row is counted by itself, so repeated rows,
ties and empty tables need no rule. A piece of any length takes time in proportion to its bytes.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import accumulate

import ahocorasick
import regex
from pyspark.sql import DataFrame

from equitrace.llm.vocab import byte_letters, file_broadcast, map_texts, read_model

#: fixed value: the pattern of this kind of vocabulary
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NEVER = 1 << 60
#: answers about pairs that a worker keeps
CACHE_PAIRS = 1_000_000
#: counts of pieces that a worker keeps, beside those of the texts at hand
CACHE_PIECES = 600_000


class PrefixCounter:
    """Counts for one vocabulary; built once in a Python worker."""

    def __init__(self, content: str):
        model = read_model(content)
        raw = {letter: byte for byte, letter in byte_letters().items()}
        vocab = model["vocab"]
        self.special = sorted(model["special"], key=len, reverse=True)
        self.bytes_of = {i: bytes(raw[c] for c in s) for s, i in vocab.items() if s not in model["special"]}
        self.made, self.parts, self.rank = {}, {}, {}
        for rank, (a, b) in enumerate(model["merges"]):
            pair, whole = (vocab[a], vocab[b]), vocab[a + b]
            self.rank[pair] = rank
            if whole not in self.made:
                self.made[whole], self.parts[whole] = rank, pair
        self.pairs: dict[tuple[int, int], bool] = {}
        self.token = {
            self.bytes_of[t]: t for t in self.bytes_of if len(self.bytes_of[t]) == 1 or self._whole(t)
        }
        self.endings = ahocorasick.Automaton()
        for content_bytes, t in self.token.items():
            self.endings.add_word(content_bytes.decode("latin-1"), (t, len(content_bytes)))
        self.endings.make_automaton()
        self.pattern = regex.compile(PATTERN)
        self.special_pattern = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.space = regex.compile(r"\s*")
        self.cut_pattern = regex.compile(r"'(?:re|ve|ll)")
        self.totals: dict[str, int] = {}

    def _edges(self, a: int, b: int, top: bool) -> bool:
        """Whether no two symbols at the border of a and b merge while both exist; top: the pair itself may."""
        rank, made, parts = self.rank, self.made, self.parts
        gone_a, gone_b = NEVER, NEVER
        while True:
            r = rank.get((a, b))
            if r is not None and not top and r < gone_a and r <= gone_b:
                return False
            at_a, at_b = made.get(a, -1), made.get(b, -1)
            if at_a < 0 and at_b < 0:
                return True
            if top:
                gone_a = gone_b = r
                top = False
            if at_a >= at_b:
                a, gone_a = parts[a][1], at_a
            else:
                b, gone_b = parts[b][0], at_b

    def _whole(self, t: int) -> bool:
        """Whether the bytes of t encode to t."""
        if t not in self.parts:
            return False
        a, b = self.parts[t]
        return all(x not in self.parts or self._whole(x) for x in (a, b)) and self._edges(a, b, True)

    def survives(self, a: int, b: int) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self._edges(a, b, False)
        return known

    def bytes_counts(self, body: bytes) -> list[int]:
        """Tokens of every prefix of one piece's bytes, the empty one first.

        The automaton visits, end by end, only the tokens that end there, the longest first.
        """
        counts, last, pairs = [0] * (len(body) + 1), [-1] * (len(body) + 1), self.pairs
        for end, (t, size) in self.endings.iter(body.decode("latin-1")):
            end += 1
            if last[end] < 0:
                start = end - size
                if start:
                    before = last[start]
                    fits = pairs.get((before, t))
                    if fits is None:
                        fits = self.survives(before, t)
                    if not fits:
                        continue
                last[end], counts[end] = t, counts[start] + 1
        return counts

    def total(self, piece: str) -> int:
        """Tokens of one piece."""
        return self.bytes_counts(piece.encode("utf-8"))[-1]

    def piece(self, piece: str) -> bytes | list[int]:
        """Tokens of every prefix of one piece, by code points, the empty one first."""
        counts = self.bytes_counts(piece.encode("utf-8"))
        if len(counts) > len(piece) + 1:
            ends = accumulate((len(c.encode("utf-8")) for c in piece), initial=0)
            counts = [counts[e] for e in ends]
        if self.cut_pattern.fullmatch(piece):
            counts[2] = 2  # the contraction cut in two is a quote and a letter
        return bytes(counts) if counts[-1] < 256 else counts

    def lookup(self, piece: str) -> bytes | list[int]:
        return self.piece(piece)

    def segments(self, text: str) -> list[tuple[int, int, bool]]:
        """Start, end, whether it is a special token."""
        out, at = [], 0
        for m in self.special_pattern.finditer(text) if self.special_pattern else ():
            if m.start() > at:
                out.append((at, m.start(), False))
            out.append((m.start(), m.end(), True))
            at = m.end()
        if at < len(text):
            out.append((at, len(text), False))
        return out

    def pieces(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of whole texts."""
        lists, extra = [], []
        for text in texts:
            if any(s in text for s in self.special):
                parts = self.segments(text)
                lists.append([p for a, b, s in parts if not s for p in self.pieces(text[a:b])])
                extra.append(sum(s for *_, s in parts))
            else:
                lists.append(self.pieces(text))
                extra.append(0)
        known, count = self.totals, self.bytes_counts
        if len(known) > CACHE_PIECES:
            known.clear()
        for pieces in lists:
            for p in pieces:
                if p not in known:
                    known[p] = count(p.encode("utf-8"))[-1]
        of = known.__getitem__
        return [sum(map(of, pieces)) + k for pieces, k in zip(lists, extra, strict=True)]

    def prefix_counts(self, text: str, budget: int | None = None) -> list[int]:
        """Tokens of text[:n] for n = 0 .. len(text), each what encoding that prefix alone gives.

        With a budget the list ends where every longer prefix is known to exceed it.
        """
        out, base, after_special = [0], 0, 0
        for start, end, special in self.segments(text):
            if special:
                out.extend(self._cut_special(out, text, after_special, start, n) for n in range(start + 1, end))
                base += 1
                out.append(base)
                after_special = end
                continue
            run, run_base = None, 0  # white space that a cut leaves at the end is one piece
            for m in self.pattern.finditer(text, start, end):
                at, piece = m.start(), m[0]
                if budget is not None and run is None and base > budget and not self.special_ahead(text, at):
                    return out
                counts = self.lookup(piece)
                lead = self.space.match(piece).end()
                if lead:
                    if run is None:
                        run, run_base = at, base
                    spaces = self.lookup(text[run : at + lead])
                    out.extend(run_base + c for c in spaces[at - run + 1 :])
                if lead < len(piece):
                    run = None
                    out.extend(base + c for c in counts[lead + 1 :])
                base += counts[-1]
            if run is not None:
                out[end] = base
        return out

    def special_ahead(self, text: str, at: int) -> bool:
        return any(text.find(s, at) >= 0 for s in self.special)

    def _cut_special(self, out: list[int], text: str, floor: int, start: int, n: int) -> int:
        """Tokens of text[:n], where the cut leaves the first part of a special token that starts at start.

        Its letters join the text before it, so the last run of letters and the white space around it
        are cut into pieces anew; what lies before is not touched.
        """
        left = len(text[floor:start].rstrip())
        left = max((m.start() for m in regex.finditer(r"\S+", text[floor : floor + left])), default=0)
        left = floor + len(text[floor : floor + left].rstrip())
        return out[left] + sum(self.lookup(p)[-1] for p in self.pieces(text[left:n]))

    def longest_prefix(self, text: str, budget: int) -> int:
        """Code points of the longest prefix that has at most budget tokens.

        Whole pieces are added up as far as the budget reaches; the counts of every prefix are needed only
        from the last end of a word on, where the pieces of the rest begin anew.
        """
        start, left = 0, budget
        if not self.special_ahead(text, 0):
            base, of = 0, self.totals
            for m in self.pattern.finditer(text):
                piece = m[0]
                base += of.get(piece) or self.total(piece)
                if base > budget:
                    break
                if not piece[-1].isspace():
                    start, left = m.end(), budget - base
        counts = self.prefix_counts(text[start:], left)
        return start + max(n for n, c in enumerate(counts) if c <= left)


@lru_cache(maxsize=2)
def worker_counter(content: str) -> PrefixCounter:
    return PrefixCounter(content)


def token_counts(
    docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens, over_limit, and limit_chars, the code points of the
    longest prefix that keeps the limit: the place to truncate at, found without encoding again."""
    content = file_broadcast(docs.sparkSession, path)

    def make():
        counter = worker_counter(content.value)

        def handle(texts: list[str]) -> list[tuple]:
            totals = counter.counts(texts)
            return [
                (len(x.encode("utf-8")), n, n > limit, len(x) if n <= limit else counter.longest_prefix(x, limit))
                for x, n in zip(texts, totals, strict=True)
            ]

        return handle

    return map_texts(
        docs, [id_col], text_col, make, "n_bytes bigint, n_tokens bigint, over_limit boolean, limit_chars bigint"
    )

"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

The leaves of a word's tree hold (rank, position) of each adjacent pair of symbols, every node the least
of its children, so the root is the leftmost pair of lowest rank. Merging it changes three leaves, each
updated along its path to the root, until no pair can merge: n log n steps for a word of n symbols.

Texts are normalised as the tokenizer's file says (NFC, white space to one blank, lower case by code
point), cut into words by its pattern, and written in the byte alphabet, the last letter of a word with
the word-end mark. Special tokens inside a raw text are found first and keep their ids. Null texts are
empty and have no ids; rows are encoded one by one, so repeated rows, ties and empty tables need no rule.
"""

from __future__ import annotations

import hashlib
import unicodedata
from array import array
from functools import lru_cache

import regex
from pyspark.sql import DataFrame

from equitrace.llm.vocab import WordCache, byte_letters, file_broadcast, map_texts, read_model

#: fixed values: how this kind of vocabulary cuts words and marks their ends
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
#: above any pair's key
NONE = 1 << 62


class Codec:
    """Encoder and decoder for one vocabulary; built once in a Python worker."""

    def __init__(self, content: str):
        model = read_model(content)
        vocab, self.special = model["vocab"], model["special"]
        self.letters = byte_letters()
        self.first = {b: vocab[c] for b, c in self.letters.items()}
        self.final = {b: vocab[c + WORD_END] for b, c in self.letters.items()}
        self.rank, self.merged = {}, {}
        for rank, (a, b) in enumerate(model["merges"]):
            pair = vocab[a], vocab[b]
            self.rank[pair], self.merged[pair] = rank, vocab[a + b]
        self.token = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        self.pattern = regex.compile(PATTERN)
        self.blank = regex.compile(r"\s+")
        names = sorted(self.special, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.words = WordCache(self._word_result)

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word."""
        body = word.encode("utf-8")
        ids = [self.first[b] for b in body[:-1]]
        ids.append(self.final[body[-1]])
        n = len(ids)
        if n == 1:
            return ids
        rank, merged = self.rank, self.merged
        size = 1 << (n - 2).bit_length() if n > 2 else 1
        tree = [NONE] * (2 * size)
        for p in range(n - 1):
            r = rank.get((ids[p], ids[p + 1]))
            if r is not None:
                tree[size + p] = r * size + p
        for node in range(size - 1, 0, -1):
            a, b = tree[2 * node], tree[2 * node + 1]
            tree[node] = a if a < b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while tree[1] < NONE:
            p = tree[1] % size
            q = after[p]
            ids[p], ids[q] = merged[ids[p], ids[q]], -1
            r = after[p] = after[q]
            changed = [(p, r)]
            if r < n:
                before[r] = p
            if q < n - 1:
                changed.append((q, n))
            if before[p] >= 0:
                changed.append((before[p], p))
            for leaf, right in changed:
                found = rank.get((ids[leaf], ids[right])) if right < n else None
                value = NONE if found is None else found * size + leaf
                node = size + leaf
                tree[node] = value
                while node > 1:
                    other = tree[node ^ 1]
                    node >>= 1
                    least = value if value < other else other
                    if tree[node] == least:
                        break
                    tree[node] = value = least
        return [i for i in ids if i >= 0]

    def _word_result(self, word: str) -> bytes:
        return array("I", self.encode_word(word)).tobytes()

    def normal(self, text: str) -> str:
        text = self.blank.sub(" ", unicodedata.normalize("NFC", text))
        return "σ".join(part.lower() for part in text.split("Σ"))

    def _parts(self, text: str) -> list[list[str] | int]:
        """Word lists and ids of special tokens, in order."""
        if self.split is None or not any(s in text for s in self.special):
            return [self.pattern.findall(self.normal(text))]
        return [
            self.special[part] if part in self.special else self.pattern.findall(self.normal(part))
            for part in self.split.split(text)
        ]

    def encode_ids(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian 32-bit numbers."""
        lists = [self._parts(text) for text in texts]
        self.words.fill(set().union(*(part for parts in lists for part in parts if isinstance(part, list))))
        known, out = self.words, []
        for parts in lists:
            ids = []
            for part in parts:
                if isinstance(part, int):
                    ids.append(array("I", [part]).tobytes())
                else:
                    ids.extend(known[w] for w in part)
            out.append(b"".join(ids))
        return out

    def encode_all(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """For each text its ids, and the text that decoding these ids gives."""
        return [(ids, self.decode(array("I", ids))) for ids in self.encode_ids(texts)]

    def encode(self, text: str) -> list[int]:
        return array("I", self.encode_ids([text])[0]).tolist()

    def decode(self, ids: list[int]) -> str:
        """The tokens of the ids, a blank between them, word-end marks kept: the file names no decoder."""
        return " ".join(filter(None, map(self.token.get, ids)))


@lru_cache(maxsize=2)
def worker_codec(content: str) -> Codec:
    return Codec(content)


def encode_texts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = True
) -> DataFrame:
    """One row per input row: id, n_tokens, ids (array of int) and, if asked, the decoded text."""
    content = file_broadcast(docs.sparkSession, path)

    def make():
        codec = worker_codec(content.value)

        def handle(texts: list[str]) -> list[tuple]:
            return [
                (len(ids) // 4, array("i", ids).tolist(), codec.decode(array("I", ids)) if decoded else None)
                for ids in codec.encode_ids(texts)
            ]

        return handle

    return map_texts(docs, [id_col], text_col, make, "n_tokens bigint, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_tokens, ids_sha256, decoded_sha256; ids never leave the worker."""
    content = file_broadcast(docs.sparkSession, path)

    def make():
        codec = worker_codec(content.value)

        def handle(texts: list[str]) -> list[tuple]:
            return [
                (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(said.encode("utf-8")).hexdigest())
                for ids, said in codec.encode_all(texts)
            ]

        return handle

    return map_texts(docs, [id_col], text_col, make, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")

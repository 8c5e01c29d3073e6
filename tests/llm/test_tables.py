"""Queries over a written table of odd rows, column by column, against the public library and brute force."""

import hashlib
import struct
from collections import Counter

import pytest

from equitrace.llm import chat
from equitrace.llm.queries import NEAR_RULE, QUERIES, TOKEN_LIMIT
from tests.llm.test_near import expected

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

ROWS = [
    (1, None), (2, ""), (3, "The quick brown fox"), (3, "another text of this id"), (None, "no id, <|endoftext|> inside"),
    (None, None), (4, "ÀÉ 😀 İstanbul\n\n  x"), (5, "word " * 3000), (5, "word " * 3000), (-6, "\x00\t \r\n"), (7, "a" * 20_000),
]


@pytest.fixture
def run(spark, documents, tmp_path):
    """Rows of a query over a table, as they are counted."""

    def make(name, rows, columns):
        path = tmp_path / str(len(rows))
        documents(rows).repartition(3).write.mode("overwrite").parquet(f"{path}/documents.parquet")
        return Counter(map(tuple, QUERIES[name](spark, str(path)).select(*columns).collect()))

    return make


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_encode_query(run):
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))

    def want(i, text):
        ids = lib.encode(text or "", add_special_tokens=False).ids
        decoded = lib.decode(ids, skip_special_tokens=False)
        return i, len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(decoded.encode())

    columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert run("op8_bpe_encode_decode", ROWS, columns) == Counter(want(*r) for r in ROWS)
    assert not run("op8_bpe_encode_decode", [], columns)


def test_count_query(run):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

    def want(i, text):
        n = len(lib.encode(text or "", add_special_tokens=False).ids)
        return i, len((text or "").encode()), n, n > TOKEN_LIMIT

    columns = ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert run("op10_token_counts", ROWS, columns) == Counter(want(*r) for r in ROWS)
    assert not run("op10_token_counts", [], columns)


def test_near_query(spark, small_documents):
    rows = [(r["doc_id"], r["text"]) for r in small_documents.select("doc_id", "text").collect()]
    got = QUERIES["op4_ngram_jaccard_join"](spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected(rows, NEAR_RULE)


def test_fingerprints_of_edited_texts(run, small_documents):
    """The edited text's fingerprint, made of shared and own terms, is that of a table that holds the edited text."""
    rows = sorted(((r["doc_id"], r["text"] or "") for r in small_documents.select("doc_id", "text").collect()), reverse=True)
    edited = []
    for k, (i, text) in enumerate(rows):
        cut = len(text) // 3
        edited.append((i, text[: len(text) - cut] + rows[(k + 1) % len(rows)][1][:cut]))
    query, digests = "op2_simhash_fingerprints", dict(edited)
    columns = ["doc_id", "fingerprint", "edited_fingerprint", "edited_sha256", "near_edited", "near_next"]
    got = {r[0]: r[1:] for r in run(query, rows, columns)}
    plain = {r[0]: r[1] for r in run(query, [*edited, (-1, "")], ["doc_id", "fingerprint"])}
    following = {rows[k][0]: rows[(k + 1) % len(rows)][0] for k in range(len(rows))}
    for i, (own, other, digest, near_edited, near_next) in got.items():
        assert other == plain[i] and digest == sha(digests[i].encode())
        assert near_edited == pytest.approx(1 - (int(own, 16) ^ int(other, 16)).bit_count() / 64)
        assert near_next == pytest.approx(1 - (int(own, 16) ^ int(got[following[i]][0], 16)).bit_count() / 64)


def test_chats_ignore_columns_with_clashing_names(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (None, None, None, "x"), (2, 0, "user", "</s>")]
    plain = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    more = plain.selectExpr("*", "1 as formatted", "'x' as loss", "0 as turns", "null as again", "2 as id")
    assert sorted(map(str, chat.format_chats(plain).collect())) == sorted(map(str, chat.format_chats(more).collect()))

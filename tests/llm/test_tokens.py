"""Token operators against the public library, over odd texts and every prefix."""

import random

import pytest

from equitrace.llm.bpe import Codec
from equitrace.llm.token_counts import PrefixCounter

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

ODD = [
    "", " ", "  ", "a", " a", "a  b", "a \n\n b\n", "don't we'll they're I'd 'tis 'rex x'r x're x've",
    "<|endoftext|>", "a<|endoftext|>b", " foo! <|endoftext|>  <|endoftext|><|startoftext|> bar", "<|endof text|>",
    "foo!bar<|endoftext|>'ll", "ÀÉÎ ﬁ Ǆ İstanbul ΣΑΣ ὈΔΥΣΣΕΎΣ", "é å ẛ̣", "日本語 한국어 ไทย",
    "😀👍🏽 x‍y", "\x1c\x1d\x85 　\xa0 tab\tline\r\nend", "1234567890 3.14 ¼ Ⅷ", "x" * 300, "ab" * 500, "!?" * 200,
    " " * 100 + "end", "aaaa " * 50, "\n" * 33, "the quick brown fox jumps over the lazy dog " * 20,
]


def contents(name):
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(5)
    letters = list("abcdeINGTH  .,'!?\n\t09éßÑσΣ–字😀́\xa0")
    out = list(ODD)
    for _ in range(400):
        out.append("".join(draw.choices(letters, k=draw.randint(1, 60))))
    for _ in range(100):
        out.append("".join(chr(draw.choice([draw.randrange(32, 0x250), draw.randrange(0x370, 0x2000)])) for _ in range(30)))
    return out


def test_encode_and_decode(texts):
    codec = Codec(contents("word_bpe_49k.json"))
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for text in texts:
        want = lib.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == want, repr(text)
        assert codec.decode(want) == lib.decode(want, skip_special_tokens=False)
        assert codec.encode_all([text])[0][1] == codec.decode(want)


def test_the_ids_are_what_is_decoded():
    """A wrong id-to-token step shows in the decoded text, also for words met before."""
    codec = Codec(contents("word_bpe_49k.json"))
    ids = codec.encode("the fox")
    assert codec.encode_all(["the fox"])[0][1] == codec.decode(ids)
    codec.token[ids[0]] = "wrong"
    assert codec.encode_all(["the fox"])[0][1].startswith("wrong ")


def test_counts_of_whole_texts(texts):
    counter = PrefixCounter(contents("byte_bpe_50k.json"))
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert counter.counts(texts) == [len(lib.encode(t, add_special_tokens=False).ids) for t in texts]


def test_counts_of_every_prefix(texts):
    counter = PrefixCounter(contents("byte_bpe_50k.json"))
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in texts:
        prefixes = [text[:n] for n in range(len(text) + 1)]
        want = [len(e.ids) for e in lib.encode_batch(prefixes, add_special_tokens=False)]
        assert list(counter.prefix_counts(text)) == want, repr(text)
        for budget in (0, 1, 7):
            assert counter.longest_prefix(text, budget) == max(n for n, c in enumerate(want) if c <= budget)


def test_every_token_and_its_halves():
    counter = PrefixCounter(contents("byte_bpe_50k.json"))
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    some = [t.decode("utf-8") for t in list(counter.bytes_of.values())[::37] if t.decode("utf-8", "ignore").encode() == t]
    assert counter.counts(some) == [len(e.ids) for e in lib.encode_batch(some, add_special_tokens=False)]


def test_long_word():
    codec = Codec(contents("word_bpe_49k.json"))
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    word = "".join(random.Random(2).choices("theinganst", k=20_000))
    assert codec.encode(word) == lib.encode(word, add_special_tokens=False).ids


def test_caches_stay_bounded():
    codec = Codec(contents("word_bpe_49k.json"))
    codec.words.limit = 50
    for k in range(20):
        codec.encode_all([" ".join(f"w{k}x{j}" for j in range(30))])
        assert len(codec.words) <= 150

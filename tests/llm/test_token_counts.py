import functools
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from touchledger.llm import token_counts as tc

PATH = tc.byte_bpe()


tokenizer = functools.cache(Tokenizer.from_file)


def by_library(text, path=PATH):
    """The brute-force counterpart: the library as it comes."""
    return len(tokenizer(path).encode(text or "", add_special_tokens=False).ids)


TEXTS = ["", " ", "\n\n  x", "it's we'll 'S I'M", "a<|endoftext|>b <|endoftext|>", "<|endoftext|>", "日本語 のテキスト、です", "naïve café ﬁ",
         "  two  spaces \t tabs\r\n", "x\u0085y z w᠎​", "\x1c\x1d a\x1eb\x1f", "½ ² ٣ Ⅷ 𝟘 𐄇", "😀👩‍👩‍👧 🇩🇪",
         "\U0001e030\U00011f04 \U000323af ꟊ", "é กำ", "12345 1,000.50 €", "a" * 5000, "!?" * 900]


def test_equal_to_the_library_on_odd_texts():
    counter = tc.TokenCounter(PATH)
    assert [counter.count(t) for t in TEXTS] == [by_library(t) for t in TEXTS]
    assert counter.count(None) == 0


def test_equal_to_the_library_on_random_texts():
    rng, counter = random.Random(5), tc.TokenCounter(PATH)
    alphabet = [*" \n\t'.,!sStTrevmd0123abcéßжλ中文あ가😀  ́", " the", " and", "'ll", "<|endoftext|>"]
    for _ in range(400):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 60)))
        assert counter.count(text) == by_library(text), text


def test_portions_of_long_texts(monkeypatch):
    rng = random.Random(6)
    text = "".join(rng.choices([" ", "  ", "\n", "word", "'s", "12", "!", " it"], k=4000))
    monkeypatch.setattr(tc, "PORTION", 50)
    parts = list(tc.portions(text))
    assert "".join(parts) == text and len(parts) > 50
    assert tc.TokenCounter(PATH).count(text) == by_library(text)
    assert list(tc.portions("x" * 200)) == ["x" * 200] and list(tc.portions(" " * 120)) == [" " * 120]


def test_cache_generations(monkeypatch):
    monkeypatch.setattr(tc, "REMEMBERED", 3)
    counter, words = tc.TokenCounter(PATH), [f" w{i}x" for i in range(20)] * 2
    assert [counter.count(w) for w in words] == [by_library(w) for w in words]
    assert len(counter.young) <= 3 and len(counter.old) <= 3


def test_packed_table():
    table = {" the": 1, "é\n": 3, " ": 1, "x" * 64: 17}
    assert dict(tc.unpacked(*tc.packed(table))) == table
    assert dict(tc.unpacked(*tc.packed({}))) == {}


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_count_whole_texts(name):
    path = public_tokenizers.path(name)
    counter = tc.TokenCounter(path)
    assert counter.pieces("some text") is None
    if name.endswith(".json"):
        assert counter.count("Some TEXT  here") == by_library("Some TEXT  here", path)
    else:
        assert counter.count("") == 0 and counter.count("Some text here") > 2


def test_rows_nulls_repeats_and_clashing_columns(llm, documents):
    rows = [(1, "one two", 5, "a"), (1, "one two", 5, "a"), (None, None, 6, "b"), (3, "", 7, None), (4, "é" * 1500, 8, "c")]
    frame = documents(*rows, schema="doc_id bigint, text string, n_tokens int, source string")
    got = tc.count_tokens(frame, PATH)
    assert got.columns == ["doc_id", "text", "n_tokens", "source", "n_bytes", "over_limit"]
    found = sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got.collect()), key=str)
    want = [(i, len((t or "").encode()), by_library(t), by_library(t) > 1024) for i, t, *_ in rows]
    assert found == sorted(want, key=str)
    assert tc.count_tokens(frame.limit(0), PATH).count() == 0


def test_limit_is_exceeded_by_more_tokens_only(llm, documents):
    frame = documents((1, " the" * 1024), (2, " the" * 1025))
    assert [r["over_limit"] for r in tc.count_tokens(frame, PATH).orderBy("doc_id").collect()] == [False, True]


def test_table_is_from_the_documents_and_bounded(llm, documents):
    frame = documents(*[(i, f" common w{i}") for i in range(60)])
    table = dict(tc.unpacked(*tc.frequent_lengths(frame, PATH, size=5)))
    assert len(table) == 5 and table[" common"] == by_library(" common")


def test_plan_has_no_shuffle(llm, documents):
    plan = tc.count_tokens(documents((1, "a")), PATH)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan

import functools
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from touchledger.llm import packing

PATHS = packing.byte_bpe()


@pytest.fixture(scope="module")
def tokens():
    return packing.WordTokens(*PATHS)


@functools.cache
def library():
    """The tokenizer as its file gives it."""
    return Tokenizer.from_file(PATHS[0])


def whole(tokens, text):
    return library().encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list(" \n\t\r\x0b\x85  'sreab1½.,é漢ї<|>")), st.characters(codec="utf-8")),
               max_size=40))
def test_every_text_has_the_tokenizers_ids(text):
    tokens = packing.once(packing.WordTokens, *PATHS)
    assert tokens.of(text).tolist() == whole(tokens, text)


def test_random_pieces_have_the_tokenizers_ids(tokens):
    rng = random.Random(8)
    pieces = [" the", "<|endoftext|>", "  ", " ", "\n", "'s", "é", " 漢", "word", " 12", "\t", "ǆ", "ɐ"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(600)]
    assert [np.frombuffer(b, tokens.kind).tolist() for b in tokens.batch(texts)] == [whole(tokens, t) for t in texts]


@pytest.mark.parametrize("text", ["", " ", "  ", "   a", "a   b", "a \n b", "a\n  b  ", "it's  we'll <|endoftext|> x", "x" * 5000,
                                  "漢字 かな", " lead", "trail ", "a  ", "tab\t \tb", "é" * 70 + " " + "z" * 200])
def test_runs_of_white_space_and_odd_texts(tokens, text):
    assert tokens.of(text).tolist() == whole(tokens, text)


def test_remembered_words_are_bounded(tokens, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 10)
    tokens.clear()
    for k in range(30):
        text = "漢 " + " ".join(f"word{i}" for i in range(3 * k, 3 * k + 9))
        assert tokens.of(text).tolist() == whole(tokens, text) and len(tokens) <= 19 and len(tokens.old) <= 19


def test_strings_of_added_tokens_are_what_the_tokenizer_makes_of_them(tokens, documents, workspace):
    texts = ["<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>b c", "<|endoftext", "x  <|endoftext|>  y", "word " * 3000 + "<|endoftext|>"]
    assert [np.frombuffer(b, tokens.kind).tolist() for b in tokens.batch(texts)] == [whole(tokens, t) for t in texts]
    assert whole(tokens, texts[0]) == [50256]
    docs = list(enumerate(texts))
    check(packed(documents(*docs), workspace), docs, tokens)


def test_words_of_a_batch_are_learnt_together(tokens):
    texts = ["one two\nthree", "two\n\n four 漢字 é", "five\x0bsix  seven", "", " one", "\n \n", "it's two's\r\n nine"]
    tokens.clear()
    assert [np.frombuffer(b, tokens.kind).tolist() for b in tokens.batch(texts)] == [whole(tokens, t) for t in texts]


def test_hilbert_curve_visits_every_cell_by_single_steps():
    for n, bits in ((2, 3), (3, 2)):
        side = 1 << bits
        cells = np.stack(np.meshgrid(*[np.arange(side)] * n, indexing="ij"), -1).reshape(-1, n)
        index = packing.hilbert_index(cells, bits)
        assert sorted(index) == list(range(side ** n))
        path = cells[np.argsort(index)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def packed(frame, workspace, **how):
    return packing.pack(frame, PATHS, workspace=workspace, **how).collect()


def check(rows, docs, tokens, length=2048):
    """Every id in exactly one piece; sequences gapless and full but for the last."""
    ids = sorted([whole(tokens, t or "") + [1] for _, t in docs])
    found, by_sequence, by_doc = [], {}, {}
    for r in rows:
        part = np.frombuffer(r["ids"], "<u2")
        assert len(part) == r["length"] > 0 and zlib.crc32(part.astype("<u4")) == r["ids_crc32"]
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault((str(r["doc_id"]), r["sequence_id"] * length + r["offset"] - r["start"]), []).append((r["start"], part, r["doc_tokens"]))
    for pieces in by_doc.values():
        pieces.sort(key=lambda p: p[0])
        assert [p[0] for p in pieces] == np.cumsum([0] + [len(p[1]) for p in pieces])[:-1].tolist()
        found.append(np.concatenate([p[1] for p in pieces]).tolist())
        assert {p[2] for p in pieces} == {len(found[-1])}
    assert sorted(found) == ids
    fills = []
    for k in sorted(by_sequence):
        end = 0
        for offset, n in sorted(by_sequence[k]):
            assert offset == end
            end += n
        fills.append(end)
    assert sorted(by_sequence) == list(range(len(fills))) and all(f == length for f in fills[:-1]) and fills[-1] <= length


def test_pieces_hold_each_id_once(llm, documents, workspace, tokens):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(rng.randrange(300)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "word " * 9000), (None, "no id"), (5, docs[5][1])]
    docs += [(200 + i, "the very same text") for i in range(40)]
    rows = packed(documents(*docs), workspace, range_tokens=1500)
    check(rows, docs, tokens)


def test_many_ranges_give_the_order_of_one(llm, documents, workspace, tokens, tmp_path):
    from touchledger.plans.workspace import Workspace

    docs = [(i, f"text {i % 7} " * (i % 5 + 1)) for i in range(80)]
    one = packed(documents(*docs), workspace)
    many = packed(documents(*docs).repartition(5), Workspace(llm, str(tmp_path / "other")), range_tokens=50)
    assert sorted(map(tuple, one), key=str) == sorted(map(tuple, many), key=str)


def test_neighbours_share_a_language(llm, documents, workspace):
    """Documents of two vocabularies lie apart on the curve."""
    rng = random.Random(1)
    vocabularies = [["red", "green", "blue", "black"], ["uno", "dos", "tres", "cuatro"]]
    docs = [(i, " ".join(rng.choice(vocabularies[i % 2]) for _ in range(50))) for i in range(60)]
    rows = sorted(packed(documents(*docs), workspace, length=64), key=lambda r: (r["sequence_id"], r["offset"]))
    kinds = [r["doc_id"] % 2 for r in rows]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
    assert changes < len(kinds) / 6


def test_empty_table(llm, documents, workspace):
    assert packed(documents(schema="doc_id bigint, text string"), workspace) == []

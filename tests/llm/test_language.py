import numpy as np
import pytest

from touchledger.llm import language

FOLDER = "/root/testdata/sf0.01"


def test_codewords_are_apart():
    for n in (2, 3, 4, 5, 12, 40):
        code = language.codewords(n)
        assert code.shape[0] == n and set(np.unique(code)) == {-1, 1}
        apart = min(int((code[a] != code[b]).sum()) for a in range(n) for b in range(a))
        assert apart >= (1 if n == 2 else 2 if n == 3 else 4)
        assert all(len(set(column)) == 2 for column in code.T)
    assert language.codewords(1).shape == (1, 0)


def test_long_texts_are_counted_in_parts(monkeypatch):
    text = "wörter über alles " * 40
    whole = language.features([text])
    monkeypatch.setattr(language, "_PORTION", 64)
    assert np.allclose(language.features([text]), whole, atol=0.02)


@pytest.fixture(scope="module")
def found(llm):
    from touchledger.llm.queries import op4_language

    rows = op4_language(llm, FOLDER).collect()
    lang = {r["doc_id"]: r["lang"] for r in llm.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    return rows, lang


def test_held_out_accuracy(found):
    rows, lang = found
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and 0.2 < len(held) / len(rows) < 0.3
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_only_the_text_decides(llm, documents):
    docs = documents((1, "der die das und nicht", "de"), (2, "the and of to in", "en"), (3, "ein und der mit von", "de"),
                     (4, "is it that for was", "en"), schema="doc_id bigint, text string, lang string")
    model = language.LanguageModel.fit(docs)
    odd = documents((9, "der und das", "en"), (10, None, "de"), (11, "123 ½²Ⅷ !?", "de"), (12, "", None), (9, "der und das", "en"),
                    (13, "the " * 200_000, None), (None, "mit von der", None), schema="doc_id bigint, text string, score string")
    got = [(r["doc_id"], r["lang_pred"]) for r in language.identify(odd, model).collect()]
    assert sorted(got, key=str) == sorted([(9, "de"), (10, "und"), (11, "und"), (12, "und"), (9, "de"), (13, "en"), (None, "de")], key=str)


def test_one_language_or_none(llm, documents):
    schema = "doc_id bigint, text string, lang string"
    one = language.LanguageModel.fit(documents((1, "hello you", "en"), (2, "x", None), schema=schema))
    assert one.predict(["anything", None, "1"]) == [("en", 1.0, False), ("und", 0.0, False), ("und", 0.0, False)]
    none = language.LanguageModel.fit(documents(schema=schema))
    assert none.predict(["anything"]) == [("und", 0.0, False)]


def test_close_codewords_are_flagged():
    texts = ["der die und nicht"] * 20 + ["the and of not"] * 20 + ["le la et pas"] * 20
    model = language.LanguageModel._train(["de", "en", "fr"], texts, np.repeat([0, 1, 2], 20))
    clear, mixed = model.predict(["der und die nicht", "der und the of"])
    assert not clear[2] and clear[1] > mixed[1]


def test_every_language_is_learnt_and_the_sample_is_bounded(documents, monkeypatch):
    schema = "doc_id bigint, text string, lang string"
    rows = [(i, f"{'abcdefghij'[i % 10] * 3} word{i}", f"l{i % 10}") for i in range(600)] + [(1000, "zzz alone", "rare")] + [(1, "bbb word1", "l1")] * 50
    texts = []
    monkeypatch.setattr(language.LanguageModel, "_train", classmethod(lambda cls, languages, t, label: texts.append((languages, t, label))))
    language.LanguageModel.fit(documents(*rows, schema=schema), sample=33)
    languages, found, label = texts[-1]
    assert languages == sorted([f"l{i}" for i in range(10)] + ["rare"]) and np.bincount(label).tolist() == [3] * 10 + [1]
    again = documents(*rows, schema=schema).repartition(7)
    language.LanguageModel.fit(again, sample=33)
    assert texts[-1][1] == found
    monkeypatch.setattr(language, "SAMPLE_BYTES", 11 * 15)
    language.LanguageModel.fit(again, sample=330)
    assert np.bincount(texts[-1][2]).tolist() == [1] * 11
    monkeypatch.setattr(language, "LANGUAGES", 4)
    language.LanguageModel.fit(again, sample=33)
    assert len(texts[-1][0]) == 4 and "rare" not in texts[-1][0]

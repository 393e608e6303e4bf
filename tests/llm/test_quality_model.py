import math
from collections import Counter

import numpy as np
import pytest

from touchledger.llm import quality

TEXTS = ["the cat sat on the mat", "a cat and a hat", "the hat on the cat é", None, "", "the cat sat on the mat"]


def plain_model(texts, symbols):
    """Interpolated modified Kneser-Ney as the definition has it, by recursion over dictionaries."""
    n = quality.ORDER
    space = int(symbols[32])
    counts = [None] + [Counter() for _ in range(n)]
    for t in texts:
        s = [space] * (n - 1) + [int(symbols[b]) for b in (t or "").encode()] + [space]
        for i in range(n - 1, len(s)):
            counts[n][tuple(s[i - n + 1:i + 1])] += 1
    for k in range(n - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    discounts = [None]
    for k in range(1, n + 1):
        c = Counter(counts[k].values())
        n1, n2, n3, n4 = (c[i] for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.0
        d = (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 0.75, 3 - 4 * y * n4 / n3 if n3 else 0.9)
        discounts.append([max(quality.LEAST_DISCOUNT, x) for x in d])

    def p(gram):
        if not gram:
            return 1 / quality.ALPHABET
        k = len(gram)
        same = {g: c for g, c in counts[k].items() if g[:-1] == gram[:-1]}
        below = p(gram[1:])
        if not same:
            return below
        d = {g: min(c, discounts[k][min(c, 3) - 1]) for g, c in same.items()}
        total = sum(same.values())
        own = same.get(gram, 0)
        return (own - d.get(gram, 0)) / total + sum(d.values()) / total * below
    return p


@pytest.fixture(scope="module")
def fitted(llm, tmp_path_factory):
    from touchledger.plans.workspace import Workspace

    docs = llm.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id bigint, text string").repartition(3)
    return quality.QualityModel.fit(docs, Workspace(llm, str(tmp_path_factory.mktemp("model"))))


def test_probabilities_are_those_of_the_definition(fitted):
    table, p = np.exp(fitted.dense().astype(np.float64)), plain_model(TEXTS, fitted.symbols)
    rng = np.random.default_rng(1)
    seen = [c for t in TEXTS for c in quality.codes((t or "").encode(), fitted.symbols).tolist()]
    for code in {*seen, *rng.integers(0, quality.ALPHABET ** quality.ORDER, 200).tolist()}:
        gram = tuple(code >> quality.BITS * k & quality.ALPHABET - 1 for k in range(quality.ORDER - 1, -1, -1))
        assert table[code] == pytest.approx(p(gram), rel=1e-4)


def test_probabilities_of_a_context_add_up_to_one(fitted):
    table = np.exp(fitted.dense().astype(np.float64)).reshape(-1, quality.ALPHABET)
    assert np.allclose(table.sum(1), 1, atol=1e-4)


def test_perplexity_of_a_text_and_of_its_parts(llm, fitted, documents, monkeypatch):
    docs = documents((1, "the cat on a mat"), (2, None), (3, ""), (4, "#### zzzz"), (5, "the cat sat on the mat " * 3000))
    got = {r["doc_id"]: r["p"] for r in docs.select("doc_id", quality.perplexities(docs, fitted)(docs["text"]).alias("p")).collect()}
    p = plain_model(TEXTS, fitted.symbols)
    for doc, text in ((1, "the cat on a mat"), (2, ""), (3, ""), (4, "#### zzzz")):
        s = [int(fitted.symbols[32])] * 3 + [int(fitted.symbols[b]) for b in text.encode()] + [int(fitted.symbols[32])]
        logs = [math.log(p(tuple(s[i - 3:i + 1]))) for i in range(3, len(s))]
        assert got[doc] == pytest.approx(math.exp(-sum(logs) / len(logs)), rel=1e-3)
    assert got[4] > 5 * got[1] > 5 * got[5]
    table = fitted.dense()
    raw = ("the cat sat on the mat " * 40).encode()
    whole = table[quality.codes(raw, fitted.symbols)].sum()
    monkeypatch.setattr(quality, "_PORTION", 64)
    parts = 0.0
    for at in range(0, len(raw) + 1, 64):
        first = max(0, at - quality.ORDER)
        code = quality.codes(raw[first:at + 64], fitted.symbols)[at - first:]
        parts += table[code if at + 64 > len(raw) else code[:-1]].sum()
    assert parts == pytest.approx(whole, rel=1e-5)


def test_thresholds_by_language(llm, documents, workspace):
    rows = [(i, f"this is plain text number {i} of a series", "en") for i in range(40)]
    rows += [(100 + i, f"voici un texte simple numéro {i} de la série", "fr") for i in range(40)]
    rows += [(200, "#@!$ %^&* ~~~~ ||||", "en"), (201, "plain text of a series", None), (202, None, "en"), (203, "this is text number 5", "xx"),
             (None, "this is plain text number 3 of a series", "en"), (0, rows[0][1], "en")]
    docs = documents(*rows, schema="doc_id bigint, text string, lang string")
    ids = documents(*[(i,) for i in range(30)], *[(100 + i,) for i in range(30)], (None,), schema="doc_id bigint")
    got = quality.judge(docs, ids, slack=1.5, workspace=workspace).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert not by[200]["kept"] and by[35]["kept"] and by[135]["kept"] and by[0]["kept"]
    assert by[35]["threshold"] != by[135]["threshold"] and by[201]["threshold"] == by[203]["threshold"]


def test_no_trusted_text_and_no_documents(llm, documents, workspace):
    docs = documents((1, "a", "en"), (2, None, None), schema="doc_id bigint, text string, lang string")
    none = documents(schema="doc_id bigint")
    got = quality.judge(docs, none, workspace=workspace).collect()
    assert {r["kept"] for r in got} == {True} and {round(r["perplexity"], 3) for r in got} == {64.0}
    assert quality.judge(docs.limit(0), none, workspace=workspace).count() == 0


def test_junk_goes_and_good_documents_stay(llm):
    from touchledger.llm.queries import op7_quality

    kept = {r["doc_id"]: r["kept"] for r in op7_quality(llm, "/root/testdata/sf0.01").collect()}
    labels = llm.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    good = [kept[r["doc_id"]] for r in labels if r["quality"] == 1]
    junk = [kept[r["doc_id"]] for r in labels if r["quality"] == 0]
    assert sum(good) / len(good) > 0.97 and sum(junk) / len(junk) < 0.35


def plain_words(texts, own, text, model):
    """Log probability by bigrams of words of all texts but ``own``; discounts from all texts."""
    table = model.dense()

    def pairs(t):
        words = quality._WORD.findall(t.encode())
        return Counter(zip([b"", *words], words))

    def discount(counts):
        c = Counter(counts.values())
        n1, n2, n3, n4 = (c[i] for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.0
        d = (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 0.75, 3 - 4 * y * n4 / n3 if n3 else 0.9)
        return lambda n: min(n, max(quality.LEAST_DISCOUNT, d[min(n, 3) - 1])) if n else 0.0
    every = sum((pairs(t) for t in texts), Counter())
    d2, d1 = discount(every), discount(Counter(b for _, b in every))
    c2 = sum((pairs(t) for i, t in enumerate(texts) if i != own), Counter())
    c1 = Counter(b for _, b in c2)
    raw, total = text.encode(), 0.0
    logs = table[quality.codes(raw, model.symbols)].astype(float)
    spans = [m.start() for m in quality._WORD.finditer(raw)]
    words, sums, ends = quality._WORD.findall(raw), {}, [*spans[1:], len(logs)]
    grams = list(zip([b"", *words], words))
    for g, a, b in zip(grams, [0, *spans[1:]], ends):
        sums.setdefault(g, []).append(logs[a:b].sum())
    for a, b in grams:
        p = math.exp(sum(sums[a, b]) / len(sums[a, b]))
        p = (c1[b] - d1(c1[b])) / sum(c1.values()) + sum(map(d1, c1.values())) / sum(c1.values()) * p
        same = {g: n for g, n in c2.items() if g[0] == a}
        if same:
            p = (c2[a, b] - d2(c2[a, b])) / sum(same.values()) + sum(map(d2, same.values())) / sum(same.values()) * p
        total += math.log(p)
    return total / len(logs)


def test_words_are_measured_by_the_definition_and_trusted_ones_by_the_others(llm, documents, workspace):
    texts = ["the cat sat on the mat", "a cat and a hat , a cat", "the hat on the cat \u00e9t\u00e9 \u6f22\u5b57 12 %", "the cat sat on the mat"]
    others = ["the mat sat on a cat", "zebra \u6f22 99 %%", "  on the  the "]
    docs = documents(*[(i, t, "en") for i, t in enumerate(texts + others)], schema="doc_id bigint, text string, lang string").repartition(3)
    ids = documents(*[(i,) for i in range(len(texts))], schema="doc_id bigint")
    got = {r["doc_id"]: r["perplexity"] for r in quality.judge(docs, ids, workspace=workspace).collect()}
    model = quality.QualityModel.fit(docs.where(f"doc_id < {len(texts)}"), workspace)
    for i, t in enumerate(texts + others):
        assert got[i] == pytest.approx(math.exp(-plain_words(texts, i if i < len(texts) else None, t, model)), rel=1e-3), t


def test_senseless_order_and_symbols_of_one_class_are_told_apart(llm, documents, workspace):
    """The order of known words, digits for digits and capitals for capitals, which the spelling alone cannot see."""
    line = "every small town has one old church near the river"
    good = [(i, f"{line} and it was built in 1872 by Kim", "en") for i in range(30)]
    words = good[0][1].split()
    shuffled = " ".join(words[::2] + words[1::2])
    odd = [(100, shuffled, "en"), (101, good[0][1].replace("1872", "#%@!"), "en"), (102, good[0][1].replace("Kim", "Xim"), "en")]
    docs = documents(*good, *odd, schema="doc_id bigint, text string, lang string")
    got = {r["doc_id"]: r for r in quality.judge(docs, documents(*[(i,) for i in range(30)], schema="doc_id bigint"), workspace=workspace).collect()}
    assert got[0]["kept"] and not any(got[i]["kept"] for i in (100, 101, 102))
    assert got[100]["perplexity"] > 3 * got[0]["perplexity"]


def test_words_are_found_by_bytes_as_by_the_expression():
    rng = np.random.default_rng(3)
    signs = [chr(c) for c in (0, 9, 10, 11, 12, 13, 28, 32, 46, 48, 65, 95, 0xA0, 0xE9, 0x3B1, 0x7FF, 0x800, 0xDFF, 0xE00, 0xE40, 0xFFF,
                              0x1000, 0x2000, 0x4E00, 0xA000, 0xD7FF, 0xE000, 0x10000, 0x10FFFF)]
    for k in range(3000):
        raw = "".join(rng.choice(signs, rng.integers(0, 12))).encode()
        if k % 4 == 0:
            raw = bytes(rng.choice(np.frombuffer(raw + b"\xc3\xe0\x80 ", np.uint8), 8))
        starts, ends = quality.spans(raw)
        assert list(zip(starts.tolist(), ends.tolist())) == [m.span() for m in quality._WORD.finditer(raw)]


def test_words_of_a_block_are_told_apart():
    import pyarrow as pa
    import xxhash

    texts = [b"a \x00 a a\x00b abcdefgh abcdefghi abcdefghj abcdefghabcdefgh abcdefghibcdefgh", b"", b"x" * 40 + b" " + b"x" * 41, b" \xc3", b"\x28 a "]
    block = quality.Block(pa.table({"text": pa.array(texts, pa.binary()), "trusted": [1, 1, 0, 1, 0]}))
    words = [quality._WORD.findall(t) for t in texts]
    hashes = [[xxhash.xxh64_intdigest(w) for w in of] for of in words]
    assert block.keys[block.words].tolist() == sum(hashes, [])
    assert block.keys[block.before].tolist() == sum(([0, *of][:len(of)] for of in hashes), [])
    assert dict(zip(block.keys.tolist(), block.word_counts().tolist()))[0] == 2


def test_arrays_come_back_from_their_packed_form():
    arrays = [np.array([], np.uint64), np.array([0, 0], np.uint64), np.array([1, 2 ** 64 - 1, 255, 256], np.uint64)]
    assert [a.tolist() for a in quality.unpack(quality.pack(*arrays))] == [a.tolist() for a in arrays]


def test_perplexities_do_not_depend_on_blocks_and_shards(llm, documents, workspace, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.4, 30) % 60), "en") for i in range(40)] + [(40, None, None), (0, "w1 w2 w3", "en")]
    docs = documents(*rows, schema="doc_id bigint, text string, lang string").repartition(2)
    ids = documents(*[(i,) for i in range(0, 40, 3)], schema="doc_id bigint")
    found = []
    for block, shards in ((1 << 20, 8), (200, 1), (1, 3)):
        monkeypatch.setattr(quality, "BLOCK", block)
        monkeypatch.setattr(quality, "LEAST_SHARDS", shards)
        got = quality.judge(docs, ids, workspace=workspace).collect()
        found.append(sorted((r["doc_id"], round(r["perplexity"], 6), r["kept"]) for r in got))
    assert len(found[0]) == len(rows) and found[0] == found[1] == found[2]


def test_no_row_is_written_for_each_bigram(llm, documents, tmp_path):
    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from touchledger.plans.workspace import Workspace

    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"word{int(x)}" for x in rng.integers(0, 4000, 400)), "en") for i in range(200)]
    docs = documents(*rows, schema="doc_id bigint, text string, lang string").repartition(2)
    model = quality.QualityModel.fit(docs.where("doc_id % 3 = 0"), Workspace(llm, str(tmp_path / "model")))
    trusted = (F.col("doc_id") % 3 == 0).cast("bigint")
    flagged = docs.select("doc_id", "lang", trusted.alias("trusted"), F.col("text").cast("binary").alias("text"))
    assert quality.measure(flagged, model, Workspace(llm, str(tmp_path / "measured"))).count() == len(rows)
    written = sum(pq.read_metadata(f).num_rows for f in (tmp_path / "measured").rglob("*.parquet"))
    assert written < 10 * len(rows)

import random

import numpy as np
import pytest

from touchledger.llm import toxicity

FOLDER = "/root/testdata/sf0.1"


def test_bags_share_character_runs_and_not_words():
    (a, _), (b, _), (c, _) = (toxicity.bags([w]) for w in ("idiotic", "idiots", "harmless"))
    assert len(set(a) & set(b)) >= 6 and not set(a) & set(c)
    together, first = toxicity.bags(["idiotic", "x", "idiots", ""])
    parts = np.split(together, first[1:])
    assert [sorted(p) for p in parts[:3]] == [sorted(toxicity.bags([w])[0]) for w in ("idiotic", "x", "idiots")]
    # 3- to 5-grams of "<idiots>" and the word
    assert len(b) == 6 + 5 + 4 + 1


def test_features_are_a_mean_over_words():
    size, bucket, share = toxicity.features(["good good day", None, "", "bad"])
    assert size.tolist()[1:3] == [0, 0] and len(bucket) == len(share) == size.sum()
    first = share[:size[0]].sum()
    weight = 1 + np.log(2) + 1
    assert first == pytest.approx(weight / (weight + toxicity.EMPTY), rel=1e-5)


def made(n, seed=5):
    """Texts of random words; toxic ones have a few insults among them."""
    rng = random.Random(seed)
    syllables = ["ba", "do", "ki", "lu", "me", "no", "ra", "si", "tu", "ve"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    out = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(30, 120))]
        if i % 3 == 0:
            for _ in range(max(1, len(words) // 25)):
                words.insert(rng.randrange(len(words)), rng.choice(["grufflump", "grufflumper", "snerkwad", "snerkwads"]))
        out.append((i, " ".join(words), int(i % 3 == 0)))
    return out


@pytest.fixture(scope="module")
def model():
    rows = made(600)
    return toxicity.ToxicityModel(*toxicity.train([toxicity.features([r[1] for r in rows])], np.array([r[2] for r in rows])))


def test_unseen_misspellings_are_found(model):
    rng = random.Random(9)
    clean = " ".join(rng.choice(["bado", "kilu", "menora", "situ", "veba"]) for _ in range(50))
    scores = model.scores([clean, clean + " grufflumping grufflumpz grufflumpo", clean + " snerkwadly snerkwadded snerkwadz", None, "", "x" * 100_000])
    assert scores[0] < 0.5 and (scores[1:3] > 0.5).all() and (scores[3:5] < 0.5).all() and scores[3] == scores[4]


def test_scores_do_not_depend_on_the_batch(model):
    texts = [r[1] for r in made(40, 3)] + [None, "word " * 50_000]
    assert np.allclose(model.scores(texts), [model.scores([t])[0] for t in texts])


@pytest.fixture(scope="module")
def scored(llm):
    from touchledger.llm.queries import op9_toxicity

    return op9_toxicity(llm, FOLDER).collect()


def test_held_out_documents(llm, scored):
    labels = {}
    for r in llm.read.parquet(f"{FOLDER}/labels.parquet").collect():
        labels[r["doc_id"]] = max(labels.get(r["doc_id"], 0), r["toxic"])
    # Here only the English documents that are labelled toxic have anything toxic in them.
    english = {r["doc_id"] for r in llm.read.parquet(f"{FOLDER}/documents.parquet").where("lang = 'en'").collect()}
    held = [(r["predicted"], labels[r["doc_id"]]) for r in scored if r["held_out"] and r["doc_id"] in labels
            and (not labels[r["doc_id"]] or r["doc_id"] in english)]
    assert 0.15 < sum(r["held_out"] for r in scored) / len(scored) < 0.25
    toxic, clean = [p for p, y in held if y], [p for p, y in held if not y]
    assert sum(toxic) / len(toxic) > 0.7 and sum(clean) / len(clean) < 0.02
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in scored)


def test_held_out_labels_are_not_learnt(llm, documents):
    """Turning round the labels of held-out documents changes no score."""
    from pyspark.sql import functions as F

    rows = made(120)
    docs = documents(*[(i, t) for i, t, _ in rows])
    labels = documents(*[(i, y) for i, _, y in rows], schema="doc_id bigint, toxic int")
    other = labels.withColumn("toxic", F.when(toxicity.is_training(F.col("doc_id")), F.col("toxic")).otherwise(1 - F.col("toxic")))
    a, b = ({r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, x).collect()} for x in (labels, other))
    assert a == b and len(a) == 120


def test_sample_is_bounded_and_does_not_depend_on_partitions(llm, documents):
    docs = documents(*[(i, "t") for i in range(200)])
    labels = documents(*[(i, i % 2) for i in range(200)], (3, None), (None, 1), (4, 7), (6, 1), schema="doc_id bigint, toxic int")
    one, two = (sorted(map(tuple, toxicity.sample(docs.repartition(n), labels.repartition(n), (10, 5)).collect())) for n in (1, 7))
    assert one == two and [r[2] for r in one].count(0) == 10 and [r[2] for r in one].count(1) == 5


def test_one_class_or_no_labels(llm, documents):
    docs = documents((1, "a"), (2, None), (None, "b"), (1, "a"), schema="doc_id bigint, text string")
    for labels, want in (([], {0}), ([(1, 0)], {0}), ([(1, 1), (2, 1)], {1})):
        frame = documents(*labels, schema="doc_id bigint, toxic int")
        model = toxicity.ToxicityModel.fit(docs, frame)
        scores = [r[0] for r in docs.select(toxicity.scorer(model, llm.sparkContext)(docs["text"])).collect()]
        assert len(scores) == 4 and {int(s >= 0.5) for s in scores} == want
    assert toxicity.score_documents(docs.limit(0), frame).count() == 0


def test_the_sample_is_bounded_in_bytes(documents, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", (100, 35))
    docs = documents(*[(i, "x" * 10) for i in range(40)], (5, "x" * 10), (5, "x" * 10), (41, None))
    labels = documents(*[(i, i % 2) for i in range(42)], schema="doc_id bigint, toxic int")
    got = [r["toxic"] for r in toxicity.sample(docs, labels, (8, 30)).collect()]
    assert got.count(1) == 3 and got.count(0) == 8

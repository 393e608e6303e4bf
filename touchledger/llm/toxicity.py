"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character 3- to 5-grams, with marks at both ends, and of the word itself; each is hashed into a
bucket with an embedding. A word's vector is the mean of its bag, a document's vector the mean over its words, and a
softmax over that vector tells toxic from clean. Embeddings and softmax are trained together by Adam, in numpy, on a
bounded sample of labelled documents. Misspelt or unseen words get the vectors of the n-grams they share.

For scoring, the product of each bucket's embedding with the softmax weights is all that is needed, so the model that is
broadcast is one number per bucket, whatever the corpus.

Defined results: a text without words (null and empty ones too) gets the score of an empty bag, which is the bias, and
is not predicted toxic unless that reaches one half; labels other than 0 and 1 are not learnt from; a document with
several labels counts as toxic if one of them says so; with labels of one class alone, or none, every score is that
class's, or 0. Repeated rows each get their score; input columns with a result's name give way.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchledger.llm.common import remainder

BUCKETS = 1 << 18
DIMENSIONS = 8
#: Bound of the sample of labelled documents: clean ones, toxic ones.
SAMPLE = (5000, 2500)
#: Bytes of the sample's texts, clean and toxic; documents beyond are left out of the sample, however few it then has.
SAMPLE_BYTES = (48 << 20, 24 << 20)
#: Share of the sample's documents that a bucket must have to be learnt, and documents at least.
SHARE, LEAST = 0.01, 5
#: The mean over a document's words is scaled by this before the softmax: a few words in a hundred are to decide.
SCALE = 50.0
#: Words without a bucket that are counted in every document.
EMPTY = 50.0
_WORD = re.compile(r"\w+")
_PRIMES = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], np.uint64)
#: A longer word, such as encoded data, is cut into pieces of this length.
_LONGEST = 40


def words_of(text: str | None) -> list[str]:
    found = _WORD.findall((text or "").lower())
    if any(len(w) > _LONGEST for w in found):
        found = [w[i:i + _LONGEST] for w in found for i in range(0, len(w), _LONGEST)]
    return found


def bags(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words one after the other, and where each word's begin."""
    joined = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    owner = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(starts + lengths, lengths) - np.arange(len(joined))
    parts, owners = [], []
    rolled = joined * _PRIMES[0]
    for n in range(2, 6):
        rolled = rolled[:-1] * _PRIMES[n - 1] + joined[n - 1:] if len(rolled) > 1 else rolled[:0]
        if n > 2:
            whole = left[:len(rolled)] >= n
            parts.append(rolled[whole] + np.uint64(n))
            owners.append(owner[:len(rolled)][whole])
    # The word itself: a sum over its characters by place.
    place = np.arange(len(joined)) - starts[owner]
    mixed = (joined + np.uint64(7)) * (place.astype(np.uint64) * _PRIMES[2] + _PRIMES[1])
    mixed ^= mixed >> np.uint64(29)
    parts.append(np.add.reduceat(mixed * _PRIMES[0], starts))
    owners.append(np.arange(len(words)))
    code, owner = np.concatenate(parts), np.concatenate(owners)
    code ^= code >> np.uint64(31)
    code *= np.uint64(0x9E3779B97F4A7C15)
    bucket = (code >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32)
    order = np.argsort(owner, kind="stable")
    return bucket[order], np.searchsorted(owner[order], np.arange(len(words)))


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many buckets each document has; these buckets and their shares in a mean over the document's words.

    A word that occurs c times weighs 1 + ln c. EMPTY words without a bucket stand in every document, so that a short
    text has to be clearly toxic to look it.
    """
    counts = [Counter(words_of(t)) for t in texts]
    vocabulary: dict[str, int] = {}
    word = np.array([vocabulary.setdefault(w, len(vocabulary)) for c in counts for w in c], np.int64)
    if not vocabulary:
        return np.zeros(len(texts), np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32)
    weight = 1 + np.log(np.array([n for c in counts for n in c.values()], np.float64))
    doc = np.repeat(np.arange(len(texts)), [len(c) for c in counts])
    weight /= (np.bincount(doc, weight, len(texts)) + EMPTY)[doc]
    buckets, first = bags(list(vocabulary))
    size = np.diff(np.append(first, len(buckets)))
    n = size[word]
    entry = np.arange(n.sum()) + np.repeat(first[word] - np.cumsum(n) + n, n)
    pairs, where = np.unique(np.repeat(doc, n) * BUCKETS + buckets[entry], return_inverse=True)
    return (np.bincount(pairs // BUCKETS, minlength=len(texts)), (pairs % BUCKETS).astype(np.int32),
            np.bincount(where, np.repeat(weight / n, n)).astype(np.float32))


def _steps(state: dict, name: str, grad, rate: float, at: int):
    """Adam's step."""
    m, v = state.get(name, (0.0, 0.0))
    m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
    state[name] = (m, v)
    return rate * (m / (1 - 0.9 ** at)) / (np.sqrt(v / (1 - 0.999 ** at)) + 1e-8)


def train(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray, steps: int = 150, batch: int = 128,
          rate: float = 0.06, decay: float = 0.3, seed: int = 7) -> tuple[np.ndarray, float]:
    """Each bucket's product with the softmax weights (toxic less clean), and the bias.

    ``parts`` hold, for some documents after the other, what ``features`` gives; they are used up.
    """
    rng = np.random.default_rng(seed)
    # A bucket that few documents have tells the sample apart, not toxic from clean; it stays at zero.
    common = sum(np.bincount(bucket, minlength=BUCKETS) for _, bucket, _ in parts) >= max(LEAST, SHARE * len(labels))
    kept, number, sizes, end = np.flatnonzero(common), (np.cumsum(common) - 1).astype(np.int32), [], 0
    entries = sum(int(common[bucket].sum()) for _, bucket, _ in parts)
    bucket, share = np.empty(entries, np.int32), np.empty(entries, np.float32)
    parts.reverse()
    while parts:
        size, some, part = parts.pop()
        use = common[some]
        sizes.append(np.bincount(np.repeat(np.arange(len(size)), size)[use], minlength=len(size)))
        begin, end = end, end + int(use.sum())
        bucket[begin:end], share[begin:end] = number[some[use]], part[use]
    first = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
    table = (rng.normal(size=(len(kept), DIMENSIONS)) / DIMENSIONS).astype(np.float32)
    weights, bias = (rng.normal(size=(DIMENSIONS, 2)) / DIMENSIONS).astype(np.float32), np.zeros(2, np.float32)
    m1, m2, state, order = np.zeros_like(table), np.zeros_like(table), {}, np.zeros(0, np.int64)
    for at in range(1, steps + 1):
        if len(order) < batch:
            order = np.concatenate([order, rng.permutation(len(labels))])
        chosen, order = order[:batch], order[batch:]
        step = rate * (1 - 0.95 * at / steps)
        n = first[chosen + 1] - first[chosen]
        entry = np.arange(n.sum()) + np.repeat(first[chosen] - np.cumsum(n) + n, n)
        owner, value = np.repeat(np.arange(len(chosen)), n), SCALE * share[entry]
        touched, local = np.unique(bucket[entry], return_inverse=True)
        now = table[touched]
        mean = np.stack([np.bincount(owner, value * now[local, k], len(chosen)) for k in range(DIMENSIONS)], 1)
        logit = mean @ weights + bias
        p = np.exp(logit - logit.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(chosen)), labels[chosen]] -= 1
        p /= len(chosen)
        back = p @ weights.T
        grad = np.stack([np.bincount(local, value * back[owner, k], len(touched)) for k in range(DIMENSIONS)],
                        1).astype(np.float32)
        m1[touched] = 0.9 * m1[touched] + 0.1 * grad
        m2[touched] = 0.999 * m2[touched] + 0.001 * grad * grad
        table[touched] = now * (1 - step * decay) - step * (m1[touched] / (1 - 0.9 ** at)) / (
            np.sqrt(m2[touched] / (1 - 0.999 ** at)) + 1e-8)
        weights -= _steps(state, "weights", mean.T @ p, step, at).astype(np.float32)
        bias -= _steps(state, "bias", p.sum(0), step, at).astype(np.float32)
    out = np.zeros(BUCKETS, np.float32)
    out[kept] = SCALE * table @ (weights[:, 1] - weights[:, 0])
    return out, float(bias[1] - bias[0])


def sample(docs: DataFrame, labels: DataFrame, bound: tuple[int, int] = SAMPLE) -> DataFrame:
    """(doc_id, text, toxic) of a bounded number of labelled documents, by the order of a hash of the id.

    The ids are chosen among the labels alone; only these, at most ``sum(bound)`` of them, are broadcast to the texts.
    Both the rows and, by ``SAMPLE_BYTES``, their texts are bounded.
    """
    known = (labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id")
             .agg(F.max("toxic").cast("int").alias("toxic")))
    mixed = F.xxhash64(F.lit("toxicity"), F.col("doc_id"))
    chosen = [known.where(F.col("toxic") == k).orderBy(mixed, "doc_id").limit(n) for k, n in enumerate(bound)]
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
    # of rows that share an id the smallest text stands for all, so there are as many as were chosen
    texts = texts.groupBy("doc_id", "toxic").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    row = Window.partitionBy("toxic").orderBy(mixed, "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    most = F.when(F.col("toxic") == 1, SAMPLE_BYTES[1]).otherwise(SAMPLE_BYTES[0])
    return (texts.withColumn("_bytes", F.sum(F.octet_length("text").cast("bigint")).over(row)).where(F.col("_bytes") <= most)
            .select("doc_id", "text", "toxic"))


class ToxicityModel:
    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, bound: tuple[int, int] = SAMPLE) -> ToxicityModel:
        """Trains on a bounded sample of the labels given."""
        rows = sorted(((r["doc_id"], r["text"] or "", r["toxic"]) for r in sample(docs, labels, bound).collect()))
        toxic, texts, parts = np.array([r[2] for r in rows], np.int64), [r[1] for r in rows], []
        del rows
        if len(set(toxic.tolist())) < 2:
            return cls(np.zeros(BUCKETS, np.float32), 40.0 if len(toxic) and toxic[0] else -40.0)
        for some in _portions(texts):
            parts.append(features([texts[i] for i in some]))
            for i in some:
                texts[i] = ""
        return cls(*train(parts, toxic))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        logit = np.full(len(texts), self.bias)
        # A few documents at a time, by their length, bound the memory.
        for some in _portions(texts):
            size, bucket, share = features([texts[i] for i in some])
            logit[some] += np.bincount(np.repeat(np.arange(len(some)), size), share * self.weights[bucket], len(some))
        return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))


def _portions(texts: list[str | None], most: int = 1 << 18):
    some, size = [], 0
    for i, t in enumerate(texts):
        some.append(i)
        size += len(t or "")
        if size >= most:
            yield some
            some, size = [], 0
    if some:
        yield some


def scorer(model: ToxicityModel, sc):
    """Column function: the score of a text."""
    held = sc.broadcast((model.weights, model.bias))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(ToxicityModel(*held.value).scores(texts.tolist()))
    return score.asNondeterministic()


def is_training(doc_id: Column) -> Column:
    return remainder(doc_id, 5) != 0


def score_documents(docs: DataFrame, labels: DataFrame, bound: tuple[int, int] = SAMPLE) -> DataFrame:
    """The documents with score and predicted; learnt from the labels whose crc32(doc_id) mod 5 is not 0."""
    model = ToxicityModel.fit(docs, labels.where(is_training(F.col("doc_id"))), bound)
    scored = docs.withColumn("score", scorer(model, docs.sparkSession.sparkContext)(F.col("text")))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

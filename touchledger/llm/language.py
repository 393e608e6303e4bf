"""Language identification by error-correcting output codes.

Every language has a codeword; for each bit a logistic classifier over hashed byte 1- to 3-grams tells the languages
with a one from those with a zero. The decoder takes the codeword with the least loss, summed over the bits with weights
for how well each bit's classifier knows that language, and flags a text whose two best codewords are close.

The classifiers are trained in numpy on a bounded sample: of each language the texts with the smallest hashes, as many of
each, ``SAMPLE`` in all and of ``SAMPLE_BYTES``, but one at least. Of more than ``LANGUAGES`` languages the most frequent
are learnt, and other texts get one of these. The broadcast model has a fixed number of buckets.

Defined results: a null text, or one without a letter, is ``und`` with score 0; texts of a null language are not learnt
from; with one language learnt every other text gets it, with none every text is ``und``; ties go to the language that
sorts first; repeated rows each get their row; input columns with a result's name give way.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchledger.llm.common import remainder

BUCKETS = 1 << 12
#: Bound of the sample of labelled documents, over all languages, in rows and in bytes; and of the languages.
SAMPLE, SAMPLE_BYTES, LANGUAGES = 4000, 64 << 20, 1000
#: The two best codewords are ambiguous if their scores differ by less.
MARGIN = 0.2
UNDETERMINED = "und"
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint32)
_MIX = np.uint32(0x9E3779B1)
_SHIFT = np.uint32(32 - 12)
#: Bytes whose n-grams are counted at once; a longer text is counted in parts.
_PORTION = 1 << 20


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """Rows of +1 and -1: all partitions for up to five languages, else the best of some random codes."""
    if n <= 5:
        masks = [m for m in range(1, 1 << max(n - 1, 0))]
        return np.array([[1 if k < n - 1 and m >> k & 1 else -1 for m in masks] for k in range(n)]).reshape(n, -1)
    rng, best = np.random.default_rng(seed), None
    bits = max(15, 10 * int(np.ceil(np.log2(n))))
    for _ in range(50):
        code = rng.choice([-1, 1], size=(n, bits))
        code = code[:, np.abs(code.sum(0)) < n]
        apart = ((code.shape[1] - code @ code.T) // 2 + np.eye(n, dtype=int) * bits).min()
        if best is None or apart > best[0]:
            best = (apart, code)
    return best[1]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _grams(raw: np.ndarray) -> list[np.ndarray]:
    folded = _FOLD[raw]
    two = folded[:-1] * np.uint32(257) + folded[1:]
    three = two[:-1] * np.uint32(257) + folded[2:]
    return [((g + np.uint32(n << 25)) * _MIX) >> _SHIFT for n, g in enumerate((folded, two, three), 1)]


def features(texts: list[str]) -> np.ndarray:
    """Square roots of the shares of hashed n-grams, one row for each text; rows have unit length."""
    out = np.zeros((len(texts), BUCKETS), np.float32)
    for i, text in enumerate(texts):
        raw = np.frombuffer(b" " + text.encode() + b" ", np.uint8)
        for at in range(0, len(raw), _PORTION):
            for g in _grams(raw[max(0, at - 2):at + _PORTION] if at else raw[:_PORTION]):
                out[i] += np.bincount(g, minlength=BUCKETS)
    np.sqrt(out, out=out)
    return out / np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-9)


class LanguageModel:
    def __init__(self, languages: list[str], code: np.ndarray, weights: np.ndarray, bias: np.ndarray,
                 trust: np.ndarray):
        self.languages, self.code, self.weights, self.bias, self.trust = languages, code, weights, bias, trust

    @classmethod
    def fit(cls, docs: DataFrame, sample: int = SAMPLE) -> LanguageModel:
        """Learns from the rows given (columns doc_id, text and lang)."""
        known = docs.where("lang is not null and text is not null")
        counts = dict(sorted(tuple(r) for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang")
                             .limit(LANGUAGES).collect()))
        if not counts:
            return cls([], np.zeros((0, 0)), np.zeros((BUCKETS, 0), np.float32), np.zeros(0), np.zeros((0, 0)))
        each = max(1, sample // len(counts))
        parts = 1 << 60
        place = F.pmod(F.xxhash64(F.lit("language"), F.col("doc_id"), F.col("text")), F.lit(parts))

        def below(limits: dict[str, int]) -> Column:
            return place <= F.create_map(*itertools.chain.from_iterable(
                (F.lit(k), F.lit(n)) for k, n in limits.items()))[F.col("lang")]

        # The smallest hashes of each language: enough are looked at that their number cannot fall short by chance.
        ample = {k: int(parts * min(1.0, (2 * each + 64) / n)) for k, n in counts.items()}
        sizes = known.where(below(ample)).groupBy("lang", place.alias("place")).agg(F.max(F.octet_length("text")).alias("size"))
        taken: dict[str, list[tuple[int, int]]] = {}
        for lang, at, size in sorted((r["lang"], r["place"], r["size"]) for r in sizes.collect()):
            own = taken.setdefault(lang, [])
            if not own or len(own) < each and sum(n for _, n in own) + size <= SAMPLE_BYTES // len(counts):
                own.append((at, size))
        last = {k: own[-1][0] for k, own in taken.items()}
        chosen = known.where(below(last)).groupBy("lang", place.alias("place")).agg(F.min("text").alias("text"))
        among = {(k, at) for k, own in taken.items() for at, _ in own}
        rows = sorted((r["lang"], r["place"], r["text"]) for r in chosen.collect() if (r["lang"], r["place"]) in among)
        rows = [r for r in rows if has_letter(r[2])]
        languages = sorted({r[0] for r in rows})
        number = {k: i for i, k in enumerate(languages)}
        return cls._train(languages, [r[2] for r in rows], np.array([number[r[0]] for r in rows], int))

    @classmethod
    def _train(cls, languages: list[str], texts: list[str], label: np.ndarray, steps: int = 150,
               rate: float = 0.5) -> LanguageModel:
        code = codewords(len(languages))
        if not code.size:
            return cls(languages, code, np.zeros((BUCKETS, 0), np.float32), np.zeros(0), code.astype(float))
        x, target = features(texts), code[label].astype(np.float32)
        share = np.bincount(label, minlength=len(languages))
        even = (1 / share[label] / len(languages))[:, None].astype(np.float32)
        w, b = np.zeros((BUCKETS, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
        m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)
        for t in range(1, steps + 1):
            back = -even * target / (1 + np.exp(np.clip(target * (x @ w + b), -30, 30)))
            grad, grad_b = x.T @ back + 1e-5 * w, back.sum(0)
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            mb, vb = 0.9 * mb + 0.1 * grad_b, 0.999 * vb + 0.001 * grad_b * grad_b
            c1, c2 = 1 - 0.9 ** t, 1 - 0.999 ** t
            w -= rate * (m / c1) / (np.sqrt(v / c2) + 1e-8)
            b -= rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
        right = (x @ w + b) * target > 0
        trust = np.array([(right[label == k].sum(0) + 1) / (share[k] + 2) for k in range(len(languages))])
        return cls(languages, code, w, b, trust / trust.sum(1, keepdims=True))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """Language, score and whether the decoding is ambiguous."""
        out = [(UNDETERMINED, 0.0, False)] * len(texts)
        some = [i for i, t in enumerate(texts) if t and self.languages and has_letter(t)]
        for at in range(0, len(some), 128):
            own = some[at:at + 128]
            if len(self.languages) == 1:
                best, score, close = [0] * len(own), [1.0] * len(own), [False] * len(own)
            else:
                f = np.clip(features([texts[i] for i in own]) @ self.weights + self.bias, -30, 30)
                loss = (np.log1p(np.exp(-f[:, None, :] * self.code[None])) * self.trust[None]).sum(2)
                p = np.exp(-(loss - loss.min(1, keepdims=True)) * 4)
                p /= p.sum(1, keepdims=True)
                best = loss.argmin(1)
                first = np.sort(p, axis=1)
                score, close = first[:, -1], first[:, -1] - first[:, -2] < MARGIN
            for i, k, s, a in zip(own, best, score, close):
                out[i] = (self.languages[k], float(s), bool(a))
        return out


def is_training(doc_id: Column) -> Column:
    return remainder(doc_id, 4) != 2


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The documents with lang_pred, score and ambiguous."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = ["lang_pred", "score", "ambiguous"]

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(held.value.predict(texts.tolist()), columns=names)

    out = docs.drop("_language").withColumn("_language", predict.asNondeterministic()(F.col("text")))
    return out.withColumns({n: F.col(f"_language.{n}") for n in names}).drop("_language")

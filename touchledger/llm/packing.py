"""Packing along a space-filling curve.

Documents are tokenized; each gets a hashed vector of its tokens, projected to a few dimensions, and from these the
index on the Hilbert curve. Documents are range-sorted by it and laid end to end in that order, cut every 2048 tokens,
so neighbours on the curve share a sequence, and only the very last one can need padding.

Tokens move once. They are written with their keys; the bounds of the ranges come from a bounded sample of the keys, the
number of tokens before each range from a sum per range, and each range then numbers its own tokens.

Defined results: a null or empty text is a document of the closing id alone; equal keys are ordered by doc_id, nulls
first, and then by a hash of the text, so a large group of copies is dealt to several ranges; rows that are equal in all
of these are packed one after the other in any order, which changes nothing but their place. An empty table gives no
pieces. Columns of the input other than doc_id and text are not read.
"""

from __future__ import annotations

import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchledger.llm.common import once
from touchledger.plans.workspace import Workspace

LENGTH = 2048
CLOSING_ID = 1
#: Dimensions of the hashed vectors and of the curve, and bits for each of the latter.
HASHED, DIMENSIONS, BITS = 1024, 3, 16
#: Words whose tokens a worker remembers, in each of two generations.
REMEMBERED = 200_000
#: Tokens that a range should hold; keys in the sample that bounds the ranges, for each range and at most.
RANGE_TOKENS, SAMPLE_PER_RANGE, SAMPLE = 4_000_000, 100, 1_000_000


class WordTokens(dict):
    """Token ids of texts, as little-endian unsigned 16 or 32 bits; itself remembers those of words after a space.

    A text in Latin script is encoded whole, by the merges of the rank file of the same vocabulary. Another one is
    tokenized word by word, for the pre-tokenizer of byte-level BPE never joins text across a space that follows a
    non-space: what is not remembered of the words of a batch is encoded in one call, a line each, or by the tokenizer
    itself if it is beyond Latin or has a line break. Texts with the string of an added token, and those beyond Latin
    with runs of white space, go to the tokenizer whole.
    """

    #: White space before a space that is not the last of its run; what the rank file's pattern may cut differently.
    _RUN, _LATIN = re.compile(r"\s (?=\s|\Z)"), bytes(range(0xC9))

    def __init__(self, tokenizer_path: str, ranks_path: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.added = sorted(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.ranks, self.old = None, {}
        if ranks_path:
            import base64

            import tiktoken

            with open(ranks_path, "rb") as file:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            self.ranks = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            self.line = ranks[b"\n"]

    def _latin(self, text: str) -> bool:
        """Whether all characters are below U+0240: their first bytes in UTF-8 are below C9."""
        return text.isascii() or not text.encode("utf-8", "replace").translate(None, self._LATIN)

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def learn(self, words: set[str]) -> None:
        """Makes the ids of these words known. Words are in two generations, of which the older one goes."""
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        new, old = words.difference(self), self.old
        known = new.intersection(old)
        self.update((w, old[w]) for w in known)
        new -= known
        plain = [w for w in new if self._latin(w) and "\n" not in w] if self.ranks is not None else []
        if plain:
            ids = np.array(self.ranks.encode_ordinary("\n".join([f" {w}" for w in plain])), self.kind)
            ends = np.flatnonzero(ids == self.line)
            starts = np.r_[0, ends + 1].tolist()
            raw, size = ids.tobytes(), self.kind.itemsize
            self.update(zip(plain, [raw[a * size:b * size] for a, b in zip(starts, [*ends.tolist(), len(ids)])]))
            new.difference_update(plain)
        self.update((w, self.encode(" " + w)) for w in new)

    def _whole(self, text: str) -> bytes | None:
        """Ids of a text that is not to be tokenized word by word."""
        if any(a in text for a in self.added):
            return self.encode(text)
        if self.ranks is not None and self._latin(text):
            return np.array(self.ranks.encode_ordinary(text), self.kind).tobytes()
        return self.encode(text) if self._RUN.search(text) else None

    def batch(self, texts: list[str]) -> list[bytes]:
        """Ids of texts."""
        out = list(map(self._whole, texts))
        cut = {k: texts[k].split(" ") for k, ids in enumerate(out) if ids is None}
        self.learn(set(itertools.chain.from_iterable(c[1:] for c in cut.values())))
        for k, c in cut.items():
            out[k] = (self.encode(c[0]) if c[0] else b"") + b"".join(map(self.__getitem__, c[1:]))
        return out

    def of(self, text: str) -> np.ndarray:
        return np.frombuffer(self.batch([text])[0], self.kind)


def hilbert_index(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of points (rows of integers of that many bits) on the Hilbert curve.

    Coordinates are turned into the transposed index by undoing the rotations from the top bit down, then Gray-decoded
    and interleaved.
    """
    x = [points[:, k].astype(np.uint64) for k in range(points.shape[1])]
    n, one = len(x), np.uint64(1)
    for bit in range(bits - 1, 0, -1):
        q = one << np.uint64(bit)
        low = q - one
        for k in range(n):
            flip = (x[k] & q) != 0
            swap = np.where(flip, np.uint64(0), (x[0] ^ x[k]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            if k:
                x[k] = x[k] ^ swap
    for k in range(1, n):
        x[k] = x[k] ^ x[k - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[n - 1] & (one << np.uint64(bit)), (one << np.uint64(bit)) - one, np.uint64(0))
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for k in range(n):
            out = (out << one) | (((x[k] ^ turn) >> np.uint64(bit)) & one)
    return out.astype(np.int64)


def _projection(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(HASHED, DIMENSIONS))


def curve_keys(ids: np.ndarray, counts: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Coordinates of documents, a row each: hashed token counts, damped and of unit length, projected.

    ``ids`` are those of all documents one after the other, ``counts`` how many each has.
    """
    bucket = ((ids.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(22)).astype(np.int64)
    bucket += np.repeat(np.arange(len(counts)) * HASHED, counts)
    vectors = np.log1p(np.bincount(bucket, minlength=len(counts) * HASHED).reshape(-1, HASHED))
    norms = np.sqrt((vectors * vectors).sum(1, keepdims=True))
    return (vectors / np.where(norms > 0, norms, 1)) @ projection


def _places(coordinates: np.ndarray) -> np.ndarray:
    """Coordinates, about standard normal, on the grid of the curve."""
    return np.minimum((0.5 + np.arctan(coordinates * 1.5) / np.pi) * (1 << BITS), (1 << BITS) - 1).astype(np.int64)


def tokenized(docs: DataFrame, tokenizer: tuple, closing_id: int | None = CLOSING_ID, seed: int = 3) -> DataFrame:
    """doc_id, text hash, number of tokens, Hilbert key and the token ids as bytes, for every document."""
    def run(batches):
        tokens, projection = once(WordTokens, *tokenizer), once(_projection, seed)
        end = np.array([] if closing_id is None else [closing_id], tokens.kind)
        end = end.tobytes()
        for batch in batches:
            ids = [own + end for own in tokens.batch([t or "" for t in batch.column("text").to_pylist()])]
            counts = np.array([len(own) for own in ids], np.int64) // tokens.kind.itemsize
            points = curve_keys(np.frombuffer(b"".join(ids), tokens.kind), counts, projection)
            keys = hilbert_index(_places(points))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tie"), pa.array(counts, pa.int64()), pa.array(keys, pa.int64()),
                 pa.array(ids, pa.binary())], names=["doc_id", "tie", "n", "key", "ids"])
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    return rows.mapInArrow(run, "doc_id bigint, tie bigint, n bigint, key bigint, ids binary")


def _range_of(bounds):
    """Number of the range that (key, doc_id, tie) falls in; a null id is below all others."""
    @F.pandas_udf("int")
    def number(key, doc_id, tie):
        import pandas as pd

        rows = np.empty(len(key), dtype=[("k", "<i8"), ("d", "<i8"), ("t", "<i8")])
        rows["k"], rows["d"], rows["t"] = key, doc_id, tie
        return pd.Series(np.searchsorted(bounds.value, rows, side="right").astype(np.int32))
    return number


def pack(docs: DataFrame, tokenizer: tuple, length: int = LENGTH, closing_id: int | None = CLOSING_ID,
         range_tokens: int = RANGE_TOKENS, workspace: Workspace | None = None) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, key, ids) of documents in sequences.

    ``tokenizer`` is (path of a tokenizer file, path of its rank file or None, pattern of the latter).
    """
    spark = docs.sparkSession
    sc, workspace = spark.sparkContext, workspace or Workspace(spark)
    tokens = workspace.settle(tokenized(docs, tokenizer, closing_id), "tokens")
    order = [F.col("key"), F.coalesce("doc_id", F.lit(-(1 << 63))), F.col("tie")]
    rows, total = tokens.agg(F.count(F.lit(1)), F.sum("n")).first()
    wanted = max(1, min(-(-(total or 0) // range_tokens), 100_000))
    fraction = min(1.0, min(SAMPLE_PER_RANGE * wanted, SAMPLE) / max(rows, 1))
    names = ("k", "d", "t")
    some = tokens.select(*[c.alias(n) for c, n in zip(order, names)]).sample(fraction, 11)
    some = np.array(sorted(map(tuple, some.collect())), dtype=[(n, "<i8") for n in names])
    cuts = np.unique(some[np.linspace(0, len(some), wanted + 1).astype(int)[1:-1]]) if len(some) else some
    ranged = tokens.withColumn("range", _range_of(sc.broadcast(cuts))(*order))
    before, at = {}, 0
    for r in ranged.groupBy("range").agg(F.sum("n").alias("n")).orderBy("range").collect():
        before[r["range"]] = at
        at += r["n"]
    starts = sc.broadcast((before, "<u2" if _small(tokenizer[0]) else "<u4"))

    def cut(batches):
        (begins, kind), now, place = starts.value, None, 0
        wide = np.dtype("<u4")
        for batch in batches:
            out = []
            for doc, n, key, number, ids in zip(*(batch.column(c) for c in ("doc_id", "n", "key", "range", "ids"))):
                if number.as_py() != now:
                    now = number.as_py()
                    place = begins[now]
                own, n, done = np.frombuffer(ids.as_py(), kind), n.as_py(), 0
                while done < n:
                    take = min(n - done, length - place % length)
                    part = own[done:done + take]
                    out.append((doc.as_py(), done, take, zlib.crc32(part.astype(wide)), n, place // length,
                                place % length, key.as_py(), part.tobytes()))
                    done += take
                    place += take
            for i in range(0, len(out), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[i:i + 4096]), kinds)],
                                                 names=columns)

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "key", "ids"]
    kinds = [pa.int64()] * 8 + [pa.binary()]
    placed = (ranged.repartitionById(len(cuts) + 1, F.col("range"))
              .sortWithinPartitions("range", *order))
    return placed.mapInArrow(cut, ", ".join(f"`{c}` bigint" for c in columns[:-1]) + ", ids binary")


def _small(path: str) -> bool:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size() <= 1 << 16


def byte_bpe() -> tuple:
    """The public byte-level tokenizer of 50,257 ids, with the rank file of the same vocabulary."""
    import public_tokenizers

    return (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
            public_tokenizers.PATTERN)

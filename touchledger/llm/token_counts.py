"""Token counts by a two-tier lookup in the map task.

A byte-level BPE tokenizer first cuts a text into pre-tokens, and the tokens of a text are those of its pre-tokens. So
only the number of tokens of each pre-token is needed. The first tier is a broadcast table of frequent pre-tokens, from a
bounded sample of documents; the second is a cache in each worker, which asks the library for what neither tier knows.
Pre-tokens are never shuffled, and the sample decides how fast a count is found, not what it is.

A text goes to the library whole if it holds a string of an added token, or a character that the library's pre-tokenizer
and the pattern here cut differently (asked of the library once for each character). So does every text if the tokenizer
is not a plain byte-level one.

Defined results: a null or empty text has no bytes and no tokens; a text of any length counts whole; special strings
in a text count as the library counts them by default; repeated rows each get their row, null ids too; an empty table
gives no rows. Columns of the input stay; one with a result's name gives way.
"""

from __future__ import annotations

import itertools
import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchledger.llm.common import once

#: Documents of the sample (in expectation), tasks that count it, pre-tokens in the table, and characters of one at most.
SAMPLE, SAMPLE_TASKS, FREQUENT, LONGEST = 4_000, 8, 1 << 16, 64
#: Pre-tokens in each of the two generations of a worker's cache.
REMEMBERED = 1 << 18
#: Characters of a text that are cut into pre-tokens at once.
PORTION = 1 << 20
#: How byte-level BPE cuts a text into pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Library:
    """Counts of whole texts by the library that a tokenizer file is for."""

    def __init__(self, path: str):
        self.pieces = self.tokenizer = None
        if path.endswith(".model"):
            import sentencepiece

            self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(path)
            self.tokenizer.no_truncation()
            self.tokenizer.no_padding()

    def count(self, text: str) -> int:
        if self.pieces:
            return len(self.pieces.encode(text, add_bos=False, add_eos=False))
        return len(self.tokenizer.encode(text, add_special_tokens=False))

    def byte_level(self) -> bool:
        """Whether the tokens of a text are those of its pre-tokens by ``PATTERN``."""
        if self.pieces:
            return False
        made = json.loads(self.tokenizer.to_str())
        cut = made["pre_tokenizer"] or {}
        return (made["normalizer"] is None and made["post_processor"] is None and made["model"]["type"] == "BPE"
                and cut.get("type") == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"])


class TokenCounter(dict):
    """Numbers of tokens by pre-token: itself is the table of frequent ones, what it misses goes to the worker's cache."""

    def __init__(self, path: str, frequent: tuple[bytes, bytes, bytes] | None = None):
        import regex

        self.library = Library(path)
        self.cut = regex.compile(PATTERN).findall if self.library.byte_level() else None
        self.young, self.old = {}, {}
        self.agreed, self.foreign = set(), set()
        added = [] if self.library.pieces else self.library.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in added]
        if frequent:
            self.update(unpacked(*frequent))

    def __missing__(self, piece: str) -> int:
        found = self.young.get(piece)
        if found is None:
            found = self.old.get(piece)
            if found is None:
                found = self.library.count(piece)
            if len(piece) <= LONGEST:
                if len(self.young) >= REMEMBERED:
                    self.young, self.old = {}, self.young
                self.young[piece] = found
        return found

    def pieces(self, text: str) -> Iterator[list[str]] | None:
        """Pre-tokens of a text, portion by portion; none if it has to go to the library whole."""
        if self.cut is None or not self._agrees(text) or any(a in text for a in self.added):
            return None
        return map(self.cut, portions(text)) if len(text) > PORTION else iter((self.cut(text),))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        pieces = self.pieces(text)
        if pieces is None:
            return self.library.count(text)
        return sum(sum(map(self.__getitem__, part)) for part in pieces)

    def _agrees(self, text: str) -> bool:
        """Whether library and pattern cut around each character of a text in the same way."""
        new = set(text) - self.agreed
        for c in new - self.foreign:
            probes = [a + c + b for a in ("a", "1", "!", " ", "'") for b in ("", "a", "1", "!", " ")]
            (self.agreed if all(map(self._alike, probes)) else self.foreign).add(c)
        return new.isdisjoint(self.foreign) if new else True

    def _alike(self, probe: str) -> bool:
        theirs = [len(probe[a:b]) for _, (a, b) in self.library.tokenizer.pre_tokenizer.pre_tokenize_str(probe)]
        return theirs == list(map(len, self.cut(probe)))


def portions(text: str) -> Iterator[str]:
    """Parts of a text, cut before a space after something else than white space, where pre-tokens end in any case."""
    start = 0
    while start < len(text):
        end = start + PORTION
        while 0 < end < len(text):
            end = text.find(" ", end)
            if end > 0 and not text[end - 1].isspace():
                break
            end += end > 0
        end = end if 0 < end < len(text) else len(text)
        yield text[start:end]
        start = end


def packed(lengths: dict[str, int]) -> tuple[bytes, bytes, bytes]:
    """A table as one run of UTF-8, the ends of the keys in it, and their numbers of tokens."""
    keys = [k.encode() for k in lengths]
    return (b"".join(keys), np.cumsum([len(k) for k in keys], dtype="<u4").tobytes(),
            np.array(list(lengths.values()), "<u2").tobytes())


def unpacked(text: bytes, ends: bytes, numbers: bytes) -> Iterator[tuple[str, int]]:
    ends = np.frombuffer(ends, "<u4").tolist()
    keys = (text[a:b].decode() for a, b in zip(itertools.chain((0,), ends), ends))
    return zip(keys, np.frombuffer(numbers, "<u2").tolist())


def frequent_lengths(docs: DataFrame, path: str, size: int = FREQUENT, sample: int = SAMPLE) -> tuple:
    """The packed table of the pre-tokens that are most frequent in a sample of the documents.

    The tasks of the sample hand over their most frequent ones, so the driver gets ``SAMPLE_TASKS * size`` at most.
    """
    def tops(batches):
        counter, seen = once(TokenCounter, path), Counter()
        for text in itertools.chain.from_iterable(b.column(0) for b in batches):
            for part in counter.pieces(text.as_py()) or ():
                seen.update(p for p in part if len(p) <= LONGEST)
            if len(seen) > 16 * size:
                seen = Counter(dict(seen.most_common(size)))
        top = seen.most_common(size)
        for at in range(0, len(top), 1 << 13):
            keys, counts = zip(*top[at:at + (1 << 13)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(counts, pa.int64()), pa.array([counter[k] for k in keys], pa.int32())],
                names=["piece", "n", "tokens"])

    rows = docs.count()
    texts = docs.select("text").where("text != ''").sample(min(1.0, sample / max(rows, 1)), 7)
    found = texts.repartition(SAMPLE_TASKS).mapInArrow(tops, "piece string, n bigint, tokens int").toArrow()
    found = found.group_by("piece").aggregate([("n", "sum"), ("tokens", "max")])
    found = found.sort_by([("n_sum", "descending"), ("piece", "ascending")]).slice(0, size)
    return packed(dict(zip(found["piece"].to_pylist(), found["tokens_max"].to_pylist())))


def count_tokens(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """The documents with n_bytes, n_tokens and over_limit (more than ``limit`` tokens).

    ``path`` is the file of a tokenizer: ``.json`` for tokenizers, ``.model`` for sentencepiece.
    """
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path))

    @F.pandas_udf("bigint")
    def number(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = once(TokenCounter, path, table.value)
        for text in texts:
            yield text.map(counter.count).astype("int64")

    text = F.coalesce("text", F.lit(""))
    return (docs.withColumns({"n_bytes": F.octet_length(text).cast("bigint"), "n_tokens": number(text)})
            .withColumn("over_limit", F.col("n_tokens") > limit))


def byte_bpe() -> str:
    """The public byte-level tokenizer of 50,257 ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")

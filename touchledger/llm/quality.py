"""Quality by perplexity under interpolated modified Kneser-Ney models of trusted text.

Words are modelled by bigrams: all those of the trusted text, however many. A word is a run of letters and digits, a
character of a script without spaces, or any other character but white space, as it is written. Its spelling is
modelled by n-grams of order four over a fixed alphabet, the 63 most frequent bytes of the trusted text, in UTF-8, and
one symbol for all others; a word's bytes, with the white space after it, have the probability that the words back off
to. So words that are not known, in any script, are as probable as their spelling, and known ones in an order that is
not known as probable as the words alone.

Trusted documents are counted whole in the tasks; counts are added up in shards by n-gram, and the statistics of
Kneser-Ney smoothing (continuations, discounts from counts of counts, back-off weights) are aggregates and joins of
these shards. Of the spelling only the finished probabilities of the n-grams seen, at most 64^4 numbers, are broadcast.
Of the words nothing is. The documents are written once, in blocks of neighbours, and stay there. Each block asks the
shards of words for the numbers of its distinct words, then the shards of bigrams for the counts of its distinct bigrams
of known words, handing in what its own trusted documents have of them; a shard adds up what the blocks hand in and
answers each block in the order in which it has asked. The shards of bigrams tell those of words what begins and ends
with a word, and these tell the blocks. Questions and answers are sorted, packed arrays, a row for each block and shard.

A trusted document is measured by what the others have: its own bigrams are taken off the counts, the continuations and
the discounts, so that the thresholds hold for text that the model has not seen.

A document's perplexity is exp of the mean negative log probability of its bytes, with spaces before the first and one
after the last. It is kept if that is at most its language's threshold, a quantile of the perplexities of the trusted
documents of the language (of all, for a language that has none).

Defined results: a null or empty text has one symbol, the closing space; documents of a null language are one language;
without trusted text every perplexity is the alphabet's size and everything is kept; repeated rows each get their row
and count as often as they come; input columns other than doc_id, text and lang are not read.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchledger.llm.common import once
from touchledger.plans.workspace import Workspace

ORDER, BITS = 4, 6
ALPHABET = 1 << BITS
#: Quantile of the trusted documents' perplexities that is still kept, and what the threshold is multiplied by.
QUANTILE, SLACK = 0.99, 1.05
LEAST_DISCOUNT = 0.1
#: Labels up to which a set of ids is broadcast; beyond, documents and labels are shuffled.
BROADCAST_ROWS = 2_000_000
#: Symbols that are counted at once.
_PORTION = 1 << 22
#: Bytes of text to a block of documents, and to a shard of words or bigrams, of which there are so many at least.
BLOCK, SHARD, LEAST_SHARDS = 24 << 20, 32 << 20, 8
#: Of a word: the bigrams that it begins; how many distinct ones of count one, two, and more; how many it ends.
STATISTICS = 5
#: What blocks and shards tell one another; ``numbers`` has counts of a shard as a whole.
MESSAGE = T.StructType([T.StructField("kind", T.StringType()), T.StructField("target", T.LongType()),
                        T.StructField("source", T.LongType()), T.StructField("data", T.BinaryType()),
                        T.StructField("numbers", T.ArrayType(T.LongType()))])
#: Words in UTF-8: letters and digits of scripts with spaces; else single characters.
_WORD = re.compile(rb"(?:[0-9A-Za-z_]|[\xc3-\xdf].|\xe0[\xa0-\xb7].|\xe1..|[\xea-\xed]..)+|"
                   rb"\xc2.|\xe0..|[\xe2-\xe9\xee\xef]..|[\xf0-\xf4]...|\S", re.DOTALL)
#: The same by bytes, for valid UTF-8: what a byte begins, or that it is inside a character.
_SPACE, _LETTER, _SINGLE, _INSIDE = range(4)
_KINDS = np.array([_SPACE if b in b" \t\n\r\v\f" else _INSIDE if 0x80 <= b < 0xC0 else
                   _LETTER if re.match(rb"[0-9A-Za-z_\xc3-\xe1\xea-\xed]", bytes([b])) else _SINGLE for b in range(256)], np.uint8)
#: The first bytes of eight.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Bytes of text that are divided into words at once.
_TOGETHER = 1 << 20


def alphabet(trusted: DataFrame) -> np.ndarray:
    """Symbol of each byte: its rank by frequency, the last symbol for all that are not among the first."""
    def count(batches):
        total = np.zeros(256, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += np.bincount(np.frombuffer(text.as_buffer() or b"", np.uint8), minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(range(256), pa.int32()), pa.array(total)], names=["byte", "n"])

    rows = (trusted.select(F.coalesce("text", F.lit("")).cast("binary").alias("text"))
            .mapInArrow(count, "byte int, n bigint").groupBy("byte").agg(F.sum("n").alias("n"))
            .where("n > 0").collect())
    symbols = np.full(256, ALPHABET - 1, np.uint8)
    # The space is always the first; it stands around every text.
    ranked = [32] + [r["byte"] for r in sorted(rows, key=lambda r: (-r["n"], r["byte"])) if r["byte"] != 32]
    symbols[ranked[:ALPHABET - 1]] = np.arange(len(ranked[:ALPHABET - 1]))
    return symbols


def codes(raw: bytes, symbols: np.ndarray) -> np.ndarray:
    """The n-grams of the highest order that end at each symbol of a text, and at the space after it."""
    s = np.zeros(len(raw) + ORDER, np.uint32)
    s[ORDER - 1:-1] = symbols[np.frombuffer(raw, np.uint8)]
    code = s[:len(raw) + 1].copy()
    for k in range(1, ORDER):
        code <<= np.uint32(BITS)
        code |= s[k:len(raw) + 1 + k]
    return code


def counts(trusted: DataFrame, symbols: np.ndarray) -> DataFrame:
    """(code, n): how often each n-gram of the highest order occurs in the trusted text."""
    def count(batches):
        total, waiting, size = np.zeros(ALPHABET ** ORDER, np.uint32), [], 0

        def add():
            for code in waiting:
                found, n = np.unique(code, return_counts=True)
                total[found] += n.astype(np.uint32)
            waiting.clear()

        for batch in batches:
            for text in batch.column(0):
                waiting.append(codes(memoryview(text.as_buffer()), symbols))
                size += len(waiting[-1])
                if size >= _PORTION:
                    waiting[:] = [np.concatenate(waiting)]
                    add()
                    size = 0
        if waiting:
            waiting[:] = [np.concatenate(waiting)]
            add()
        seen = np.flatnonzero(total)
        for at in range(0, len(seen), 1 << 16):
            some = seen[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())],
                                             names=["code", "n"])

    rows = trusted.select(F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(count, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))


def discounts(level: DataFrame) -> list[float]:
    """What is taken off counts of one, of two, and of three and more."""
    few = level.agg(*[F.sum((F.col("n") == k).cast("bigint")) for k in (1, 2, 3, 4)]).first()
    return _discounts(*(x or 0 for x in few))


def _discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """From how many counts are one, two, three and four."""
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.0
    # Never nothing: each context keeps a share for symbols that it has not had.
    return [max(LEAST_DISCOUNT, x) for x in (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 0.75,
                                             3 - 4 * y * n4 / n3 if n3 else 0.9)]


def smoothed(counted: DataFrame, workspace: Workspace) -> list[DataFrame]:
    """For each order from the lowest: (code, p, rest), where ``rest`` is the back-off weight of the n-gram's context.

    The highest order has counts, the lower ones have the number of symbols seen before an n-gram. Each shard of
    n-grams is joined with the totals of its contexts and with the probabilities of its endings.
    """
    levels = [workspace.settle(counted, f"counts-{ORDER}-{uuid.uuid4().hex}")]
    for order in range(ORDER - 1, 0, -1):
        ending = F.col("code").bitwiseAND(F.lit((1 << BITS * order) - 1))
        levels.append(levels[-1].groupBy(ending.alias("code")).agg(F.count(F.lit(1)).alias("n")))
    out: list[DataFrame] = []
    for order, level in enumerate(reversed(levels), 1):
        d = discounts(level)
        discount = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        level = level.withColumns({"context": F.shiftright("code", BITS), "d": F.least(discount, F.col("n").cast("double"))})
        context = level.groupBy("context").agg(F.sum("n").alias("total"), F.sum("d").alias("held"))
        joined = level.hint("merge").join(context.hint("merge"), "context").withColumn("rest", F.col("held") / F.col("total"))
        if out:
            lower = out[-1].select(F.col("code").alias("ending"), F.col("p").alias("below"))
            ending = F.col("code").bitwiseAND(F.lit((1 << BITS * (order - 1)) - 1))
            joined = joined.withColumn("ending", ending).hint("merge").join(lower.hint("merge"), "ending")
        else:
            joined = joined.withColumn("below", F.lit(1.0 / ALPHABET))
        p = (F.col("n") - F.col("d")) / F.col("total") + F.col("rest") * F.col("below")
        out.append(workspace.settle(joined.select("code", p.alias("p"), "rest"), f"level-{order}-{uuid.uuid4().hex}"))
    return out


class QualityModel:
    """Log probabilities of all n-grams of the highest order, from those of the n-grams seen at each order."""

    def __init__(self, key: str, symbols: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.key, self.symbols, self.levels = key, symbols, levels

    @classmethod
    def fit(cls, trusted: DataFrame, workspace: Workspace) -> QualityModel:
        symbols = alphabet(trusted)
        levels = []
        for level in smoothed(counts(trusted, symbols), workspace):
            found = level.toArrow()
            levels.append((found["code"].to_numpy().astype(np.uint32), found["p"].to_numpy().astype(np.float32),
                           found["rest"].to_numpy().astype(np.float32)))
        return cls(uuid.uuid4().hex, symbols, levels)

    def __hash__(self):
        return hash(self.key)

    def __eq__(self, other):
        return self.key == other.key

    def dense(self) -> np.ndarray:
        """An n-gram that was not seen has its context's back-off weight times its ending's probability."""
        table = np.full(1, 1.0 / ALPHABET, np.float32)
        for order, (code, p, rest) in enumerate(self.levels, 1):
            weights = np.ones(ALPHABET ** (order - 1), np.float32)
            weights[code >> np.uint32(BITS)] = rest
            if order == 1:
                table = np.full(ALPHABET, table[0], np.float32) * weights[0]
            else:
                table = (weights.reshape(ALPHABET, -1, 1) * table.reshape(1, -1, ALPHABET)).reshape(-1)
            table[code] = p
        return np.log(table, out=table)


def _dense(model: QualityModel) -> np.ndarray:
    return model.dense()


def perplexities(docs: DataFrame, model: QualityModel):
    """Column function: the perplexity of a text by its spelling alone."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def perplexity(texts: pd.Series) -> pd.Series:
        table, out = once(_dense, held.value), []
        for text in texts:
            logs = spelling((text or "").encode(), table, held.value.symbols)
            out.append(np.exp(-float(logs.sum(dtype=np.float64)) / len(logs)))
        return pd.Series(out, dtype=np.float64)
    return perplexity.asNondeterministic()


def spelling(raw: bytes, table: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Log probability of each byte of a text and of the space after it."""
    out = []
    # Parts of a long text overlap by a context.
    for at in range(0, len(raw) + 1, _PORTION):
        first = max(0, at - ORDER)
        code = codes(raw[first:at + _PORTION], symbols)[at - first:]
        out.append(table[code if at + _PORTION > len(raw) else code[:-1]])
    return np.concatenate(out)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of natural numbers by byte planes, compressed."""
    raw = []
    for a in arrays:
        planes = np.ascontiguousarray(a, "<u8").view(np.uint8).reshape(len(a), 8).T
        used = 8 - next((k for k in range(8) if planes[7 - k].any()), 8)
        raw += [np.array([len(a), used], "<u8").tobytes(), np.ascontiguousarray(planes[:used]).tobytes()]
    whole = b"".join(raw)
    return len(whole).to_bytes(8, "little") + pa.Codec("zstd", 5).compress(whole, asbytes=True)


def unpack(packed: bytes) -> list[np.ndarray]:
    raw = pa.Codec("zstd").decompress(packed[8:], int.from_bytes(packed[:8], "little"), asbytes=True)
    out, at = [], 0
    while at < len(raw):
        n, used = np.frombuffer(raw, "<u8", 2, at).tolist()
        planes = np.zeros((n, 8), np.uint8)
        planes[:, :used] = np.frombuffer(raw, np.uint8, n * used, at + 16).reshape(used, n).T
        out.append(planes.view("<u8").reshape(n))
        at += 16 + n * used
    return out


def _steps(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending.astype(np.uint64), prepend=np.uint64(0))


def _message(rows: list[tuple]) -> pa.Table:
    """Rows of (kind, target, source, arrays), and of counts, which are read as numbers."""
    names, kinds = zip(*((f.name, f.dataType) for f in MESSAGE.fields))
    types = dict(zip(names, (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))))
    full = [(kind, target, source, None, [int(x) for x in data]) if kind == "counts" else
            (kind, target, source, pack(*data), None) for kind, target, source, data in rows]
    return pa.table({n: pa.array([r[i] for r in full], types[n]) for i, n in enumerate(names)})


def dealt(rows: DataFrame) -> DataFrame:
    """The documents with the block that they are in: neighbours of a partition, up to ``BLOCK`` bytes of text."""
    def deal(batches):
        block, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            of = []
            for n in pc.binary_length(batch.column("text")).to_pylist():
                if size and size + n > BLOCK:
                    block, size = block + 1, 0
                of.append(block)
                size += n + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(of, pa.int64())], names=[*batch.schema.names, "block"])

    return rows.mapInArrow(deal, T.StructType([*rows.schema.fields, T.StructField("block", T.LongType())]))


def spans(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text begin and end."""
    try:
        raw.decode()
    except UnicodeDecodeError:
        found = np.array([m.span() for m in _WORD.finditer(raw)], np.int64).reshape(-1, 2)
        return found[:, 0], found[:, 1]
    data = np.frombuffer(raw, np.uint8)
    kind = _KINDS[data]
    some = np.flatnonzero(data == 0xE0)
    kind[some[data[some + 1] >= 0xB8]] = _SINGLE
    at = np.flatnonzero(kind != _INSIDE)
    kind = kind[at]
    letter = kind == _LETTER
    # A word ends at the next one or at white space.
    edge = ~letter
    edge[:1] = True
    edge[1:] |= ~letter[:-1]
    at, word = at[edge], kind[edge] != _SPACE
    return at[word], np.append(at[1:], len(raw))[word]


def _numbered(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, int]:
    """The number of each word, equal for equal words; and how many numbers there are."""
    padded, size = raw + bytes(8), ends - starts
    eight = np.ndarray(len(raw), "<u8", padded, strides=(1,))
    number, count = np.empty(len(starts), starts.dtype), 0
    # Words of up to 16 bytes are told apart by their first and last eight and their length.
    some = np.flatnonzero(size <= 8)
    number[some], found = pd.factorize(eight[starts[some]] & _FIRST[size[some]])
    count += len(found)
    some = np.flatnonzero((size > 8) & (size <= 16))
    head, tail = pd.factorize(eight[starts[some]]), pd.factorize(eight[ends[some] - 8])
    code, found = pd.factorize((head[0] * len(tail[1]) + tail[0]) * 8 + size[some] - 9)
    number[some] = code + count
    count += len(found)
    some, places = np.flatnonzero(size > 16), {}
    for i, a, b in zip(some.tolist(), starts[some].tolist(), ends[some].tolist()):
        number[i] = count + places.setdefault(raw[a:b], len(places))
    return number, count + len(places)


class Block:
    """The words and bigrams of a block's documents.

    ``keys`` are the hashes of its distinct words, rising, 0 for the place before a text; ``words`` and ``before`` are the
    places in them of each word and of the one before it, document after document, of which ``cuts`` are the ends.
    """

    def __init__(self, docs: pa.Table):
        self.texts = docs["text"].to_pylist()
        begins = np.cumsum([0, *(len(raw) + 1 for raw in self.texts)])
        raw = b"\n".join([*self.texts, b""])
        # As small as they can be: there are several of these numbers to a word of the block.
        kind = np.int32 if len(raw) < 1 << 31 else np.int64
        found, at = [(np.zeros(0, kind),) * 2], 0
        for i in range(len(self.texts)):
            if begins[i + 1] - begins[at] >= _TOGETHER or i + 1 == len(self.texts):
                try:
                    raw[begins[at]:begins[i + 1]].decode()
                    parts = [(begins[at], begins[i + 1])]
                except UnicodeDecodeError:
                    parts = [(a, b - 1) for a, b in zip(begins[at:i + 1], begins[at + 1:])]
                found += [tuple((x + a).astype(kind) for x in spans(raw[a:b])) for a, b in parts]
                at = i + 1
        starts, ends = (np.concatenate(x) for x in zip(*found))
        del found
        number, count = _numbered(raw, starts, ends)
        first = np.empty(count, np.int64)
        first[number[::-1]] = np.arange(len(number))[::-1]
        hashes = np.fromiter((xxhash.xxh64_intdigest(raw[a:b]) for a, b in zip(starts[first].tolist(), ends[first].tolist())),
                             np.uint64, count)
        self.keys, place = np.unique(np.append(hashes, np.uint64(0)), return_inverse=True)
        self.words, self.cuts = place.astype(kind)[number], np.searchsorted(starts, begins.astype(kind))
        #: Where the words begin in their documents.
        self.starts = starts - np.repeat(begins[:-1].astype(kind), np.diff(self.cuts))
        self.before = np.roll(self.words, 1)
        self.heads = self.cuts[:-1][np.diff(self.cuts) > 0]
        self.before[self.heads] = 0
        self.trusted = docs["trusted"].to_pylist()
        #: Of each word, whether its document is trusted.
        self.own = np.repeat(np.array(self.trusted, bool), np.diff(self.cuts))

    def word_counts(self) -> np.ndarray:
        """How often each word occurs in the block's trusted documents; the place before a text counts as one."""
        n = np.bincount(self.words[self.own], minlength=len(self.keys))
        n[0] += self.own[self.heads].sum()
        return n


class Asked:
    """What a block asks the shards for: its words, and its bigrams of known words, in the shards' order.

    A word's shard is a range of hashes. A known word has a number, its rank in its shard times the number of shards, plus
    that, plus one; frequent words have small ones. A bigram's shard is the sum of its numbers, so that the bigrams of one
    word are spread, modulo the number of shards; the quotient of the second number is what is left of it.
    """

    def __init__(self, block: Block, shards: int):
        self.block, self.shards = block, shards
        starts = np.array([(s << 64) // shards for s in range(shards)], np.uint64)
        self.cuts = np.append(np.searchsorted(block.keys, starts), len(block.keys))

    def words(self) -> list[tuple]:
        n = self.block.word_counts()
        return [(s, _steps(self.block.keys[a:b]), n[a:b])
                for s, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])) if b > a]

    def know(self, answers: dict[int, list[np.ndarray]]) -> None:
        """Takes the numbers of the words."""
        self.number = np.zeros(len(self.block.keys), np.int64)
        for s, (rank,) in answers.items():
            rank = rank.astype(np.int64)
            self.number[self.cuts[s]:self.cuts[s + 1]] = np.where(rank > 0, (rank - 1) * self.shards + s + 1, 0)
        if self.number.max() >> 32:
            raise ValueError("more than 2^32 words")
        #: The distinct bigrams of the block, first word times number of words plus second word, and which one is where.
        at, self.codes = pd.factorize(self.block.before.astype(np.int64) * len(self.block.keys) + self.block.words)
        self.at = at.astype(self.block.words.dtype)
        self.n = np.bincount(self.at[self.block.own], minlength=len(self.codes))
        first, second = (self.number[x] for x in np.divmod(self.codes, len(self.block.keys)))
        known = np.flatnonzero((first > 0) & (second > 0))
        first, second = first[known], second[known]
        shard, inner = (first + second) % self.shards, first.astype(np.uint64) << np.uint64(32) | (second // self.shards).astype(np.uint64)
        order = np.lexsort((inner, shard))
        #: Where the known bigrams are in ``codes``, in the order in which they are asked for.
        self.known, self.inner = known[order], inner[order]
        self.pair_cuts = np.searchsorted(shard[order], np.arange(self.shards + 1))

    def pairs(self) -> list[tuple]:
        n = self.n[self.known]
        return [(s, _steps(self.inner[a:b]), n[a:b])
                for s, (a, b) in enumerate(zip(self.pair_cuts, self.pair_cuts[1:])) if b > a]

    def pair_counts(self, answers: dict[int, list[np.ndarray]]) -> np.ndarray:
        """The count in all trusted text of each of ``codes``."""
        out = np.zeros(len(self.codes), np.int64)
        for s, (c2,) in answers.items():
            out[self.known[self.pair_cuts[s]:self.pair_cuts[s + 1]]] = c2
        return out

    def word_statistics(self, answers: dict[int, list[np.ndarray]]) -> np.ndarray:
        """For each word what ``STATISTICS`` names."""
        out = np.zeros((STATISTICS, len(self.number)), np.int64)
        for s, found in answers.items():
            at = self.cuts[s] + np.flatnonzero(self.number[self.cuts[s]:self.cuts[s + 1]])
            out[:, at] = np.array(found, np.int64)
        return out


def _answers(messages: pa.Table, kind: str, by: str = "source") -> dict[int, list[np.ndarray]]:
    return {m[by]: unpack(m["data"]) for m in messages.filter(pc.equal(messages["kind"], kind)).to_pylist()}


def _joined(messages: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """The distinct keys of a shard's messages, their counts added up, the place of each message's keys among them, and
    where each message's keys are."""
    parts = [unpack(m["data"]) for m in messages]
    ends = np.cumsum([0, *(len(p[0]) for p in parts)]).tolist()
    keys = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
    n = np.concatenate([p[1] for p in parts])
    # The parts are in order, which a stable sort makes use of.
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.append(True, keys[1:] != keys[:-1])
    at = np.empty(len(keys), np.int64)
    at[order] = np.cumsum(new) - 1
    every = keys[new]
    return (every, np.bincount(at, n, len(every)).astype(np.int64), at,
            [(m["source"], a, b) for m, a, b in zip(messages, ends, ends[1:])])


def _number_words(asked: pa.Table) -> pa.Table:
    """To each block the ranks of its words in a shard, by how often trusted text has them; 0 if it does not."""
    shard = asked["target"][0].as_py()
    every, n, at, parts = _joined(asked.to_pylist())
    known = np.flatnonzero(n)
    rank = np.zeros(len(every), np.int64)
    rank[known[np.argsort(-n[known], kind="stable")]] = np.arange(1, len(known) + 1)
    return _message([("words", block, shard, [rank[at[a:b]]]) for block, a, b in parts])


def _classes(n: np.ndarray) -> list[int]:
    """How many are one, two, three and four; how many are three and more; and their sum."""
    return [*(int((n == k).sum()) for k in (1, 2, 3, 4)), int((n > 2).sum()), int(n.sum())]


def _count_pairs(shards: int):
    def count(asked: pa.Table) -> pa.Table:
        """To each block the counts of its bigrams in a shard; to the words' shards what these say of their words."""
        shard = asked["target"][0].as_py()
        every, n, at, parts = _joined(asked.to_pylist())
        rows = [("pairs", block, shard, [n[at[a:b]]]) for block, a, b in parts]
        every, n = every[n > 0], n[n > 0]
        first = (every >> np.uint64(32)).astype(np.int64)
        second = (every & np.uint64((1 << 32) - 1)).astype(np.int64) * shards + (shard - first) % shards
        (firsts, f), (seconds, s) = (np.unique(x - 1, return_inverse=True) for x in (first, second))
        of = [np.bincount(f, x, len(firsts)).astype(np.int64) for x in (n, n == 1, n == 2, n > 2)]
        c1 = np.bincount(s, minlength=len(seconds))
        for k in range(shards):
            a, b = firsts % shards == k, seconds % shards == k
            if a.any() or b.any():
                rows.append(("statistics", k, shard, [_steps(firsts[a] // shards), *(x[a] for x in of), _steps(seconds[b] // shards), c1[b]]))
        return _message([*rows, ("counts", None, shard, _classes(n))])
    return count


def _add_statistics(messages: pa.Table) -> pa.Table:
    """To each block the statistics of its known words in a shard."""
    shard = messages["shard"][0].as_py()
    blocks = _answers(messages, "words", "target")
    size = max((int(rank.max(initial=0)) for rank, in blocks.values()), default=0)
    total = np.zeros((STATISTICS, size), np.int64)
    for first, *of, second, c1 in _answers(messages, "statistics").values():
        total[:-1, np.cumsum(first, dtype=np.int64)] += np.array(of, np.int64)
        total[-1, np.cumsum(second, dtype=np.int64)] += c1.astype(np.int64)
    rows = [("answers", block, shard, total[:, rank[rank > 0].astype(np.int64) - 1]) for block, (rank,) in blocks.items()]
    return _message([*rows, ("counts", None, shard, _classes(total[-1]))])


def _taken(n: np.ndarray, d: list[float]) -> np.ndarray:
    """The discount of each count."""
    return np.minimum(np.array([0.0, *d])[np.minimum(n, 3).astype(np.int64)], n)


def log_probability(first, second, n, spelt, trusted, c2, total, held, c1, of, rest, d2, d1) -> float:
    """Of a document, from its bigrams, their counts (c2), the counts and discounts of their first words (total, held)
    and the continuations of their second words (c1), as well as the number of continuations and their discounts.

    A trusted document's own bigrams are taken off first.
    """
    if trusted:
        left = c2 - n
        which, at = np.unique(first, return_inverse=True)
        total = total - np.bincount(at, n, len(which))[at]
        held = held - np.bincount(at, _taken(c2, d2) - _taken(left, d2), len(which))[at]
        which, begin, at = np.unique(second, return_index=True, return_inverse=True)
        lost = np.bincount(at, left == 0, len(which))
        remaining = np.rint(c1[begin] - lost)
        of, rest = of - lost.sum(), rest - (_taken(c1[begin], d1) - _taken(remaining, d1)).sum()
        c2, c1 = left, remaining[at]
    below = np.exp(np.maximum(spelt / n, -700.0))
    if of > 0:
        below = (c1 - _taken(c1, d1)) / of + rest / of * below
    seen = total > 0.5
    among_all = np.where(seen, total, 1.0)
    p = np.where(seen, (c2 - _taken(c2, d2)) / among_all + held / among_all * below, below)
    return float((n * np.log(p)).sum())


def measure(rows: DataFrame, model: QualityModel, workspace: Workspace) -> DataFrame:
    """(doc_id, lang, trusted, perplexity) of documents with ``trusted``, 1 or 0, and ``text`` in UTF-8."""
    spark, run = rows.sparkSession, uuid.uuid4().hex
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(LEAST_SHARDS, size // SHARD)
    # Written once, block by block, so that no later step moves the texts again.
    buckets, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"quality_blocks_{run}"
    (dealt(rows).write.format("parquet").option("path", f"{workspace.root}/blocks-{run}").option("compression", "zstd")
     .option("parquet.compression.codec.zstd.level", "9").option("parquet.page.size", str(8 << 20)).bucketBy(buckets, "block").saveAsTable(name))
    blocks = spark.table(name)

    def settle(df: DataFrame, what: str) -> DataFrame:
        return workspace.settle(df, f"{what}-{run}")

    def by_shard(messages: DataFrame, shard: str = "target"):
        return messages.repartition(shards, shard).groupBy(shard)

    def with_answers(run, answers: DataFrame, schema) -> DataFrame:
        # The blocks stay where they are: the answers are dealt as the blocks' table is.
        return blocks.groupBy("block").cogroup(answers.withColumnRenamed("target", "block").groupBy("block")).applyInArrow(run, schema)

    def counts(messages: DataFrame) -> list[int]:
        found = messages.where("kind = 'counts'").agg(*[F.sum(F.col("numbers")[i]) for i in range(6)]).first()
        return [x or 0 for x in found]

    def ask_words(docs: pa.Table) -> pa.Table:
        block = docs["block"][0].as_py()
        return _message([("ask", s, block, data) for s, *data in Asked(Block(docs), shards).words()])

    def ask_pairs(docs: pa.Table, answers: pa.Table) -> pa.Table:
        asked = Asked(Block(docs), shards)
        asked.know(_answers(answers, "words"))
        block = docs["block"][0].as_py()
        return _message([("ask", s, block, data) for s, *data in asked.pairs()])

    words = settle(by_shard(blocks.groupBy("block").applyInArrow(ask_words, MESSAGE)).applyInArrow(_number_words, MESSAGE), "words")
    pairs = settle(by_shard(with_answers(ask_pairs, words, MESSAGE)).applyInArrow(_count_pairs(shards), MESSAGE), "pairs")
    to_words = words.withColumn("shard", F.col("source")).unionByName(
        pairs.where("kind = 'statistics'").withColumn("shard", F.col("target")))
    statistics = settle(by_shard(to_words, "shard").applyInArrow(_add_statistics, MESSAGE), "statistics")

    n1, n2, n3, n4, _, _ = counts(pairs)
    d2 = _discounts(n1, n2, n3, n4)
    n1, n2, n3, n4, more, of = counts(statistics)
    d1 = _discounts(n1, n2, n3, n4)
    rest = float(_taken(np.arange(1, 4), d1) @ [n1, n2, more])
    held = spark.sparkContext.broadcast(model)

    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        table, symbols = once(_dense, held.value), held.value.symbols
        block = Block(docs)
        asked = Asked(block, shards)
        asked.know(_answers(answers, "words"))
        c2 = asked.pair_counts(_answers(answers, "pairs"))
        total, *classes, c1 = asked.word_statistics(_answers(answers, "answers")).astype(np.float64)
        kept = _taken(np.arange(1, 4), d2) @ classes
        out = []
        for raw, trusted, a, b in zip(block.texts, block.trusted, block.cuts, block.cuts[1:]):
            logs = spelling(raw, table, symbols).astype(np.float64)
            log = float(logs.sum())
            if b > a:
                starts = block.starts[a:b].copy()
                starts[0] = 0
                found, at, n = np.unique(asked.at[a:b], return_inverse=True, return_counts=True)
                spelt = np.bincount(at, np.add.reduceat(logs, starts))
                first, second = np.divmod(asked.codes[found], len(block.keys))
                log = log_probability(first, second, n, spelt, trusted, c2[found], total[first], kept[first], c1[second],
                                      of, rest, d2, d1)
            out.append(np.exp(-log / len(logs)))
        return docs.select(["doc_id", "lang", "trusted"]).append_column("perplexity", pa.array(out, pa.float64()))

    result = T.StructType([*(rows.schema[n] for n in ("doc_id", "lang", "trusted")), T.StructField("perplexity", T.DoubleType())])
    answers = (words.unionByName(pairs.where("kind = 'pairs'")).unionByName(statistics.where("kind = 'answers'")))
    measured = settle(with_answers(score, answers, result), "perplexity")
    spark.sql(f"DROP TABLE {name}")
    return measured


def among(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose doc_id is in a table of distinct ids; broadcast if that is small."""
    small = ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(ids) if small else ids.hint("merge"), "doc_id", "left_semi")


def judge(docs: DataFrame, trusted_ids: DataFrame, quantile: float = QUANTILE, slack: float = SLACK,
          workspace: Workspace | None = None) -> DataFrame:
    """(doc_id, lang, perplexity, threshold, kept) for every document; the model learns from those with these ids."""
    workspace = workspace or Workspace(docs.sparkSession)
    ids = trusted_ids.select("doc_id").where("doc_id is not null").distinct()
    rows = docs.select("doc_id", "lang", "text")
    trusted = among(rows, ids)
    model = QualityModel.fit(trusted, workspace)
    flags = ids.select(F.col("doc_id").alias("_id"), F.lit(1).cast("bigint").alias("trusted"))
    small = ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    flagged = (rows.join(F.broadcast(flags) if small else flags.hint("merge"), F.col("doc_id") == F.col("_id"), "left")
               .select("doc_id", "lang", F.coalesce("trusted", F.lit(0).cast("bigint")).alias("trusted"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("text")))
    measured = measure(flagged, model, workspace)
    known = measured.where("trusted = 1")
    limit = (F.percentile_approx("perplexity", quantile, 10_000) * slack)
    by_language = known.groupBy(F.col("lang").alias("_lang")).agg(limit.alias("own"))
    every = known.agg(limit).first()[0]
    # A row per language: far fewer than documents; joined by sort-merge, so nothing depends on how few.
    named = measured.join(by_language.hint("merge"), F.col("lang").eqNullSafe(F.col("_lang")), "left")
    threshold = F.coalesce("own", F.lit(every if every is not None else float("inf")).cast("double"))
    return named.select("doc_id", "lang", "perplexity", threshold.alias("threshold"),
                        (F.col("perplexity") <= threshold).alias("kept"))

"""Phrase collocations: frequent phrases by mergeable Misra-Gries summaries, then exact counts, then scores.

First pass. Every task hashes the phrases of up to five words of its texts to cells and hands over, for each hash
partition, a summary: sorted cells, their counts, and the error so far. A partition's task merges its summaries; when
the counters pass the capacity, all of them are lowered by the first one that has to go and what is left of none is
dropped. The capacity exceeds the mass (occurrences of phrases) divided by the threshold, so what has been taken off any
counter stays below the threshold: every cell whose counter and error reach it survives, and with it every frequent
phrase. Should the mass be dealt unevenly, a summary rather grows beyond its capacity than let its error reach the
threshold.

Second pass. Survivors mark bits of a filter of bounded size. Tasks count the phrases that pass it, by their words and
not by their hashes, and hand the counts over by hash partition again, where those of survivors' cells are added up and
what stays below the threshold goes. So hashes that coincide cost time alone. Parts of a frequent phrase are frequent
themselves, hence all counts that a score needs are there.

Defined results: a null language counts as ``und``, a null text as empty; only A-Z are lower-cased; texts, pieces
and words may have any length; repeated rows count each; a table without rows or without frequent phrases gives no
rows; columns of the input other than text and lang are not read.
"""

from __future__ import annotations

import itertools
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchledger.plans.workspace import Workspace

#: Occurrences that make a phrase a candidate, words of the longest one, rows of the result for each language, and
#: per cent of a phrase's occurrences that a longer one around it needs for the phrase to be dropped.
THRESHOLD, LONGEST, FIRST, SHARE = 100, 5, 2000, 100
#: Bound of the phrases' mass that one hash partition is made for; how far its capacity exceeds mass / threshold.
PARTITION_MASS, SPARE = 1 << 26, 4
#: Words that a task hashes at once; cells of its summaries before they are handed over.
BLOCK, HELD = 1 << 19, 1 << 22
#: Rows of exact counts that a task collects before it adds up those of one phrase.
COUNTED = 1 << 19
#: Bits of the survivors' filter: for each survivor, at least and at most (128 MB).
FILTER_EACH, FILTER_LEAST, FILTER_MOST = 64, 1 << 23, 1 << 30
#: Languages whose totals are broadcast; more are joined by a shuffle.
LANGUAGES = 10_000
#: Words whose numbers a task remembers; bytes of a text that it cuts into words at once.
VOCABULARY, PORTION = 1 << 20, 1 << 21

#: The end of a piece, as one byte for all separators, and A-Z to lower case.
END = b"."
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans(bytes(range(65, 91)) + SEPARATORS, bytes(range(97, 123)) + END * len(SEPARATORS))
_GAP = re.compile(rb"[ \t.]")
_ODD, _MORE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class Words:
    """Numbers of words, by language, with their hashes; 0 ends a piece."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.list, self.langs, self._next = [b""], [], itertools.count(1)
        self._known: dict[str, defaultdict] = {}
        self._fresh: list[tuple[int, int]] = []  # numbers from where on, and which language
        self.hashes, self.lang = np.zeros(1, np.uint64), np.zeros(1, np.int64)

    def numbers(self, lang: str, raw: bytes) -> np.ndarray:
        known = self._known.get(lang)
        if known is None:
            known = self._known[lang] = defaultdict(self._next.__next__)
            known[END] = 0
            self.langs.append(lang)
        words, begin = raw.replace(END, b" . ").split(), len(self.list)
        out = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        fresh = np.flatnonzero(out >= begin)
        if len(fresh):
            _, first = np.unique(out[fresh], return_index=True)
            self.list += [words[k] for k in fresh[first]]
            self._fresh.append((begin, self.langs.index(lang)))
        return out

    def settle(self) -> None:
        """Hashes and languages of the words that have come since."""
        ends = [b for b, _ in self._fresh[1:]] + [len(self.list)]
        hashes, langs = [self.hashes], [self.lang]
        for (begin, lang), end in zip(self._fresh, ends):
            seed = xxhash.xxh64_intdigest(self.langs[lang])
            hashes.append(np.array([xxhash.xxh64_intdigest(w, seed) for w in self.list[begin:end]], np.uint64))
            langs.append(np.full(end - begin, lang))
        self.hashes, self.lang, self._fresh = np.concatenate(hashes), np.concatenate(langs), []


def blocks(batches, words: Words, longest: int) -> Iterator[tuple[np.ndarray, int, bool]]:
    """Numbers of the words of (lang, text) batches, in blocks; how many at a block's head belong to the last one; and
    whether the numbers end their meaning with this block, which the very last one does.

    A text that goes over several blocks leaves its last words to the next one, so no phrase is cut.
    """
    nothing = np.zeros(0, np.int64)
    held, size, carry = [], 0, nothing

    def block(ends: bool):
        words.settle()
        return np.concatenate([carry, *held]), len(carry), ends

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            text = text.as_py()
            for part in _portions(text.encode().translate(_FOLD) + END) if text else ():
                held.append(words.numbers(lang.as_py(), part))
                size += len(held[-1])
                if size >= BLOCK:
                    yield (last := block(False))
                    carry, held, size = last[0][len(last[0]) - longest + 1:], [], 0
            if len(words.list) > VOCABULARY:
                yield block(True)
                words.clear()
                carry, held, size = nothing, [], 0
    yield block(True)


def _portions(raw: bytes) -> Iterator[bytes]:
    """A text in parts that end with a word."""
    start = 0
    while start < len(raw):
        gap = _GAP.search(raw, start + PORTION)
        end = gap.start() if gap else len(raw)
        yield raw[start:end]
        start = end


def phrase_hashes(numbers: np.ndarray, hashes: np.ndarray, carry: int, longest: int):
    """For each length: positions of the block's phrases that end beyond the carried words, and their hashes."""
    own, previous = hashes[numbers], None
    real = numbers > 0
    for size in range(1, longest + 1):
        if size == 1:
            previous, valid = own, real
        else:
            previous = previous[:-1] * _ODD + own[size - 1:]
            previous ^= previous >> np.uint64(32)
            previous = previous * _MORE
            valid = valid[:-1] & real[size - 1:]
        if not len(previous):
            return
        begin = max(carry - size + 1, 0)
        at = np.flatnonzero(valid[begin:]) + begin
        h = previous[at]
        yield size, at, h ^ (h >> np.uint64(29))


class Cells:
    """How hashes are dealt to partitions and cells, and cells to the bits of the filter."""

    def __init__(self, partitions: int, per_partition: int):
        self.partitions, self.per_partition = partitions, per_partition

    def of(self, h: np.ndarray) -> np.ndarray:
        """Partition and cell in one number, which sorts by partition."""
        part = (h >> np.uint64(40)) % np.uint64(self.partitions)
        return part << np.uint64(32) | (h & np.uint64(self.per_partition - 1))

    def bit(self, codes: np.ndarray, slice_bits: int) -> np.ndarray:
        return (codes >> np.uint64(32)) * np.uint64(slice_bits) + (codes & np.uint64(slice_bits - 1))


class Summary:
    """A Misra-Gries summary: cells in order, their counters, and what has been taken off any of them at most."""

    def __init__(self, cells: np.ndarray, counters: np.ndarray, error: int = 0):
        self.cells, self.counters, self.error = cells, counters, error

    @classmethod
    def merged(cls, parts: list[Summary]) -> Summary:
        cells = np.concatenate([p.cells for p in parts])
        order = np.argsort(cells, kind="stable")
        cells, counters = cells[order], np.concatenate([p.counters for p in parts])[order]
        first = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]]) if len(cells) else np.zeros(0, np.int64)
        sums = np.add.reduceat(counters, first) if len(first) else counters
        return cls(cells[first], sums, sum(p.error for p in parts))

    def cut(self, capacity: int, threshold: int) -> Summary:
        """At most ``capacity`` counters, unless the error would reach the threshold."""
        if len(self.cells) <= capacity:
            return self
        off = int(np.partition(self.counters, -capacity - 1)[-capacity - 1])
        off = min(off, threshold - 1 - self.error)
        if off <= 0:
            return self
        stay = self.counters > off
        return Summary(self.cells[stay], self.counters[stay] - off, self.error + off)

    def survivors(self, threshold: int) -> np.ndarray:
        return self.cells[self.counters + self.error >= threshold]

    def pack(self) -> bytes:
        """Differences of the cells and counters, byte plane by byte plane, compressed."""
        planes = (np.diff(self.cells, prepend=np.uint32(0)).astype("<u4"), self.counters.astype("<i8"))
        raw = b"".join(np.ascontiguousarray(p.view(np.uint8).reshape(len(p), p.itemsize).T).tobytes() for p in planes)
        head = np.array([len(self.cells), self.error], "<i8").tobytes()
        return head + _codec().compress(raw, asbytes=True)

    @classmethod
    def unpack(cls, packed: bytes) -> Summary:
        n, error = np.frombuffer(packed[:16], "<i8").tolist()
        if not n:
            return cls(np.zeros(0, np.uint32), np.zeros(0, np.int64), error)
        raw = np.frombuffer(_codec().decompress(packed[16:], 12 * n, asbytes=True), np.uint8)
        cells = np.ascontiguousarray(raw[:4 * n].reshape(4, n).T).view("<u4").reshape(n)
        counters = np.ascontiguousarray(raw[4 * n:].reshape(8, n).T).view("<i8").reshape(n)
        return cls(np.cumsum(cells, dtype=np.uint32), counters, error)


def _codec() -> pa.Codec:
    return pa.Codec("zstd", 1)


def summaries(texts: DataFrame, cells: Cells, longest: int) -> DataFrame:
    """A row (part, summary) for each hash partition and each time a task hands over what it has."""
    def run(batches):
        words, held, size = Words(), [], 0
        for numbers, carry, _ in blocks(batches, words, longest):
            for _, _, h in phrase_hashes(numbers, words.hashes, carry, longest):
                held.append(cells.of(h))
                size += len(h)
            if size >= HELD:
                yield from handed(held)
                held, size = [], 0
        if size:
            yield from handed(held)

    def handed(held):
        codes = np.sort(np.concatenate(held))
        first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        counts, codes = np.diff(np.r_[first, len(codes)]), codes[first]
        at = np.searchsorted(codes, np.arange(cells.partitions + 1, dtype=np.uint64) << np.uint64(32))
        for begin in range(0, cells.partitions, 256):
            parts = [p for p in range(begin, min(begin + 256, cells.partitions)) if at[p] < at[p + 1]]
            packed = [Summary(codes[at[p]:at[p + 1]].astype(np.uint32), counts[at[p]:at[p + 1]]).pack() for p in parts]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(packed, pa.binary())],
                                             names=["part", "summary"])

    return texts.mapInArrow(run, "part int, summary binary")


def survivors(handed: DataFrame, partitions: int, capacity: int, threshold: int) -> DataFrame:
    """A row (part, n, error, summary) for each hash partition: the cells that may hold a frequent phrase."""
    room = max(capacity, 1 << 16)

    def run(batches):
        states: dict[int, list[Summary]] = defaultdict(list)
        sizes: dict[int, int] = defaultdict(int)
        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                states[part].append(Summary.unpack(packed.as_py()))
                sizes[part] += len(states[part][-1].cells)
                if sizes[part] > 2 * room:
                    states[part] = [Summary.merged(states[part]).cut(capacity, threshold)]
                    # what one merge cannot bring below the capacity must grow by a share before the next one
                    sizes[part] = max(0, len(states[part][0].cells) - room)
        for part, state in sorted(states.items()):
            whole = Summary.merged(state).cut(capacity, threshold)
            left = whole.survivors(threshold)
            packed = Summary(left, np.ones(len(left), np.int64)).pack()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([len(left)], pa.int64()), pa.array([whole.error], pa.int64()),
                 pa.array([packed], pa.binary())], names=["part", "n", "error", "summary"])

    return (handed.repartitionById(partitions, F.col("part"))
            .mapInArrow(run, "part int, n bigint, error bigint, summary binary"))


def filter_of(found: DataFrame, cells: Cells) -> tuple[int, bytes]:
    """Bits of each partition's slice, and the slices of all partitions one after the other.

    The driver gets the bits alone, whose number is bounded; partitions set those of their survivors in tasks.
    """
    total = found.agg(F.sum("n")).first()[0] or 0
    wanted = min(max(total * FILTER_EACH, FILTER_LEAST), FILTER_MOST) // cells.partitions
    slice_bits = min(max(8, 1 << max(wanted, 1).bit_length() - 1), cells.per_partition)

    def run(batches):
        for batch in batches:
            slices = []
            for packed in batch.column(1):
                marked = np.zeros(slice_bits, bool)
                marked[Summary.unpack(packed.as_py()).cells & np.uint32(slice_bits - 1)] = True
                slices.append(np.packbits(marked, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(slices, pa.binary())], names=["part", "bits"])

    bits = bytearray(cells.partitions * slice_bits // 8)
    for r in found.select("part", "summary").mapInArrow(run, "part int, bits binary").toLocalIterator():
        at = r["part"] * slice_bits // 8
        bits[at:at + slice_bits // 8] = r["bits"]
    return slice_bits, bytes(bits)


class Counts:
    """Exact counts of phrases of one length: their hashes, their words' numbers, and how often each occurs."""

    def __init__(self, size: int):
        self.size, self.parts, self.rows = size, [], 0

    def add(self, hashes: np.ndarray, phrases: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append(self._merged(hashes, phrases, counts))
        self.rows += len(self.parts[-1][0])
        if len(self.parts) > 1 and self.rows > 2 * len(self.parts[0][0]) + COUNTED:
            self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(self.parts) != 1:
            none = (np.zeros(0, np.uint64), np.zeros((0, self.size), np.int64), np.zeros(0, np.int64))
            self.parts = [self._merged(*map(np.concatenate, zip(*(self.parts or [none]))))]
        self.rows = len(self.parts[0][0])
        return self.parts[0]

    @staticmethod
    def _merged(hashes, phrases, counts):
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if not np.array_equal(phrases[first][which], phrases):  # two phrases have one hash
            phrases, first, which = np.unique(phrases, axis=0, return_index=True, return_inverse=True)
            return hashes[first], phrases, np.bincount(which.ravel(), counts).astype(np.int64)
        return distinct, phrases[first], np.bincount(which, counts, minlength=len(first)).astype(np.int64)


def counted(texts: DataFrame, cells: Cells, filtered: tuple[int, bytes], longest: int) -> DataFrame:
    """Rows (part, lang, cells, phrases, counts): what a task has counted of the phrases that pass the filter.

    The words of a language are counted under the empty phrase, in a partition by the language's hash.
    """
    slice_bits, shared = filtered[0], texts.sparkSession.sparkContext.broadcast(filtered[1])

    def run(batches):
        bits, words = np.frombuffer(shared.value, np.uint8), Words()
        counts, of_lang = [Counts(size) for size in range(1, longest + 1)], Counter()
        for numbers, carry, ends in blocks(batches, words, longest):
            for size, at, h in phrase_hashes(numbers, words.hashes, carry, longest):
                if size == 1:
                    for lang, n in enumerate(np.bincount(words.lang[numbers[at]]).tolist()):
                        of_lang[words.langs[lang]] += n
                bit = cells.bit(cells.of(h), slice_bits)
                hit = (bits[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                if hit.any():
                    at, h = at[hit], h[hit]
                    counts[size - 1].add(h, numbers[at[:, None] + np.arange(size)], np.ones(len(at), np.int64))
            if ends or sum(c.rows for c in counts) > HELD:
                for c in counts:
                    yield from handed(words, *c.settle())
                    c.parts, c.rows = [], 0
        for lang, n in of_lang.items():
            yield batch_of([(xxhash.xxh64_intdigest(lang) % cells.partitions, lang, [0], [""], [n])])

    def handed(words, hashes, phrases, counts):
        codes, langs = cells.of(hashes), words.lang[phrases[:, 0]] if len(phrases) else np.zeros(0, np.int64)
        order = np.lexsort((codes, langs, codes >> np.uint64(32)))
        codes, langs, phrases, counts = codes[order], langs[order], phrases[order], counts[order]
        parts = (codes >> np.uint64(32)).astype(np.int64)
        cuts = np.flatnonzero(np.r_[True, (parts[1:] != parts[:-1]) | (langs[1:] != langs[:-1])]) if len(codes) else codes
        out, size = [], 0
        for a, b in zip(cuts.tolist(), [*cuts.tolist()[1:], len(codes)]):
            texts = [b" ".join([words.list[k] for k in p]).decode() for p in phrases[a:b].tolist()]
            out.append((int(parts[a]), words.langs[langs[a]], codes[a:b].astype(np.uint32), texts, counts[a:b]))
            size += b - a
            if size > 1 << 14:
                yield batch_of(out)
                out, size = [], 0
        if out:
            yield batch_of(out)

    def batch_of(rows):
        kinds = (pa.int32(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                          names=["part", "lang", "cells", "phrases", "counts"])

    return texts.mapInArrow(run, "part int, lang string, cells array<bigint>, phrases array<string>, counts array<bigint>")


def exact_counts(handed: DataFrame, found: DataFrame, partitions: int, threshold: int) -> DataFrame:
    """lang, phrase, its number of words and its count, for all that occur often enough; and all words, as size 0.

    A partition's task gets the survivors first and adds up the counts of their cells alone, so it holds no more
    phrases than the capacity allows, however full the filter may be.
    """
    survivors = found.select("part", F.col("summary").alias("survivors"), *[F.lit(None).cast(t).alias(c) for c, t in handed.dtypes[1:]])
    both = survivors.unionByName(handed.withColumn("survivors", F.lit(None).cast("binary")))

    def run(batches):
        known, sums, now = set(), Counter(), None
        for batch in batches:
            for part, packed, lang, at, phrases, counts in zip(*(batch.column(c) for c in range(6))):
                if part.as_py() != now:
                    yield from frequent(sums)
                    known, sums, now = set(), Counter(), part.as_py()
                if packed.is_valid:
                    known = set(Summary.unpack(packed.as_py()).cells.tolist())
                    continue
                lang = lang.as_py()
                for cell, phrase, n in zip(at.as_py(), phrases.as_py(), counts.as_py()):
                    if cell in known or not phrase:
                        sums[lang, phrase] += n
        yield from frequent(sums)

    def frequent(sums):
        rows = [(lang, p, p.count(" ") + 1 if p else 0, n) for (lang, p), n in sums.items() if n >= threshold or not p]
        for at in range(0, len(rows), 1 << 13):
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at:at + (1 << 13)]), kinds)],
                                             names=["lang", "phrase", "size", "n"])

    placed = both.repartitionById(partitions, F.col("part")).sortWithinPartitions("part", F.col("survivors").isNull())
    return placed.mapInArrow(run, "lang string, phrase string, size int, n bigint")


def phrase_counts(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST,
                  partition_mass: int = PARTITION_MASS, workspace: Workspace | None = None) -> DataFrame:
    """(lang, phrase, size, n) of all phrases of up to ``longest`` words that occur ``threshold`` times in a language.

    Rows of size 0 with an empty phrase hold the words of each language. Both the mass and the capacity come from the
    bytes of the texts: a word and its gap are two at least.
    """
    spark = docs.sparkSession
    workspace, run = workspace or Workspace(spark), uuid.uuid4().hex
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    mass = longest * (docs.agg(F.sum(F.octet_length("text").cast("bigint") + 1)).first()[0] or 0) // 2
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-mass // partition_mass))
    share = -(-mass // partitions)
    cells = Cells(partitions, 1 << min(max((4 * share).bit_length(), 16), 32))
    capacity = SPARE * (share // threshold + 1)
    found = workspace.settle(
        survivors(summaries(texts, cells, longest), partitions, capacity, threshold), f"survivors-{run}")
    handed = counted(texts, cells, filter_of(found, cells), longest)
    return workspace.settle(exact_counts(handed, found, partitions, threshold), f"phrases-{run}")


def scores(counts: DataFrame) -> DataFrame:
    """Candidates with a, l, r, n and score at their lowest-scoring cut, by equality joins on the parts of each cut."""
    words = F.split("phrase", " ")
    cuts = (counts.where("size > 1")
            .select("lang", "phrase", F.col("n").alias("a"), words.alias("w"),
                    F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
            .select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
                    F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("rest")))
    part = counts.where("size > 0")
    left = part.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = part.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    totals = counts.where("size = 0").select("lang", "n")
    if totals.limit(LANGUAGES + 1).count() <= LANGUAGES:
        totals = F.broadcast(totals)
    joined = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    # decimals of 38 digits: the products of two counts may pass 64 bits
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "n")}
    ratio = F.call_function("div", wide["a"] * wide["n"] * F.lit(1000), wide["l"] * wide["r"])
    best = F.min(F.struct(ratio.alias("score"), "k", "l", "r", "a", "n"))
    return joined.groupBy("lang", "phrase").agg(best.alias("best")).select(
        "lang", "phrase", *[F.col(f"best.{c}") for c in ("a", "l", "r", "n", "score")])


def covered(counts: DataFrame, share: int) -> DataFrame:
    """Candidates that lie in a longer one with ``share`` per cent of their occurrences.

    A phrase between the two occurs at least as often as the longer, so it is enough to look one word further.
    """
    longer = counts.where("size > 2").withColumn("w", F.split("phrase", " "))
    inner = longer.select("lang", F.col("n").alias("longer"), F.explode(F.array(
        F.array_join(F.slice("w", F.lit(1), F.size("w") - 1), " "),
        F.array_join(F.slice("w", F.lit(2), F.size("w") - 1), " "))).alias("phrase"))
    most = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    here = counts.where("size > 1").select("lang", "phrase", "n")
    return here.join(most, ["lang", "phrase"]).where(F.col("longer") * 100 >= F.col("n") * share).select("lang", "phrase")


def ranked(rows: DataFrame, first: int, order: list[Column]) -> DataFrame:
    """Each language's first rows; parts of a language are cut to that many before they meet."""
    from pyspark.sql import Window

    salt = F.pmod(F.xxhash64("phrase"), F.lit(64))
    own = F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))
    some = rows.withColumn("_salt", salt).withColumn("_rank", own).where(F.col("_rank") <= first)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return some.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= first).drop("_salt", "_rank")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, first: int = FIRST,
                 share: int = SHARE, partition_mass: int = PARTITION_MASS,
                 workspace: Workspace | None = None) -> DataFrame:
    """Each language's first phrases: lang, rank, phrase, a, l, r, n, score."""
    counts = phrase_counts(docs, threshold, longest, partition_mass, workspace)
    left = scores(counts).join(covered(counts, share), ["lang", "phrase"], "left_anti")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    return ranked(left, first, order).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

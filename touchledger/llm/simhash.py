"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint of 64 bits is cut into three segments of 23, 23 and 18 bits. If two fingerprints differ in at most four
bits, then one of the first two segments differs in at most one bit or the third is equal (otherwise they would differ
in 2 + 2 + 1 bits). So each fingerprint is indexed under the 23 one-wildcard variants of each of the first two segments
and under its third: 47 keys. Two fingerprints that agree in a key are compared; a pair is reported at its first common
key alone. Only distinct fingerprints are indexed, each with a representative, so copies make no pairs.

Groups are the connected components of the links, found by alternating star contractions on the cluster.

Defined results: a text without words has fingerprint zero and is linked like any other; null ids are allowed and are
never the smallest of a group that has an id (a group of null ids alone has none); repeated rows each get their row;
columns of the input other than doc_id and text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchledger.llm.common import LOWER
from touchledger.plans.workspace import Workspace

SHINGLE = 4
MAX_DISTANCE = 4
SEED = 42
#: Offset and length of the segments with one wildcard, and of the exact one.
WILD, EXACT = ((0, 23), (23, 23)), (46, 18)
_SPACES = bytes(32 if b == 32 or 9 <= b <= 13 else LOWER[b] for b in range(256))
#: Shingles whose bits are counted at once; bounds the memory that a long text takes.
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode().translate(_SPACES).split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-shingle]]).tolist()
    stops = (ends[shingle - 1:] - 1).tolist()
    ones, n = np.zeros(64, np.int64), len(starts)
    for at in range(0, n, _BLOCK):
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[at:at + _BLOCK], stops[at:at + _BLOCK])),
                             "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint_of(shingle: int = SHINGLE):
    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))
    return of


def _segment(column: str, offset: int, length: int) -> str:
    return f"(shiftrightunsigned({column}, {offset}) & {(1 << length) - 1}L)"


def keys(column: str = "fp") -> str:
    """SQL for the 47 keys: number of the variant above bit 32, the bits that are left below."""
    out = []
    for offset, length in WILD:
        for bit in range(length):
            part = _segment(column, offset, length)
            low = f"({part} & {(1 << bit) - 1}L)"
            out.append(f"({len(out) << 32}L | shiftleft(shiftright({part}, {bit + 1}), {bit}) | {low})")
    out.append(f"({len(out) << 32}L | {_segment(column, *EXACT)})")
    return f"array({', '.join(out)})"


def _first_common_key() -> str:
    """SQL for the number of the first variant in which fingerprints a and b agree."""
    cases, n = [], 0
    for offset, length in WILD:
        d = f"({_segment('a.fp', offset, length)} ^ {_segment('b.fp', offset, length)})"
        cases.append(f"when {d} = 0 then {n}")
        cases.append(f"when bit_count({d}) = 1 then {n} + cast(round(log2({d})) as int)")
        n += length
    return f"case {' '.join(cases)} else {n} end"


def links(fingerprints: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Pairs a < b of distinct fingerprints that differ in at most max_distance bits, each once."""
    if not 0 <= max_distance <= MAX_DISTANCE:
        raise ValueError(f"these segments find up to {MAX_DISTANCE} differing bits, not {max_distance}")
    index = fingerprints.select("fp", F.explode(F.expr(keys())).alias("key"))
    same = F.expr(f"a.key = b.key and a.fp < b.fp and bit_count(a.fp ^ b.fp) <= {max_distance} "
                  f"and shiftright(a.key, 32) = {_first_common_key()}")
    return (index.alias("a").join(index.alias("b").hint("merge"), same)
            .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")))


def components(edges: DataFrame, workspace: Workspace) -> DataFrame:
    """(node, root) for every node with a link; alternating large-star and small-star contractions.

    A hub is no hot group: its neighbours are only reduced to their minimum, in the tasks first. The minima are written
    before they are joined back, so that both sides of the join come out of an exchange and Spark can split the hub's.
    """
    edges = workspace.settle(edges.select("a", "b"), f"links-{uuid.uuid4().hex}")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        least = workspace.settle(least, f"least-{uuid.uuid4().hex}")
        large = both.where("b > a").join(least.hint("merge"), "a").select(F.col("b").alias("u"), F.col("m").alias("v"))
        large = workspace.settle(large.where("u <> v").distinct(), f"large-{uuid.uuid4().hex}")
        # Every pair of large now leads from a node to a smaller one.
        low = workspace.settle(large.groupBy("u").agg(F.min("v").alias("m")), f"low-{uuid.uuid4().hex}")
        small = (large.join(low.hint("merge"), "u")
                 .select(F.explode(F.expr("array(struct(u as a, m as b), struct(v as a, m as b))")).alias("e"))
                 .select("e.a", "e.b").where("a <> b").distinct())
        edges = workspace.settle(small, f"stars-{uuid.uuid4().hex}")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE,
                    workspace: Workspace | None = None) -> DataFrame:
    """A row per document: doc_id, fp, component_id (the smallest doc_id reachable) and whether it stays.

    Of a component one document stays: that with the smallest id, of repeated ids that with the smallest text hash.
    ``text_hash`` tells documents with equal ids apart.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    rows = workspace.settle(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
                    fingerprint_of(shingle)(F.col("text")).alias("fp")), f"fingerprints-{uuid.uuid4().hex}")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")
    classes = workspace.settle(rows.groupBy("fp").agg(first), f"classes-{uuid.uuid4().hex}")
    stars = components(links(classes, max_distance), workspace)
    rooted = classes.join(stars.hint("merge"), F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    # written, so that both sides of the join come out of an exchange and Spark can split a large component
    rooted = workspace.settle(rooted, f"rooted-{uuid.uuid4().hex}")
    heads = workspace.settle(rooted.groupBy("root").agg(F.min("first").alias("head")), f"heads-{uuid.uuid4().hex}")
    named = rooted.join(heads.hint("merge"), "root").select("fp", "head")
    return rows.join(named.hint("merge"), "fp").select(
        "doc_id", "fp", "text_hash", F.col("head.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("text_hash") == F.col("head.text_hash"))).alias("kept"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE,
             workspace: Workspace | None = None) -> DataFrame:
    """The documents with one of each group, with all their columns; the texts move once."""
    def key(text_hash, doc_id):
        return F.concat_ws(":", text_hash.cast("string"), doc_id.cast("bigint").cast("string"))

    kept = (near_duplicates(docs, shingle, max_distance, workspace).where("kept")
            .select(key(F.col("text_hash"), F.col("doc_id")).alias("_key")).distinct())
    marked = docs.withColumn("_key", key(F.xxhash64("text"), F.col("doc_id")))
    return marked.hint("merge").join(kept.hint("merge"), "_key").dropDuplicates(["_key"]).select(*docs.columns)

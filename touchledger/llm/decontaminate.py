"""Benchmark decontamination with a generalised suffix automaton of the test items.

Texts are lower-cased in A-Z and cut into words of ASCII letters, digits and all characters beyond ASCII. Each document
is streamed through the automaton once; a run that matches at least ``width`` words (or a whole shorter item) is a hit.

The automaton is broadcast, so its size is checked first: items are dealt into as many shards as keep one shard under
``shard_words`` words (at most twice as many states), and documents pass the shards one after the other.

Defined results: null and empty texts have no words and no hits; null or empty items never occur; repeated rows each get
their own result; an empty benchmark hits nothing; columns of the input with the name of a result column give way.
"""

from __future__ import annotations

import re
import uuid

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchledger.llm.automaton import SuffixAutomaton
from touchledger.llm.common import LOWER
from touchledger.plans.workspace import Workspace

WIDTH = 10
SHARD_WORDS = 2_000_000
#: Separators become spaces, so that splitting at white space leaves the words.
_SPACED = bytes(LOWER[b] if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
HITS = "n_words bigint, spans array<struct<start:bigint,stop:bigint>>, items array<string>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_SPACED).split()


def shard_count(benchmark: DataFrame, shard_words: int) -> int:
    """How many automata the items need; a word and its separator take two characters at least."""
    most = benchmark.agg(F.sum(F.length("text") / 2 + 1)).first()[0] or 0
    return max(1, -(-int(most) // shard_words))


def shards(benchmark: DataFrame, n: int, width: int):
    """One automaton after the other, each over a share of the items."""
    items = (benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text"))
             .where("item_id is not null and text is not null"))
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        yield SuffixAutomaton(((r["item_id"], words_of(r["text"])) for r in rows), width)


def _find(automaton):
    @F.pandas_udf(HITS)
    def find(texts: pd.Series) -> pd.DataFrame:
        a, out = automaton.value, []
        for text in texts:
            words = words_of(text)
            spans, items = a.scan(words)
            out.append((len(words), spans, sorted(items)))
        return pd.DataFrame(out, columns=["n_words", "spans", "items"])
    return find.asNondeterministic()


def _merge(a, b):
    """Sorted disjoint spans that cover what either list covers."""
    both = F.array_sort(F.concat(a, b))
    empty = F.array().cast("array<struct<start:bigint,stop:bigint>>")

    def put(done, x):
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["stop"], x["stop"]).alias("stop"))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["stop"] >= x["start"]),
                      F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(joined))
                      ).otherwise(F.concat(done, F.array(x)))
    return F.aggregate(both, empty, put)


def find_hits(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, shard_words: int = SHARD_WORDS,
              workspace: Workspace | None = None) -> DataFrame:
    """The documents with n_words, the spans of hit words (half open) and the items whose windows occur."""
    spark, names = docs.sparkSession, ("n_words", "spans", "items")
    n, out = shard_count(benchmark, shard_words), docs.drop("_hits", "_now")
    for k, automaton in enumerate(shards(benchmark, n, width)):
        held = spark.sparkContext.broadcast(automaton)
        if not k:
            out = out.withColumn("_hits", _find(held)(F.col("text")))
        else:
            out = out.withColumn("_now", _find(held)(F.col("text"))).withColumn("_hits", F.struct(
                F.col("_hits.n_words").alias("n_words"),
                _merge(F.col("_hits.spans"), F.col("_now.spans")).alias("spans"),
                F.array_sort(F.array_union("_hits.items", "_now.items")).alias("items"))).drop("_now")
        if n > 1:
            # One automaton at a time in a worker: what this one found is written before the next one comes.
            workspace = workspace or Workspace(spark)
            out = workspace.settle(out, f"hits-{k}-{uuid.uuid4().hex}")
            held.unpersist()
    return out.withColumns({c: F.col(f"_hits.{c}") for c in names}).drop("_hits")


def without_spans(text: str, spans) -> str:
    """The text less these spans of words; each leaves a line break."""
    places = [m.span() for m in _WORD.finditer(text.encode().translate(LOWER).decode())]
    out, at = [], 0
    for start, stop in spans:
        out.append(text[at:places[start][0]])
        at = places[stop - 1][1]
    out.append(text[at:])
    return "\n".join(out)


def _clean(automaton, max_coverage):
    @F.pandas_udf("text string, n_hit bigint, rejected boolean")
    def clean(texts: pd.Series) -> pd.DataFrame:
        a, out = automaton.value, []
        for text in texts:
            words = words_of(text)
            spans, _ = a.scan(words)
            hit = sum(stop - start for start, stop in spans)
            rejected = hit > max_coverage * len(words)
            while spans and not rejected:
                # What is left can meet and make a new occurrence.
                text = without_spans(text, spans)
                spans, _ = a.scan(words_of(text))
            out.append((text, hit, rejected))
        return pd.DataFrame(out, columns=["text", "n_hit", "rejected"])
    return clean.asNondeterministic()


def _cut(text, spans):
    @F.pandas_udf("string")
    def cut(texts: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([without_spans(t, [(x["start"], x["stop"]) for x in s]) if len(s) else t
                          for t, s in zip(texts, found)], dtype=object)
    return cut(text, spans)


def remove_hits(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, max_coverage: float = 0.5,
                shard_words: int = SHARD_WORDS, workspace: Workspace | None = None) -> DataFrame:
    """The documents without hit spans; one with more than ``max_coverage`` of its words hit goes as a whole.

    A span leaves a line break; what is left is scanned again until nothing is hit. ``n_chars``, where there is such a
    column, follows the text.
    """
    spark = docs.sparkSession
    n = shard_count(benchmark, shard_words)
    if n == 1:
        held = spark.sparkContext.broadcast(next(shards(benchmark, 1, width)))
        out = docs.withColumn("_clean", _clean(held, max_coverage)(F.col("text"))).where("not _clean.rejected")
        return _renewed(out, docs, F.col("_clean.text"), F.col("_clean.n_hit") > 0).select(*docs.columns)
    workspace = workspace or Workspace(spark)
    out, hit = docs, F.aggregate("_spans", F.lit(0).cast("bigint"), lambda sofar, x: sofar + x["stop"] - x["start"])
    first = True
    while True:
        found = find_hits(out.select(F.struct(*docs.columns).alias("_row"), "text"), benchmark, width, shard_words,
                          workspace).withColumnRenamed("spans", "_spans")
        if first:
            found = found.where(hit <= max_coverage * F.col("n_words"))
            first = False
        if found.where("size(_spans) > 0").isEmpty():
            return found.select("_row.*")
        rows = found.select("_row.*", F.col("_spans"))
        out = _renewed(rows, docs, _cut(F.col("text"), F.col("_spans")), F.size("_spans") > 0).select(*docs.columns)
        out = workspace.settle(out, f"clean-{uuid.uuid4().hex}")


def _renewed(rows: DataFrame, docs: DataFrame, text, changed) -> DataFrame:
    columns = {"text": text}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(changed, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(
            F.col("n_chars"))
    return rows.withColumns(columns)

"""The corpus pipeline: toxicity, exact dedup, SimHash near-dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents, others that the frame has included, whatever their names.

Defined results: a null text counts as empty and may stay, as the null it was; a null id is an id smaller than any other;
of rows with equal texts the one with the largest id stays, of repeated rows one; texts of any length are processed whole;
a frame without rows passes every stage.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchledger.llm import decontaminate, exact, packing, simhash, toxicity
from touchledger.llm.common import prepared, table
from touchledger.plans.workspace import Workspace


#: Columns of documents; others travel through a stage in one struct, so that no name clashes with an operator's own.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def carrying_others(stage):
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = [c for c in docs.columns if c not in COLUMNS]
        if not others:
            return stage(spark, docs, sf_dir)
        packed = F.struct(*[docs[f"`{c}`"].alias(c) for c in others]).alias("_other_columns")
        out = stage(spark, docs.select(*[c for c in docs.columns if c in COLUMNS], packed), sf_dir)
        return out.select(*[F.col(c) if c in COLUMNS else F.col("_other_columns").getField(c).alias(c) for c in docs.columns])
    return run_stage


@carrying_others
def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier, learnt from labels of its training share, predicts toxic."""
    labels = table(prepared(spark), sf_dir, "labels")
    return toxicity.score_documents(docs, labels).where("predicted = 0").select(*docs.columns)


@carrying_others
def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each text, that with the largest doc_id."""
    workspace = Workspace(prepared(spark))
    return exact.DigestIndex(spark, f"{workspace.root}/digest_index").keep(docs, workspace)


@carrying_others
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates, that with the smallest doc_id."""
    return simhash.keep_one(docs, workspace=Workspace(prepared(spark)))


@carrying_others
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts the passages of test items; drops a document that consists of such passages for the most part."""
    return decontaminate.remove_hits(docs, table(prepared(spark), sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens, with the ids."""
    prepared(spark)
    return packing.pack(docs, packing.byte_bpe())


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("simhash_near_dedup", without_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("packing", packed),
]

#: A trained classifier and a tokenizer are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder before the next."""
    workspace = Workspace(prepared(spark))
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = workspace.settle(stage(spark, docs, sf_dir), f"{name}-{uuid.uuid4().hex}")
    return docs

"""Exact deduplication against a persistent digest index.

The index is a parquet table bucketed and sorted by the SHA-256 of the text. A batch of documents is reduced to one
row per digest, anti-joined with the index by a sort-merge join that needs no exchange on the index's side, and the
digests that were not there are appended. Everything is a DataFrame operation.

Defined results: a null text counts as the empty text; of equal texts in a batch the row with the largest doc_id stays
(a null id is smaller than any other); of repeated rows exactly one stays; a text that an earlier batch has brought is
dropped and its keep_id is that batch's; an empty batch gives an empty result and leaves the index as it is. Columns of
the input other than doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchledger.plans.workspace import Workspace


def digest_of(text: Column) -> Column:
    """SHA-256 of the text in UTF-8, as 32 bytes."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


class DigestIndex:
    """A digest table at a path; a later session that opens the same path goes on with it.

    The number of buckets is a property of the written files. It is kept beside them, in ``<path>.buckets``, and whoever
    opens the path again gets that number, whatever the session's settings are then; to ask for another one raises. A new
    index without a number takes the session's number of shuffle partitions: then a batch, dealt as Spark deals it, writes
    one file for each bucket, and joins with the index bucket by bucket.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path
        self.buckets = self._kept_buckets(buckets)
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(f"""CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet
                      CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'""")

    def _kept_buckets(self, wanted: int | None) -> int:
        """The number of buckets that the index has, or gets now."""
        kept = f"{self.path}.buckets"
        try:
            found = self.spark.read.schema("buckets int").parquet(kept).first()["buckets"]
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            found = wanted or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            self.spark.createDataFrame([(found,)], "buckets int").coalesce(1).write.parquet(kept)
        if wanted not in (None, found):
            raise ValueError(f"the index at {self.path} has {found} buckets, not {wanted}")
        return found

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, docs: DataFrame, workspace: Workspace | None = None, batch: str | None = None) -> DataFrame:
        """Enters a batch; returns a row per document with its digest, keep_id, group_size and whether it stays.

        ``group_size`` counts the documents of the batch with this text. A table with null ids gets one row of
        keep_id null for each text that has no other. ``batch`` names the batch: one that is entered again under its
        name, say after a failure, keeps what it kept, for its own digests do not count as earlier ones.
        """
        batch, attempt = batch or uuid.uuid4().hex, uuid.uuid4().hex
        workspace = workspace or Workspace(self.spark)
        # Row numbers settle which of several equal rows stays; they are written, so a retry cannot change them.
        keyed = workspace.settle(
            docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), digest_of(F.col("text")).alias("digest"),
                        F.monotonically_increasing_id().alias("row")), f"digests-{attempt}")
        groups = keyed.groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("last"),
                                             F.count(F.lit(1)).alias("group_size"))
        # an earlier attempt's own digests are there already and are not entered twice
        fresh = (groups.hint("merge").join(self.rows().hint("merge"), "digest", "left_anti")
                 .select("digest", F.col("last.doc_id").alias("keep_id"), F.lit(batch).alias("batch")))
        (fresh.repartition(self.buckets, "digest").sortWithinPartitions("digest")
         .write.format("parquet").mode("append").bucketBy(self.buckets, "digest").sortBy("digest")
         .saveAsTable(self.name))
        # Written, so that both sides of the last join come out of an exchange and Spark can split a text with many copies.
        held = workspace.settle(groups.join(self.rows().hint("merge"), "digest"), f"held-{attempt}")
        return (keyed.hint("merge").join(held.hint("merge"), "digest")
                .select(keyed["doc_id"], "digest", "keep_id", "group_size",
                        ((F.col("batch") == batch) & (keyed["row"] == F.col("last.row"))).alias("kept")))

    def keep(self, docs: DataFrame, workspace: Workspace | None = None, batch: str | None = None) -> DataFrame:
        """The documents of a batch that stay, with all their columns.

        Joined by digest and id in one key, so that a text with many copies is no hot key, and repeated rows are
        reduced to one where the join has brought them: the texts move once.
        """
        def key(digest: Column, doc_id: Column) -> Column:
            return F.concat(digest, F.coalesce(doc_id.cast("bigint").cast("string"), F.lit("")).cast("binary"))

        staying = self.add(docs, workspace, batch).where("kept").select(key(F.col("digest"), F.col("doc_id")).alias("_key"))
        marked = docs.withColumn("_key", key(digest_of(F.col("text")), F.col("doc_id")))
        return marked.hint("merge").join(staying.hint("merge"), "_key").dropDuplicates(["_key"]).select(*docs.columns)

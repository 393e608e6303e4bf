"""Shared folder for intermediate tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession

#: Codec of the tables. Keys in hexadecimal digits are most of their bytes; this one halves them, Spark's default does not.
CODEC = "zstd"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach: ``spark.checkpoint.dir``, or else the warehouse.

    Spark's own default for the warehouse is a folder of the driver's machine, so one without a shared store counts only
    where driver and executors are one process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    folder = spark.conf.get("spark.sql.warehouse.dir", None)
    alone = re.match(r"local(\[|$)", spark.conf.get("spark.master", None) or "")
    if not folder or not alone and re.match("file:|/", folder):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


class Workspace:
    """Intermediate tables of one run, in their own subfolder of the shared folder.

    Without a root of the caller's, the subfolder goes when the session ends.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        #: table -> what its write has counted
        self.observed: dict[str, dict] = {}
        self.root = f"{root or shared_folder(spark)}/run-{uuid.uuid4().hex}"
        if root is None:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)

    def settle(self, df: DataFrame, name: str, watch: Mapping[str, Column] | None = None) -> DataFrame:
        """Writes a table once and returns a reader of it.

        Cuts the lineage, survives lost executors, and gives later joins a real size to plan with. ``watch`` names
        aggregates that the write takes along, in ``observed``, so that they cost no pass of their own.
        """
        path = f"{self.root}/{name}"
        if watch:
            seen = Observation(f"{name}-{uuid.uuid4().hex}")
            df.observe(seen, *[c.alias(n) for n, c in watch.items()]).write.parquet(path, compression=CODEC)
            self.observed[name] = seen.get
        else:
            df.write.parquet(path, compression=CODEC)
        return self.spark.read.schema(df.schema).parquet(path)

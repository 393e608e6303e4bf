"""Helpers that several operators of this package share."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchledger.session import pin

#: Upper case to lower case, for A-Z alone, on UTF-8 bytes.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings for Python workers: batches small enough for long texts, no threads of their own."""
    pin(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    ship(spark.sparkContext)
    return spark


def ship(sc) -> None:
    """Gives the executors this package, once per context."""
    if getattr(sc, "_touchledger_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="touchledger-")) / "touchledger_package.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    sc.addPyFile(str(target))
    sc._touchledger_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, base: int) -> Column:
    """crc32 of the number as text, modulo a base; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % base


def replaced(df: DataFrame, **columns: Column) -> DataFrame:
    """The frame with these columns; one of its own with a clashing name gives way."""
    return df.withColumns(columns)


@functools.lru_cache(maxsize=3)
def once(make, *args):
    """One object per Python worker, such as a tokenizer or the dense form of a broadcast model."""
    return make(*args)


def chunks(values: Iterable, size: int):
    batch = []
    for v in values:
        batch.append(v)
        if len(batch) == size:
            yield batch
            batch = []
    if batch:
        yield batch

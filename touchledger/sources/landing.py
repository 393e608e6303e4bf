"""Landing of exports: every file becomes a table of text columns plus its load time."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchledger.sinks import write_layer
from touchledger.sources.feeds import LOADED_AT, text_schema
from touchledger.sources.split_csv import read_split

# A cell that cannot occur in an export. It stands for "no value", so that a quoted empty cell stays an
# empty string while an unquoted one becomes NULL.
_NO_VALUE = "\u0001"


CELLS = {"nullValue": _NO_VALUE, "emptyValue": "", "quote": '"', "escape": '"'}


def _csv(spark: SparkSession, path: str, size: int, multi_line: bool | str) -> DataFrame:
    """A short or long row, and a part file with another header, stop the load."""
    whole = (spark.read.option("header", True).option("inferSchema", False).option("mode", "FAILFAST")
             .option("enforceSchema", False).option("columnPruning", False).options(**CELLS)
             .option("multiLine", multi_line is not False))
    if multi_line == "split" or multi_line is True and size > _range_bytes(spark):
        return read_split(spark, path, whole.csv(path).columns, CELLS)
    return whole.csv(path)


def _range_bytes(spark: SparkSession) -> int:
    """Bytes of a file that one task reads at most."""
    return spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()


def _exports(spark: SparkSession, pattern: str) -> dict[str, int]:
    """CSV exports that a path pattern finds, with the bytes of their largest file; an export is one file or a folder of them.

    Only the listing is read, and there is one row per table, so what the driver gets stays short.
    """
    tail = F.regexp_extract("path", r"([^/]+)\.csv(?:/[^/]*)?$", 1)
    listing = spark.read.format("binaryFile").load(pattern).select(tail.alias("name"), "length")
    found = listing.where("name != ''").groupBy("name").agg(F.max("length").alias("length"))
    return {r["name"]: r["length"] for r in found.orderBy("name").collect()}


def land_raw(spark: SparkSession, folder: str, load_ts: datetime | None = None, fmt: str = "csv",
             tables: list[str] | None = None, multi_line: bool | str = True) -> dict[str, DataFrame]:
    """Every export in ``folder`` as a DataFrame of text columns named after its header, plus the load time.

    ``tables`` names the exports to land, otherwise all are. Quoted cells may hold line breaks. A file that fits one
    task is then read by one; a larger one is split at any byte by counting quotes (``sources.split_csv``), as with
    ``multi_line="split"`` all are. ``multi_line=False`` is for exports without a line break in any cell. Reading a table
    with a malformed row raises.
    """
    stamp = F.lit(load_ts) if load_ts else F.current_timestamp()
    root = folder.rstrip("/")
    if fmt == "parquet":
        if tables is None:
            raise ValueError("name the tables to land from Parquet")
        found = {t: spark.read.parquet(f"{root}/{t}.parquet") for t in tables}
        landed = {t: df.select([F.col(c).cast("string").alias(c) for c in df.columns]) for t, df in found.items()}
    else:
        # sizes matter only where they decide how a table is read
        listed = tables is None or multi_line is True
        sizes = _exports(spark, f"{root}/{'{' + ','.join(tables) + '}' if tables else '*'}.csv") if listed else {}
        names = sizes if tables is None else tables
        landed = {t: _csv(spark, f"{root}/{t}.csv", sizes.get(t, 0), multi_line) for t in names}
    return {t: df.withColumn(LOADED_AT, stamp.cast("timestamp")) for t, df in landed.items()}


def schema_drift(spark: SparkSession, expected: dict[str, list[str]], landed: dict[str, DataFrame]) -> DataFrame:
    """What a reload has to do per landed table: ``replace`` its rows, ``rebuild`` it, or ``create`` it.

    Same columns in the same order keep the table; any other header means a rebuild. Only headers are
    compared, which the plans already hold, so no data is read.
    """
    rows = []
    for table, df in sorted(landed.items()):
        found = [c for c in df.columns if c != LOADED_AT]
        before = expected.get(table)
        action = "create" if before is None else "replace" if list(before) == found else "rebuild"
        rows.append((table, None if before is None else ",".join(before), ",".join(found), action))
    return spark.createDataFrame(rows, "table string, expected string, found string, action string")


def refresh_raw(spark: SparkSession, landed: dict[str, DataFrame], root: str) -> DataFrame:
    """Replaces the stored raw tables by the landed ones and returns the drift against what was stored.

    The tables are written into a folder of this load; a row that names it is added when all are there. So readers
    see one complete load or the other, and a load that fails leaves the last one in place.
    """
    stored = {t: [c for c in df.columns if c != LOADED_AT]
              for t, df in ((t, raw_table(spark, root, t)) for t in landed) if df is not None}
    drift = schema_drift(spark, stored, landed)
    load = f"load-{uuid.uuid4().hex}"
    for table, df in landed.items():
        write_layer(df, load, table, f"{root.rstrip('/')}/raw")
    stamp = datetime.now(timezone.utc)
    rows = [(table, load, stamp) for table in sorted(landed)]
    (spark.createDataFrame(rows, "table string, folder string, loaded_at timestamp").coalesce(1)
     .write.mode("append").parquet(f"{root.rstrip('/')}/raw/loads"))
    return drift


def raw_table(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """The latest load of a raw table, None before the first."""
    folder = f"{root.rstrip('/')}/raw"
    try:
        loads = spark.read.schema("table string, folder string, loaded_at timestamp").parquet(f"{folder}/loads")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    last = loads.where(F.col("table") == table).orderBy(F.desc("loaded_at")).first()
    return spark.read.parquet(f"{folder}/{last['folder']}/{table}") if last else None


def load_manifest(landed: dict[str, DataFrame]) -> DataFrame:
    """Row count per landed table and in total (``table`` = ``all``)."""
    counts = None
    for table, df in sorted(landed.items()):
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(table).alias("table"), "rows")
        counts = one if counts is None else counts.unionByName(one)
    return (counts.rollup("table").agg(F.sum("rows").alias("rows"))
            .select(F.coalesce("table", F.lit("all")).alias("table"), "rows"))


def empty_feed(spark: SparkSession, columns: list[str]) -> DataFrame:
    """A feed that delivered nothing."""
    return spark.createDataFrame([], text_schema(columns))

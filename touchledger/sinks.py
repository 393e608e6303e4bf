"""Where results go: layer tables, the dashboard document, append-only logs."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchledger.operators.catalogue import metric_definitions

# Rows that a result set of the dashboard can have.
REPORT_ROWS = 100_000


def write_layer(df: DataFrame, layer: str, name: str, root: str, mode: str = "overwrite") -> DataFrame:
    """Writes a table of a layer, staging like any other, to ``root/layer/name`` and returns what readers will see."""
    path = f"{root.rstrip('/')}/{layer}/{name}"
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dashboard_extract(results: dict[str, DataFrame], path: str, lookback_days: int = 90,
                      summary: str = "summary", company: str = "", pitch: str = "") -> dict:
    """Writes the result sets, the run's metadata and the metric definitions as one JSON document.

    Result sets are reports of bounded size (channels, models, months, last runs); more than ``REPORT_ROWS`` rows
    raise, for nothing larger may pass through the driver. One that fails becomes an empty list, so that a missing
    log does not keep the rest from being published. ``company`` and ``pitch`` head the page. Returns the document.
    """
    spark = next(iter(results.values())).sparkSession
    document: dict = {}
    for name, df in results.items():
        try:
            rows = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).limit(REPORT_ROWS + 1).collect()
            if len(rows) > REPORT_ROWS:
                raise ValueError(f"{name} has more than {REPORT_ROWS} rows; a dashboard shows reports only")
            document[name] = [json.loads(r[0]) for r in rows]
        except PySparkException as failure:
            print(f"  ! {name}: {str(failure).splitlines()[0]}")
            document[name] = []
    if summary in document:
        document[summary] = document[summary][0] if document[summary] else {}
    document["meta"] = {"company": company, "pitch": pitch, "lookback_days": lookback_days,
                        "built_at": datetime.now(timezone.utc).isoformat(timespec="minutes")}
    document["metrics"] = [r.asDict() for r in metric_definitions(spark).collect()]
    spark.createDataFrame([(json.dumps(document),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return document


def append_run_log(run: DataFrame, path: str) -> None:
    """Adds a run to the log: steps and summary are kept as JSON text, whatever their shape."""
    as_text = [F.col(c) if t in ("string", "timestamp", "bigint", "int") else F.to_json(c).alias(c)
               for c, t in run.dtypes]
    run.select(as_text).write.mode("append").parquet(path)


def append_write_log(changed: DataFrame, mode: str, path: str, system: str = "hubspot", kind: str = "company") -> None:
    """Adds one log row per CRM row considered; ``mode`` is ``live`` or ``dry_run``."""
    if mode not in ("live", "dry_run"):
        raise ValueError(f"unknown mode: {mode}")
    (changed.select(
        F.current_timestamp().alias("written_at"), F.lit(system).alias("system"), F.lit(kind).alias("object"),
        "domain", F.to_json(F.struct("*")).alias("payload"), F.lit(mode).alias("mode"))
     .write.mode("append").parquet(path))

"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Static settings are for newly built sessions only; the runtime ones can be pinned on any session.
STATIC = {"spark.ui.enabled": "false"}
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
# Only where a session has no value of its own. A join of deals and touches gives many times the bytes that it reads, so a
# task of Spark's 64 MB holds too many rows to aggregate them in memory.
TASK_BYTES = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")
# What a table is taken to be before it is read is the size of its files, and sorted, compressed rows are up to sixty times
# that in memory. So no join is broadcast for it; one side is when its rows, as they came out of a shuffle, have at most this.
BROADCAST_PLANNED, BROADCAST_MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
BROADCAST_BYTES = 2 << 20


def build_session(app: str = "touchledger", master: str | None = None, **conf: str) -> SparkSession:
    """New or existing session with UTC time, ANSI casts and adaptive execution."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**STATIC, **RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return pin(builder.getOrCreate())


def pin(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on a session somebody else built."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def limit_tasks(spark: SparkSession) -> SparkSession:
    """Smaller tasks after a shuffle, unless the session says how large they are."""
    key, value = TASK_BYTES
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, value)
    return spark


def measure_broadcasts(spark: SparkSession) -> SparkSession:
    """Broadcasts that a plan does not ask for are decided by measured sizes alone, so that the driver holds little of a join.

    A lower limit of the session's, for planned sizes, holds for measured ones; one for measured sizes stays as it is.
    """
    if spark.conf.get(BROADCAST_MEASURED, None) is None:
        planned = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
        spark.conf.set(BROADCAST_MEASURED, str(min(planned, BROADCAST_BYTES)))
    spark.conf.set(BROADCAST_PLANNED, "-1")
    return spark

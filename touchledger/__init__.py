"""Multi-touch revenue attribution as Spark DataFrame operators.

``sources``    raw feeds, CSV/Parquet landing, mapping of the benchmark tables
``functions``  Column -> Column helpers
``operators``  DataFrame -> DataFrame steps (staging, identity, touches, attribution, marts, ...)
``plans``      how the layers are wired together and which of them are written
``sinks``      layer tables, dashboard extract, append-only logs
"""

from touchledger.config import AttributionConfig

__all__ = ["AttributionConfig"]

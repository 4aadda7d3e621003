"""tessera — a Spark-native telemetry lakehouse.

Batch medallion build (raw -> silver -> gold star schema), a validated
stream path with dead-letter routing, cursor-incremental API ingestion with
keyed upserts, and a data-quality audit, all as DataFrame / SQL / Structured
Streaming plans.
"""

__version__ = "0.1.0"

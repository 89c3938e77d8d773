"""auric: a Spark-native medallion engine.

Bronze ingest with a high-watermark cursor and merge-by-key, silver dedupe with
soft/hard delete reconciliation, gold metric snapshots appended idempotently by
date, and versioned Parquet publishing with time travel. Everything is written
with DataFrames and Spark SQL on built-in Catalyst operators.
"""

__version__ = "0.1.0"

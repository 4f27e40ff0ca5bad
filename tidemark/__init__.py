"""tidemark: delivery accounting over partitioned logs on Spark.

Commit frontiers, retries with capped backoff, drain / replay / no-loss
accounting, run-log evidence and a streaming frontier, as DataFrame
functions.  See README.md for the operator map.
"""

__version__ = "0.1.0"

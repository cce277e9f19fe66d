"""dimweave: slowly changing dimensions on Spark.

Batch and streaming ingest of JSON pages, incremental source batches, type 2
dimension maintenance with checksums, soft delete and history, merges,
origin-date attribution by id bands, and audits -- all as DataFrame plans.
"""

__version__ = "0.1.0"

"""ridelake: trip-data batch analytics on the Spark DataFrame API.

Subpackages:
  functions  column expressions (typing rules, keys, time predicates)
  sources    readers (parquet, csv, union-by-name, paged JSON, file plans)
  operators  staging, dedup, joins, marts, loads, checks, diagnostics
  plans      the registered queries and their SQL oracles
  streaming  incremental file ingest, streaming dedup and daily report
"""

__version__ = "0.1.0"

"""carestay: hospital-stay analytics as Spark DataFrame jobs.

Layers
------
sources    readers, writers, the test fixture and small reference tables
functions  Column functions (no Python UDFs)
operators  silver / gold transforms, quality checks, measures, time intelligence,
           exploration, statistical tests and the risk model
plans      shared plan shapes (size-checked joins, distributed running totals)
           and the registry of named queries with their DuckDB oracles
streaming  incremental bronze ingestion with Structured Streaming
"""

__version__ = "0.1.0"

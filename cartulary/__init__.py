"""Catalogue metadata harmonisation on Spark.

Functions take and return DataFrames or Columns. ``sources`` read, ``functions`` hold the
rules for one record, ``operators`` work on tables, ``plans`` compose jobs, ``sinks`` write,
``streaming`` runs ingest incrementally and ``workload`` holds the registered queries.
"""

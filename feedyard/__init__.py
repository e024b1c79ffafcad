"""feedyard: ingest paged open-data feeds into one keyed table with Spark.

Subpackages: ``sources`` (landed page documents, test fixtures),
``functions`` (date / text column functions), ``operators`` (paging,
filters, projection, upsert, dimensions, window join), ``plans`` (run and
request planning), ``sinks`` (versioned publish), ``streaming`` (incremental
ingest, de-duplication) and ``demos`` (one demo per operator with its DuckDB
oracle).
"""

__version__ = "0.1.0"

"""Demo queries over the test tables, one per operator, each with a DuckDB
oracle. ``QUERIES`` maps a name to ``fn(spark, sf_dir) -> DataFrame``;
``ORACLES`` maps the same name to DuckDB SQL over the same tables."""

from feedyard.demos.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

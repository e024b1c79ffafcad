"""Registry shared by the demo modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def demo(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir)`` as demo ``name`` with its DuckDB oracle."""
    def wrap(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return wrap


def load_all() -> None:
    # importing the modules registers their demos
    from feedyard.demos import dates, feeds, paging, sinks, streams, text  # noqa: F401

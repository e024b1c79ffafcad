"""Synthetic feeds over the test tables (plain projections, nothing random).

Each feed fixture names a base table and, per source field, a Spark SQL
expression producing the field's text and the DuckDB expression for the
value the target column must end up with. Amounts are integer cents, since
Spark and DuckDB print large doubles differently. Dates are ISO text on the
Spark side and epoch seconds on the oracle side.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedyard.schema import ISO_FORMAT, feed as get_feed

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@dataclass(frozen=True)
class Field:
    source: str
    spark: str  # Spark SQL: value (text field) or timestamp (date field)
    duck: str  # DuckDB SQL: the same value / timestamp
    is_date: bool = False


@dataclass(frozen=True)
class FeedFixture:
    feed: str
    table: str
    fields: tuple[Field, ...]
    order: tuple[str, ...]  # total arrival order within a window (Spark SQL)
    window: str | None = None  # Spark SQL date of the window a record is requested in


def _t(source, expr, duck=None):
    return Field(source, expr, duck if duck is not None else expr)


def _d(source, expr, duck=None):
    return Field(source, expr, duck if duck is not None else expr, is_date=True)


def _cents(c):
    return f"CAST(round({c} * 100) AS BIGINT)"


_LI_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")

FIXTURES: dict[str, FeedFixture] = {
    "transactions": FeedFixture("transactions", "orders", (
        _t("TRANSACTION_NUMBER", "o_orderkey"),
        _d("INSTANCE_DATE", "o_orderdate"),
        _t("GROUP_EN", "o_orderstatus"),
        _t("PROCEDURE_EN", "o_orderpriority"),
        _t("TRANS_VALUE", _cents("o_totalprice")),
        _t("TOTAL_BUYER", "o_custkey"),
    ), order=("o_orderkey",), window="trunc(o_orderdate, 'MM')"),
    "rents": FeedFixture("rents", "lineitem", (
        _t("CONTRACT_NUMBER", "concat(l_orderkey, '-', l_linenumber)"),
        _d("REGISTRATION_DATE", "l_shipdate"),
        _d("START_DATE", "l_shipdate"),
        _d("END_DATE", "l_shipdate + INTERVAL 365 DAYS", "l_shipdate + INTERVAL 365 DAY"),
        _t("VERSION_EN", "l_returnflag"),
        _t("USAGE_EN", "l_linestatus"),
        _t("CONTRACT_AMOUNT", _cents("l_extendedprice")),
        _t("TOTAL_PROPERTIES", "CAST(l_quantity AS BIGINT)"),
    ), order=_LI_ORDER, window="trunc(l_shipdate, 'MM')"),
    "projects": FeedFixture("projects", "part", (
        _t("PROJECT_NUMBER", "p_partkey"),
        _t("PROJECT_EN", "p_name"),
        _t("DEVELOPER_EN", "p_brand"),
        _t("PRJ_TYPE_EN", "p_type"),
        _t("PROJECT_VALUE", _cents("p_retailprice")),
        _t("CNT_UNIT", "p_size"),
    ), order=("p_partkey",)),
    "valuations": FeedFixture("valuations", "lineitem", (
        _t("PROCEDURE_NUMBER", "l_orderkey"),
        _t("PROCEDURE_YEAR", "year(l_shipdate)"),
        _d("INSTANCE_DATE", "l_shipdate"),
        _t("PROPERTY_TOTAL_VALUE", _cents("l_extendedprice")),
        _t("ACTUAL_WORTH", _cents("l_extendedprice")),
        _t("PROCEDURE_AREA", "CAST(l_quantity AS BIGINT)"),
    ), order=("l_extendedprice",) + _LI_ORDER, window="trunc(l_shipdate, 'MM')"),
    "lands": FeedFixture("lands", "part", (
        _t("LAND_NUMBER", "p_partkey"),
        _t("LAND_SUB_NUMBER", "p_size"),
        _t("LAND_TYPE_EN", "p_type"),
        _t("PROJECT_EN", "p_name"),
    ), order=("p_partkey", "p_size")),
    "units": FeedFixture("units", "events", (
        _t("UNIT_NUMBER", "event_id"),
        _d("CREATION_DATE", "date_trunc('SECOND', ts)", "date_trunc('second', ts)"),
        _t("ROOM_EN", "event_type"),
        _t("BUILDING_NUMBER", "user_id"),
        _t("IS_FREE_HOLD_EN", "CASE WHEN user_id % 2 = 0 THEN '1' ELSE '0' END"),
    ), order=("event_id",)),
    "brokers": FeedFixture("brokers", "customer", (
        _t("BROKER_NUMBER", "c_custkey"),
        _t("BROKER_EN", "c_name"),
        _t("GENDER_EN", "c_mktsegment"),
        _t("REAL_ESTATE_NUMBER", "c_nationkey"),
    ), order=("c_custkey",)),
    "developers": FeedFixture("developers", "supplier", (
        _t("DEVELOPER_NUMBER", "s_suppkey"),
        _t("DEVELOPER_EN", "s_name"),
        _t("LICENSE_SOURCE_EN", "s_nationkey"),
    ), order=("s_suppkey",)),
}


def record_columns(feed: str) -> list:
    """The feed's source fields as the service serves them: text, dates as ISO text."""
    cols = []
    for fld in FIXTURES[feed].fields:
        if fld.is_date:
            cols.append(F.date_format(F.expr(fld.spark), ISO_FORMAT).alias(fld.source))
        else:
            cols.append(F.expr(fld.spark).cast("string").alias(fld.source))
    return cols


def used_columns(feed: str, columns: list[str]) -> list[str]:
    """Those of the base table's columns that the feed's records are made of."""
    words = {w for fld in FIXTURES[feed].fields for w in re.findall(r"\w+", fld.spark)}
    return [c for c in columns if c in words]


def window_and_order(feed: str) -> list:
    """``window_start`` and the order columns ``_o0.._oN`` of a feed's records."""
    fx = FIXTURES[feed]
    win = F.expr(fx.window) if fx.window else F.lit(None).cast("date")
    return [win.cast("date").alias("window_start")] + [F.expr(o).alias(f"_o{i}") for i, o in enumerate(fx.order)]


def feed_records(spark: SparkSession, sf_dir: str, feed: str, source: DataFrame | None = None) -> DataFrame:
    """The feed's source records plus ``window_start`` and the order columns."""
    base = source if source is not None else table(spark, sf_dir, FIXTURES[feed].table)
    return base.select(*record_columns(feed), *window_and_order(feed))


def order_columns(feed: str) -> list[str]:
    return [f"_o{i}" for i in range(len(FIXTURES[feed].order))]


def oracle_projection(feed: str, extra: str = "") -> str:
    """DuckDB SELECT of the feed's target columns straight off the base table."""
    fx = FIXTURES[feed]
    f = get_feed(feed)
    by_source = {fld.source: fld for fld in fx.fields}
    cols = [f"'{feed}' AS feed"]
    for m in f.mappings:
        fld = by_source.get(m.source)
        if fld is None:
            cols.append(f"{'CAST(0 AS BIGINT)' if m.is_date else 'CAST(NULL AS VARCHAR)'} AS {m.target}")
        elif m.is_date:
            cols.append(f"CAST(epoch({fld.duck}) AS BIGINT) AS {m.target}")
        else:
            cols.append(f"CAST({fld.duck} AS VARCHAR) AS {m.target}")
    sel = ", ".join(cols + ([extra] if extra else []))
    return f"SELECT {sel} FROM {fx.table}"

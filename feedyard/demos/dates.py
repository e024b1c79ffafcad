"""Demos: date and time column functions over orders / events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedyard.demos.registry import demo
from feedyard.functions import dates as D
from feedyard.schema import ISO_FORMAT
from feedyard.session import use_utc
from feedyard.sources.fixtures import table


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    return table(spark, sf_dir, "orders")


# Bad-date fixture: o_orderdate as ISO text, every 100th key 'bad', every
# 101st '', every 103rd null.
_BAD_TEXT_DUCK = """CASE WHEN o_orderkey % 100 = 0 THEN 'bad' WHEN o_orderkey % 101 = 0 THEN ''
 WHEN o_orderkey % 103 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END"""


def bad_date_text(key="o_orderkey", iso=None):
    k = F.col(key)
    good = F.col(iso) if iso else F.date_format("o_orderdate", ISO_FORMAT)
    return (F.when(k % 100 == 0, F.lit("bad")).when(k % 101 == 0, F.lit(""))
            .when(k % 103 == 0, F.lit(None).cast("string"))
            .otherwise(good))


# -- O14 ---------------------------------------------------------------------
@demo("iso_to_epoch", f"""
SELECT o_orderkey, v AS value,
  CASE WHEN v IS NULL OR v = '' THEN 0 ELSE CAST(epoch(try_strptime(v, '%Y-%m-%dT%H:%M:%S')) AS BIGINT) END AS epoch_s,
  CAST(v IS NOT NULL AND v <> '' AND try_strptime(v, '%Y-%m-%dT%H:%M:%S') IS NULL AS INTEGER) AS malformed
FROM (SELECT o_orderkey, {_BAD_TEXT_DUCK} AS v FROM orders)""")
def iso_to_epoch_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir).select("o_orderkey", bad_date_text().alias("value"))
    return o.select("o_orderkey", "value", D.iso_to_epoch("value").alias("epoch_s"),
                    D.iso_is_malformed("value").cast("int").alias("malformed"))


# -- O15 ---------------------------------------------------------------------
_CUST_SPAN = """SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e
FROM orders GROUP BY o_custkey"""


def _cust_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).groupBy("o_custkey").agg(
        F.to_date(F.min("o_orderdate")).alias("s"), F.to_date(F.max("o_orderdate")).alias("e"))


@demo("month_windows", f"""
WITH c AS ({_CUST_SPAN}),
b AS (
  SELECT o_custkey, s AS d FROM c WHERE s < e
  UNION ALL
  SELECT o_custkey, CAST(m AS DATE) FROM c, generate_series(CAST(date_trunc('month', s) AS TIMESTAMP),
         CAST(date_trunc('month', e) AS TIMESTAMP), INTERVAL 1 MONTH) g(m)
  WHERE s < e AND CAST(m AS DATE) > s AND CAST(m AS DATE) < e
  UNION ALL
  SELECT o_custkey, e FROM c WHERE s < e),
w AS (SELECT o_custkey, d AS ws, lead(d) OVER (PARTITION BY o_custkey ORDER BY d) AS we FROM b)
SELECT o_custkey, CAST(ws AS VARCHAR) AS window_start, CAST(we AS VARCHAR) AS window_end,
       CAST(we = max(we) OVER (PARTITION BY o_custkey) AS INTEGER) AS is_last
FROM w WHERE we IS NOT NULL""")
def month_windows_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _cust_span(spark, sf_dir).select("o_custkey", F.inline(D.month_windows("s", "e")))
    return w.select("o_custkey", F.col("window_start").cast("string").alias("window_start"),
                    F.col("window_end").cast("string").alias("window_end"), F.col("is_last").cast("int").alias("is_last"))


# -- O16 ---------------------------------------------------------------------
@demo("month_ends", f"""
WITH c AS ({_CUST_SPAN})
SELECT o_custkey, CAST(least(last_day(CAST(m AS DATE)), e) AS VARCHAR) AS month_end
FROM c, generate_series(CAST(date_trunc('month', s) AS TIMESTAMP), CAST(date_trunc('month', e) AS TIMESTAMP),
                        INTERVAL 1 MONTH) g(m)
WHERE s <= e""")
def month_ends_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _cust_span(spark, sf_dir).select("o_custkey", F.explode(D.month_ends("s", "e")).alias("d"))
    return m.select("o_custkey", F.col("d").cast("string").alias("month_end"))


# -- O17 ---------------------------------------------------------------------
@demo("lookback_window", """
SELECT o_orderkey,
  CAST(CASE WHEN o_orderstatus = 'F' THEN DATE '2024-01-01' ELSE CAST(o_orderdate AS DATE) - INTERVAL 30 DAY END
       AS DATE)::VARCHAR AS window_from,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS window_to
FROM orders""")
def lookback_window_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    run_type = F.when(F.col("o_orderstatus") == "F", F.lit("all")).otherwise(F.lit("incremental"))
    w = D.lookback_window(F.to_date("o_orderdate"), run_type, days=30)
    return o.select("o_orderkey", w["window_from"].cast("string").alias("window_from"),
                    w["window_to"].cast("string").alias("window_to"))


# -- O18 ---------------------------------------------------------------------
@demo("end_of_day_ms", """
SELECT o_orderkey,
  epoch_ms(CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 DAY AS TIMESTAMP)) - 1 AS today_end_ms,
  epoch_ms(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)) - 1 AS yesterday_end_ms
FROM orders""")
def end_of_day_ms_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.to_date("o_orderdate")
    return _orders(spark, sf_dir).select(
        "o_orderkey", D.end_of_day_ms(d).alias("today_end_ms"), D.end_of_day_ms(d, -1).alias("yesterday_end_ms"))


# Millisecond instants: the order date plus a time of day taken from the key.
_MS_DUCK = "(epoch_ms(o_orderdate) + o_orderkey % 86400000)"


def _ms(o: DataFrame):
    return F.unix_millis(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 86400000


# -- O19 ---------------------------------------------------------------------
@demo("prev_month_end_ms", f"""
SELECT o_orderkey, {_MS_DUCK} AS ms,
  epoch_ms(date_trunc('month', make_timestamp({_MS_DUCK} * 1000))) - 1 AS prev_month_end_ms
FROM orders""")
def prev_month_end_ms_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    return o.select("o_orderkey", _ms(o).alias("ms")).select(
        "o_orderkey", "ms", D.prev_month_end_ms("ms").alias("prev_month_end_ms"))


# -- O20 ---------------------------------------------------------------------
@demo("month_start_ms", f"""
SELECT o_orderkey, {_MS_DUCK} AS ms, epoch_ms(date_trunc('month', make_timestamp({_MS_DUCK} * 1000))) AS month_start_ms
FROM orders""")
def month_start_ms_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    return o.select("o_orderkey", _ms(o).alias("ms")).select("o_orderkey", "ms", D.month_start_ms("ms").alias("month_start_ms"))


# -- O21 ---------------------------------------------------------------------
@demo("days_before_start_ms", f"""
SELECT o_orderkey, {_MS_DUCK} AS ms,
  epoch_ms(CAST(CAST(make_timestamp({_MS_DUCK} * 1000) AS DATE) - INTERVAL 7 DAY AS TIMESTAMP)) AS start_ms
FROM orders""")
def days_before_start_ms_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    return o.select("o_orderkey", _ms(o).alias("ms")).select("o_orderkey", "ms", D.days_before_start_ms("ms", 7).alias("start_ms"))


# -- O22 ---------------------------------------------------------------------
@demo("ms_to_sql_date", f"""
SELECT o_orderkey, {_MS_DUCK} AS ms, strftime(make_timestamp({_MS_DUCK} * 1000), '%Y-%m-%d') AS sql_date
FROM orders""")
def ms_to_sql_date_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    return o.select("o_orderkey", _ms(o).alias("ms")).select("o_orderkey", "ms", D.ms_to_sql_date("ms").alias("sql_date"))


# -- O23 ---------------------------------------------------------------------
# Shift n in [-5, 24] taken from the key, so negative and multi-year shifts occur.
_N_DUCK = "(o_orderkey % 30 - 5)"


def _n():
    return (F.col("o_orderkey") % 30 - 5).cast("int")


@demo("months_before", f"""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date_text, CAST({_N_DUCK} AS INTEGER) AS n,
  CAST(CAST(CAST(o_orderdate AS DATE) - to_months(CAST({_N_DUCK} AS INTEGER)) AS DATE) AS VARCHAR) AS shifted
FROM orders""")
def months_before_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir).select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_text"),
                                      _n().alias("n"))
    return o.select("o_orderkey", "date_text", "n", D.months_before("date_text", F.col("n")).cast("string").alias("shifted"))


# The stated behaviour: the first of the month moves by the interval; the day
# is then clipped to the target month's end for October to December, to the
# end of the target year's February for all other months.
@demo("months_before_legacy", f"""
WITH moved AS (
  SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date_text, CAST({_N_DUCK} AS INTEGER) AS n,
    day(o_orderdate) AS day, CAST(date_trunc('month', o_orderdate) - to_months(CAST({_N_DUCK} AS INTEGER)) AS DATE) AS first
  FROM orders)
SELECT o_orderkey, date_text, n, CAST(CAST(first + to_days(CAST(least(day, day(last_day(
    CASE WHEN month(first) >= 10 THEN first ELSE make_date(year(first), 2, 1) END))) - 1 AS INTEGER)) AS DATE) AS VARCHAR) AS shifted
FROM moved""")
def months_before_legacy_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir).select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_text"),
                                      _n().alias("n"))
    return o.select("o_orderkey", "date_text", "n",
                    D.months_before("date_text", F.col("n"), clamp="legacy").cast("string").alias("shifted"))


# -- O24 ---------------------------------------------------------------------
@demo("date_labels", """
SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS day_label, strftime(o_orderdate, '01/%m/%Y') AS month_label,
       strftime(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH, '%d/%m/%Y') AS next_month_label
FROM orders""")
def date_labels_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.to_date("o_orderdate")
    return _orders(spark, sf_dir).select("o_orderkey", D.day_label(d).alias("day_label"),
                                         D.month_label(d).alias("month_label"),
                                         D.next_month_label(d).alias("next_month_label"))

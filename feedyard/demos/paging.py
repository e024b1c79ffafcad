"""Demos: run planning, paging, retries, filters and the window join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from feedyard.demos.feeds import projected
from feedyard.demos.registry import demo
from feedyard.operators.filters import feed_default_filter, window_filter
from feedyard.operators.paging import assign_pages, cap_audit, page_slice, resolve_attempts, take_until_empty
from feedyard.operators.windows import assign_windows, unassigned, windows_for
from feedyard.plans.requests import request_plan, select_feeds
from feedyard.schema import DATED_FEEDS, feed as get_feed
from feedyard.session import use_utc
from feedyard.sources.fixtures import FIXTURES, feed_records, table

# Month windows over the whole orders date range, with is_last, in DuckDB.
_ORDER_WINDOWS = """
span AS (SELECT CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e FROM orders),
bnd AS (
  SELECT s AS d FROM span WHERE s < e
  UNION ALL
  SELECT CAST(m AS DATE) FROM span, generate_series(CAST(date_trunc('month', s) AS TIMESTAMP),
         CAST(date_trunc('month', e) AS TIMESTAMP), INTERVAL 1 MONTH) g(m)
  WHERE s < e AND CAST(m AS DATE) > s AND CAST(m AS DATE) < e
  UNION ALL
  SELECT e FROM span WHERE s < e),
w0 AS (SELECT d AS ws, lead(d) OVER (ORDER BY d) AS we FROM bnd),
win AS (SELECT ws, we, we = max(we) OVER () AS is_last FROM w0 WHERE we IS NOT NULL)"""

_IN_WINDOW = "CAST(o.o_orderdate AS DATE) >= ws AND (CAST(o.o_orderdate AS DATE) < we OR (is_last AND CAST(o.o_orderdate AS DATE) = we))"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    return table(spark, sf_dir, "orders")


# -- O41 ---------------------------------------------------------------------
@demo("assign_windows", f"""
WITH {_ORDER_WINDOWS}
SELECT o.o_orderkey, CAST(ws AS VARCHAR) AS window_start, CAST(we AS VARCHAR) AS window_end
FROM orders o JOIN win ON {_IN_WINDOW}""")
def assign_windows_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    w = assign_windows(o, "o_orderdate", windows_for(o, "o_orderdate"))
    return w.select("o_orderkey", F.col("window_start").cast("string").alias("window_start"),
                    F.col("window_end").cast("string").alias("window_end"))


# Two windows per customer, of days to years, that overlap; the second is closed.
_LONG_FIRST = "date_add(DATE'1992-01-01', CAST(c_custkey * 37 % 1500 AS INT))"
_LONG_WINDOWS = """
w AS (SELECT c_custkey, s AS ws, s + CAST(c_custkey % 9 * 150 + 1 AS INT) AS we, false AS is_last
      FROM (SELECT c_custkey, DATE '1992-01-01' + CAST(c_custkey * 37 % 1500 AS INT) AS s FROM customer)
      UNION ALL SELECT c_custkey, s + 90, s + 90 + CAST(c_custkey % 400 AS INT), true
      FROM (SELECT c_custkey, DATE '1992-01-01' + CAST(c_custkey * 37 % 1500 AS INT) AS s FROM customer)),
o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders),
hit AS (SELECT o_orderkey, ws, we FROM o JOIN w ON o_custkey = c_custkey AND d >= ws AND (d < we OR (is_last AND d = we)))"""


@demo("assign_long_windows", f"""
WITH {_LONG_WINDOWS}
SELECT o_orderkey, CAST(ws AS VARCHAR) AS window_start, CAST(we AS VARCHAR) AS window_end FROM hit
UNION ALL SELECT o_orderkey, NULL, NULL FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM hit)""")
def assign_long_windows_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with the windows of its customer that it lies in, and the
    orders in none."""
    o = _orders(spark, sf_dir).select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderdate")
    first = F.expr(_LONG_FIRST)
    second = F.date_add(first, 90)
    c = table(spark, sf_dir, "customer")
    windows = c.select("c_custkey", first.alias("window_start"), F.date_add(first, (F.col("c_custkey") % 9 * 150 + 1).cast("int")).alias("window_end"),
                       F.lit(False).alias("is_last")).unionByName(
        c.select("c_custkey", second.alias("window_start"), F.date_add(second, (F.col("c_custkey") % 400).cast("int")).alias("window_end"),
                 F.lit(True).alias("is_last")))
    hit = assign_windows(o, "o_orderdate", windows, by=["c_custkey"]).select(
        "o_orderkey", *[F.col(x).cast("string").alias(x) for x in ("window_start", "window_end")])
    none = unassigned(o, "o_orderdate", windows, by=["c_custkey"]).select(
        "o_orderkey", *[F.lit(None).cast("string").alias(x) for x in ("window_start", "window_end")])
    return hit.unionByName(none)


# -- O3 ----------------------------------------------------------------------
def _body_sql(feed: str, skip_sql: str) -> str:
    f = get_feed(feed)
    parts = [f'"{k}":"{v}"' for k, v in f.params]
    head = ",".join(parts)
    return ("'{" + head + ',"P_FROM_DATE":"\' || strftime(ws, \'%m/%d/%Y\') || \'","P_TO_DATE":"\' || '
            "strftime(we, '%m/%d/%Y') || '\",\"P_TAKE\":\"100\",\"P_SKIP\":\"' || CAST(" + skip_sql +
            " AS VARCHAR) || '\",\"P_SORT\":\"" + f.sort + "\"}'")


@demo("request_plan", f"""
WITH {_ORDER_WINDOWS},
cnt AS (SELECT ws, we, count(o.o_orderkey) AS n FROM win LEFT JOIN orders o ON {_IN_WINDOW} GROUP BY ws, we)
SELECT 'transactions' AS feed, CAST(ws AS VARCHAR) AS window_start, CAST(we AS VARCHAR) AS window_end,
       CAST(p AS INTEGER) AS page_no, CAST(p * 100 AS INTEGER) AS skip, 100 AS take,
       'TRANSACTION_NUMBER_ASC' AS sort, {_body_sql('transactions', 'p * 100')} AS body
FROM cnt, generate_series(0, CAST(ceil(n / 100) AS BIGINT) - 1) g(p)
WHERE n > 0""")
def request_plan_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    windows = windows_for(o, "o_orderdate")
    counts = assign_windows(o, "o_orderdate", windows).groupBy("window_start").agg(
        F.count(F.lit(1)).alias("n_records")).withColumn("feed", F.lit("transactions"))
    feeds = select_feeds(spark).filter(F.col("feed") == "transactions")
    plan = request_plan(feeds, windows, counts=counts)
    return plan.select("feed", F.col("window_start").cast("string").alias("window_start"),
                       F.col("window_end").cast("string").alias("window_end"), "page_no", "skip", "take", "sort", "body")


# -- O11 ---------------------------------------------------------------------
def _select_feeds_oracle() -> str:
    parts = [f"SELECT '{f}' AS feed, 'dated' AS kind, '{get_feed(f).sort}' AS sort, count(*) AS n_records "
             f"FROM {FIXTURES[f].table}" for f in DATED_FEEDS]
    return "\nUNION ALL\n".join(parts)


@demo("select_feeds", _select_feeds_oracle())
def select_feeds_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = select_feeds(spark, None)
    counts = reduce(DataFrame.unionByName, [
        table(spark, sf_dir, FIXTURES[f].table).agg(F.count(F.lit(1)).alias("n_records")).withColumn("feed", F.lit(f))
        for f in DATED_FEEDS])
    return feeds.join(counts, on="feed", how="inner").select("feed", "kind", "sort", "n_records")


# -- O6 ----------------------------------------------------------------------
@demo("cap_audit", """
SELECT 'transactions' AS feed, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS window_start,
       count(*) AS n_records, CAST(ceil(count(*) / 100) AS BIGINT) AS n_pages,
       CAST(ceil(count(*) / 100) >= 2 AS INTEGER) AS capped
FROM orders GROUP BY date_trunc('month', o_orderdate)""")
def cap_audit_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    recs = feed_records(spark, sf_dir, "transactions").withColumn("feed", F.lit("transactions"))
    a = cap_audit(recs, size=100, max_pages=2)
    return a.select("feed", F.col("window_start").cast("string").alias("window_start"), "n_records", "n_pages",
                    F.col("capped").cast("int").alias("capped"))


# -- O7 ----------------------------------------------------------------------
@demo("feed_filter", """
SELECT CAST(event_id AS VARCHAR) AS unit_number, CAST(user_id AS VARCHAR) AS building_number, '1' AS free_hold,
       event_type AS room_type
FROM events WHERE user_id % 2 = 0""")
def feed_filter_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = projected(spark, sf_dir, "units")
    return feed_default_filter(units, "units").select("unit_number", "building_number", "free_hold", "room_type")


# -- O8 ----------------------------------------------------------------------
@demo("window_filter", """
SELECT o_orderkey, o_custkey, 'open' AS kind FROM orders
WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1996-07-01'
UNION ALL
SELECT o_orderkey, o_custkey, 'closed' AS kind FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-07-01' AND DATE '1996-12-31'""")
def window_filter_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    first = window_filter(o, "o_orderdate", "1996-01-01", "1996-07-01").select(
        "o_orderkey", "o_custkey", F.lit("open").alias("kind"))
    last = window_filter(o, "o_orderdate", "1996-07-01", "1996-12-31", closed=True).select(
        "o_orderkey", "o_custkey", F.lit("closed").alias("kind"))
    return first.unionByName(last)


# -- O9 ----------------------------------------------------------------------
@demo("page_slice", """
SELECT CAST(o_orderkey AS VARCHAR) AS app_number, CAST(epoch(o_orderdate) AS BIGINT) AS transaction_date,
       CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS amount_
FROM orders ORDER BY CAST(o_orderkey AS VARCHAR) LIMIT 100 OFFSET 200""")
def page_slice_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = projected(spark, sf_dir, "transactions")
    return page_slice(t, ["app_number"], skip=200, take=100).select("app_number", "transaction_date", "amount_")


@demo("page_slice_deep", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate
LIMIT 250 OFFSET (SELECT count(*) * 9 // 10 FROM lineitem)""")
def page_slice_deep_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page behind nine tenths of the table: no task holds what is skipped."""
    li = table(spark, sf_dir, "lineitem").select("l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    order = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    page = page_slice(li, order, skip=li.count() * 9 // 10, take=250, top_rows=1000)
    return page.select("l_orderkey", "l_linenumber", "l_partkey")


# -- O10 ---------------------------------------------------------------------
@demo("assign_pages", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(CAST(date_trunc('month', l_shipdate) AS DATE) AS VARCHAR) AS window_start,
       CAST((rn - 1) // 100 AS BIGINT) AS page_no, CAST((rn - 1) % 100 AS INTEGER) AS position
FROM (SELECT *, row_number() OVER (PARTITION BY date_trunc('month', l_shipdate)
                                   ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate) AS rn
      FROM lineitem)""")
def assign_pages_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").withColumn("window_start", F.trunc("l_shipdate", "MM"))
    p = assign_pages(li, by=["window_start"], order=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"])
    return p.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    F.col("window_start").cast("string").alias("window_start"), "page_no", "position")


# -- O4 ----------------------------------------------------------------------
# Pages from events: one page per (day, user); it holds the user's events
# of that day that are neither signups nor errors, so some pages are empty.
_PAGES_DUCK = """SELECT 'units' AS feed, CAST(ts AS DATE) AS window_start, user_id AS page_no,
  CAST(count(*) FILTER (WHERE event_type NOT IN ('signup', 'error')) AS BIGINT) AS n_records
FROM events GROUP BY CAST(ts AS DATE), user_id"""


@demo("take_until_empty", f"""
WITH p AS ({_PAGES_DUCK}),
s AS (SELECT window_start, min(CASE WHEN n_records = 0 THEN page_no END) AS stop FROM p GROUP BY window_start)
SELECT feed, CAST(p.window_start AS VARCHAR) AS window_start, page_no, n_records
FROM p JOIN s USING (window_start) WHERE stop IS NULL OR page_no < stop""")
def take_until_empty_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    pages = ev.groupBy(F.to_date("ts").alias("window_start"), F.col("user_id").alias("page_no")).agg(
        F.count_if(~F.col("event_type").isin("signup", "error")).alias("n_records")).withColumn("feed", F.lit("units"))
    kept = take_until_empty(pages)
    return kept.select("feed", F.col("window_start").cast("string").alias("window_start"), "page_no", "n_records")


# -- O5 ----------------------------------------------------------------------
# Attempts log from events: one page per (day, user_id div 10), attempts
# numbered by time within it; errors fail, signups come back empty.
_ATTEMPTS_DUCK = """SELECT 'units' AS feed, CAST(ts AS DATE) AS window_start, user_id // 10 AS page_no,
  CAST(row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id // 10 ORDER BY ts, event_id) AS INTEGER) AS attempt,
  CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
  CASE WHEN event_type = 'signup' THEN 0 ELSE 100 END AS n_records
FROM events"""


def attempts_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    day, page = F.to_date("ts"), F.floor(F.col("user_id") / 10).cast("bigint")
    ev = ev.withColumn("window_start", day).withColumn("page_no", page)
    # attempts of one page are few
    w = Window.partitionBy("window_start", "page_no").orderBy("ts", "event_id")
    return ev.select(
        F.lit("units").alias("feed"), "window_start", "page_no", F.row_number().over(w).cast("int").alias("attempt"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
        F.when(F.col("event_type") == "signup", 0).otherwise(100).alias("n_records"))


@demo("resolve_attempts", f"""
WITH a AS ({_ATTEMPTS_DUCK}),
pg AS (SELECT feed, window_start, page_no,
              min(attempt) FILTER (WHERE status = 200) AS attempt,
              arg_min(n_records, attempt) FILTER (WHERE status = 200) AS n_records
       FROM a GROUP BY feed, window_start, page_no),
s AS (SELECT feed, window_start, min(CASE WHEN attempt IS NULL OR n_records = 0 THEN page_no END) AS stop
      FROM pg GROUP BY feed, window_start)
SELECT feed, CAST(window_start AS VARCHAR) AS window_start, page_no, attempt, n_records
FROM pg JOIN s USING (feed, window_start) WHERE stop IS NULL OR page_no < stop""")
def resolve_attempts_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = resolve_attempts(attempts_log(spark, sf_dir))
    return kept.select("feed", F.col("window_start").cast("string").alias("window_start"), "page_no", "attempt",
                       "n_records")


# -- O3, snapshot feeds: one window without dates, pages from the table size ---
def _snapshot_body_sql(feed: str) -> str:
    f = get_feed(feed)
    head = ",".join(f'"{k}":"{v}"' for k, v in f.params)
    return ("'{" + head + ",\"P_TAKE\":\"100\",\"P_SKIP\":\"' || CAST(p * 100 AS VARCHAR) || '\",\"P_SORT\":\"" +
            f.sort + "\"}'")


def _snapshot_plan_oracle() -> str:
    from feedyard.schema import SNAPSHOT_FEEDS
    parts = []
    for f in SNAPSHOT_FEEDS:
        parts.append(
            f"SELECT '{f}' AS feed, CAST(NULL AS VARCHAR) AS window_start, CAST(NULL AS VARCHAR) AS window_end, "
            f"CAST(p AS INTEGER) AS page_no, CAST(p * 100 AS INTEGER) AS skip, 100 AS take, "
            f"'{get_feed(f).sort}' AS sort, {_snapshot_body_sql(f)} AS body "
            f"FROM (SELECT count(*) AS n FROM {FIXTURES[f].table}) c, "
            f"generate_series(0, CAST(ceil(n / 100) AS BIGINT) - 1) g(p) WHERE n > 0")
    return "\nUNION ALL\n".join(parts)


@demo("request_plan_snapshot", _snapshot_plan_oracle())
def request_plan_snapshot_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedyard.schema import SNAPSHOT_FEEDS
    feeds = reduce(DataFrame.unionByName, [select_feeds(spark, f) for f in SNAPSHOT_FEEDS])
    counts = reduce(DataFrame.unionByName, [
        table(spark, sf_dir, FIXTURES[f].table).agg(F.count(F.lit(1)).alias("n_records"))
        .select(F.lit(f).alias("feed"), F.lit(None).cast("date").alias("window_start"), "n_records")
        for f in SNAPSHOT_FEEDS])
    use_utc(spark)
    windows = spark.range(0).select(F.lit(None).cast("date").alias("window_start"), F.lit(None).cast("date").alias("window_end"))
    plan = request_plan(feeds, windows, counts=counts)  # snapshot feeds have no dated windows
    return plan.select("feed", F.col("window_start").cast("string").alias("window_start"),
                       F.col("window_end").cast("string").alias("window_end"), "page_no", "skip", "take", "sort", "body")

"""Demos: upsert family, rejects, lookups, audit stamps, statements, publish."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedyard.demos.feeds import projected_direct
from feedyard.demos.registry import demo
from feedyard.operators.upsert import (lookup_existing, quarantine, reject_duplicates, run_statement, upsert,
                                       upsert_stamped)
from feedyard.session import scratch_path, use_utc
from feedyard.sinks.table import VersionedTable
from feedyard.sources.envelopes import build_envelopes, explode_envelope, parse_envelopes
from feedyard.sources.fixtures import feed_records, order_columns, table

KEYS = ["app_number"]
ORDER = ["window_start", "page_no", "position"]
COLS = ["app_number", "registration_date", "end_date", "transaction_type", "usage_", "contract_amount", "no_of_units"]
CUTOFF = 883612800  # 1998-01-01T00:00:00Z in epoch seconds


def rents_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rents from lineitem via landed pages, in arrival order (window, page,
    position); every 97th order's key is null.

    Written once as a table in the shared work folder, as the ingest step
    would leave it, so the target and the batch (and every join branch that
    reads them) scan it instead of re-running the landing path.
    """
    r = projected_direct(spark, sf_dir, "rents")
    orderkey = F.split(F.col("app_number"), "-").getItem(0).cast("bigint")
    r = r.withColumn("app_number", F.when(orderkey % 97 == 0, F.lit(None).cast("string")).otherwise(F.col("app_number")))
    path = scratch_path(spark, "rents-rows")
    r.select(*COLS, *ORDER).write.parquet(path)
    return spark.read.parquet(path)


def target_and_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    r = rents_rows(spark, sf_dir)
    return r.filter(F.col("registration_date") < CUTOFF), r.filter(F.col("registration_date") >= CUTOFF)


# The same rows in DuckDB; o1..o6 is the arrival order.
_RENTS_DUCK = """
r AS (SELECT CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE concat(l_orderkey, '-', l_linenumber) END AS app_number,
  CAST(epoch(l_shipdate) AS BIGINT) AS registration_date, CAST(epoch(l_shipdate + INTERVAL 365 DAY) AS BIGINT) AS end_date,
  l_returnflag AS transaction_type, l_linestatus AS usage_,
  CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS contract_amount,
  CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS no_of_units,
  date_trunc('month', l_shipdate) AS o1, l_orderkey AS o2, l_linenumber AS o3, l_partkey AS o4, l_suppkey AS o5,
  l_shipdate AS o6
  FROM lineitem),
t AS (SELECT * FROM r WHERE o6 < TIMESTAMP '1998-01-01'),
b AS (SELECT * FROM r WHERE o6 >= TIMESTAMP '1998-01-01')"""
_C = ", ".join(COLS)
_ASC = "o1, o2, o3, o4, o5, o6"
_DESC = "o1 DESC, o2 DESC, o3 DESC, o4 DESC, o5 DESC, o6 DESC"


# -- O25 ---------------------------------------------------------------------
_REPLACE_DUCK = f"""
WITH {_RENTS_DUCK},
bl AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY app_number ORDER BY {_DESC}) AS rn
                      FROM b WHERE app_number IS NOT NULL) WHERE rn = 1)
SELECT {_C} FROM t WHERE app_number IS NULL OR NOT EXISTS (SELECT 1 FROM bl WHERE bl.app_number = t.app_number)
UNION ALL SELECT {_C} FROM bl
UNION ALL SELECT {_C} FROM b WHERE app_number IS NULL"""


@demo("upsert_replace", _REPLACE_DUCK)
def upsert_replace_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, b = target_and_batch(spark, sf_dir)
    return upsert(t, b, KEYS, ORDER, mode="replace").select(*COLS)


# -- O26 ---------------------------------------------------------------------
@demo("upsert_keep", f"""
WITH {_RENTS_DUCK},
bf AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY app_number ORDER BY {_ASC}) AS rn
                      FROM b WHERE app_number IS NOT NULL) WHERE rn = 1)
SELECT {_C} FROM t
UNION ALL SELECT {_C} FROM bf WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.app_number = bf.app_number)
UNION ALL SELECT {_C} FROM b WHERE app_number IS NULL""")
def upsert_keep_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, b = target_and_batch(spark, sf_dir)
    return upsert(t, b, KEYS, ORDER, mode="keep").select(*COLS)


# -- O27 ---------------------------------------------------------------------
@demo("reject_duplicates", f"""
WITH {_RENTS_DUCK},
rk AS (SELECT *, row_number() OVER (PARTITION BY app_number ORDER BY {_ASC}) AS rn FROM b WHERE app_number IS NOT NULL)
SELECT {_C}, 'Duplicate item found: app_number<' || app_number || '>' AS reason
FROM rk WHERE EXISTS (SELECT 1 FROM t WHERE t.app_number = rk.app_number) OR rn > 1""")
def reject_duplicates_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, b = target_and_batch(spark, sf_dir)
    return reject_duplicates(t, b, KEYS, ORDER).select(*COLS, "reason")


# Transactions whose INSTANCE_DATE text is 'bad' every 100th key ('' every
# 101st and null every 103rd are blanks, not errors).
@demo("quarantine", """
SELECT CAST(o_orderkey AS VARCHAR) AS TRANSACTION_NUMBER, 'malformed date INSTANCE_DATE=<bad>' AS reason
FROM orders WHERE o_orderkey % 100 = 0""")
def quarantine_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedyard.demos.dates import bad_date_text
    use_utc(spark)
    recs = feed_records(spark, sf_dir, "transactions")
    recs = recs.withColumn("INSTANCE_DATE", bad_date_text(key="_o0", iso="INSTANCE_DATE"))
    rows = explode_envelope(parse_envelopes(build_envelopes(recs, "transactions", order_columns("transactions")),
                                            "transactions"))
    return quarantine(rows, "transactions").select("TRANSACTION_NUMBER", "reason")


# -- O28 ---------------------------------------------------------------------
@demo("lookup_existing", f"""
WITH {_RENTS_DUCK}
SELECT {_C} FROM t WHERE EXISTS (SELECT 1 FROM b WHERE b.app_number = t.app_number)""")
def lookup_existing_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, b = target_and_batch(spark, sf_dir)
    return lookup_existing(t, b, KEYS).select(*COLS)


# -- O29 ---------------------------------------------------------------------
T1, T2 = dt.datetime(2024, 5, 1, 8, 0, 0), dt.datetime(2024, 6, 1, 8, 0, 0)


@demo("stamp", f"""
WITH {_RENTS_DUCK},
bl AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY app_number ORDER BY {_DESC}) AS rn
                      FROM b WHERE app_number IS NOT NULL) WHERE rn = 1)
SELECT {_C}, 'run-1' AS _tid, '2024-05-01 08:00:00' AS created_at, '2024-05-01 08:00:00' AS updated_at
FROM t WHERE app_number IS NULL OR NOT EXISTS (SELECT 1 FROM bl WHERE bl.app_number = t.app_number)
UNION ALL
SELECT {_C}, 'run-2' AS _tid,
  CASE WHEN EXISTS (SELECT 1 FROM t WHERE t.app_number = bl.app_number) THEN '2024-05-01 08:00:00'
       ELSE '2024-06-01 08:00:00' END AS created_at, '2024-06-01 08:00:00' AS updated_at
FROM bl
UNION ALL
SELECT {_C}, 'run-2', '2024-06-01 08:00:00', '2024-06-01 08:00:00' FROM b WHERE app_number IS NULL""")
def stamp_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedyard.operators.upsert import stamp
    use_utc(spark)
    t, b = target_and_batch(spark, sf_dir)
    first = stamp(t, "run-1", T1)
    after = upsert_stamped(first, b, KEYS, ORDER, "run-2", T2)
    return after.select(*COLS, "_tid", F.col("created_at").cast("string").alias("created_at"),
                        F.col("updated_at").cast("string").alias("updated_at"))


# -- O33 ---------------------------------------------------------------------
_STATEMENT = """
SELECT l_returnflag AS flag, l_linestatus AS status, count(*) AS n_rows,
       CAST(sum(l_quantity) AS BIGINT) AS qty, CAST(sum(round(l_extendedprice * 100)) AS BIGINT) AS cents
FROM {li} WHERE l_shipdate >= :since GROUP BY l_returnflag, l_linestatus"""


@demo("run_statement", _STATEMENT.replace("{li}", "lineitem").replace(":since", "DATE '1997-01-01'"))
def run_statement_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_statement(spark, _STATEMENT, {"since": dt.date(1997, 1, 1)}, {"li": table(spark, sf_dir, "lineitem")})


# -- O32 ---------------------------------------------------------------------
@demo("write_then_read", _REPLACE_DUCK)
def write_then_read_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish the target (initial load, as is), then the batch (replace);
    read the newest version back: equals ``upsert_replace``."""
    t, b = target_and_batch(spark, sf_dir)
    table_ = VersionedTable(spark, scratch_path(spark, "tables"), KEYS, n_buckets=16)
    table_.publish(t, mode="append", batch_id="initial")
    table_.publish(b, order=ORDER, mode="replace", batch_id="batch-1")
    table_.publish(b, order=ORDER, mode="replace", batch_id="batch-1")  # a replay changes nothing
    return table_.read().select(*COLS)


# -- many publishes: levels are merged on the way ------------------------------
@demo("many_publishes", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem)
WHERE rn = 1""")
def many_publishes_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One publish per line number, each replacing most of the keys of the one
    before; with two folders a level the publishes merge over three levels."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    table_ = VersionedTable(spark, scratch_path(spark, "tables"), ["l_orderkey"], n_buckets=8, fanout=2)
    for n in range(1, 8):  # line numbers run from 1 to 7
        table_.publish(lines.where(F.col("l_linenumber") == n), order=["l_linenumber", "l_partkey", "l_suppkey"])
    return table_.read()


@demo("merge_small_batch", """
SELECT o_orderkey, CASE WHEN o_orderkey % 100 = 7 THEN 'new' ELSE 'old' END AS said FROM orders
UNION ALL SELECT o_orderkey + 100000000, 'added' FROM orders WHERE o_orderkey % 100 = 7""")
def merge_small_batch_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row in a hundred replaced, the same keys and as many new ones
    offered to ``keep``: only the buckets that hold the keys are read."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.lit("old").alias("said"))
    few = orders.where("o_orderkey % 100 = 7")
    table_ = VersionedTable(spark, scratch_path(spark, "tables"), ["o_orderkey"], n_buckets=64)
    table_.publish(orders, mode="append")
    table_.merge(few.withColumn("said", F.lit("new")), order=["said"])
    table_.merge(few.unionByName(few.withColumn("o_orderkey", F.col("o_orderkey") + 100000000)).withColumn("said", F.lit("added")),
                 order=["said"], mode="keep")
    return table_.read()


# -- a whole run (O11 -> O1 -> O4 -> O2 -> O27 -> O12 -> O30 -> O29 -> O31 -> O25/O32)
@demo("ingest_run", """
SELECT 'transactions' AS feed, CAST(o_orderkey AS VARCHAR) AS id, CAST(epoch(o_orderdate) AS BIGINT) AS dated,
  CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS amount, 'run-1' AS tid FROM orders
UNION ALL SELECT 'rents', app_number, registration_date, contract_amount, 'run-1' FROM (
  SELECT concat(l_orderkey, '-', l_linenumber) AS app_number, CAST(epoch(l_shipdate) AS BIGINT) AS registration_date,
    CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS contract_amount,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY date_trunc('month', l_shipdate) DESC, l_partkey DESC, l_suppkey DESC, l_shipdate DESC) AS rn
  FROM lineitem) WHERE rn = 1
UNION ALL SELECT 'other', CAST(n AS VARCHAR), NULL, NULL, 'run-1' FROM (
  SELECT count(DISTINCT p_partkey) AS n FROM part
  UNION ALL SELECT count(DISTINCT (l_orderkey, year(l_shipdate))) FROM lineitem
  UNION ALL SELECT count(DISTINCT s_suppkey) FROM supplier)""")
def ingest_run_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five dated feeds land as page files; one run ingests them into the
    wide keyed table; transactions and rents are compared row by row (per
    natural key the last row in arrival order), the other feeds by their
    number of keys."""
    from feedyard.demos.feeds import envelope_pages
    from feedyard.plans.run import WideTable, ingest_run
    from feedyard.schema import DATED_FEEDS
    from feedyard.sources.envelopes import land_envelopes
    use_utc(spark)
    landed = scratch_path(spark, "landed")
    for f in DATED_FEEDS:
        land_envelopes(envelope_pages(spark, sf_dir, f, terminator=True), landed, feed=f)
    wide = WideTable(spark, scratch_path(spark, "tables"), n_buckets=16)
    ingest_run(spark, landed, wide, "run-1", T1, rejects_root=scratch_path(spark, "rejects"))
    rows = wide.read()
    told = rows.where(F.col("feed").isin("transactions", "rents")).select(
        "feed", F.col("app_number").alias("id"), F.coalesce("transaction_date", "registration_date").alias("dated"),
        F.coalesce("amount_", "contract_amount").alias("amount"), F.col("_tid").alias("tid"))
    counted = rows.where(~F.col("feed").isin("transactions", "rents")).groupBy("feed").agg(
        F.count(F.lit(1)).cast("string").alias("id"), F.max("_tid").alias("tid"))
    return told.unionByName(counted.select(
        F.lit("other").alias("feed"), "id", F.lit(None).cast("long").alias("dated"), F.lit(None).cast("string").alias("amount"), "tid"))


# -- envelope truth: error bodies, bad identity and broken text are rejects ----
@demo("envelope_rejects", """
WITH pages AS (SELECT o_orderkey AS k, o_orderkey % 7 AS kind FROM orders)
SELECT 'kept' AS side, CAST(k AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS reason FROM pages WHERE kind IN (0, 1, 2)
UNION ALL SELECT 'rejected', CAST(k AS VARCHAR), CASE kind WHEN 3 THEN 'no result array' WHEN 4 THEN 'bad window_start <soon>'
  WHEN 5 THEN 'malformed page document' ELSE 'bad page_no <>' END FROM pages WHERE kind >= 3""")
def envelope_rejects_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page document per order, some broken in four ways."""
    from feedyard.sources.envelopes import bad_envelopes, parse_envelopes

    use_utc(spark)
    kind, key = F.col("o_orderkey") % 7, F.col("o_orderkey").cast("string")
    body = F.concat(F.lit('"response":{"result":[{"TRANSACTION_NUMBER":"'), key, F.lit('"}]}}'))
    head = F.concat(F.lit('{"feed":"transactions","window_start":"2024-01-01","page_no":'), key, F.lit(","))
    doc = F.when(kind == 3, F.concat(head, F.lit('"error":"timeout"}'))) \
        .when(kind == 4, F.concat(F.replace(head, F.lit("2024-01-01"), F.lit("soon")), body)) \
        .when(kind == 5, F.concat(F.lit("<html>"), key)) \
        .when(kind == 6, F.concat(F.lit('{"window_start":"2024-01-01",'), body)).otherwise(F.concat(head, body))
    pages = parse_envelopes(table(spark, sf_dir, "orders").select(doc.alias("value")), "transactions")
    kept = explode_envelope(pages).select(F.lit("kept").alias("side"), F.col("TRANSACTION_NUMBER").alias("id"),
                                          F.lit(None).cast("string").alias("reason"))
    number = F.coalesce(F.nullif(F.regexp_extract("raw", r'TRANSACTION_NUMBER":"(\d+)', 1), F.lit("")),
                        F.nullif(F.regexp_extract("raw", r'page_no":(\d+)', 1), F.lit("")), F.regexp_extract("raw", r"(\d+)$", 1))
    return kept.unionByName(bad_envelopes(pages).select(F.lit("rejected").alias("side"), number.alias("id"), "reason"))


# -- a later crawl wins, whatever page its row moved to ------------------------
@demo("recrawl", """
SELECT CAST(o_orderkey AS VARCHAR) AS app_number,
  CASE WHEN o_orderkey % 3 = 0 THEN 'new' ELSE 'old' END AS amount_ FROM orders""")
def recrawl_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two crawls of one feed without windows; in the second a third of the
    records come back, on an earlier page, with a new value."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("app_number"), F.lit(None).cast("date").alias("window_start"),
        F.floor(F.col("o_orderkey") / 100).cast("long").alias("page_no"), F.lit(0).alias("position"))
    first = rows.select(F.lit("2024-05-01").alias("run"), "*", F.lit("old").alias("amount_"))
    again = rows.where(F.col("app_number").cast("long") % 3 == 0).select(
        F.lit("2024-06-01").alias("run"), "app_number", "window_start", F.lit(-1).cast("long").alias("page_no"), "position",
        F.lit("new").alias("amount_"))
    table_ = VersionedTable(spark, scratch_path(spark, "tables"), KEYS, n_buckets=16)
    # out of order on purpose: arrival order decides, not publish order
    table_.publish(again, order=["run", *ORDER], mode="newest")
    table_.publish(first, order=["run", *ORDER], mode="newest")
    return table_.read().select("app_number", "amount_")


# -- bucket counts change without losing rows ----------------------------------
@demo("rebucket", _REPLACE_DUCK)
def rebucket_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4 buckets, then 16, then 4 again, with a publish in between."""
    t, b = target_and_batch(spark, sf_dir)
    table_ = VersionedTable(spark, scratch_path(spark, "tables"), KEYS, n_buckets=4)
    table_.publish(t, mode="append", batch_id="initial")
    table_.rebucket(16)
    table_.publish(b, order=ORDER, mode="replace", batch_id="batch-1")
    table_.rebucket(4)
    table_.compact()
    return table_.read().select(*COLS)


# -- keep mode: what is kept and what is refused is the whole batch -------------
@demo("keep_and_reject", """
SELECT l_orderkey AS key, count(*) AS n_batch, 1 AS n_kept, count(*) - 1 AS n_refused
FROM (SELECT l_orderkey FROM lineitem UNION ALL SELECT l_orderkey FROM lineitem) GROUP BY l_orderkey""")
def keep_and_reject_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line landed twice with the same arrival position (ties): per key
    one row is kept and all others are refused."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("at"), "l_partkey")
    batch = lines.unionByName(lines)
    kept = upsert(batch.limit(0), batch, ["key"], ["at"], mode="keep").groupBy("key").agg(F.count(F.lit(1)).alias("kept"))
    refused = reject_duplicates(batch.limit(0), batch, ["key"], ["at"]).groupBy("key").agg(F.count(F.lit(1)).alias("refused"))
    sizes = batch.groupBy("key").agg(F.count(F.lit(1)).alias("n_batch"))
    return sizes.join(kept, "key", "left").join(refused, "key", "left").select(
        "key", "n_batch", F.coalesce("kept", F.lit(0)).cast("int").alias("n_kept"), F.coalesce("refused", F.lit(0)).alias("n_refused"))

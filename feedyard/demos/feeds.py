"""Demos: envelope scan, per-feed projection, wide table, conform."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedyard.demos.registry import demo
from feedyard.operators.project import conform, project_feed, saved_fields, to_wide
from feedyard.schema import FEEDS, WIDE_COLUMNS, feed as get_feed
from feedyard.session import scratch_path, use_utc
from feedyard.operators.paging import assign_pages
from feedyard.sources.envelopes import (envelopes_from_pages, explode_envelope, land_envelopes, parse_envelopes,
                                        read_envelopes)
from feedyard.sources.fixtures import (FIXTURES, oracle_projection, record_columns, table, used_columns,
                                       window_and_order)


def paged_records(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """A feed's records with the window, page and position they are served on.

    Pages are assigned on the raw rows (only window and order keys are
    computed before the shuffle, and columns that neither they nor the records
    need stay behind); the records are formatted after it, in parallel and once.
    """
    use_utc(spark)
    base = table(spark, sf_dir, FIXTURES[feed].table)
    staged = base.select("*", window_and_order(feed)[0])
    paged = assign_pages(staged, by=["window_start"], order=[F.expr(o) for o in FIXTURES[feed].order],
                         keep=used_columns(feed, base.columns))
    return paged.select(*record_columns(feed), "window_start", "page_no", "position")


def envelope_pages(spark: SparkSession, sf_dir: str, feed: str, terminator: bool = False) -> DataFrame:
    """Page documents for a feed, built from its base table (what a fetcher lands)."""
    return envelopes_from_pages(paged_records(spark, sf_dir, feed), feed, terminator=terminator)


def feed_rows(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """Table -> page documents -> decode (O1) -> explode (O2): one row per record."""
    return explode_envelope(parse_envelopes(envelope_pages(spark, sf_dir, feed), feed))


def projected(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """O1 -> O2 -> O12 for one feed, with arrival order (page_no, position)."""
    return project_feed(feed_rows(spark, sf_dir, feed), feed)


def projected_direct(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """O12 over the paged records without the JSON round trip: the rows an
    ingest leaves behind (the round trip itself is what ``projected`` adds)."""
    return project_feed(paged_records(spark, sf_dir, feed).withColumn("feed", F.lit(feed)), feed)


def _register_projection(feed: str) -> None:
    targets = get_feed(feed).targets
    # valuations maps one source field to two targets; keep first occurrences
    cols = list(dict.fromkeys(targets))

    @demo(f"project_{feed}", oracle_projection(feed))
    def _q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return projected(spark, sf_dir, feed).select("feed", *cols)


for _f in FEEDS:
    _register_projection(_f)


# -- O1: read landed page documents back from storage ------------------------
@demo("scan_envelopes", """
SELECT 'transactions' AS feed, CAST(o_orderkey AS VARCHAR) AS app_number,
       strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS window_start,
       CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS amount
FROM orders""")
def scan_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "landed")
    land_envelopes(envelope_pages(spark, sf_dir, "transactions", terminator=True), path)
    rows = explode_envelope(read_envelopes(spark, f"{path}/feed=transactions", "transactions"))
    return rows.select("feed", F.col("TRANSACTION_NUMBER").alias("app_number"),
                       F.col("window_start").cast("string").alias("window_start"), F.col("TRANS_VALUE").alias("amount"))


# -- O2: records with window, page and position ------------------------------
@demo("explode_envelope", """
SELECT 'transactions' AS feed, CAST(o_orderkey AS VARCHAR) AS TRANSACTION_NUMBER,
       CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS window_start,
       CAST((rn - 1) // 100 AS BIGINT) AS page_no, CAST((rn - 1) % 100 AS INTEGER) AS position
FROM (SELECT *, row_number() OVER (PARTITION BY date_trunc('month', o_orderdate) ORDER BY o_orderkey) AS rn
      FROM orders)""")
def explode_envelope_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feed_rows(spark, sf_dir, "transactions")
    return rows.select("feed", "TRANSACTION_NUMBER", F.col("window_start").cast("string").alias("window_start"),
                       "page_no", "position")


# -- O13 ---------------------------------------------------------------------
@demo("saved_fields", """
SELECT CAST(o_orderkey AS VARCHAR) AS app_number, CAST(epoch(o_orderdate) AS BIGINT) AS transaction_date,
       CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS amount_
FROM orders""")
def saved_fields_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return saved_fields(projected(spark, sf_dir, "transactions"), ["app_number", "transaction_date", "amount_"])


# -- O30: all feeds in one wide table ----------------------------------------
DATA_COLUMNS = [c.name for c in WIDE_COLUMNS if c.name not in ("feed", "_tid", "created_at", "updated_at")]


def _wide_oracle() -> str:
    parts = []
    for f in FEEDS:
        targets = list(dict.fromkeys(get_feed(f).targets))
        told = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" if c in targets else "'~'" for c in DATA_COLUMNS)
        parts.append(f"SELECT feed, md5(concat_ws('|', {told})) AS row_md5 FROM ({oracle_projection(f)})")
    return "\nUNION ALL\n".join(parts)


def wide_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_wide([projected(spark, sf_dir, f) for f in FEEDS])


@demo("to_wide", _wide_oracle())
def to_wide_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row by feed and the digest of all its wide columns in order."""
    told = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in DATA_COLUMNS]
    return wide_table(spark, sf_dir).select("feed", F.md5(F.concat_ws("|", *told)).alias("row_md5"))


# -- O31: conform to the wide schema -----------------------------------------
# Brokers built from documents: the whole document text lands in PHONE, a
# String(126) column, so long documents are rejected with a reason.
_DOC_BROKERS = """
SELECT CAST(doc_id AS VARCHAR) AS broker_number, source AS broker_name, lang AS gender_, text AS phone,
       'run-1' AS _tid
FROM documents"""


def _doc_brokers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.lit("brokers").alias("feed"), F.col("doc_id").cast("string").alias("broker_number"),
        F.col("source").alias("broker_name"), F.col("lang").alias("gender_"), F.col("text").alias("phone"),
        F.when(F.col("doc_id") % 50 == 0, F.lit(None)).otherwise(F.lit("run-1")).alias("_tid"))


@demo("conform", f"""
SELECT broker_number, broker_name, gender_, phone, _tid FROM (
  SELECT CAST(doc_id AS VARCHAR) AS broker_number, source AS broker_name, lang AS gender_, text AS phone,
         CASE WHEN doc_id % 50 = 0 THEN NULL ELSE 'run-1' END AS _tid FROM documents)
WHERE length(phone) <= 126 AND _tid IS NOT NULL""")
def conform_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok, _ = conform(_doc_brokers(spark, sf_dir))
    return ok.select("broker_number", "broker_name", "gender_", "phone", "_tid")


@demo("conform_rejects", """
SELECT broker_number, concat_ws('; ',
         CASE WHEN length(phone) > 126 THEN format('phone: length {} > 126', length(phone)) END,
         CASE WHEN _tid IS NULL THEN '_tid: null' END) AS reason
FROM (SELECT CAST(doc_id AS VARCHAR) AS broker_number, text AS phone,
             CASE WHEN doc_id % 50 = 0 THEN NULL ELSE 'run-1' END AS _tid FROM documents)
WHERE length(phone) > 126 OR _tid IS NULL""")
def conform_rejects_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = conform(_doc_brokers(spark, sf_dir))
    return rejects.select("broker_number", "reason")

"""Demos: incremental ingest and streaming de-duplication."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedyard.demos.feeds import envelope_pages
from feedyard.demos.registry import demo
from feedyard.session import scratch_path, use_utc
from feedyard.sinks.table import VersionedTable
from feedyard.sources.envelopes import land_envelopes
from feedyard.sources.fixtures import FIXTURES, table
from feedyard.streaming.ingest import stream_dedupe, stream_ingest, stream_until_empty
from feedyard.streaming.recent import stream_dedupe_recent

COLS = ["app_number", "registration_date", "end_date", "transaction_type", "usage_", "contract_amount", "no_of_units"]
#: Records whose pages one landed file holds.
RECORDS_PER_FILE = 250_000


# -- O42 ---------------------------------------------------------------------
@demo("stream_ingest", """
SELECT app_number, registration_date, end_date, transaction_type, usage_, contract_amount, no_of_units
FROM (SELECT concat(l_orderkey, '-', l_linenumber) AS app_number,
        CAST(epoch(l_shipdate) AS BIGINT) AS registration_date,
        CAST(epoch(l_shipdate + INTERVAL 365 DAY) AS BIGINT) AS end_date,
        l_returnflag AS transaction_type, l_linestatus AS usage_,
        CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS contract_amount,
        CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS no_of_units,
        row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY date_trunc('month', l_shipdate) DESC, l_partkey DESC, l_suppkey DESC,
                                    l_shipdate DESC) AS rn
      FROM lineitem)
WHERE rn = 1""")
def stream_ingest_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rents pages land as files; the stream publishes them into a keyed
    table; reading the table equals the batch upsert of the same rows."""
    use_utc(spark)
    landed = scratch_path(spark, "landed")
    land_envelopes(envelope_pages(spark, sf_dir, "rents", terminator=True), landed)
    tbl = VersionedTable(spark, scratch_path(spark, "tables"), ["app_number"], n_buckets=16)
    q = stream_ingest(spark, f"{landed}/feed=rents", "rents", tbl, checkpoint=scratch_path(spark, "checkpoints"),
                      rejects_dir=scratch_path(spark, "rejects"), run_id="run-1", as_of="2024-05-01T08:00:00")
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return tbl.read().select(*COLS)


@demo("stream_until_empty", """
SELECT app_number, registration_date, contract_amount
FROM (SELECT concat(l_orderkey, '-', l_linenumber) AS app_number,
        CAST(epoch(l_shipdate) AS BIGINT) AS registration_date,
        CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS contract_amount,
        row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY date_trunc('month', l_shipdate) DESC, l_partkey DESC, l_suppkey DESC, l_shipdate DESC) AS rn
      FROM (SELECT *, (row_number() OVER (PARTITION BY date_trunc('month', l_shipdate)
              ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate) - 1) // 100 AS page FROM lineitem)
      WHERE page < 2 + month(l_shipdate) % 3)
WHERE rn = 1""")
def stream_until_empty_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rents pages land shuffled over files, in four micro-batches; every window
    has an empty page among them, after its second to fourth page, and what
    lies above it must not come in."""
    use_utc(spark)
    pages = envelope_pages(spark, sf_dir, "rents")
    last = 2 + F.month("window_start") % 3
    empty = pages.select("feed", "window_start").distinct().select(
        "feed", "window_start", last.cast("long").alias("page_no"),
        F.to_json(F.struct("feed", "window_start", last.alias("page_no"),
                           F.struct(F.array().cast("array<string>").alias("result")).alias("response"))).alias("value"))
    docs = pages.where(F.col("page_no") != last).unionByName(empty)
    landed = scratch_path(spark, "landed")
    # four micro-batches; a file holds what one task can, however large the table is
    files = -(-table(spark, sf_dir, FIXTURES["rents"].table).count() // (4 * RECORDS_PER_FILE)) or 1
    land_envelopes(docs.repartition(4 * files, F.xxhash64("value")), landed)
    tbl = VersionedTable(spark, scratch_path(spark, "tables"), ["app_number"], n_buckets=16)
    q = stream_until_empty(spark, f"{landed}/feed=rents", "rents", tbl, checkpoint=scratch_path(spark, "checkpoints"),
                           rejects_dir=scratch_path(spark, "rejects"), run_id="run-1", as_of="2024-05-01T08:00:00",
                           max_files_per_trigger=files)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return tbl.read().select("app_number", "registration_date", "contract_amount")


# -- O43 ---------------------------------------------------------------------
@demo("stream_dedupe", """
SELECT DISTINCT event_id, user_id, event_type, epoch_us(ts) AS ts_us FROM events""")
def stream_dedupe_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event delivered twice, one file per micro-batch; the stream keeps
    one copy of each."""
    use_utc(spark)
    events = table(spark, sf_dir, "events")
    src = scratch_path(spark, "stream-in")
    events.repartition(3, "user_id").write.parquet(src)
    events.repartition(2, "event_id").write.mode("append").parquet(src)  # the second delivery
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(src)
    seen = VersionedTable(spark, scratch_path(spark, "tables"), ["event_id"], n_buckets=16)
    q = stream_dedupe(stream, ["ts"], seen, scratch_path(spark, "checkpoints"))
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return seen.read().select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"))


# -- O43, bounded state --------------------------------------------------------
@demo("stream_dedupe_recent", """
WITH days AS (SELECT min(CAST(ts AS DATE)) AS first, max(CAST(ts AS DATE)) AS last FROM events)
SELECT 'kept' AS side, event_id, user_id, event_type, epoch_us(ts) AS ts_us FROM events
UNION ALL SELECT 'late', event_id, user_id, event_type, epoch_us(ts) FROM events, days
WHERE CAST(ts AS DATE) <= first + 1 AND first + 1 < last - 3""")
def stream_dedupe_recent_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of five days that share their boundary day land one after the
    other, each as one micro-batch; then the first two days land again, far
    behind the watermark. One copy of every event is kept, the stragglers are
    in the table of late rows."""
    use_utc(spark)
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    span = events.agg(F.min(F.to_date("ts")).alias("first"), F.max(F.to_date("ts")).alias("last")).first()
    src, day = scratch_path(spark, "stream-in"), F.to_date("ts")
    start = span.first
    while start <= span.last:  # a handful of windows
        end = start + dt.timedelta(days=5)
        events.where((day >= F.lit(start)) & (day <= F.lit(end))).coalesce(1).write.mode("append").parquet(src)
        start = end
    again = events.where((day <= F.lit(span.first + dt.timedelta(days=1))) & F.lit(span.first + dt.timedelta(days=1) < span.last - dt.timedelta(days=3)))
    again.coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(src)
    seen = VersionedTable(spark, scratch_path(spark, "tables"), ["event_id"], n_buckets=16)
    late = scratch_path(spark, "late")
    q = stream_dedupe_recent(stream, ["event_id"], "ts", "2 days", seen, late, scratch_path(spark, "checkpoints"), groups=64)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    sides = [("kept", seen.read()), ("late", spark.read.schema(seen.read().schema).parquet(late))]
    rows = [df.select(F.lit(side).alias("side"), "event_id", "user_id", "event_type", F.unix_micros("ts").alias("ts_us")) for side, df in sides]
    return rows[0].unionByName(rows[1])

"""Incremental ingest with Structured Streaming.

``stream_ingest`` (O42): landed page documents -> decode -> explode ->
reject malformed rows -> project -> stamp -> conform -> upsert into a
versioned table, one publish per micro-batch, the same row path as a batch
run (``plans.run.staged_rows``: decoded once, written once, split by verdict).
Exactly once: the file source tracks which files were read in the
checkpoint, and the table records the highest micro-batch id it committed for
the query, so a batch retried after a failure changes nothing; rejects go to
one folder per micro-batch, overwritten on retry.

``stream_until_empty`` also stops at a window's first empty page (O4), which
is a decision over all pages of a window while a stream sees them in pieces.
A keyed stateful operator sees the page index only (identity, record count,
file) and lets a page go once every page below it has come and none was
empty; a page above one that is missing waits. What it lets go is then read
from the landed files and decoded. Pages at or above an empty one are dropped.
If nothing more of a window comes for ``patience``, a timer takes what is
missing for never landed, as a batch run does, and the pages below the first
empty one go. Pages may land in any order and any split into micro-batches.

``stream_dedupe`` (O43): drop records delivered twice (adjacent windows
share a boundary day), exactly, against the keyed table; ``streaming.recent``
does so in bounded state. ``dedupe_recent`` is Spark's own form of that, for
streams whose late rows may be lost.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from feedyard.plans.run import ARRIVAL, page_index, staged_rows
from feedyard.session import use_utc
from feedyard.sinks.table import VersionedTable
from feedyard.sources.envelopes import index_envelopes, read_documents


def _documents(spark: SparkSession, in_dir: str, max_files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.load(in_dir)


def _started(writer, available_now: bool) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def stream_ingest(spark: SparkSession, in_dir: str, feed: str, table: VersionedTable, checkpoint: str,
                  rejects_dir: str, run_id: str, as_of: dt.datetime | str, available_now: bool = True,
                  max_files_per_trigger: int | None = None, query_name: str | None = None,
                  mode: str = "newest") -> StreamingQuery:
    """Start the ingest stream; returns the running query.

    With ``available_now`` the query processes what has landed and stops
    (``trigger(availableNow=True)``), which suits scheduled runs. ``mode``
    ``newest`` (default) keeps, per key, the row latest in arrival order
    (run, window, page, position) whatever micro-batch it came in; ``replace``
    lets a later micro-batch win, as the one-item-at-a-time source does.
    """
    use_utc(spark)
    landed = _documents(spark, in_dir, max_files_per_trigger)
    name = query_name or f"ingest_{feed}"

    def publish(batch: DataFrame, batch_id: int) -> None:
        ok, refused = staged_rows(batch, feed, run_id, as_of)
        table.publish(ok, order=list(ARRIVAL), mode=mode, stream_mark=(name, batch_id), keep_created=True)
        index = page_index(batch, feed)
        bad = index.where("bad_reason is not null").select("feed", "raw", F.col("bad_reason").alias("reason"))
        # one folder per micro-batch, overwritten on replay: idempotent
        refused.unionByName(bad).write.mode("overwrite").parquet(f"{rejects_dir}/batch_id={batch_id}")

    return _started(landed.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(publish), available_now)


# -- O42 with O4 ------------------------------------------------------------------
PAGE = "run string, window_start date, page_no long, path string, raw string, reason string"
HELD = "next long, stop long, open boolean, pages array<long>, paths array<string>"


def _release(first_page: int, patience_ms: int):
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now, stop, opened, pages, paths = state.get if state.exists else (first_page, None, False, [], [])
        held = list(zip(pages or [], paths or []))
        out = []
        for batch in batches:
            for page, n, path, raw, reason in zip(*(batch[c] for c in ("page_no", "n_records", "path", "raw", "bad_reason"))):
                if reason is not None:  # a bad document ends no window; it is only passed on
                    out.append((None, path, raw, reason))
                elif n == 0:
                    stop = int(page) if stop is None else min(stop, int(page))
                else:
                    held.append((int(page), path))
        opened = opened or state.hasTimedOut
        held = sorted(h for h in held if stop is None or h[0] < stop)
        waiting = []
        for page, path in held:
            if opened or page <= now:
                out.append((page, path, None, None))
                now = max(now, page + 1)
            else:
                waiting.append((page, path))
        state.update((now, stop, opened, [p for p, _ in waiting], [p for _, p in waiting]))
        if waiting:
            state.setTimeoutDuration(patience_ms)
        if out:
            page, path, raw, reason = zip(*out)
            yield pd.DataFrame({
                "run": [key[0]] * len(out), "window_start": [key[1]] * len(out), "page_no": pd.array(page, "Int64"),
                "path": path, "raw": raw, "reason": reason})

    return run


def stream_until_empty(spark: SparkSession, in_dir: str, feed: str, table: VersionedTable, checkpoint: str,
                       rejects_dir: str, run_id: str, as_of: dt.datetime | str, patience: dt.timedelta = dt.timedelta(hours=1),
                       first_page: int = 0, available_now: bool = True, max_files_per_trigger: int | None = None,
                       query_name: str | None = None, mode: str = "newest") -> StreamingQuery:
    """``stream_ingest`` that stops every (run, window) at its first empty page.

    Equals a batch run over the same documents where each page lands once;
    pages above a missing one follow when it lands, or with the first
    micro-batch after ``patience`` (with ``available_now``: the first that
    has data). A page that has been let go is not
    withdrawn if it lands again empty. The driver learns the names of the
    files that hold a micro-batch's pages, as the file source does.
    """
    use_utc(spark)
    name = query_name or f"until_empty_{feed}"
    landed = _documents(spark, in_dir, max_files_per_trigger).withColumn("path", F.col("_metadata.file_path"))
    index = index_envelopes(landed, feed, keep=("path",)).select(
        "run", "window_start", "page_no", F.col("n_records").cast("long").alias("n_records"), "path", "bad_reason",
        F.when(F.col("bad_reason").isNotNull(), F.col("value")).alias("raw"))
    pages = index.groupBy("run", "window_start").applyInPandasWithState(
        _release(int(first_page), int(patience / dt.timedelta(milliseconds=1))), PAGE, HELD, "append",
        GroupStateTimeout.ProcessingTimeTimeout)

    def publish(batch: DataFrame, batch_id: int) -> None:
        let_go = batch.persist()  # a few numbers a page; two actions follow
        try:
            good = let_go.where("reason is null")
            paths = [unquote(r.path) for r in good.select("path").distinct().collect()]
            rejects = let_go.where("reason is not null").select(F.lit(feed).alias("feed"), "raw", "reason")
            if paths:
                text = read_documents(spark, paths).withColumn("path", F.col("_metadata.file_path"))
                here = index_envelopes(text, feed, keep=("path",)).where("bad_reason is null")
                wanted = good.select(*[F.col(c).alias(f"_g_{c}") for c in ("run", "window_start", "page_no", "path")])
                same = F.lit(True)
                for c in ("run", "window_start", "page_no", "path"):
                    same = same & here[c].eqNullSafe(wanted[f"_g_{c}"])
                ok, refused = staged_rows(here.join(wanted, same, "left_semi"), feed, run_id, as_of)
                table.publish(ok, order=list(ARRIVAL), mode=mode, stream_mark=(name, batch_id), keep_created=True)
                rejects = rejects.unionByName(refused)
            rejects.write.mode("overwrite").parquet(f"{rejects_dir}/batch_id={batch_id}")
        finally:
            let_go.unpersist()

    # timers make Spark run micro-batches without data for ever, which a run
    # that is to end must not do: there they fire in the next one with data
    idle = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(idle)
    spark.conf.set(idle, str(not available_now).lower())
    try:
        return _started(pages.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(publish), available_now)
    finally:
        spark.conf.set(idle, before)  # the started query has its own copy


def stream_dedupe(df: DataFrame, order: Sequence[str], table: VersionedTable, checkpoint: str,
                  available_now: bool = True, query_name: str = "dedupe") -> StreamingQuery:
    """Keep the first delivery of every key, exactly, however late another
    comes and however the input is split into micro-batches: each micro-batch
    is published into ``table``, by its keys, with mode ``keep`` (insert if
    absent); ``order`` decides inside a micro-batch."""
    def publish(batch: DataFrame, batch_id: int) -> None:
        table.publish(batch, order=list(order), mode="keep", stream_mark=(query_name, batch_id))

    return _started(df.writeStream.queryName(query_name).option("checkpointLocation", checkpoint).foreachBatch(publish), available_now)


def dedupe_recent(df: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Drop duplicates of ``keys`` arriving within ``delay`` of each other, in
    state bounded by the delay.

    The event-time column is cast to ``TIMESTAMP`` (watermarks reject
    ``TIMESTAMP_NTZ``). Rows behind the watermark are not passed on: use this
    where lateness is known to stay below ``delay``, else ``stream_dedupe``.
    """
    with_time = df.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return with_time.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))

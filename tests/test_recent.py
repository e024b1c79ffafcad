"""Bounded-state de-duplication of streams (O43)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedyard.session import scratch_path
from feedyard.sinks.table import VersionedTable
from feedyard.streaming.recent import split_recent, stream_dedupe_recent

SCHEMA = "id long, at timestamp, what string"
DAY0 = dt.datetime(2024, 1, 1)


def deliver(spark, batches, delay="2 days", groups=8):
    """One file per micro-batch; the kept rows, the late rows, the checkpoint."""
    src, ckpt, late = (scratch_path(spark, f"test-{x}") for x in ("in", "ckpt", "late"))
    for rows in batches:
        spark.createDataFrame([(i, None if d is None else DAY0 + dt.timedelta(days=d), w) for i, d, w in rows], SCHEMA).coalesce(1) \
            .write.mode("append").parquet(src)
    table = VersionedTable(spark, scratch_path(spark, "test-recent"), ["id", "at", "what"], n_buckets=4)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    q = stream_dedupe_recent(stream, ["id"], "at", delay, table, late, ckpt, groups=groups)
    q.awaitTermination()
    assert q.exception() is None

    def told(df):
        return sorted(((r.id, None if r["at"] is None else (r["at"] - DAY0) / dt.timedelta(days=1), r.what) for r in df.collect()), key=str)

    kept = table.read()
    return told(kept) if kept is not None else [], told(spark.read.schema(SCHEMA).parquet(late)), ckpt, q


def test_first_deliveries_and_late_rows(spark):
    kept, late, *_ = deliver(spark, [
        [(1, 0, "a"), (2, 1, "a"), (2, 1, "b"), (None, 1, "null")],  # a tie inside a batch
        [(2, 1, "again"), (3, 4, "a"), (None, 1, "null again")],
        # the watermark is now day 2: what lies before it is late, known or not
        [(1, 0, "late"), (9, 1.5, "late"), (3, 4, "again"), (4, 2, "on the mark")],
        [(5, 9, "a")],
        # day 7: key 3 (day 4, kept until day 6) is forgotten
        [(3, 8, "a new delivery"), (None, None, "no time")],
    ])
    assert [r for r in kept if r[0] != 2] == sorted([
        (1, 0, "a"), (None, 1, "null"), (3, 4, "a"), (4, 2, "on the mark"), (5, 9, "a"), (3, 8, "a new delivery")], key=str)
    assert len([r for r in kept if r[0] == 2]) == 1
    assert late == sorted([(1, 0, "late"), (9, 1.5, "late"), (None, None, "no time")], key=str)


def test_state_is_bounded(spark):
    """Forty days of new keys, each delivered twice. At the last micro-batch
    the watermark is three days behind its newest key, and keys are forgotten
    two days after their own time: six days' keys are left of forty."""
    per_day = 30
    batches = [[(d * per_day + k, d, "x") for d in (b - 1, b) if d >= 0 for k in range(per_day)] for b in range(0, 40, 1)]
    kept, late, ckpt, q = deliver(spark, batches, groups=4)
    assert len(kept) == 40 * per_day and not late
    state = spark.read.format("statestore").load(ckpt)
    sizes = state.select(F.size("value.groupState.first").alias("n")).agg(F.sum("n").alias("n"), F.count("*").alias("groups")).first()
    assert sizes.groups <= 4
    assert 2 * per_day <= sizes.n <= 6 * per_day  # of 1,200 keys
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4


def test_helper_names_are_refused(spark):
    df = spark.createDataFrame([(1, DAY0, 2)], "id long, at timestamp, _group int")
    with pytest.raises(ValueError):
        split_recent(df, ["id"], "at", "1 day")

"""Steps whose data must not grow in one place: the driver, one task, or shuffles that add nothing."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from feedyard.operators import paging
from feedyard.operators.paging import row_numbers
from feedyard.operators.windows import assign_windows, unassigned
from feedyard.session import scratch_path
from feedyard.sinks import table as sink
from feedyard.sinks.table import VersionedTable
from feedyard.sources.envelopes import land_envelopes, read_documents


@pytest.fixture
def no_broadcast(spark):
    """Tables too large for a broadcast that Spark chooses itself."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_many_cells_are_not_broadcast(spark):
    """A few bytes of windows become many cells, which Spark does not foresee."""
    windows = spark.range(3000).select(
        F.col("id").alias("g"), F.date_add(F.lit("2020-01-02").cast("date"), (F.col("id") % 30).cast("int")).alias("window_start"),
        F.lit("2024-03-05").cast("date").alias("window_end"), F.lit(False).alias("is_last"))
    recs = spark.range(6000).select("id", (F.col("id") % 3000).alias("g"), F.date_add(F.lit("2019-12-20").cast("date"), (F.col("id") % 50).cast("int")).alias("d"))
    hit = assign_windows(recs, "d", windows, ["g"])
    assert "BroadcastHashJoin" not in plan_of(hit)
    start = {r.g: r.window_start for r in windows.collect()}
    rows = recs.collect()
    want = sorted(r.id for r in rows if r.d >= start[r.g])
    assert sorted(r.id for r in hit.collect()) == want and 0 < len(want) < 6000
    assert sorted(r.id for r in unassigned(recs, "d", windows, ["g"]).collect()) == sorted({r.id for r in rows} - set(want))
    # few cells are still sent to the records
    few = assign_windows(recs, "d", windows.where("g < 3"), ["g"])
    assert "BroadcastHashJoin" in plan_of(few)


@pytest.mark.parametrize("parts", [None, 5])
def test_row_numbers_move_what_is_wanted_once(spark, no_broadcast, parts):
    rows = spark.range(400).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 400).alias("o"), F.col("id").alias("v"),
                                   F.lit("x").alias("unused"))
    rows = rows.withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    got = row_numbers(rows, ["g"], [F.col("o")], num_partitions=parts, keep=["v"])
    assert got.columns == ["g", "v", "rn"]
    want = {}
    for g in (None, 1, 2):
        for n, (_, v) in enumerate(sorted((r.o, r.v) for r in rows.collect() if r.g == g), start=1):
            want[v] = (g, n)
    assert {r.v: (r.g, r.rn) for r in got.collect()} == want
    if parts:
        assert "BroadcastHashJoin" in plan_of(got) and "SortMergeJoin" not in plan_of(got)
        assert spark.read.parquet(*got.inputFiles()).columns == ["g", "v", "_pid", "_idx"]
        every = row_numbers(rows, ["g"], ["o"], num_partitions=parts)  # without keep all columns stay
        assert sorted(every.columns) == ["g", "o", "rn", "unused", "v"]
        assert {r.v: (r.g, r.rn) for r in every.collect()} == want


def test_many_groups_are_not_broadcast(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(paging, "FEW_COUNTS", 10)
    got = row_numbers(spark.range(100).select("id", (F.col("id") % 50).alias("g")), ["g"], ["id"], num_partitions=3)
    assert "BroadcastHashJoin" not in plan_of(got)
    assert sorted((r.g, r.rn) for r in got.collect()) == [(g, n) for g in range(50) for n in (1, 2)]


def test_a_written_bucket_is_not_shuffled(spark):
    """Every task writes its own share of each bucket."""
    table = VersionedTable(spark, scratch_path(spark, "test-scale"), ["k"], n_buckets=2)
    rows = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("k"), F.lit("v").alias("v"))
    table.publish(rows, mode="append")
    files = table.read().inputFiles()
    assert len([f for f in files if "_bucket=0/" in f]) == 4 and len([f for f in files if "_bucket=-1/" in f]) == 4
    table.publish(spark.createDataFrame([(1, "new")], "k long, v string"), order=["v"])
    table.rebucket(3)
    got = sorted((r.k, r.v) for r in table.read().where("k is not null").collect())
    assert got == [(k, "new" if k == 1 else "v") for k in range(1000) if k % 10] and table.read().where("k is null").count() == 100


@pytest.mark.parametrize("few", [0, 100])
@pytest.mark.parametrize("created", [False, True])
def test_merged_tables_are_not_broadcast(spark, monkeypatch, few, created):
    """Compressed files tell little of the rows in them: stored keys never go through the driver, a batch's only if they were counted."""
    monkeypatch.setattr(sink, "FEW_KEYS", few)
    plans, write = [], VersionedTable._write
    monkeypatch.setattr(VersionedTable, "_write", lambda self, rows, *a, **k: plans.append(plan_of(rows)) or write(self, rows, *a, **k))
    key, at = F.when(F.col("id") % 10 > 0, F.col("id")).alias("k"), [dt.datetime(2024, 1, n) for n in (1, 2, 3)]

    def rows(lo, hi, said, n):
        return spark.range(lo, hi).select(key, F.lit(said).alias("v"), *([F.lit(at[n]).alias("created_at")] if created else []))

    table = VersionedTable(spark, scratch_path(spark, "test-scale"), ["k"], n_buckets=4)
    table.publish(rows(0, 200, "old", 0), order=["v"], keep_created=created)
    table.merge(rows(150, 210, "new", 1), order=["v"])
    table.merge(rows(180, 220, "kept", 2), order=["v"], mode="keep")
    assert len(plans) == 3
    for plan in [*plans, plan_of(table.read())]:
        # the stored side is never built: of both merges only the batch's keys are, where they are few
        assert ("BroadcastHashJoin" in plan) == (few > 0 and plan in plans[1:])
    want = {k: ("old", 0) if k < 150 else ("new", 0 if k < 200 else 1) if k < 210 else ("kept", 2) for k in range(220) if k % 10}
    got = table.read().collect()
    assert {r.k: (r.v, at.index(r.created_at)) if created else (r.v, want[r.k][1]) for r in got if r.k is not None} == want
    assert len([r for r in got if r.k is not None]) == len(want)
    assert sorted(r.v for r in got if r.k is None) == ["kept"] * 4 + ["new"] * 6 + ["old"] * 20


def document(window, n, numbers):
    return json.dumps({"feed": "developers", "run": None, "window_start": window, "page_no": n,
                       "response": {"result": [{"DEVELOPER_NUMBER": str(x)} for x in numbers]}})


def test_documents_meet_their_stops_without_a_shuffle(spark, no_broadcast, monkeypatch):
    from feedyard.plans import run
    docs = [document("2024-01-01", 0, [1]), document("2024-01-01", 1, []), document("2024-01-01", 2, [2]), document("2024-02-01", 5, [3]),
            document(None, 0, [4]), document(None, 1, []), document(None, 2, [5])]
    pages = spark.createDataFrame([("developers", d) for d in docs], "feed string, value string")
    landed = land_envelopes(pages, scratch_path(spark, "test-landed"))
    plans, staged = [], run.staged_rows
    monkeypatch.setattr(run, "staged_rows", lambda documents, *a: plans.append(plan_of(documents)) or staged(documents, *a))
    table = run.WideTable(spark, scratch_path(spark, "test-scale"), n_buckets=2)
    run.ingest_run(spark, landed, table, "r1", dt.datetime(2024, 5, 1), scratch_path(spark, "rejects"))
    assert sorted(r.developer_number for r in table.read().collect()) == ["1", "3", "4"]
    assert len(plans) == 1 and "BroadcastHashJoin" in plans[0] and "SortMergeJoin" not in plans[0]


def test_landed_documents_are_compressed(spark):
    docs = [document("2024-01-01", n, range(100)) for n in range(20)]
    landed = land_envelopes(spark.createDataFrame([("developers", d) for d in docs], "feed string, value string"), scratch_path(spark, "test-landed"))
    text = read_documents(spark, f"{landed}/feed=developers")
    assert all(f.endswith(".gz") for f in text.inputFiles())
    assert sorted(r.value for r in text.collect()) == sorted(docs)


def test_landed_files_grow_in_number(spark, monkeypatch):
    """A larger table lands in more files, in as many micro-batches."""
    from conftest import SF_SMALL
    from feedyard.demos import streams
    landed, started = [], []
    land, start = streams.land_envelopes, streams.stream_until_empty
    monkeypatch.setattr(streams, "land_envelopes", lambda docs, path: landed.append(docs.rdd.getNumPartitions()) or land(docs, path))
    monkeypatch.setattr(streams, "stream_until_empty", lambda *a, **k: started.append(k["max_files_per_trigger"]) or start(*a, **k))
    plain = sorted(map(tuple, streams.stream_until_empty_demo(spark, SF_SMALL).collect()))
    monkeypatch.setattr(streams, "RECORDS_PER_FILE", 500)
    assert sorted(map(tuple, streams.stream_until_empty_demo(spark, SF_SMALL).collect())) == plain
    n = -(-spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count() // 2000)
    assert n > 1 and landed == [4, 4 * n] and started == [1, n]

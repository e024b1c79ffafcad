"""Stop at the first empty page while pages stream in (O42 with O4), the page
index and the single staged write of an ingest."""

from __future__ import annotations

import datetime as dt
import json
import random
import time

from pyspark.sql import functions as F

from feedyard.operators.paging import take_until_empty
from feedyard.plans.run import page_index, staged_rows
from feedyard.session import scratch_path
from feedyard.sinks.table import VersionedTable
from feedyard.sources.envelopes import explode_envelope, index_envelopes, parse_envelopes, read_documents
from feedyard.streaming.ingest import stream_until_empty

FEED = "developers"  # keyed by developer_number


def page(window, n, numbers, run="r1"):
    return json.dumps({"feed": FEED, "run": run, "window_start": window, "page_no": n,
                       "response": {"result": [{"DEVELOPER_NUMBER": str(x)} for x in numbers]}})


def land(spark, files, folder=None):
    """One file per list of documents, in order."""
    folder = folder or scratch_path(spark, "test-landed")
    for docs in files:
        spark.createDataFrame([(d,) for d in docs], "value string").coalesce(1).write.mode("append").text(folder)
    return folder


def run_stream(spark, folder, table, ckpt, rejects, patience=dt.timedelta(hours=1)):
    q = stream_until_empty(spark, folder, FEED, table, ckpt, rejects, "run", "2024-05-01T00:00:00", patience=patience,
                           max_files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None
    rows = table.read()
    return set() if rows is None else {r.developer_number for r in rows.collect()}


def new_places(spark):
    return VersionedTable(spark, scratch_path(spark, "test-until"), ["developer_number"], n_buckets=2), scratch_path(spark, "ckpt"), scratch_path(spark, "rejects")


def test_shuffled_pages_equal_the_batch_run(spark):
    rnd = random.Random(5)
    docs = []
    for w, (pages, empty) in enumerate([(5, 3), (4, None), (3, 0), (6, 5), (2, 2)]):
        for n in range(pages):
            if n != empty:
                docs.append(page(f"2024-0{w + 1}-01", n, [1000 * w + 10 * n + k for k in range(3)]))
        if empty is not None:
            docs.append(page(f"2024-0{w + 1}-01", empty, []))
    docs += [page(None, n, [9000 + n]) for n in range(3)] + ["<html>", page("soon", 1, [1])]
    rnd.shuffle(docs)
    folder = land(spark, [docs[k::4] for k in range(4)])
    table, ckpt, rejects = new_places(spark)
    got = run_stream(spark, folder, table, ckpt, rejects)
    whole = parse_envelopes(read_documents(spark, folder), FEED)
    kept = take_until_empty(whole.where("bad_reason is null"), by=("feed", "run", "window_start"))
    want = {r.DEVELOPER_NUMBER for r in explode_envelope(kept).select("DEVELOPER_NUMBER").collect()}
    assert got == want and "3020" in want and "0" in want and "30" not in want
    assert sorted(r.reason for r in spark.read.parquet(rejects).collect()) == ["bad window_start <soon>", "malformed page document"]


def test_a_gap_waits_for_its_page_or_for_patience(spark):
    table, ckpt, rejects = new_places(spark)
    folder = land(spark, [[page("2024-01-01", 0, [0]), page("2024-01-01", 2, [2]), page("2024-02-01", 1, [101]), page("2024-02-01", 3, [103])]])
    assert run_stream(spark, folder, table, ckpt, rejects, dt.timedelta(seconds=1)) == {"0"}
    # the missing page of January comes; February's never does
    land(spark, [[page("2024-01-01", 1, [1])]], folder)
    time.sleep(1.5)
    first = run_stream(spark, folder, table, ckpt, rejects, dt.timedelta(seconds=1))
    assert {"0", "1", "2"} <= first
    time.sleep(1.5)
    land(spark, [[page("2024-03-01", 0, [200]), page("2024-02-01", 2, [])]], folder)
    # patience is over: page 1 goes; the empty page still keeps page 3 out
    # unless its timer fired before
    last = run_stream(spark, folder, table, ckpt, rejects, dt.timedelta(seconds=1))
    assert {"0", "1", "2", "101", "200"} <= last


def test_an_empty_page_drops_what_waits_above_it(spark):
    table, ckpt, rejects = new_places(spark)
    folder = land(spark, [[page("2024-01-01", 2, [2]), page("2024-01-01", 3, [3])], [page("2024-01-01", 1, [])], [page("2024-01-01", 0, [0])],
                          [page("2024-01-01", 4, [4])]])
    assert run_stream(spark, folder, table, ckpt, rejects) == {"0"}


def test_the_index_builds_no_records(spark):
    docs = [page("2024-01-01", 0, [1, 2]), page("2024-01-01", 1, []), '{"feed":"developers","page_no":2,"error":"x"}', "<html>",
            '{"feed":"developers","page_no":3,"response":{"result":[{"DEVELOPER_NUMBER":"5"}', page("soon", 4, [1])]
    text = spark.createDataFrame([(d,) for d in docs], "value string")
    index, full = index_envelopes(text, FEED), parse_envelopes(text, FEED)
    columns = ["feed", "run", "window_start", "page_no", "n_records", "bad_reason"]
    assert sorted(map(str, index.select(columns).collect())) == sorted(map(str, full.select(columns).collect()))
    assert "DEVELOPER_NUMBER" not in index._jdf.queryExecution().executedPlan().toString()
    kept = page_index(text, FEED)
    assert kept.where("raw is not null").count() == 4 and set(kept.columns) == {*columns, "raw"}


def test_rows_are_decoded_and_written_once(spark):
    text = spark.createDataFrame([(page("2024-01-01", 0, [1, 2]),), (page("2024-01-01", 1, ["x" * 300, 4]),)], "value string")
    ok, refused = staged_rows(text, FEED, "run", "2024-05-01T00:00:00")
    for part in (ok, refused):  # both read what was written; nothing is decoded again
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "from_json" not in plan and "FileScan parquet" in plan
    assert sorted(r.developer_number for r in ok.collect()) == ["1", "2", "4"]
    bad = refused.collect()
    assert len(bad) == 1 and bad[0].reason.startswith("developer_number: length 300") and "x" * 300 in bad[0].raw
    assert not [k for k in ok.columns if k.startswith("_") and k != "_tid"]

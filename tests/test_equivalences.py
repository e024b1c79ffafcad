"""Equivalences between operators."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from feedyard.demos import feeds, sinks
from feedyard.operators.paging import assign_pages, page_slice, row_numbers
from feedyard.operators.project import project_feed
from feedyard.operators.upsert import upsert
from feedyard.session import scratch_path
from feedyard.sinks.table import VersionedTable
from feedyard.sources.envelopes import build_envelopes, explode_envelope, land_envelopes, read_envelopes
from feedyard.sources.fixtures import feed_records, order_columns, table


def _rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((v is not None, v if v is not None else "") for v in t))


def test_round_trip_through_landed_files(spark):
    """table -> envelopes -> files -> O1 -> O2 -> O12 equals the in-memory path."""
    path = scratch_path(spark, "test-landed")
    land_envelopes(feeds.envelope_pages(spark, SF_SMALL, "brokers", terminator=True), path)
    from_files = project_feed(explode_envelope(read_envelopes(spark, f"{path}/feed=brokers", "brokers")), "brokers")
    direct = feeds.projected(spark, SF_SMALL, "brokers")
    cols = ["broker_number", "broker_name", "gender_", "real_estate_number", "page_no", "position"]
    assert _rows(from_files, cols) == _rows(direct, cols)


def test_malformed_document_is_isolated(spark):
    good = feeds.envelope_pages(spark, SF_SMALL, "developers").select("value")
    bad = spark.createDataFrame([('{"feed": "developers", "response": {"result": [',)], "value string")
    from feedyard.sources.envelopes import bad_envelopes, parse_envelopes
    pages = parse_envelopes(good.unionByName(bad), "developers")
    assert bad_envelopes(pages).count() == 1
    assert explode_envelope(pages).count() == table(spark, SF_SMALL, "supplier").count()


def test_page_k_equals_page_slice(spark):
    li = table(spark, SF_SMALL, "orders")
    paged = assign_pages(li, by=None, order=["o_orderkey"], size=100)
    k = 3
    from_pages = sorted(r.o_orderkey for r in paged.filter(F.col("page_no") == k).collect())
    sliced = sorted(r.o_orderkey for r in page_slice(li, ["o_orderkey"], skip=100 * k, take=100).collect())
    assert from_pages == sliced


import pytest  # noqa: E402


@pytest.mark.parametrize("partitions", [1, 5, 40])
def test_row_numbers_agree_with_a_window(spark, partitions):
    """Range path (0 / None) and window path (large bound) give the same numbers."""
    li = table(spark, SF_SMALL, "lineitem").withColumn("g", F.col("l_orderkey") % 3)
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    rn = row_numbers(li, ["g"], order, num_partitions=partitions)
    stats = rn.groupBy("g").agg(F.count("*").alias("n"), F.min("rn").alias("lo"), F.max("rn").alias("hi"),
                                F.count_distinct("rn").alias("d")).collect()
    for s in stats:
        assert (s.lo, s.hi, s.d) == (1, s.n, s.n)
    from pyspark.sql import Window
    ref = li.withColumn("ref", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    joined = rn.join(ref.select(*order, "ref"), on=order)
    assert joined.filter(F.col("rn") != F.col("ref")).count() == 0
    assert joined.count() == li.count()


def test_write_then_read_equals_upsert_and_replay_is_noop(spark):
    t, b = sinks.target_and_batch(spark, SF_SMALL)
    expected = _rows(upsert(t, b, sinks.KEYS, sinks.ORDER), sinks.COLS)
    tbl = VersionedTable(spark, scratch_path(spark, "test-table"), sinks.KEYS, n_buckets=4)
    assert tbl.publish(t, mode="append", batch_id="a") == 1
    assert tbl.publish(b, order=sinks.ORDER, batch_id="b") == 2
    assert tbl.publish(b, order=sinks.ORDER, batch_id="b") == 2  # replay: no new version
    assert _rows(tbl.read(), sinks.COLS) == expected
    assert _rows(tbl.read(version=1), sinks.COLS) == _rows(t, sinks.COLS)  # old versions stay readable


def test_stream_equals_batch(spark):
    from feedyard.demos.streams import stream_ingest_demo
    streamed = stream_ingest_demo(spark, SF_SMALL)
    rows = feeds.projected(spark, SF_SMALL, "rents")
    batch = upsert(rows.limit(0), rows, ["app_number"], ["window_start", "page_no", "position"])
    assert _rows(streamed, sinks.COLS) == _rows(batch, sinks.COLS)


def test_envelope_pages_hold_at_most_page_size(spark):
    recs = feed_records(spark, SF_SMALL, "valuations")
    pages = build_envelopes(recs, "valuations", order_columns("valuations"), size=7)
    from feedyard.sources.envelopes import parse_envelopes
    sizes = parse_envelopes(pages, "valuations").agg(F.max("n_records").alias("m"), F.sum("n_records").alias("s")).first()
    assert sizes.m == 7
    assert sizes.s == table(spark, SF_SMALL, "lineitem").count()


def test_stream_in_many_micro_batches_equals_batch(spark):
    """One file per micro-batch: per key the row latest in arrival order wins,
    however the pages were split across micro-batches."""
    from feedyard.streaming.ingest import stream_ingest
    landed = scratch_path(spark, "test-landed")
    pages = feeds.envelope_pages(spark, SF_SMALL, "rents").repartition(6)
    land_envelopes(pages, landed)
    tbl = VersionedTable(spark, scratch_path(spark, "test-table"), ["app_number"], n_buckets=4)
    q = stream_ingest(spark, f"{landed}/feed=rents", "rents", tbl, checkpoint=scratch_path(spark, "test-ckpt"),
                      rejects_dir=scratch_path(spark, "test-rejects"), run_id="r", as_of="2024-05-01T00:00:00",
                      max_files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None
    assert len(tbl.versions()) > 1
    rows = feeds.projected(spark, SF_SMALL, "rents")
    batch = upsert(rows.limit(0), rows, ["app_number"], ["window_start", "page_no", "position"])
    assert _rows(tbl.read(), sinks.COLS) == _rows(batch, sinks.COLS)


def test_publish_after_a_failed_attempt(spark):
    """A publish that died after writing (orphan folder, no commit) neither
    blocks the retry nor leaks into reads; a second commit of the same
    version is refused."""
    import os

    import pytest as _pytest
    t, b = sinks.target_and_batch(spark, SF_SMALL)
    root = scratch_path(spark, "test-table")
    tbl = VersionedTable(spark, root, sinks.KEYS, n_buckets=4)
    tbl.publish(t, mode="append", batch_id="a")
    orphan = os.path.join(root, "v=2-deadbeef", "_bucket=0")
    os.makedirs(orphan)
    b.limit(5).write.parquet(os.path.join(orphan, "junk"))
    assert tbl.publish(b, order=sinks.ORDER, batch_id="b") == 2
    assert _rows(tbl.read(), sinks.COLS) == _rows(upsert(t, b, sinks.KEYS, sinks.ORDER), sinks.COLS)
    with _pytest.raises(RuntimeError):
        tbl._fs.commit_text(f"{root}/_commits/{2:012d}.json", "{}")


def test_stream_mark_skips_replayed_micro_batches(spark):
    t, b = sinks.target_and_batch(spark, SF_SMALL)
    tbl = VersionedTable(spark, scratch_path(spark, "test-table"), sinks.KEYS, n_buckets=4)
    assert tbl.publish(t, order=sinks.ORDER, stream_mark=("q", 0)) == 1
    assert tbl.publish(b, order=sinks.ORDER, stream_mark=("q", 0)) == 1  # replay of micro-batch 0
    assert tbl.publish(b, order=sinks.ORDER, stream_mark=("q", 1)) == 2
    assert tbl.manifest()["stream_marks"] == {"q": 1}


def test_bare_service_bodies_take_identity_from_the_path(spark):
    """Pages landed as the service's own body ({"response": ...} only), one
    file per page under window_start=/page_no= folders, read back whole."""
    import os
    root = scratch_path(spark, "test-bare")
    docs = feeds.envelope_pages(spark, SF_SMALL, "developers").collect()
    for d in docs:
        folder = os.path.join(root, f"window_start={d.window_start or '__HIVE_DEFAULT_PARTITION__'}",
                              f"page_no={d.page_no}")
        os.makedirs(folder)
        body = d.value[d.value.index('"response"'):]
        with open(os.path.join(folder, "page.json"), "w") as fh:
            fh.write("{" + body)
    rows = explode_envelope(read_envelopes(spark, root, "developers", whole_file=True))
    direct = feeds.feed_rows(spark, SF_SMALL, "developers")
    cols = ["DEVELOPER_NUMBER", "DEVELOPER_EN", "LICENSE_SOURCE_EN", "page_no", "position"]
    assert _rows(rows, cols) == _rows(direct, cols)


def test_first_of_many_batch_ids_is_remembered(spark):
    """A replay is a no-op however many batches came after it."""
    t, b = sinks.target_and_batch(spark, SF_SMALL)
    tbl = VersionedTable(spark, scratch_path(spark, "test-table"), sinks.KEYS, n_buckets=4)
    tbl.publish(t, mode="append", batch_id="first")
    for k in range(1500):
        tbl._fs.touch(tbl._marker(f"batch-{k}"))
    v = tbl.publish(b, order=sinks.ORDER, batch_id="second")
    assert tbl.publish(t, order=sinks.ORDER, batch_id="first") == v
    assert tbl.publish(b, order=sinks.ORDER, batch_id="batch-0") == v


def test_marker_of_a_publish_cut_short_is_made_up(spark):
    t, b = sinks.target_and_batch(spark, SF_SMALL)
    tbl = VersionedTable(spark, scratch_path(spark, "test-table"), sinks.KEYS, n_buckets=4)
    tbl.publish(t, mode="append", batch_id="a")
    tbl._fs.delete(tbl._marker("a"))  # as if the driver died right after the commit
    assert tbl.publish(t, order=sinks.ORDER, batch_id="a") == 1
    assert tbl.has_batch("a")


def test_bucket_count_and_keys_belong_to_the_table(spark):
    t, b = sinks.target_and_batch(spark, SF_SMALL)
    root = scratch_path(spark, "test-table")
    VersionedTable(spark, root, sinks.KEYS, n_buckets=4).publish(t, mode="append")
    with pytest.raises(ValueError):
        VersionedTable(spark, root, sinks.KEYS, n_buckets=16).publish(b, order=sinks.ORDER)
    with pytest.raises(ValueError):
        VersionedTable(spark, root, ["usage_"], n_buckets=4).read()
    with pytest.raises(ValueError):
        VersionedTable(spark, root, sinks.KEYS, n_buckets=4).publish(b, order=sinks.ORDER, mode="newest")
    tbl = VersionedTable(spark, root, sinks.KEYS, n_buckets=4)
    for n in (16, 4):
        tbl.rebucket(n)
        assert _rows(tbl.read(), sinks.COLS) == _rows(t, sinks.COLS)


def test_modes_fold_like_sequential_upserts(spark):
    """Deltas read back equal the batches applied one after the other."""
    li = table(spark, SF_SMALL, "lineitem").select((F.col("l_orderkey") % 40).alias("k"), F.col("l_partkey").alias("v"), F.col("l_linenumber").alias("o"))
    parts = [li.where(F.col("v") % 5 == p).where(F.col("k") % (p + 2) != 0) for p in range(5)]
    tbl = VersionedTable(spark, scratch_path(spark, "test-table"), ["k"], n_buckets=3)
    state = li.limit(0)
    for p, (part, mode) in enumerate(zip(parts, ["replace", "keep", "replace", "keep", "replace"])):
        tbl.publish(part, order=["o", "v"], mode=mode)
        state = upsert(state, part, ["k"], ["o", "v"], mode=mode)
        if p == 2:
            tbl.compact()
    assert _rows(tbl.read(), ["k", "v", "o"]) == _rows(state, ["k", "v", "o"])
    tbl.compact()
    tbl.expire(keep=1)
    assert tbl.versions() == tbl.versions()[-1:]
    assert _rows(tbl.read(), ["k", "v", "o"]) == _rows(state, ["k", "v", "o"])


def test_own_statement_in_the_sink(spark):
    t, b = sinks.target_and_batch(spark, SF_SMALL)
    tbl = VersionedTable(spark, scratch_path(spark, "test-table"), sinks.KEYS, n_buckets=4)
    tbl.publish(t, mode="append")
    tbl.run_statement("SELECT * FROM {target} WHERE usage_ = :u UNION ALL SELECT * FROM {batch}", b, {"u": "F"}, batch_id="s")
    assert _rows(tbl.read(), sinks.COLS) == _rows(t.where("usage_ = 'F'").unionByName(b), sinks.COLS)
    assert tbl.has_batch("s")


def test_deep_pages_equal_sorted_pages(spark):
    """A page found by counted ranges is the page of the whole sorted table,
    at any depth and page size, and no sort holds the skipped rows."""
    li = table(spark, SF_SMALL, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    order = ["l_partkey", "l_orderkey", "l_linenumber"]
    rows = sorted(tuple(r) for r in li.select(*order).collect())
    for skip, take in ((0, 10), (17, 100), (len(rows) // 2, 900), (len(rows) - 5, 100), (len(rows) + 1, 10), (5, 0)):
        page = page_slice(li, order, skip=skip, take=take, num_partitions=7, top_rows=0)
        assert [tuple(r) for r in page.select(*order).collect()] == rows[skip:skip + take]
        assert "TakeOrderedAndProject" not in page._jdf.queryExecution().executedPlan().toString()
    assert page_slice(li.limit(0), order, skip=3, take=2, top_rows=0).count() == 0
    with pytest.raises(ValueError):
        page_slice(li.withColumnRenamed("l_partkey", "_pid"), ["_pid"], skip=3, take=2, top_rows=0)

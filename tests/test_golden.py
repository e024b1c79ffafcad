"""Hand-traced cases for the helpers (SURVEY Appendix D)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedyard.functions import dates as D
from feedyard.functions.text import clean_list, flatten_whitespace, parse_taxonomy
from feedyard.operators.paging import resolve_attempts, take_until_empty
from feedyard.operators.upsert import reject_duplicates, upsert

d = dt.date


def _windows(spark, start, end):
    df = spark.createDataFrame([(start, end)], "s date, e date")
    rows = df.select(F.inline(D.month_windows("s", "e"))).collect()
    if not rows:
        return []
    return [r.window_start for r in rows] + [rows[-1].window_end]


@pytest.mark.parametrize("start,end,expected", [
    (d(2024, 1, 1), d(2024, 3, 20), [d(2024, 1, 1), d(2024, 2, 1), d(2024, 3, 1), d(2024, 3, 20)]),
    (d(2024, 3, 15), d(2024, 5, 20), [d(2024, 3, 15), d(2024, 4, 1), d(2024, 5, 1), d(2024, 5, 20)]),
    (d(2024, 5, 5), d(2024, 5, 20), [d(2024, 5, 5), d(2024, 5, 20)]),
    (d(2024, 4, 10), d(2024, 5, 1), [d(2024, 4, 10), d(2024, 5, 1)]),
    (d(2023, 11, 10), d(2024, 2, 5), [d(2023, 11, 10), d(2023, 12, 1), d(2024, 1, 1), d(2024, 2, 1), d(2024, 2, 5)]),
    (d(2023, 1, 15), d(2024, 1, 20), [d(2023, 1, 15)] + [d(2023, m, 1) for m in range(2, 13)] + [d(2024, 1, 1), d(2024, 1, 20)]),
    (d(2023, 3, 15), d(2024, 3, 20), [d(2023, 3, 15)] + [d(2023, m, 1) for m in range(4, 13)] + [d(2024, m, 1) for m in (1, 2, 3)] + [d(2024, 3, 20)]),
    (d(2024, 5, 20), d(2024, 5, 20), []),
    (d(2024, 6, 1), d(2024, 5, 20), []),
])
def test_month_windows(spark, start, end, expected):
    assert _windows(spark, start, end) == expected


def test_month_windows_last_is_closed(spark):
    df = spark.createDataFrame([(d(2024, 1, 10), d(2024, 3, 5))], "s date, e date")
    flags = [r.is_last for r in df.select(F.inline(D.month_windows("s", "e"))).collect()]
    assert flags == [False, False, True]


def test_iso_to_epoch(spark):
    df = spark.createDataFrame([("2024-01-31T10:20:30",), (None,), ("",), ("bad",)], "v string")
    rows = df.select(D.iso_to_epoch("v").alias("e"), D.iso_is_malformed("v").alias("m")).collect()
    assert [(r.e, r.m) for r in rows] == [(1706696430, False), (0, False), (0, False), (None, True)]


def test_usual_iso_text_reads_as_the_format_does(spark):
    """The cast that usual text takes agrees with the formatter, and no other text takes it."""
    import itertools
    texts = [f"{y}-{m}-{d}T{t}" for y, m, d, t in itertools.product(
        ("0000", "0001", "1582", "1900", "2000", "2023", "9999"), ("00", "02", "10", "13"), ("00", "01", "10", "29", "30", "32"),
        ("00:00:00", "23:59:59", "24:00:00", "10:60:00", "10:00:60"))]
    texts += ["2024-01-01T00:00:0Z", "2024-01-01T00:00:5.", "2024-01-01 00:00:00", "2024-1-01T00:00:00Z", "2024-01-01T00:00:00\n", " 2024-01-01T00:00:00",
              "2024-01-01T00:00:00Z", "2024-01-01T00:00:00.5", "2024-01-01", "12024-01-01T00:00:00", "-2024-01-01T00:00:00", "\u0662024-01-01T00:00:00", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", D.iso_timestamp("t").cast("string").alias("got"), F.try_to_timestamp("t", F.lit("yyyy-MM-dd'T'HH:mm:ss")).cast("string").alias("want")).collect()
    assert [r for r in got if r.got != r.want] == [] and 0 < len([r for r in got if r.want]) < len(got)


def test_month_ends(spark):
    df = spark.createDataFrame([(d(2024, 1, 15), d(2024, 3, 20))], "s date, e date")
    assert df.select(D.month_ends("s", "e").alias("x")).first().x == [d(2024, 1, 31), d(2024, 2, 29), d(2024, 3, 20)]


def test_end_of_day_ms(spark):
    df = spark.createDataFrame([(d(2024, 1, 31),)], "d date")
    r = df.select(D.end_of_day_ms("d").alias("t"), D.end_of_day_ms("d", -1).alias("y")).first()
    assert r.t == 1706745599999
    assert r.y == 1706745599999 - 86400000


def test_ms_helpers(spark):
    ms = 1706696430123  # 2024-01-31T10:20:30.123Z
    df = spark.createDataFrame([(ms,)], "ms long")
    r = df.select(D.prev_month_end_ms("ms").alias("p"), D.month_start_ms("ms").alias("s"),
                  D.days_before_start_ms("ms", 3).alias("b"), D.ms_to_sql_date("ms").alias("q")).first()
    assert r.p == 1704067199999  # 2023-12-31T23:59:59.999Z
    assert r.s == 1704067200000  # 2024-01-01T00:00:00Z
    assert r.b == 1706400000000  # 2024-01-28T00:00:00Z
    assert r.q == "2024-01-31"


@pytest.mark.parametrize("text,n,calendar,legacy", [
    ("2024-05-31", 2, d(2024, 3, 31), d(2024, 3, 29)),
    ("2023-05-31", 2, d(2023, 3, 31), d(2023, 3, 28)),
    ("2024-12-31", 1, d(2024, 11, 30), d(2024, 11, 30)),
    ("2024-01-31", 3, d(2023, 10, 31), d(2023, 10, 31)),
    ("2024-02-10", 14, d(2022, 12, 10), d(2022, 12, 10)),
    ("2024-05-10", -1, d(2024, 6, 10), d(2024, 6, 10)),
])
def test_months_before(spark, text, n, calendar, legacy):
    df = spark.createDataFrame([(text,)], "t string")
    r = df.select(D.months_before("t", n).alias("c"), D.months_before("t", n, clamp="legacy").alias("l")).first()
    assert (r.c, r.l) == (calendar, legacy)


def test_date_labels(spark):
    df = spark.createDataFrame([(d(2024, 12, 15),)], "d date")
    r = df.select(D.day_label("d").alias("a"), D.month_label("d").alias("b"), D.next_month_label("d").alias("c")).first()
    assert (r.a, r.b, r.c) == ("15/12/2024", "01/12/2024", "01/01/2025")


def test_lookback_window(spark):
    df = spark.createDataFrame([(d(2024, 3, 10), "all"), (d(2024, 3, 10), "incremental")], "a date, rt string")
    rows = df.select(D.lookback_window("a", F.col("rt"), 30).alias("w")).collect()
    assert [(r.w.window_from, r.w.window_to) for r in rows] == [
        (d(2024, 1, 1), d(2024, 3, 10)), (d(2024, 2, 9), d(2024, 3, 10))]


def test_clean_list(spark):
    df = spark.createDataFrame([([" a ", "", "  ", "b", None, " x "],), (None,)], "l array<string>")
    assert [r.c for r in df.select(clean_list("l").alias("c")).collect()] == [["a", "", "b", "x"], []]


def test_flatten_whitespace(spark):
    df = spark.createDataFrame([("a\r\nb\tc ",)], "t string")
    assert df.select(flatten_whitespace("t").alias("f")).first().f == "a  b c"


def test_parse_taxonomy(spark):
    df = spark.createDataFrame([("A;|B;",), ("A;",), ("A;|B",)], "e string")
    rows = df.select(parse_taxonomy("e").alias("t")).select("t.*").collect()
    assert [tuple(r) for r in rows] == [("A", "B", 2), ("A", None, 1), ("A", "B", 2)]


def _kv(spark, rows, cols="k string, v string, seq int"):
    return spark.createDataFrame(rows, cols)


def test_upsert_replace_golden(spark):
    target = _kv(spark, [("1", "x", 0)])
    batch = _kv(spark, [("1", "y", 1), ("1", "z", 2), (None, "p", 3), (None, "q", 4)])
    out = upsert(target, batch, ["k"], ["seq"], mode="replace")
    assert sorted((r.k or "", r.v) for r in out.collect()) == [("", "p"), ("", "q"), ("1", "z")]


def test_upsert_keep_golden(spark):
    target = _kv(spark, [("1", "x", 0)])
    batch = _kv(spark, [("1", "y", 1), ("1", "z", 2), (None, "p", 3), (None, "q", 4)])
    out = upsert(target, batch, ["k"], ["seq"], mode="keep")
    assert sorted((r.k or "", r.v) for r in out.collect()) == [("", "p"), ("", "q"), ("1", "x")]
    rej = reject_duplicates(target, batch, ["k"], ["seq"]).collect()
    assert sorted(r.v for r in rej) == ["y", "z"]
    assert {r.reason for r in rej} == {"Duplicate item found: k<1>"}


def test_upsert_null_safe(spark):
    target = _kv(spark, [(None, "x", 0)])
    batch = _kv(spark, [(None, "p", 3), (None, "q", 4)])
    out = upsert(target, batch, ["k"], ["seq"], mode="replace", null_safe=True)
    assert [r.v for r in out.collect()] == ["q"]


def test_take_until_empty_golden(spark):
    pages = spark.createDataFrame([("f", 0, 100), ("f", 1, 100), ("f", 2, 0), ("f", 3, 100)],
                                  "feed string, page_no int, n_records int").withColumn("window_start", F.lit(None).cast("date"))
    kept = take_until_empty(pages)
    assert sorted(r.page_no for r in kept.collect()) == [0, 1]


def test_resolve_attempts_golden(spark):
    rows = [("f", 0, 1, 500, 0), ("f", 0, 2, 500, 0), ("f", 0, 3, 200, 100)]
    rows += [("f", 1, a, 500, 0) for a in range(1, 11)]
    rows += [("f", 2, 1, 200, 100)]
    att = spark.createDataFrame(rows, "feed string, page_no int, attempt int, status int, n_records int") \
        .withColumn("window_start", F.lit(None).cast("date"))
    kept = resolve_attempts(att).collect()
    assert [(r.page_no, r.attempt) for r in kept] == [(0, 3)]


def test_upsert_newest_ignores_batch_boundaries(spark):
    target = _kv(spark, [("1", "late", 9), ("2", "x", 1)])
    batch = _kv(spark, [("1", "early", 3), ("2", "y", 5), ("3", "z", 2)])
    out = upsert(target, batch, ["k"], ["seq"], mode="newest")
    assert sorted((r.k, r.v) for r in out.collect()) == [("1", "late"), ("2", "y"), ("3", "z")]


def test_request_plan_bodies(spark):
    from feedyard.plans.requests import request_plan, select_feeds
    windows = spark.createDataFrame([(d(2024, 1, 1), d(2024, 2, 1)), (d(2024, 2, 1), d(2024, 2, 15))],
                                    "window_start date, window_end date")
    dated = request_plan(select_feeds(spark).filter(F.col("feed") == "transactions"), windows, max_pages=2).collect()
    assert len(dated) == 4
    first = sorted(dated, key=lambda r: (r.window_start, r.page_no))[1]
    assert first.skip == 100 and first.take == 100
    assert first.body == ('{"P_GROUP_ID":"","P_IS_OFFPLAN":"","P_IS_FREE_HOLD":"","P_AREA_ID":"","P_USAGE_ID":"",'
                          '"P_PROP_TYPE_ID":"","P_FROM_DATE":"01/01/2024","P_TO_DATE":"02/01/2024","P_TAKE":"100",'
                          '"P_SKIP":"100","P_SORT":"TRANSACTION_NUMBER_ASC"}')
    # a snapshot feed is planned once, without dates, whatever the windows
    units = request_plan(select_feeds(spark, "units"), windows, max_pages=3).collect()
    assert len(units) == 3 and all(r.window_start is None for r in units)
    assert '"P_IS_FREE_HOLD":"1"' in units[0].body and "P_FROM_DATE" not in units[0].body


def test_assign_windows_closed_last_day_on_month_start(spark):
    from feedyard.operators.windows import assign_windows, windows_between
    spans = spark.createDataFrame([(d(2024, 4, 10), d(2024, 6, 1))], "start date, end date")
    windows = windows_between(spans)
    recs = spark.createDataFrame([(1, d(2024, 4, 10)), (2, d(2024, 4, 30)), (3, d(2024, 5, 1)), (4, d(2024, 5, 31)),
                                  (5, d(2024, 6, 1)), (6, d(2024, 6, 2)), (7, d(2024, 4, 9))], "id int, d date")
    got = {r.id: (r.window_start, r.window_end) for r in assign_windows(recs, "d", windows).collect()}
    assert got == {1: (d(2024, 4, 10), d(2024, 5, 1)), 2: (d(2024, 4, 10), d(2024, 5, 1)),
                   3: (d(2024, 5, 1), d(2024, 6, 1)), 4: (d(2024, 5, 1), d(2024, 6, 1)),
                   5: (d(2024, 5, 1), d(2024, 6, 1))}


def test_run_windows(spark):
    from feedyard.plans.requests import run_windows
    runs = spark.createDataFrame([("r1", d(2024, 3, 20), "all"), ("r2", d(2024, 3, 20), "incremental")],
                                 "run string, as_of date, run_type string")
    got = {}
    for r in run_windows(runs).collect():
        got.setdefault(r.run, []).append((r.window_start, r.window_end))
    assert got["r1"] == [(d(2024, 1, 1), d(2024, 2, 1)), (d(2024, 2, 1), d(2024, 3, 1)), (d(2024, 3, 1), d(2024, 3, 20))]
    assert got["r2"] == [(d(2024, 2, 19), d(2024, 3, 1)), (d(2024, 3, 1), d(2024, 3, 20))]


def test_conform_rejects_long_and_missing(spark):
    from feedyard.operators.project import conform
    df = spark.createDataFrame([("brokers", "1", "x" * 127, "t"), ("brokers", "2", "ok", None), ("brokers", "3", "ok", "t")],
                               "feed string, broker_number string, phone string, _tid string")
    ok, rej = conform(df)
    assert [r.broker_number for r in ok.collect()] == ["3"]
    assert sorted((r.broker_number, r.reason) for r in rej.collect()) == [
        ("1", "phone: length 127 > 126"), ("2", "_tid: null")]
    assert ok.columns[:3] == ["feed", "app_number", "transaction_date"]


def test_publish_requires_order(spark, tmp_path):
    from feedyard.sinks.table import VersionedTable
    tbl = VersionedTable(spark, str(tmp_path / "t"), ["k"], n_buckets=2)
    with pytest.raises(ValueError):
        tbl.publish(_kv(spark, [("1", "x", 0)]), mode="replace")


def test_feed_filter_parameters(spark):
    from feedyard.operators.filters import feed_default_filter, feed_filter
    df = spark.createDataFrame([("1", "Sale", "A"), ("0", "Sale", "B"), ("1", "Gift", "A")],
                               "free_hold string, transaction_type string, area_ string")
    # request names resolve to columns; '' and None mean no constraint;
    # control parameters (P_DATE_TYPE, paging) constrain nothing
    got = feed_filter(df, {"P_IS_FREE_HOLD": "1", "P_GROUP_ID": "Sale", "P_AREA_ID": "", "P_DATE_TYPE": "0",
                           "P_TAKE": "100", "area_": None}).collect()
    assert [(r.free_hold, r.transaction_type, r.area_) for r in got] == [("1", "Sale", "A")]
    units = spark.createDataFrame([("1",), ("0",), (None,)], "free_hold string")
    assert [r.free_hold for r in feed_default_filter(units, "units").collect()] == ["1"]


def test_feed_filter_dates_and_unknown_names(spark):
    from feedyard.operators.filters import feed_filter
    df = spark.createDataFrame([("1", 1704067200, "z"), ("2", 1706659200 + 86399, "z"), ("3", 1706745600, "q")],
                               "project_number string, start_date long, zone_authority string")
    from feedyard.schema import feed as get_feed
    column = get_feed("projects").date_column
    df = df.withColumnRenamed("start_date", column)
    got = feed_filter(df, {"P_FROM_DATE": "01/01/2024", "P_TO_DATE": "01/31/2024", "P_ZONE_ID": "z"}, "projects")
    assert sorted(r.project_number for r in got.collect()) == ["1", "2"]
    with pytest.raises(ValueError):
        feed_filter(df, {"P_AERA_ID": "7"}, "projects")
    with pytest.raises(ValueError):
        feed_filter(df, {"P_FROM_DATE": "01/01/2024"})


def test_request_plan_has_every_page(spark):
    from feedyard.plans.requests import request_plan, select_feeds
    windows = spark.createDataFrame([], "window_start date, window_end date")
    counts = spark.createDataFrame([("units", None, 915_000)], "feed string, window_start date, n_records long")
    assert request_plan(select_feeds(spark, "units"), windows, counts=counts).count() == 9150


def test_keep_mode_ties_are_kept_or_refused(spark):
    batch = _kv(spark, [("1", "y", 1), ("1", "y", 1), ("1", "z", 1), ("2", "p", 3), (None, "n", 1), (None, "n", 1)])
    target = _kv(spark, [("2", "x", 0)])
    kept = upsert(target, batch, ["k"], ["seq"], mode="keep").count() - target.count()
    assert kept + reject_duplicates(target, batch, ["k"], ["seq"]).count() == batch.count()


def test_surrogate_keys_tell_nulls_and_parts_apart(spark):
    from feedyard.functions.text import surrogate_key
    rows = [("a", None), (None, "a"), ("a\x1fb", "c"), ("a", "b\x1fc"), (None, None), ("", ""), ("n", "n"), ("\x1en", "\x1en")]
    ids = [r[0] for r in spark.createDataFrame(rows, "x string, y string").select(surrogate_key("x", "y")).collect()]
    assert len(set(ids)) == len(rows)


def test_conform_rejects_values_that_do_not_cast(spark):
    from feedyard.operators.project import conform
    df = spark.createDataFrame([("brokers", "1", "x", "t"), ("brokers", "2", "17", "t")], "feed string, broker_number string, start_date string, _tid string")
    ok, rej = conform(df)
    assert [(r.broker_number, r.start_date) for r in ok.collect()] == [("2", 17)]
    assert [r.reason for r in rej.collect()] == ["start_date: not a bigint <x>"]


def test_bad_identity_is_a_reject(spark):
    from feedyard.sources.envelopes import bad_envelopes, parse_envelopes
    docs = ['{"window_start":"soon","page_no":1,"response":{"result":[]}}', '{"page_no":1,"response":{"result":[]}}']
    pages = parse_envelopes(spark.createDataFrame([(d,) for d in docs], "value string"), "rents")
    assert [r.reason for r in bad_envelopes(pages).collect()] == ["bad window_start <soon>"]
    path = spark.createDataFrame([('{"response":{"result":[]}}', "x")], "value string, page_no string")
    assert [r.reason for r in bad_envelopes(parse_envelopes(path, "rents")).collect()] == ["bad page_no <x>"]

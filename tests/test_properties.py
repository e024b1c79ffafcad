"""Property tests: many generated cases per Spark job, checked against a
plain-Python model of the intended semantics."""

import calendar
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedyard.functions import dates as D
from feedyard.functions.text import clean_list
from feedyard.operators.upsert import upsert

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
days = st.dates(min_value=dt.date(2019, 1, 1), max_value=dt.date(2027, 12, 31))


def model_windows(s, e):
    if s >= e:
        return []
    bounds = [s]
    m = dt.date(s.year, s.month, 1)
    while True:
        m = dt.date(m.year + (m.month == 12), m.month % 12 + 1, 1)
        if m >= e:
            break
        bounds.append(m)
    bounds.append(e)
    return [(a, b, i == len(bounds) - 2) for i, (a, b) in enumerate(zip(bounds, bounds[1:]))]


@SETTINGS
@given(st.lists(st.tuples(days, days), min_size=1, max_size=40))
def test_month_windows_model(spark, pairs):
    df = spark.createDataFrame([(i, s, e) for i, (s, e) in enumerate(pairs)], "i int, s date, e date")
    got = {}
    for r in df.select("i", F.inline(D.month_windows("s", "e"))).collect():
        got.setdefault(r.i, []).append((r.window_start, r.window_end, r.is_last))
    for i, (s, e) in enumerate(pairs):
        assert got.get(i, []) == model_windows(s, e)


def shift(d, n):
    y, m = divmod(d.year * 12 + d.month - 1 - n, 12)
    return y, m + 1


@SETTINGS
@given(st.lists(st.tuples(days, st.integers(-30, 30)), min_size=1, max_size=40))
def test_months_before_model(spark, cases):
    df = spark.createDataFrame([(i, d.isoformat(), n) for i, (d, n) in enumerate(cases)], "i int, t string, n int")
    rows = df.select("i", D.months_before("t", F.col("n")).alias("c"),
                     D.months_before("t", F.col("n"), clamp="legacy").alias("l")).collect()
    for r in rows:
        d, n = cases[r.i]
        y, m = shift(d, n)
        assert r.c == dt.date(y, m, min(d.day, calendar.monthrange(y, m)[1]))
        feb = calendar.monthrange(y, 2)[1]
        assert r.l == dt.date(y, m, min(d.day, feb if m <= 9 else calendar.monthrange(y, m)[1]))


@SETTINGS
@given(st.lists(st.datetimes(min_value=dt.datetime(1971, 1, 1), max_value=dt.datetime(2037, 12, 31)),
                min_size=1, max_size=40))
def test_iso_to_epoch_model(spark, stamps):
    texts = [t.replace(microsecond=0).strftime("%Y-%m-%dT%H:%M:%S") for t in stamps]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in df.select("i", D.iso_to_epoch("t").alias("e")).collect():
        want = int(dt.datetime.strptime(texts[r.i], "%Y-%m-%dT%H:%M:%S").replace(tzinfo=dt.timezone.utc).timestamp())
        assert r.e == want


ws = st.sampled_from([" ", "\t", "\n", "\r", "\x0b", "\x0c", "\x1c", "\x85", "\xa0", " ", "　", "", "a", "b c"])
items = st.lists(ws, min_size=0, max_size=4).map("".join)


@SETTINGS
@given(st.lists(st.lists(items, max_size=6), min_size=1, max_size=30))
def test_clean_list_model(spark, lists):
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lists)], "i int, l array<string>")
    for r in df.select("i", clean_list("l").alias("c")).collect():
        assert r.c == [x.strip() for x in lists[r.i] if not x.isspace()]


keys = st.sampled_from(["a", "b", "c", None])


@SETTINGS
@given(st.lists(keys, max_size=6), st.lists(keys, min_size=1, max_size=12))
def test_upsert_replace_is_sequential_application(spark, target_keys, batch_keys):
    target = [(k, f"t{i}", -i - 1) for i, k in enumerate(target_keys)]
    batch = [(k, f"b{i}", i) for i, k in enumerate(batch_keys)]
    # sequential model: each item deletes target rows with its key (a null key
    # matches nothing), then is stored
    table = list(target)
    for k, v, seq in batch:
        if k is not None:
            table = [row for row in table if row[0] != k]
        table.append((k, v, seq))
    schema = "k string, v string, seq int"
    out = upsert(spark.createDataFrame(target, schema), spark.createDataFrame(batch, schema), ["k"], ["seq"])
    assert sorted(map(tuple, out.collect()), key=str) == sorted(table, key=str)


@SETTINGS
@given(st.tuples(days, days), st.lists(days, min_size=1, max_size=60))
def test_assign_windows_brute_force(spark, span, record_days):
    """Every record inside [start, end] lands in exactly the window a brute
    force scan over all windows finds; records outside get none."""
    from feedyard.operators.windows import assign_windows, windows_between
    s, e = span
    windows = model_windows(s, e)
    spans = spark.createDataFrame([(s, e)], "start date, end date")
    recs = spark.createDataFrame([(i, x) for i, x in enumerate(record_days)], "id int, d date")
    got = {r.id: (r.window_start, r.window_end) for r in assign_windows(recs, "d", windows_between(spans)).collect()}
    want = {}
    for i, x in enumerate(record_days):
        for a, b, last in windows:
            if a <= x < b or (last and x == b):
                assert i not in want  # windows never overlap
                want[i] = (a, b)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b", None]), st.integers(0, 10**6)),
                min_size=1, max_size=80, unique_by=lambda t: t[1]))
def test_row_numbers_brute_force(spark, rows):
    """Each group is numbered 1..n in order, like sorting in Python."""
    from feedyard.operators.paging import row_numbers
    df = spark.createDataFrame(rows, "g string, o long")
    want = {}
    for g in {r[0] for r in rows}:
        for n, (_, o) in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: r[1]), start=1):
            want[(g, o)] = n
    got = {(r.g, r.o): r.rn for r in row_numbers(df, ["g"], ["o"], num_partitions=3).collect()}
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.data())
def test_windows_of_any_length_brute_force(spark, data):
    """Windows of days to centuries that overlap, some empty or reversed,
    against a plain scan; what lies in none is returned apart."""
    from feedyard.operators.windows import assign_windows, unassigned
    day = st.dates(dt.date(1890, 1, 1), dt.date(2120, 1, 1))
    near = st.dates(dt.date(2023, 12, 1), dt.date(2024, 4, 1))
    spans = data.draw(st.lists(st.tuples(st.one_of(day, near), st.one_of(day, near), st.booleans()), max_size=12))
    spans += [(dt.date(2024, 1, 15), dt.date(2024, 3, 1), False)]  # crosses a month
    days = data.draw(st.lists(st.one_of(day, near), max_size=25)) + [dt.date(2024, 1, 20), dt.date(2024, 2, 10), None]
    windows = spark.createDataFrame([(k % 2, *w) for k, w in enumerate(spans)] + [(0, None, dt.date(2024, 1, 1), False)],
                                    "g int, window_start date, window_end date, is_last boolean")
    recs = spark.createDataFrame([(k, k % 2, d) for k, d in enumerate(days)], "id int, g int, d date")
    for by in ([], ["g"]):
        want = sorted(
            (k, s, e) for k, d in enumerate(days) for j, (s, e, last) in enumerate(spans)
            if d and s <= d and (d < e or last and d == e) and (not by or j % 2 == k % 2))
        got = sorted((r.id, r.window_start, r.window_end) for r in assign_windows(recs, "d", windows, by).collect())
        assert got == want
        none = {r.id for r in unassigned(recs, "d", windows, by).collect()}
        assert none == set(range(len(days))) - {w[0] for w in want}


def test_window_cells_are_few(spark):
    from feedyard.operators.windows import window_cells
    spans = [(dt.date(1, 1, 1), dt.date(9999, 1, 1), True), (dt.date(2024, 1, 1), dt.date(2024, 2, 1), False),
             (dt.date(1969, 12, 31), dt.date(1970, 1, 1), True)]
    cells = window_cells(spark.createDataFrame(spans, "window_start date, window_end date, is_last boolean"))
    n = {r.window_start: r.n for r in cells.groupBy("window_start").agg(F.count("*").alias("n")).collect()}
    assert n[spans[0][0]] < 62 * 3 + 120 and n[spans[1][0]] == 31 and n[spans[2][0]] == 2

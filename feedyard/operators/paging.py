"""Paging operators: page numbers, page slices, stop-at-empty and retries.

The source service is read one page (100 rows) at a time. Here every
decision the crawler makes page by page is taken for a whole table at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedyard.schema import MAX_PAGES, PAGE_SIZE

_LOW33 = (1 << 33) - 1  # monotonically_increasing_id keeps the row index in the low 33 bits


def _cols(names: Sequence[str] | str | None) -> list[str]:
    if names is None:
        return []
    return [names] if isinstance(names, str) else list(names)


# -- O10 ---------------------------------------------------------------------
#: Rows of a range, which one task sorts.
ROWS_PER_RANGE = 1_000_000


#: Counts of ranges and groups up to which they are sent to every task.
FEW_COUNTS = 100_000


def row_numbers(df: DataFrame, by: Sequence[str] | str | None, order: Sequence[str | Column],
                out: str = "rn", num_partitions: int | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """1-based row number per ``by`` group in ``order``.

    The rows are counted first: every ``ROWS_PER_RANGE`` of them are a range
    that one task sorts. Up to that many rows are one range, where a plain
    row number per group is all there is to do. Beyond it, rows are
    range-partitioned on (by, order), so every task holds a contiguous slice
    of the global order, however large a group is; each task's rows are
    numbered locally, and a small table of (group, partition) counts turns
    local numbers into group numbers. That table has at most
    ``num_partitions + #groups`` rows. ``num_partitions`` asks for so many
    ranges whatever the count.

    ``order`` should be total (break ties with key columns); with ties the
    numbering is still a dense 1..n per group, the order among tied rows is
    arbitrary.

    Locally numbered rows are read twice (counts, then numbers), and a
    range exchange planned twice samples different bounds, so they are
    written once as a Parquet table in the shared work folder
    (``spark.checkpoint.dir``) and read back: this cuts the lineage, keeps
    partition and position as plain columns, and survives executor loss.
    ``keep`` names the columns that are wanted besides ``by``: others serve
    the order only and are not written.
    """
    by = _cols(by)
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    if num_partitions is None:
        ranges = -(-df.count() // ROWS_PER_RANGE)
        if ranges <= 1:
            same = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
            numbered = df.withColumn(out, F.row_number().over(same.orderBy(*order_cols)).cast("long"))
            return numbered if keep is None else numbered.select(*dict.fromkeys([*by, *keep]), out)
        num_partitions = max(ranges, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    local = _in_ranges(df, [F.col(c) for c in by] + order_cols, num_partitions, None if keep is None else [*by, *keep])
    counts = local.groupBy(*by, "_pid").agg(F.min("_idx").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    # a row per range and group, which Spark takes for as large as the rows:
    # few of them go to the rows, so that the rows are not shuffled again
    if counts.limit(FEW_COUNTS + 1).count() <= FEW_COUNTS:
        offsets = F.broadcast(offsets)
    numbered = _join_null_safe(local, offsets, [*by, "_pid"])
    return numbered.withColumn(out, F.col("_offset") + F.col("_idx") - F.col("_first") + F.lit(1)).drop(
        "_pid", "_idx", "_first", "_offset")


def _in_ranges(df: DataFrame, sort_cols: Sequence[Column], num_partitions: int | None,
               keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` in global order, cut into ranges: ``_pid`` numbers a row's range
    and ``_idx`` (from 0) the row in it. Written once, a file per range."""
    from feedyard.session import scratch_path

    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "row-numbers")
    ranged = (df.repartitionByRange(n, *sort_cols)
                .sortWithinPartitions(*sort_cols)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_idx", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33))))
    if keep is not None:
        ranged = ranged.select(*dict.fromkeys([*keep, "_pid", "_idx"]))
    ranged.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def assign_pages(df: DataFrame, by: Sequence[str] | str | None, order: Sequence[str | Column],
                 size: int = PAGE_SIZE, num_partitions: int | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """Page number and position for every row at once: the page a crawler
    would fetch the row on with ``P_SKIP = page * size`` under this sort.
    ``keep`` as in ``row_numbers``."""
    numbered = row_numbers(df, by, order, out="rn", num_partitions=num_partitions, keep=keep)
    return numbered.withColumn("page_no", F.floor((F.col("rn") - 1) / F.lit(size)).cast("bigint")).withColumn(
        "position", ((F.col("rn") - 1) % F.lit(size)).cast("int"))


# -- O9 ----------------------------------------------------------------------
#: Rows up to which a page is found as a top-(skip+take): what one task may hold.
TOP_ROWS = 100_000


def page_slice(df: DataFrame, order: Sequence[str | Column], skip: int, take: int = PAGE_SIZE,
               num_partitions: int | None = None, top_rows: int = TOP_ROWS) -> DataFrame:
    """One sorted page: ``ORDER BY order OFFSET skip LIMIT take``.

    Near the front (``skip + take`` up to ``top_rows``) this is a top-k: every
    task keeps that many rows and one task merges them. A deeper page is an
    order statistic: the rows are cut into ranges of the global order, the
    ranges are counted, and only those that hold the page are read again, so
    no task holds the rows that are skipped. To page through a whole table
    use ``assign_pages`` instead. Columns named ``_pid`` and ``_idx`` are
    refused there.
    """
    skip, take = int(skip), int(take)
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    if skip + take <= top_rows:
        return df.orderBy(*cols).offset(skip).limit(take)
    if {"_pid", "_idx"} & {c.lower() for c in df.columns}:
        raise ValueError("columns _pid and _idx are used here")
    local = _in_ranges(df, cols, num_partitions)
    before, spans = 0, []  # a count per range arrives: as many as partitions
    for pid, n in sorted((r[0], r[1]) for r in local.groupBy("_pid").count().collect()):
        first, last = max(skip - before, 0), min(skip + take - before, n)
        if first < last:
            spans.append((F.col("_pid") == pid) & (F.col("_idx") >= first) & (F.col("_idx") < last))
        before += n
    page = local.where(reduce(lambda a, b: a | b, spans)) if spans else local.limit(0)
    return page.orderBy("_pid", "_idx").drop("_pid", "_idx")


# -- O4 ----------------------------------------------------------------------
def take_until_empty(pages: DataFrame, by: Sequence[str] = ("feed", "window_start"), page: str = "page_no",
                     n_records: str = "n_records") -> DataFrame:
    """Keep the pages before the first empty one of each (feed, window).

    One aggregate gives the stop of each group that has one; an anti join
    drops the pages at or after it. The stops are a row per group, so AQE
    broadcasts them and pages stay where they are; no running window, and a
    group never has to be sorted in one task. Groups without an empty page
    keep all their pages.
    """
    return before_stops(pages, first_empty(pages, by, page, n_records), by, page)


def first_empty(pages: DataFrame, by: Sequence[str] = ("feed", "window_start"), page: str = "page_no",
                n_records: str = "n_records") -> DataFrame:
    """The groups that have an empty page, with the lowest one (``_stop``)."""
    return pages.where(F.col(n_records) == 0).groupBy(*by).agg(F.min(page).alias("_stop"))


def before_stops(pages: DataFrame, stops: DataFrame, by: Sequence[str] = ("feed", "window_start"), page: str = "page_no") -> DataFrame:
    """The pages below the ``_stop`` of their group (null is a group like any other)."""
    renamed = stops.select(*[F.col(c).alias(f"_r_{c}") for c in by], "_stop")
    cond = pages[page] >= renamed["_stop"]
    for c in by:
        cond = cond & pages[c].eqNullSafe(renamed[f"_r_{c}"])
    return pages.join(renamed, on=cond, how="left_anti")


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Equi-join on ``keys`` where null matches null (snapshot feeds have no window)."""
    r = right
    for k in keys:
        r = r.withColumnRenamed(k, f"_r_{k}")
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    out = left.join(r, on=cond, how="inner")
    return out.drop(*[f"_r_{k}" for k in keys])


# -- O5 ----------------------------------------------------------------------
def resolve_attempts(attempts: DataFrame, by: Sequence[str] = ("feed", "window_start"),
                     page: str = "page_no", attempt: str = "attempt", status: str = "status",
                     n_records: str = "n_records", max_attempts: int | None = None) -> DataFrame:
    """The pages a crawler keeps, from the log of its fetch attempts.

    Per page: the first attempt with status 200 (among the first
    ``max_attempts`` tries, where a bound is given). A page with no such attempt ends its (feed,
    window), as does an empty page; pages from that point on are dropped.
    Output: one row per kept page with the winning attempt and its size.
    """
    by = list(by)
    ok = F.col(status) == 200
    if max_attempts is not None:
        ok = ok & (F.col(attempt) <= max_attempts)
    per_page = attempts.groupBy(*by, page).agg(
        F.min(F.when(ok, F.col(attempt))).alias(attempt),
        F.min_by(F.col(n_records), F.when(ok, F.col(attempt))).alias(n_records),
    )
    # a failed page counts as a stop, just like an empty one
    marked = per_page.withColumn("_stop_here", F.col(attempt).isNull() | (F.col(n_records) == 0))
    stops = marked.groupBy(*by).agg(F.min(F.when(F.col("_stop_here"), F.col(page))).alias("_stop"))
    kept = _join_null_safe(marked, stops, by)
    return kept.filter(F.col("_stop").isNull() | (F.col(page) < F.col("_stop"))).drop("_stop", "_stop_here")


# -- O6 ----------------------------------------------------------------------
def cap_audit(records: DataFrame, by: Sequence[str] = ("feed", "window_start"), size: int = PAGE_SIZE,
              max_pages: int = MAX_PAGES) -> DataFrame:
    """Per (feed, window): record count, pages needed, and whether the page
    cap (``max_pages`` x ``size`` rows) cuts it off."""
    counts = records.groupBy(*by).agg(F.count(F.lit(1)).alias("n_records"))
    pages = F.ceil(F.col("n_records") / F.lit(size)).cast("bigint")
    return counts.withColumn("n_pages", pages).withColumn("capped", F.col("n_pages") >= F.lit(max_pages))

"""Extraction windows as tables, and the interval join that assigns records
to them (O41)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedyard.functions.dates import month_windows


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def windows_between(spans: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Explode (start, end) spans into month windows: the span's other columns
    plus window_start, window_end, is_last."""
    keep = [c for c in spans.columns if c not in (start, end)]
    return spans.select(*keep, F.inline(month_windows(start, end)))


def windows_for(df: DataFrame, date_col: Column | str) -> DataFrame:
    """Month windows covering a table's date column, first to last day."""
    d = F.to_date(_c(date_col))
    span = df.agg(F.min(d).alias("start"), F.max(d).alias("end"))
    return windows_between(span)


# -- O41 ---------------------------------------------------------------------
#: A cell of level k is 2 ^ (CELL_BITS x k) days wide: 1, 32, 1,024, 32,768.
CELL_BITS = 5
LEVELS = 4
#: Cells up to which Spark may send the windows to every task: what a driver holds easily.
FEW_CELLS = 100_000


def window_cells(windows: DataFrame) -> DataFrame:
    """Every window cut into cells: its columns plus ``_level`` and ``_cell``.

    A cell of level k is one of the 2^(5k)-day stretches that the calendar is
    cut into, counted from 1970-01-01. A window becomes the widest cells that
    lie inside it, so a window of any length is at most 62 cells of each level
    (those of the widest level aside), they do not overlap, and a date lies in
    the window exactly if the cell it falls in, of some level, is one of them.
    """
    first = F.unix_date(F.to_date("window_start"))
    last = F.unix_date(F.to_date("window_end")) + F.when(F.coalesce("is_last", F.lit(False)), 1).otherwise(0)  # exclusive
    ends = windows.withColumns({"_s": first, "_e": last}).where("_s < _e")

    def inside(level: int) -> tuple[Column, Column]:
        """The cells of a level that lie inside: from, to (exclusive)."""
        bits = CELL_BITS * level
        return F.shiftright(F.col("_s") + ((1 << bits) - 1), bits), F.shiftright("_e", bits)

    def cells(a: Column, b: Column) -> Column:
        return F.when(a < b, F.sequence(a, b - 1)).otherwise(F.array().cast("array<int>"))

    def named(own: Column, level: int) -> Column:
        return F.transform(own, lambda c: F.struct(F.lit(level).alias("_level"), c.alias("_cell")))

    parts = []
    for level in range(LEVELS):
        a, b = inside(level)
        if level + 1 < LEVELS:
            up_a, up_b = (F.shiftleft(c, CELL_BITS) for c in inside(level + 1))
            own = F.when(up_a < up_b, F.concat(cells(a, up_a), cells(up_b, b))).otherwise(cells(a, b))
        else:
            own = cells(a, b)
        parts.append(named(own, level))
    return ends.withColumn("_at", F.explode(F.concat(*parts))).select(*windows.columns, "_at._level", "_at._cell")


def assign_windows(df: DataFrame, date_col: Column | str, windows: DataFrame,
                   by: list[str] | None = None) -> DataFrame:
    """Attach each dated record to every extraction window it lies in.

    Windows may have any length and may overlap; the last one (``is_last``)
    includes its end. They are cut into cells of a few widths
    (``window_cells``) and a record looks up the cell of its date, once for
    each width that occurs, so the join is an equi-join on cells (plus any
    ``by`` keys, e.g. feed): no range test and no nested loop, each (record,
    window) pair once. Windows of up to a month cost one lookup a record.
    Records outside every window are dropped here and returned by
    ``unassigned``. Windows with a null or reversed range hold nothing.

    Spark takes the cells for as small as the windows they are cut from and
    would broadcast them through the driver: they are counted, and beyond
    ``FEW_CELLS`` both sides are shuffled.
    """
    by = by or []
    keyed = window_cells(windows.select(*by, "window_start", "window_end", "is_last"))
    # the widths that occur, and their cells: a handful of numbers
    counts = {r[0]: r[1] for r in keyed.groupBy("_level").count().collect()}
    levels = sorted(counts) or [0]
    if sum(counts.values()) > FEW_CELLS:
        keyed = keyed.hint("shuffle_merge")
    day = F.unix_date(F.to_date(_c(date_col)))
    places = [F.struct(F.lit(k).alias("_level"), F.shiftright(day, CELL_BITS * k).alias("_cell")) for k in levels]
    at = F.explode(F.array(*places)) if len(places) > 1 else places[0]
    recs = df.withColumn("_at", at).withColumns({"_rl": F.col("_at._level"), "_rc": F.col("_at._cell")}).drop("_at")
    keyed = keyed.withColumnsRenamed({c: f"_w_{c}" for c in by})
    cond = [recs["_rl"] == keyed["_level"], recs["_rc"] == keyed["_cell"]] + [recs[c] == keyed[f"_w_{c}"] for c in by]
    return recs.join(keyed, on=cond, how="inner").drop("_rl", "_rc", "_level", "_cell", *[f"_w_{c}" for c in by])


def unassigned(df: DataFrame, date_col: Column | str, windows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The records that lie in no window (those without a date among them).

    Which dates have a window is found on the distinct dates (days of the
    calendar, per ``by`` key), then one anti join.
    """
    by = by or []
    d = F.to_date(_c(date_col))
    dates = df.select(*by, d.alias("_day")).where("_day is not null").distinct()
    covered = assign_windows(dates, "_day", windows, by).select(*[F.col(c).alias(f"_w_{c}") for c in by], F.col("_day").alias("_w_day")).distinct()
    recs = df.withColumn("_day", d)
    cond = [recs["_day"] == covered["_w_day"]] + [recs[c] == covered[f"_w_{c}"] for c in by]
    return recs.join(covered, on=cond, how="left_anti").drop("_day")

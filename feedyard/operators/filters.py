"""Selection operators: request-parameter filters and date windows.

Both build plain column predicates: on a Parquet-backed table equality and
date comparisons reach the scan as pushed filters (not through a JSON decode
or a computed date).
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedyard.schema import CONTROL_PARAMS, FEED_PARAM_COLUMNS, PARAM_COLUMNS, feed as get_feed


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(day: Column) -> Column:
    """The first second of a day, as the epoch seconds of the feeds' date columns."""
    return F.unix_seconds(day.cast("timestamp"))


# -- O7 ----------------------------------------------------------------------
def feed_filter(df: DataFrame, params: Mapping[str, str | None], feed: str | None = None) -> DataFrame:
    """Conjunctive filter; '' or None means "no constraint".

    Keys are target column names or request parameter names (``P_*``): equality
    parameters resolve through the parameter -> column table (a feed may have
    its own column for one), ``P_FROM_DATE`` / ``P_TO_DATE`` (MM/dd/yyyy, both
    days included) bound the feed's date column, paging and sort parameters
    constrain nothing, and ``P_DATE_TYPE`` only says which date the service
    means, which is the feed's date column here. Other names are refused.
    """
    preds = []
    for name, value in params.items():
        if not name.startswith("P_"):
            if value is not None and value != "":
                preds.append(F.col(name) == F.lit(str(value)))
        elif name in PARAM_COLUMNS:
            column = FEED_PARAM_COLUMNS.get((feed, name), PARAM_COLUMNS[name])
            if value is not None and value != "":
                preds.append(F.col(column) == F.lit(str(value)))
        elif name in ("P_FROM_DATE", "P_TO_DATE"):
            if value is None or value == "":
                continue
            date_column = get_feed(feed).date_column if feed else None
            if date_column is None:
                raise ValueError(f"{name} needs a feed with a date column, not {feed!r}")
            day = F.to_date(F.lit(str(value)), "MM/dd/yyyy")
            at = F.col(date_column)  # epoch seconds, compared as they are: the scan can take the bound
            preds.append(at >= epoch_seconds(day) if name == "P_FROM_DATE" else at < epoch_seconds(F.date_add(day, 1)))
        elif name not in CONTROL_PARAMS:
            raise ValueError(f"unknown request parameter {name}")
    if not preds:
        return df
    return df.filter(reduce(lambda a, b: a & b, preds))


def feed_default_filter(df: DataFrame, feed: str) -> DataFrame:
    """Apply the filter a feed's default request carries (e.g. units: free hold only)."""
    return feed_filter(df, dict(get_feed(feed).params), feed)


# -- O8 ----------------------------------------------------------------------
def window_filter(df: DataFrame, date_col: Column | str, start, end, closed: bool = False) -> DataFrame:
    """Rows dated in [start, end), or [start, end] for the last window.

    ``start``/``end`` are dates (text 'yyyy-MM-dd', date objects or Columns);
    ``date_col`` is a date or timestamp column, or whole numbers: epoch
    seconds. The column is compared as it is, so the bounds reach the scan.
    """
    d = _c(date_col)
    seconds = df.select(d).schema[0].dataType.typeName() in ("long", "integer")
    lo = start if isinstance(start, Column) else F.lit(str(start)).cast("date")
    hi = end if isinstance(end, Column) else F.lit(str(end)).cast("date")
    if closed:  # the whole last day counts
        hi = F.date_add(hi, 1)
    if seconds:
        lo, hi = epoch_seconds(lo), epoch_seconds(hi)
    return df.filter((d >= lo) & (d < hi))

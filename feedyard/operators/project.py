"""Projection of feed records into the wide table.

One ``select`` per feed, generated from the mapping table in
``feedyard.schema``; no per-row Python.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedyard.functions.dates import iso_is_malformed, iso_to_epoch
from feedyard.schema import NOT_NULL, WIDE_COLUMNS, WIDE_NAMES, Feed, feed as get_feed

CARRY = ("feed", "run", "window_start", "page_no", "position")


def _feed(f: str | Feed) -> Feed:
    return get_feed(f) if isinstance(f, str) else f


def _source(df: DataFrame, name: str):
    # a field the landed record never had is simply null
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


# -- O12 ---------------------------------------------------------------------
def project_feed(records: DataFrame, feed: str | Feed, carry: Sequence[str] = CARRY,
                 date_default: int | None = 0) -> DataFrame:
    """Rename and convert a feed's source fields into target columns.

    Date fields go through ``iso_to_epoch`` (null/'' -> ``date_default``,
    malformed -> null; ``split_malformed`` routes those rows to rejects).
    """
    f = _feed(feed)
    kept = [F.col(c) for c in carry if c in records.columns]
    if "feed" not in records.columns and "feed" in carry:
        kept.insert(0, F.lit(f.name).alias("feed"))
    out = []
    for m in f.mappings:
        src = _source(records, m.source)
        out.append((iso_to_epoch(src, date_default) if m.is_date else src).alias(m.target))
    return records.select(*kept, *out)


def malformed_dates(records: DataFrame, feed: str | Feed):
    """Column: true where any of the feed's date fields is present but malformed."""
    f = _feed(feed)
    flags = [iso_is_malformed(_source(records, m.source)) for m in f.mappings if m.is_date]
    return reduce(lambda a, b: a | b, flags) if flags else F.lit(False)


def malformed_reason(records: DataFrame, feed: str | Feed, prefix: str = ""):
    """Column: 'malformed date FIELD=<value>' for each bad date field, joined
    by ', '. The fields' columns may carry a ``prefix``."""
    f = _feed(feed)
    parts = [
        F.when(iso_is_malformed(_source(records, prefix + m.source)),
               F.format_string("malformed date %s=<%s>", F.lit(m.source), _source(records, prefix + m.source)))
        for m in f.mappings if m.is_date
    ]
    return F.concat_ws(", ", *parts) if parts else F.lit(None).cast("string")


def split_malformed(records: DataFrame, feed: str | Feed) -> tuple[DataFrame, DataFrame]:
    """(good records, rejected records with ``reason``). Only the bad row is
    rejected, never the rest of its page."""
    bad = malformed_dates(records, feed)
    good = records.filter(~bad)
    rejects = records.filter(bad).withColumn("reason", malformed_reason(records, feed))
    return good, rejects


# -- O13 ---------------------------------------------------------------------
def saved_fields(df: DataFrame, fields: Sequence[str] | None) -> DataFrame:
    """Keep only the configured output columns; none configured keeps all."""
    if not fields:
        return df
    return df.select(*fields)


# -- O30 ---------------------------------------------------------------------
def to_wide(frames: Sequence[DataFrame], with_audit: bool = False) -> DataFrame:
    """All feeds in one wide table: missing columns null, schema column order.

    Each frame must carry ``feed``. Extra carried columns (page_no, ...) are
    kept after the wide columns.
    """
    unioned = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    cols = []
    for c in WIDE_COLUMNS:
        if not with_audit and c.name in ("_tid", "created_at", "updated_at"):
            continue
        if c.name in unioned.columns:
            cols.append(F.col(c.name).cast(c.type))
        else:
            cols.append(F.lit(None).cast(c.type).alias(c.name))
    extra = [c for c in unioned.columns if c not in WIDE_NAMES]
    return unioned.select(*cols, *extra)


# -- O31 ---------------------------------------------------------------------
def _violations(df: DataFrame):
    checks = []
    for c in WIDE_COLUMNS:
        if c.name not in df.columns:
            if c.name in NOT_NULL:
                checks.append(F.lit(f"{c.name}: missing"))
            continue
        if c.length is not None:
            n = F.length(F.col(c.name))
            checks.append(F.when(n > c.length, F.format_string("%s: length %d > %d", F.lit(c.name), n, F.lit(c.length))))
        if c.name in NOT_NULL:
            checks.append(F.when(F.col(c.name).isNull(), F.lit(f"{c.name}: null")))
    return F.concat_ws("; ", *checks) if checks else F.lit("")


def tag_conforming(df: DataFrame, widen: bool = True, raw: str | None = None) -> DataFrame:
    """Every row cast to the wide schema, with ``_reason`` ('' if it conforms);
    one pass, nothing split off. ``raw`` names a column for what a cast may
    have changed of the row, as it came in (a struct, null where nothing is cast)."""
    wanted = [c for c in WIDE_COLUMNS if widen or c.name in df.columns or c.name in NOT_NULL]
    cast = [c for c in wanted if c.name in df.columns and df.schema[c.name].dataType != c.type]
    uncast = [
        F.when(F.col(c.name).isNotNull() & F.col(c.name).try_cast(c.type).isNull(), F.concat(
            F.lit(f"{c.name}: not a {c.type.simpleString()} <"), F.col(c.name).cast("string"), F.lit(">")))
        for c in cast
    ]
    came = [(F.struct(*[c.name for c in cast]) if cast else F.lit(None)).alias(raw)] if raw else []
    typed = df.select(*[
        (F.col(c.name).try_cast(c.type) if c.name in df.columns else F.lit(None).cast(c.type)).alias(c.name)
        for c in wanted
    ], *[c for c in df.columns if c not in WIDE_NAMES], *came, F.concat_ws("; ", *uncast).alias("_uncast"))
    return typed.withColumn("_reason", F.concat_ws(
        "; ", F.nullif(F.col("_uncast"), F.lit("")), F.nullif(_violations(typed), F.lit("")))).drop("_uncast")


def conform(df: DataFrame, widen: bool = True) -> tuple[DataFrame, DataFrame]:
    """Cast to the wide schema; (conforming rows, rejects with ``reason``).

    A row is rejected when a value does not cast, a bounded text column is
    longer than declared or a NOT NULL column is null. Both outputs come from
    one scan expression, which Spark evaluates once per branch; an ingest that
    writes both writes ``tag_conforming`` once instead (``plans.run.staged_rows``).
    ``widen=False`` casts and checks only the columns present (plus the NOT
    NULL ones), so a feed's rows stay narrow until they are read as the wide
    table.
    """
    tagged = tag_conforming(df, widen)
    ok = tagged.filter(F.col("_reason") == "").drop("_reason")
    rejects = tagged.filter(F.col("_reason") != "").withColumnRenamed("_reason", "reason")
    return ok, rejects

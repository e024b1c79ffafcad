"""Replace-or-keep by business key, rejects, lookups, audit stamps, statements.

The source pipeline handles one item at a time: look the key up, delete or
refuse, then store. Here a whole batch is applied with one aggregate (to
reduce the batch to one row per key) and one anti join (to drop the target
rows it replaces, or the batch rows the target has already). Arrival order decides which batch row wins, so callers
pass the order explicitly (page, position from the envelope) and never rely
on ``dropDuplicates``, which keeps an arbitrary row.

Key semantics follow the source store: keys compare with ``=``, so a row
with a null key never matches anything; such rows are appended and not
reduced. ``null_safe=True`` makes null a key value like any other.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedyard.functions.dates import instant
from feedyard.schema import AUDIT_COLUMNS


def any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _order_struct(order: Sequence[str | Column]) -> Column:
    return F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])


def _key_cond(left: DataFrame, right: DataFrame, keys: Sequence[str], right_prefix: str, null_safe: bool):
    conds = []
    for k in keys:
        l, r = left[k], right[f"{right_prefix}{k}"]
        conds.append(l.eqNullSafe(r) if null_safe else l == r)
    return reduce(lambda a, b: a & b, conds)


def _key_frame(df: DataFrame, keys: Sequence[str], prefix: str = "_k_") -> DataFrame:
    return df.select(*[F.col(k).alias(f"{prefix}{k}") for k in keys])


def counted_side(df: DataFrame, few: bool | None) -> DataFrame:
    """A side of a join whose rows were counted: few are sent to every task,
    more are shuffled and never pass the driver. Uncounted (None), Spark
    decides from the size of the files below, in which a row of a sorted or
    constant column takes next to nothing."""
    return df if few is None else df.hint("broadcast" if few else "merge")


def _split_null(df: DataFrame, keys: Sequence[str], null_safe: bool) -> tuple[DataFrame, DataFrame | None]:
    """(rows that can match, rows with a null key or None).

    Under ``=`` a null key never matches, so those rows go around the join:
    an anti/semi join does not drop them before the shuffle, and all nulls
    hash to one task.
    """
    if null_safe:
        return df, None
    return df.filter(~any_null(keys)), df.filter(any_null(keys))


def _anti(left: DataFrame, right_keys: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """left rows whose key is not in right_keys (a ``_key_frame``); null keys kept."""
    matchable, nulls = _split_null(left, keys, null_safe)
    out = matchable.join(right_keys, on=_key_cond(matchable, right_keys, keys, "_k_", null_safe), how="left_anti")
    return out if nulls is None else out.unionByName(nulls)


def _semi(left: DataFrame, right_keys: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """left rows whose key is in right_keys; a null key never matches."""
    matchable, _ = _split_null(left, keys, null_safe)
    return matchable.join(right_keys, on=_key_cond(matchable, right_keys, keys, "_k_", null_safe), how="left_semi")


# -- batch reduction -----------------------------------------------------------
def _total_order(df: DataFrame, order: Sequence[str | Column]) -> list[Column]:
    """``order`` made total: remaining (orderable) columns break its ties."""
    named = [c for c in order if isinstance(c, str)]
    rest = [F.col(f.name) for f in df.schema.fields
            if f.name not in named and f.dataType.typeName() not in ("map", "variant")]
    return [F.col(c) if isinstance(c, str) else c for c in order] + rest


def _reduce_parts(batch: DataFrame, keys: Sequence[str], order: Sequence[str | Column], keep: str,
                  null_safe: bool) -> tuple[DataFrame, DataFrame | None]:
    """(one row per non-null key, null-key rows passed through or None)."""
    nonnull, nulls = _split_null(batch, keys, null_safe)
    by = _total_order(batch, order)
    ranked = Window.partitionBy(*keys).orderBy(*[c.desc() if keep == "last" else c.asc() for c in by])
    reduced = nonnull.withColumn("_at", F.row_number().over(ranked)).where("_at = 1").drop("_at")
    return reduced, nulls


def reduce_batch(batch: DataFrame, keys: Sequence[str], order: Sequence[str | Column], keep: str = "last",
                 null_safe: bool = False) -> DataFrame:
    """One row per key: the last (``keep='last'``) or first row in ``order``.

    A row number limited to 1: Spark keeps the top row per key of each task
    before the shuffle, so a hot key is reduced there instead of landing
    whole in one task. Ties in ``order`` are broken by the other columns.
    Null-key rows pass through unreduced unless ``null_safe``.
    """
    reduced, nulls = _reduce_parts(batch, keys, order, keep, null_safe)
    return reduced if nulls is None else reduced.unionByName(nulls)


def first_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[str | Column], last: bool) -> DataFrame:
    """``reduce_batch`` under ``=`` keys, by flag."""
    return reduce_batch(batch, keys, order, "last" if last else "first")


# -- O25 / O26 -----------------------------------------------------------------
def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
           mode: str = "replace", null_safe: bool = False, few: bool | None = None) -> DataFrame:
    """The target table after applying ``batch``.

    ``replace``: batch rows replace every target row with the same key; the
    last batch row per key wins. ``keep``: a key already in the target is
    left alone and the first batch row per key is inserted; see
    ``reject_duplicates`` for the refused rows. ``few`` tells ``replace``
    whether a counted batch has few rows (``counted_side``).
    """
    keys = list(keys)
    columns = target.columns
    if mode in ("replace", "keep"):
        reduced, nulls = _reduce_parts(batch, keys, order, "last" if mode == "replace" else "first", null_safe)
        old, old_nulls = _split_null(target, keys, null_safe)
        fresh = reduced.select(*columns)
        if mode == "replace":
            # the batch's keys, one each, are the side that AQE broadcasts
            # when the batch is small: the target is then not shuffled
            named = _key_frame(_split_null(batch, keys, null_safe)[0], keys).distinct()
            old = _anti(old, counted_side(named, few), keys, null_safe)
        else:
            # of the target only its keys are read here
            fresh = _anti(fresh, _key_frame(old, keys), keys, null_safe)
        out = old.unionByName(fresh)
        for extra in (old_nulls, nulls):
            out = out if extra is None else out.unionByName(extra.select(*columns))
        return out
    if mode == "newest":
        # like replace, but a target row later in ``order`` than every batch
        # row of its key survives: the result does not depend on how rows
        # were split into batches (micro-batches may arrive out of order)
        b = batch.select(*columns)
        bk = _key_frame(_split_null(b, keys, null_safe)[0], keys)
        contenders = _semi(target, bk, keys, null_safe).unionByName(b)
        untouched = _anti(target, bk, keys, null_safe)
        return untouched.unionByName(reduce_batch(contenders, keys, order, "last", null_safe))
    raise ValueError("mode must be 'replace', 'keep' or 'newest'")


# -- O27 -------------------------------------------------------------------------
# The reject message of the source pipeline, "Duplicate item
# found: " followed by "key<value>" per key column, joined by ",".
DUPLICATE_PREFIX = "Duplicate item found: "
DUPLICATE_PART = "%s<%s>"


def duplicate_reason(keys: Sequence[str]) -> Column:
    """'Duplicate item found: k1<v1>,k2<v2>' (the source pipeline's message)."""
    parts = [F.format_string(DUPLICATE_PART, F.lit(k), F.coalesce(F.col(k).cast("string"), F.lit("None")))
             for k in keys]
    return F.concat(F.lit(DUPLICATE_PREFIX), F.concat_ws(",", *parts))


def reject_duplicates(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                      null_safe: bool = False) -> DataFrame:
    """Batch rows refused in ``keep`` mode, with the reason: the key is in the
    target already, or an earlier batch row took it."""
    keys = list(keys)
    columns = batch.columns
    matchable = _split_null(batch, keys, null_safe)[0]  # a null-key row is never a duplicate
    tk = _key_frame(_split_null(target, keys, null_safe)[0], keys)
    # equal rows first become one with a count, so that all but one of them
    # can be refused; a hot key's copies collapse before the shuffle
    counted = matchable.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    in_target = _semi(counted, tk, keys, null_safe)
    fresh = counted.join(tk, on=_key_cond(counted, tk, keys, "_k_", null_safe), how="left_anti")
    at = F.struct(*_total_order(batch, order))
    firsts = fresh.groupBy(*keys).agg(F.min(at).alias("_first"))
    firsts = firsts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_first")
    # an inner join, which AQE splits on a hot key
    later = fresh.join(firsts, on=_key_cond(fresh, firsts, keys, "_k_", null_safe), how="inner").withColumn(
        "_n", F.when(at.eqNullSafe(F.col("_first")), F.col("_n") - 1).otherwise(F.col("_n")))
    refused = in_target.unionByName(later.select(*columns, "_n")).where("_n > 0")
    each = refused.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    return each.select(*columns).withColumn("reason", duplicate_reason(keys))


def quarantine(records: DataFrame, feed: str) -> DataFrame:
    """Records whose date fields do not parse, with the reason; only the bad
    row is rejected, never the rest of its page."""
    from feedyard.operators.project import split_malformed
    return split_malformed(records, feed)[1]


# -- O28 -------------------------------------------------------------------------
def lookup_existing(target: DataFrame, batch: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Target rows whose key occurs in the batch: one semi join for the whole
    batch instead of one lookup per item. AQE broadcasts the key side when
    its measured size is small."""
    bk = _key_frame(_split_null(batch, keys, null_safe)[0], keys)
    return _semi(target, bk, keys, null_safe)


# -- O29 -------------------------------------------------------------------------
def stamp(df: DataFrame, run_id: str, as_of: _dt.datetime | str | Column, previous: DataFrame | None = None,
          keys: Sequence[str] | None = None) -> DataFrame:
    """Audit columns: ``_tid`` = run id, ``updated_at`` = as_of, ``created_at``
    kept from the row being replaced (``previous``, matched on ``keys``) or
    as_of for a new row."""
    ts = instant(as_of)
    base = df.drop(*[c for c in AUDIT_COLUMNS if c in df.columns])
    fresh = base.withColumn("_tid", F.lit(run_id)).withColumn("created_at", ts).withColumn("updated_at", ts)
    return fresh if previous is None or not keys else carry_created_at(fresh, previous, keys)


def carry_created_at(batch: DataFrame, previous: DataFrame, keys: Sequence[str], few: bool | None = None) -> DataFrame:
    """``created_at`` of each batch row becomes the earliest ``created_at`` of
    the previous rows with its key, where there are any (null keys never
    match and go around the join). ``few`` as in ``upsert``."""
    keys = list(keys)
    matchable, nulls = _split_null(batch, keys, False)
    prev = _semi(previous, counted_side(_key_frame(matchable, keys), few), keys, False)
    prev = prev.groupBy(*keys).agg(F.min("created_at").alias("_prev_created"))
    prev = counted_side(prev.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_prev_created"), few)
    joined = matchable.join(prev, on=_key_cond(matchable, prev, keys, "_k_", False), how="left")
    out = joined.withColumn("created_at", F.coalesce(F.col("_prev_created"), F.col("created_at"))) \
        .drop("_prev_created", *[f"_k_{k}" for k in keys])
    return out if nulls is None else out.unionByName(nulls)


def upsert_stamped(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                   run_id: str, as_of, null_safe: bool = False) -> DataFrame:
    """``upsert(replace)`` whose new rows carry the run's audit stamps."""
    b = reduce_batch(batch, keys, order, "last", null_safe)
    stamped = stamp(b, run_id, as_of, previous=lookup_existing(target, b, keys, null_safe), keys=keys)
    sk = _key_frame(_split_null(stamped, keys, null_safe)[0], keys)
    kept = _anti(target, sk, keys, null_safe)
    return kept.unionByName(stamped.select(*target.columns))


# -- O33 -------------------------------------------------------------------------
def run_statement(spark: SparkSession, sql: str, params: Mapping[str, object] | None = None,
                  views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """A target's own statement instead of the generic upsert: named
    parameters (``:name``) and DataFrames referenced as ``{name}``; no SQL
    text is built from values."""
    return spark.sql(sql, args=dict(params or {}), **dict(views or {}))

"""Sharding by histogram sort: byte-balanced shards from exact byte counts.

Rows are ordered by a 64-bit key of their text (equal texts lie together) and
a row number that parts equal keys. Splitters between the shards are found
without sorting: each round counts, over all partitions, the exact bytes in
the intervals between candidate keys (a partial aggregate; one small row per
interval reaches the driver), and the next candidates refine the intervals
that hold a target. A splitter is done when its interval's bytes are within
the tolerance or it holds a single row; a group of equal texts that is larger
than the tolerance is refined by row number, so a hot group is cut over
shards. The same search places finer cuts inside each shard, as many as the
bytes of all rows ask for (``PART_BYTES``), and only then rows are exchanged,
once, by fine interval; slots are the interval's offset plus a local row
number, so no task sorts a whole shard. A round counts about ``CANDIDATES``
keys, or two for each interval that is still open if those are more.

Law ``bytes``: shard sizes are near equal, each boundary off by at most the
tolerance or half a row. Defined results: null texts have no bytes and count
with the fixed row cost; rows with null ids are sharded like others; ties and
repeated rows stay, each with its own slot; an empty table gives an empty
result. Input columns beyond id and text are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedyard.llm.common import landed

LOWEST = -(1 << 63)
#: Candidate keys per open interval and round, at most.
PROBES = 32
#: Candidate keys of a round, about: what reaches the driver.
CANDIDATES = 200_000
#: Allowed error of a shard boundary, as a part of a shard's bytes.
TOLERANCE = 0.001
#: Fine intervals per shard, at least, and their bytes, about: the unit of the
#: exchange and of the slot sort.
FINE = 16
PART_BYTES = 512 << 20

Key = tuple[int, int]


def _interval(cuts: list[Key], offsets: list[int] | None = None):
    """(key, row) -> number of cuts at or below it, for sorted cuts (at), and
    the offset of that interval (start)."""
    keys = np.array([k for k, _ in cuts], dtype=np.int64)
    rows = np.array([r for _, r in cuts], dtype=np.int64)
    starts = np.array(offsets or np.zeros(len(cuts) + 1), dtype=np.int64)

    @F.pandas_udf("at int, start long")
    def interval(key: pd.Series, row: pd.Series) -> pd.DataFrame:
        k, r = key.to_numpy(), row.to_numpy()
        lo, hi = np.searchsorted(keys, k, "left"), np.searchsorted(keys, k, "right")
        at = hi.copy()
        same = lo < hi  # cuts with this very key: the row number decides
        for first in np.unique(lo[same]):
            here = same & (lo == first)
            at[here] = first + np.searchsorted(rows[first:hi[here][0]], r[here], "right")
        return pd.DataFrame({"at": at.astype(np.int32), "start": starts[at]})

    return interval


@dataclass
class _Bracket:
    """Keys low < cut <= high that enclose a target, with the bytes and rows below."""

    low: Key
    high: Key
    below_low: int
    below_high: int
    rows_low: int
    rows_high: int

    def done(self, slack: float) -> bool:
        return self.below_high - self.below_low <= slack or self.rows_high - self.rows_low <= 1

    def probes(self, n: int) -> list[Key]:
        (k0, r0), (k1, r1) = self.low, self.high
        if k1 - k0 > 1:
            # cut between keys: equal texts stay together as long as possible
            return [(k, LOWEST) for i in range(1, n + 1) if k0 < (k := k0 + (k1 - k0) * i // (n + 1)) < k1] + [(k0 + 1, LOWEST)]
        if k1 > k0:
            if r1 > LOWEST:
                return [(k1, LOWEST)]
            r1 = (1 << 63) - 1  # only rows of key k0 are left
        return [(k0, r) for i in range(1, n + 1) if r0 < (r := r0 + (r1 - r0) * i // (n + 1)) < r1] + [(k0, r0 + 1)]


def find_cuts(keys: DataFrame, n_shards: int) -> tuple[list[Key], list[int], int]:
    """Cuts of (key, row) into near equal parts by ``size``, the rows before
    each part, and the number of parts in a shard.

    Cuts between shards meet TOLERANCE of a shard's bytes, the others a
    quarter of a part.
    """
    ends = keys.agg(F.sum("size"), F.count("size"), F.min("key"), F.max("key")).first()
    total, n_rows = int(ends[0] or 0), int(ends[1])
    tight = max(FINE, -(-total // (n_shards * PART_BYTES)))
    parts = n_shards * tight
    if not n_rows:
        return [], [0], tight
    first, last = (int(ends[2]), LOWEST), (int(ends[3]) + 1, LOWEST)
    targets = [total * i / parts for i in range(1, parts)]
    slack = [TOLERANCE * total * tight / parts if i % tight == 0 else total / parts / 4 for i in range(1, parts)]
    found = [_Bracket(first, last, 0, total, 0, n_rows) for _ in targets]
    while open_ := [i for i, b in enumerate(found) if not b.done(slack[i])]:
        apart = {(b.low, b.high): b for b in (found[i] for i in open_)}
        n = max(1, min(PROBES, CANDIDATES // len(apart)))
        cuts = sorted({p for b in apart.values() for p in b.probes(n)})
        held = keys.groupBy(_interval(cuts)(F.col("key"), F.col("row"))["at"].alias("i")).agg(
            F.sum("size").alias("bytes"), F.count("size").alias("rows"),
            F.min("key"), F.max("key"), F.min("row"), F.max("row"),
        ).collect()
        size, rows = np.zeros(len(cuts) + 1, np.int64), np.zeros(len(cuts) + 1, np.int64)
        extent: dict[int, tuple[Key, Key]] = {}
        for i, r_bytes, r_rows, k0, k1, r0, r1 in held:
            size[i], rows[i] = r_bytes, r_rows
            extent[i] = ((k0, r0 if k0 == k1 else LOWEST), (k0, r1 + 1) if k0 == k1 else (k1 + 1, LOWEST))
        below, before = np.cumsum(size), np.cumsum(rows)
        for i in open_:
            b = found[i]
            inside = range(bisect_right(cuts, b.low), bisect_left(cuts, b.high))
            # the first of the inner cuts with more bytes below than the target
            j = inside.start + int(np.searchsorted(below[inside.start:inside.stop], targets[i], "right"))
            if j < inside.stop:
                b.high, b.below_high, b.rows_high = cuts[j], int(below[j]), int(before[j])
            if j > inside.start:
                b.low, b.below_low, b.rows_low = cuts[j - 1], int(below[j - 1]), int(before[j - 1])
            if j in extent:  # the bracket is interval j now: draw it in to the keys it holds
                b.low, b.high = max(b.low, extent[j][0]), min(b.high, extent[j][1])
    cuts, before = [], [0]
    for b, t in zip(found, targets, strict=True):
        near_low = t - b.below_low <= b.below_high - t
        cuts.append(b.low if near_low else b.high)
        before.append(b.rows_low if near_low else b.rows_high)
    return cuts, before, tight


def shard_rows(
    docs: DataFrame, id_col: str, text_col: str, n_shards: int, row_cost: int = 0, carry: tuple[str, ...] = (),
) -> DataFrame:
    """id_col, size, text_crc32, shard, slot: ``docs`` in byte-balanced shards.

    ``size`` is the text's UTF-8 bytes plus ``row_cost``. ``carry`` names
    columns that travel along, returned in a struct ``carried``.
    """
    text: Column = F.col(text_col)
    along = [F.struct(*[F.col(c) for c in carry]).alias("carried")] if carry else []
    keys = landed(docs.select(
        *along,
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + row_cost).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("key"),
        F.monotonically_increasing_id().alias("row"),
    ), "shard-keys")
    cuts, before, fine = find_cuts(keys, n_shards)
    shard_start = [before[min(s * fine, len(before) - 1)] for s in range(n_shards)]
    offsets = [b - shard_start[min(i // fine, n_shards - 1)] for i, b in enumerate(before)]
    local = F.row_number().over(Window.partitionBy("part").orderBy("key", "row"))
    placed = keys.withColumn("to", _interval(cuts, offsets)(F.col("key"), F.col("row"))).withColumn("part", F.col("to.at"))
    return placed.withColumn("local", local).select(
        F.col("id").alias(id_col), "size", "text_crc32",
        F.floor(F.col("part") / fine).cast("int").alias("shard"),
        (F.col("to.start") + F.col("local") - 1).cast("long").alias("slot"),
        *(["carried"] if carry else []),
    )

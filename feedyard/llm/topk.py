"""Exact top-k inner product search over norm buckets.

Vectors are sorted by length and cut into buckets of a fixed number of rows,
longest first; a bucket is one row that holds its ids and components. Queries
are packed into blocks the same way. Every query block meets every bucket as
one cell (fragment and replicate, both sides in blocks), in two passes:

1. Each query is scored on the longest bucket alone: its k-th best score is a
   floor that the true top k cannot fall below.
2. In every other bucket the floor becomes a local cosine threshold, the
   floor over |q| times the bucket's longest length. Above 1 the bucket is
   skipped for the query. A high threshold prunes by coordinates: with cosine
   at least t to the unit query u, a unit vector's coordinate f lies within
   u_f t +- sqrt((1 - t^2)(1 - u_f^2)), but may rise to 1 where u_f >= t and
   fall to -1 where u_f <= -t; this is tested on the query's largest
   coordinates. Otherwise it prunes by length: only the prefix of the bucket
   with |q||p| at or above the floor. What is left is verified by exact
   products, and the best k per query and bucket are merged.

Products are exact: float64 while no sum can pass 2^53, integers beyond.

Defined results: vectors that are null or hold null or non-finite components
take no part, nor do rows without id; vectors of unequal length are compared
as if padded with zeros; ties go to the smaller id; a query with fewer than k
candidates gets all of them; a row is no candidate of a query with its own id,
so repeated ids never meet themselves; empty tables give empty results; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedyard.llm.common import landed

#: Vectors in a bucket or query block: bounds the memory of a cell.
BLOCK_ROWS = 2048
#: Query blocks and buckets in a cell, at most.
CELL_BLOCKS = 4
#: Local cosine threshold from which coordinates prune.
COORDINATE_FROM = 0.9
#: Largest coordinates of a query that are tested.
FOCUS = 4
#: Rounding room of pruning tests: pruning never decides a tie.
ROOM = 1e-9

BLOCKS = "block string, longest double, ids binary, norms binary, parts binary, width int"
HITS = "query_id long, id long, score long"
EXACT = 1 << 53
WIDE = 1 << 62


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """id, vector: floor(scale * x) of each component, as whole doubles."""
    v = F.col(vector_col)
    sound = v.isNotNull() & F.col(id_col).isNotNull() & ~F.exists(
        v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )

    def floor(x):
        y = x.cast("double") * scale
        # doubles from 2^53 on are whole, and may be too large for F.floor's long
        return F.when(F.abs(y) < float(EXACT), F.floor(y).cast("double")).otherwise(y)

    return vectors.where(sound).select(F.col(id_col).cast("long").alias("id"), F.transform(v, floor).alias("vector"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by falling norm -> blocks of BLOCK_ROWS rows."""
    held: list[tuple[int, np.ndarray]] = []

    def block() -> pa.RecordBatch:
        width = max((len(v) for _, v in held), default=0)
        parts = np.zeros((len(held), width))
        for k, (_, v) in enumerate(held):
            parts[k, :len(v)] = v
        ids = np.array([i for i, _ in held], dtype=np.int64)
        norms = np.sqrt((parts * parts).sum(axis=1))
        name = f"{norms.max():.6e}/{ids[0]}/{ids[-1]}/{len(ids)}"
        return pa.RecordBatch.from_pydict({
            "block": [name], "longest": [float(norms.max())], "ids": [ids.tobytes()],
            "norms": [norms.tobytes()], "parts": [parts.tobytes()], "width": pa.array([width], pa.int32()),
        })

    for batch in batches:
        vectors = batch.column(1)
        flat = vectors.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False))
        for i, end, start in zip(batch.column(0).to_pylist(), ends, np.r_[0, ends[:-1]]):
            held.append((i, flat[start:end]))
            if len(held) == BLOCK_ROWS:
                yield block()
                held.clear()
    if held:
        yield block()


def blocks(vectors: DataFrame, kind: str) -> DataFrame:
    """``vectors`` (id, vector) packed by falling norm, numbered from 0."""
    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    packed = (
        vectors.select("id", "vector", norm.alias("norm"))
        .repartitionByRange(F.col("norm").desc(), "id")
        .sortWithinPartitions(F.col("norm").desc(), "id")
        .select("id", "vector")
        .mapInArrow(_pack, BLOCKS)
    )
    return landed(packed, kind)


def _open(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(row.ids, np.int64)
    return ids, np.frombuffer(row.norms, np.float64), np.frombuffer(row.parts, np.float64).reshape(len(ids), row.width)


def products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact integer products of whole-number rows, as int64 (as objects beyond)."""
    width = min(q.shape[1], p.shape[1])
    q, p = q[:, :width], p[:, :width]
    top = max(1.0, np.abs(q).max(initial=0)) * max(1.0, np.abs(p).max(initial=0)) * max(1, width)
    if top < EXACT:
        return (q @ p.T).astype(np.int64)
    if top < WIDE:
        return q.astype(np.int64) @ p.astype(np.int64).T
    whole = np.vectorize(int, otypes=[object])
    made = whole(q) @ whole(p).T if width and q.size and p.size else np.zeros((len(q), len(p)), object)
    return np.clip(made, 1 - (1 << 63), (1 << 63) - 1).astype(np.int64)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(ids) > k:
        at = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = scores >= at
        ids, scores = ids[keep], scores[keep]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _survivors(q: np.ndarray, q_norm: float, floor: float, norms: np.ndarray, parts: np.ndarray) -> np.ndarray | slice:
    """Bucket rows that may reach ``floor``; norms fall."""
    if q_norm == 0 or norms[0] == 0 or floor <= 0:
        return slice(0, len(norms) if floor <= 0 else 0)
    t = floor / (q_norm * norms[0]) * (1 - ROOM)
    if t > 1:
        return slice(0, 0)
    prefix = int(np.searchsorted(-norms * q_norm, -floor * (1 - ROOM), "right"))
    if t < COORDINATE_FROM:
        return slice(0, prefix)
    u = q / q_norm
    alive = np.arange(prefix)
    for f in np.argsort(-np.abs(u))[:FOCUS]:
        if f >= parts.shape[1]:
            continue
        reach = np.sqrt(max(0.0, (1 - t * t) * (1 - u[f] * u[f]))) + ROOM
        unit = parts[alive, f] / np.maximum(norms[alive], 1e-300)
        # the axis itself lies in the cap around u: its end is open
        high = np.inf if u[f] >= t else u[f] * t + reach
        low = -np.inf if u[f] <= -t else u[f] * t - reach
        alive = alive[(unit >= low) & (unit <= high)]
    return alive


def _cell(k: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for b in right.itertuples():
            ids, norms, parts = _open(b)
            for a in left.itertuples():
                q_ids, q_norms, q_parts = _open(a)
                floors = np.frombuffer(a.floors, np.float64)
                full, kept = [], {}
                for i in range(len(q_ids)):
                    rows = _survivors(q_parts[i], q_norms[i], floors[i], norms, parts)
                    if isinstance(rows, slice):
                        if rows.stop:
                            full.append((i, rows.stop))
                    elif len(rows):
                        kept[i] = rows
                # rows pruned by length share one product, up to the longest prefix
                scores = products(q_parts[[i for i, _ in full]], parts[:max((n for _, n in full), default=0)]) if full else None
                for at, (i, n) in enumerate(full):
                    other = ids[:n] != q_ids[i]
                    out.append((q_ids[i], *_best(ids[:n][other], scores[at, :n][other], k)))
                for i, rows in kept.items():
                    rows = rows[ids[rows] != q_ids[i]]
                    out.append((q_ids[i], *_best(ids[rows], products(q_parts[i:i + 1], parts[rows])[0], k)))
        n = [len(i) for _, i, _ in out]
        return pd.DataFrame({
            "query_id": np.repeat(np.array([q for q, _, _ in out], dtype=np.int64), n),
            "id": np.concatenate([i for _, i, _ in out]) if out else np.zeros(0, np.int64),
            "score": np.concatenate([s for _, _, s in out]) if out else np.zeros(0, np.int64),
        })
    return run


def _top(hits: DataFrame, k: int) -> DataFrame:
    """Best k per query, ties to the smaller id; each (query, id) once."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _floors(lead, k: int):
    """Adds to query blocks each query's k-th best score in the lead bucket."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, _, parts = _open(lead.value)
        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                q_ids, _, q_parts = _open(r)
                floors = np.full(len(q_ids), -np.inf)
                for i, scores in enumerate(products(q_parts, parts)):
                    scores = scores[ids != q_ids[i]]
                    if len(scores) >= k:
                        floors[i] = np.partition(scores, len(scores) - k)[len(scores) - k]
                rows.append(floors.tobytes())
            yield pdf.assign(floors=rows)
    return run


def exact_topk(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """query_id, rank (from 1), id, score: the k best of ``vectors`` per query.

    Both sides: id, vector (whole doubles). A query's own id is no candidate.
    """
    spark = vectors.sparkSession
    buckets = blocks(vectors, "buckets")
    lead = buckets.orderBy(F.desc("longest"), "block").first()
    if lead is None:
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    # pass 1: one bucket, of BLOCK_ROWS vectors at most, goes to all query blocks
    asked = landed(
        blocks(queries, "query-blocks").mapInPandas(_floors(spark.sparkContext.broadcast(lead), k), BLOCKS + ", floors binary"),
        "floors",
    )
    # pass 2: cells of some query blocks and some buckets
    groups = max(1, -(-buckets.count() // CELL_BLOCKS))
    shares = max(1, -(-asked.count() // CELL_BLOCKS))

    def deal(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("block"), F.lit(n_own)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))

    left = deal(asked, "share", shares, "group", groups).groupBy("share", "group")
    right = deal(buckets, "group", groups, "share", shares).groupBy("share", "group")
    return _top(left.cogroup(right).applyInPandas(_cell(k), HITS), k).select("query_id", "rank", "id", "score")

"""N-gram Jaccard join: MinHash bands for candidates, full sets to verify.

Documents are sets of hashed five-word shingles. Equal sets are one class of
copies and joined once, by their representative. Each class gets MinHash
values in bands; rows per band and the number of bands follow from the
similarity threshold and the target recall (``choose_bands``). Classes that
share a band bucket are candidates.

Candidates are then verified on the full shingle sets, rebuilt from the texts
of their representatives only, bucket by bucket: buckets with the same members
are verified once, and a pair that shares several buckets counts in that of
its first shared band. Where a connected group of buckets costs more that way
than all its pairs do (copies that share nearly every bucket), the group is
verified as if it were one bucket; a chain, however long, is not. What is
verified together is cut into blocks of a bounded number of classes and
shingles, and each pair of blocks is one cell, so a bucket of any size is
spread over tasks; a cell counts shared shingles by matrix products and
returns one row per class (links found, a tie to its linked neighbours),
never the pairs. So no link between candidates is lost.

Result: one row per document with its class id (the smallest document id of
all documents connected by links) and its number of links (other documents
with a similarity at or above the threshold, copies included).

Defined results: words are runs of word characters of the lower-cased text;
a text of one to four words is one shingle; a text without words (null, empty)
is alone, with its own id as class id; rows with null ids take part, and a
class with only null ids has a null class id; repeated rows are copies of each
other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedyard.llm.common import free_names, landed, text_groups
from feedyard.llm.graph import components

SHINGLE = 5
THRESHOLD = 0.8
#: Chance that a pair at the threshold shares a band.
RECALL = 0.9999
#: MinHash values per document, at most.
MOST_HASHES = 300
#: Classes and shingles in a block, about: a cell holds two blocks at most.
BLOCK = 512
BLOCK_GRAMS = 1 << 20
#: Comparisons that cost as much as bringing one more set to a cell.
SHIP = 64
#: Columns of the incidence matrix handled at once.
COLUMNS = 4096

SIGNED = "id long, t1 long, t2 long, n int, k1 long, k2 long, bands array<long>"

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(rows, bands): the steepest curve that reaches the recall within ``most`` values."""
    best = (1, max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold)))) if threshold < 1 else (most, 1)
    for rows in range(1, most + 1):
        hit = threshold ** rows
        bands = math.ceil(math.log(1 - recall) / math.log1p(-hit)) if hit < 1 else 1
        if rows * bands <= most:
            best = (rows, bands)
    return best


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit mixing of whole numbers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _word_chars() -> np.ndarray:
    return np.array([(c := chr(k)).isalnum() or c == "_" for k in range(0xFFFF)] + [True])


_WORD: np.ndarray | None = None
_PLACE = mix(np.arange(1, 1025, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> list[np.ndarray]:
    """The set of hashed shingles of each text, sorted."""
    global _WORD
    if _WORD is None:
        _WORD = _word_chars()
    low = [(t or "").lower() for t in texts]
    codes = np.frombuffer("\0".join(low).encode("utf-32-le"), dtype=np.uint32)
    # characters beyond U+FFFE count as word characters
    inside = _WORD[np.minimum(codes, 0xFFFF)] if len(codes) else np.zeros(0, bool)
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if len(starts):
        place = np.arange(len(codes)) - np.repeat(np.r_[0, starts], np.diff(np.r_[0, starts, len(codes)]))
        value = mix(codes.astype(np.uint64) + np.uint64(0x9E3779B9)) * _PLACE[place & 1023]
        value[~inside] = 0
        words = mix(np.add.reduceat(value, starts) + (ends - starts).astype(np.uint64))
    else:
        words = np.zeros(0, np.uint64)
    # first word of each text
    first = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in low]))
    sets = []
    rolled = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size if len(rolled) else 0):
        rolled = mix(rolled * np.uint64(31) + words[k:k + len(rolled)])
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= size:
            sets.append(np.unique(rolled[a:b - size + 1]))
        elif b > a:
            short = np.zeros(1, np.uint64)
            for w in words[a:b]:
                short = mix(short * np.uint64(31) + w)
            sets.append(mix(short + np.uint64(b - a)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def band_hashes(sets: list[np.ndarray], rows: int, bands: int) -> np.ndarray:
    """One row of band hashes per (non-empty) set."""
    flat = np.concatenate(sets)
    x = (flat >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    seeds = mix(np.arange(1, 2 * rows * bands + 1, dtype=np.uint64))
    out = np.zeros((len(sets), bands), np.uint64)
    turned = np.empty_like(x)
    for k in range(rows * bands):
        np.multiply(x, np.uint32(seeds[2 * k] & np.uint64(0xFFFFFFFF)) | np.uint32(1), out=turned)
        np.add(turned, np.uint32(seeds[2 * k + 1] & np.uint64(0xFFFFFFFF)), out=turned)
        low = np.minimum.reduceat(turned, starts).astype(np.uint64)
        out[:, k // rows] = mix(out[:, k // rows] * np.uint64(31) + low + np.uint64(1))
    return out


def _sign(rows: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(3).to_pylist()
            for first, end in text_groups(texts):
                sets = shingle_sets(texts[first:end])
                n = np.array([len(s) for s in sets], np.int32)
                k1 = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64)
                k2 = np.array([mix(s ^ _M1).sum(dtype=np.uint64) for s in sets], np.uint64)
                full = [s for s in sets if len(s)]
                flat = band_hashes(full, rows, bands).ravel() if full else np.zeros(0, np.uint64)
                ends = np.cumsum(np.r_[0, (n > 0) * bands]).astype(np.int32)
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), part.column(2), pa.array(n), pa.array(k1.view(np.int64)),
                    pa.array(k2.view(np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64))),
                ], names=["id", "t1", "t2", "n", "k1", "k2", "bands"])
    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(F.lit(1), text).alias("t1"),
        F.xxhash64(F.lit(2), text).alias("t2"), text.alias("text"),
    )


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for first, end in text_groups(texts):
            sets = shingle_sets(texts[first:end])
            part = batch.slice(first, end - first)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[1:], pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["node", "copies", "band", "cell", "i", "j", "block", "bands", "grams"],
            )


def linked(sets: list[np.ndarray], threshold: float, upper: np.ndarray | None = None) -> np.ndarray:
    """Boolean matrix: similarity of the sets at or above the threshold.

    The number of shared shingles is a product of incidence rows, over the
    shingles that at least two sets have, some columns at a time.
    """
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = count > 1
    shared = common[column]
    owner, column = owner[shared], (np.cumsum(common) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    same = np.zeros((len(sets), len(sets)), np.float32)
    n_columns = int(common.sum())
    cuts = np.searchsorted(column, np.arange(0, n_columns + COLUMNS, COLUMNS))
    for k in range(len(cuts) - 1):
        if cuts[k] < cuts[k + 1]:
            part = np.zeros((len(sets), min(COLUMNS, n_columns - k * COLUMNS)), np.float32)
            part[owner[cuts[k]:cuts[k + 1]], column[cuts[k]:cuts[k + 1]] - k * COLUMNS] = 1
            same += part @ part.T
    union = sizes[:, None] + sizes[None, :] - same
    return same >= threshold * union - 1e-6


def _verify(threshold: float):
    def cell(rows: list[tuple]) -> tuple[list[int], list[int], list[int]]:
        at = {}
        for r in rows:  # repeated rows of one document stand for one class
            at.setdefault(r[0], r)
        nodes = sorted(at)
        copies = np.array([at[v][1] for v in nodes], np.int64)
        block = np.array([at[v][6] for v in nodes])
        link = linked([np.frombuffer(at[v][8], np.uint64) for v in nodes], threshold)
        np.fill_diagonal(link, False)
        band, i, j = rows[0][2], rows[0][4], rows[0][5]
        if i != j:  # pairs inside a block belong to its own cell
            link &= block[:, None] != block[None, :]
        if band > 0:  # pairs that share an earlier band belong to that one's bucket
            for earlier in np.array([at[v][7][:band] for v in nodes], np.int64).T:
                link &= earlier[:, None] != earlier[None, :]
        links = link @ copies
        # smallest node reachable over links inside the cell
        low = np.arange(len(nodes))
        while True:
            near = np.where(link, low[None, :], len(nodes)).min(axis=1, initial=len(nodes))
            new = np.minimum(low, near)
            new = new[new]
            if (new == low).all():
                break
            low = new
        return nodes, links.tolist(), [nodes[k] for k in low]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        made: tuple[list, list, list] = ([], [], [])

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in made], names=["node", "links", "low"])
            for c in made:
                c.clear()
            return batch

        def close() -> None:
            if held:
                for have, new in zip(made, cell(held)):
                    have.extend(new)
                held.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[2:6] != held[0][2:6]:
                    close()
                    if len(made[0]) > 10_000:
                        yield out()
                held.append(row)
        close()
        if made[0]:
            yield out()

    return run


def candidate_cells(classes: DataFrame, buckets: DataFrame, groups: DataFrame) -> DataFrame:
    """node, band, cell, i, j, block: where each class is verified.

    ``cell`` is a bucket's hash with its ``band``, or with band -1 the label
    of a group that is verified as one.
    """
    # buckets of the same members: that of the first band stands for all
    distinct = buckets.groupBy("head", "sets", "grams", "x1", "x2").agg(F.min(F.struct("band", "hash")).alias("b")).select(
        F.col("head").alias("node"), "sets", "grams", "b.band", "b.hash")
    cost = F.sum(F.col("grams") * (F.col("sets") + F.lit(float(SHIP))))
    by_bucket = distinct.join(groups, "node").groupBy("label").agg(cost.alias("by_bucket"))
    by_group = groups.join(classes.select("node", "n"), "node").groupBy("label").agg(
        F.count("*").alias("sets"), F.sum("n").alias("grams"))
    chosen = landed(
        by_group.join(by_bucket, "label").withColumn(
            "whole", F.col("grams") * (F.col("sets") + F.lit(float(SHIP))) <= F.col("by_bucket")),
        "group-costs",
    )
    whole = groups.join(chosen.where("whole"), "label").select(
        "node", F.lit(-1).alias("band"), F.col("label").alias("cell"), "sets", "grams")
    loose = groups.join(chosen.where("not whole").select("label"), "label").select("node")
    apart = (
        classes.join(loose, "node").select("node", F.posexplode("bands").alias("band", "hash"))
        .join(distinct.drop("node"), ["band", "hash"]).select("node", "band", F.col("hash").alias("cell"), "sets", "grams")
    )
    g = F.ceil(F.greatest(F.col("sets") / BLOCK, F.col("grams") / BLOCK_GRAMS)).cast("int")
    return whole.unionByName(apart).withColumn("g", g).select(
        "node", "band", "cell", F.pmod(F.xxhash64("node"), F.col("g")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("o"),
    ).select("node", "band", "cell", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block")


def similar_groups(
    docs: DataFrame, id_col: str, text_col: str, threshold: float = THRESHOLD, recall: float = RECALL,
) -> tuple[DataFrame, DataFrame]:
    """``documents`` and ``keep`` of ``grouped``."""
    return grouped(docs, id_col, text_col, threshold, recall)[:2]


def grouped(
    docs: DataFrame, id_col: str, text_col: str, threshold: float = THRESHOLD, recall: float = RECALL,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, keep, wordless).

    ``documents``: id_col, class_id, n_links, one row per document. ``keep``:
    id, t1, t2, n_same: the one document of each class that stays (smallest
    id), by id and text hashes, and how many equal rows share them.
    ``wordless``: t1, t2 of the texts without words, each once.
    """
    rows, bands = choose_bands(threshold, recall)
    keyed = _keyed(docs, id_col, text_col)
    signed = landed(keyed.mapInArrow(_sign(rows, bands), SIGNED), "signatures")
    worded, empty = signed.where("n > 0"), signed.where("n = 0")
    # copies first, then sets: hot copies are reduced before each shuffle
    classes = landed(
        worded.groupBy("k1", "k2", "id", "t1", "t2").agg(
            F.count("*").alias("n_same"), F.first("bands").alias("bands"), F.first("n").alias("n"))
        .groupBy("k1", "k2").agg(
            F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "t1", "t2", "n_same")).alias("rep"),
            F.sum("n_same").alias("copies"), F.first("bands").alias("bands"), F.first("n").alias("n"))
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    met = classes.select("node", "n", F.posexplode("bands").alias("band", "hash"))
    buckets = landed(
        met.groupBy("band", "hash").agg(
            F.min("node").alias("head"), F.count("*").alias("sets"), F.sum("n").alias("grams"),
            F.bit_xor(F.xxhash64("node")).alias("x1"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("x2"),
        ).where("sets > 1"),
        "band-buckets",
    )
    ties = landed(
        met.join(buckets.select("band", "hash", "head"), ["band", "hash"]).where(F.col("node") != F.col("head"))
        .select(F.col("node").alias("a"), F.col("head").alias("b")).distinct(),
        "band-ties",
    )
    groups = landed(components(ties), "band-groups")
    placed = candidate_cells(classes, buckets, groups)
    wanted = placed.join(classes.select("node", "copies", "rep.id", "rep.t1", "rep.t2", "bands"), "node")
    wanted = wanted.groupBy("id", "t1", "t2", "node", "copies").agg(
        F.collect_list(F.struct("band", "cell", "i", "j", "block")).alias("places"),
        F.any_value(F.when(F.col("band") > 0, F.col("bands")), True).alias("bands"),
    )
    texts = keyed.join(wanted.withColumnRenamed("id", "rep_id"), ["t1", "t2"]).where(F.col("id").eqNullSafe(F.col("rep_id")))
    cells = (
        texts.select("text", "node", "copies", "bands", F.explode("places").alias("p"))
        .select("text", "node", "copies", "p.*", F.when(F.col("p.band") > 0, F.col("bands")).alias("bands"))
        .mapInArrow(_grams, "node long, copies long, band int, cell long, i int, j int, block int, bands array<long>, grams binary")
    )
    verified = landed(
        cells.repartition("band", "cell", "i", "j").sortWithinPartitions("band", "cell", "i", "j")
        .mapInArrow(_verify(threshold), "node long, links long, low long"),
        "links",
    )
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(verified.select(F.col("node").alias("a"), F.col("low").alias("b")))
    named = (
        classes.drop("bands").join(links, "node", "left").join(labels, "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
    )
    named = landed(named.select("k1", "k2", "rep", "label", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "named-classes")
    firsts = named.groupBy("label").agg(F.min("rep.id").alias("class_id"), F.min("rep").alias("rep"))
    by_set = named.drop("rep").join(firsts.select("label", "class_id"), "label").select("k1", "k2", "class_id", "n_links")
    documents = worded.select("id", "k1", "k2").join(by_set, ["k1", "k2"]).select("id", "class_id", "n_links").unionByName(
        empty.select("id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links")))
    keep = firsts.select("rep.id", "rep.t1", "rep.t2", "rep.n_same")
    return documents.withColumnRenamed("id", id_col), keep, empty.select("t1", "t2").distinct()


def drop_similar(docs: DataFrame, id_col: str, text_col: str, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class, and all texts without words."""
    _, keep, wordless = grouped(docs, id_col, text_col, threshold)
    text = F.col(text_col)
    id_, t1, t2, same = free_names(docs, "id", "t1", "t2", "same")
    keys = {t1: F.xxhash64(F.lit(1), text), t2: F.xxhash64(F.lit(2), text)}
    # 0 stands for texts without words, which all stay
    staying = keep.unionByName(wordless.withColumn("n_same", F.lit(0).cast("long")), allowMissingColumns=True)
    named = staying.select(F.col("id").alias(id_), F.col("t1").alias(t1), F.col("t2").alias(t2), F.col("n_same").alias(same))
    found = docs.withColumns(keys).join(named, [t1, t2]).where(
        (F.col(same) == 0) | F.col(id_col).cast("long").eqNullSafe(F.col(id_)))
    once = found.where(F.col(same) < 2).unionByName(found.where(F.col(same) > 1).dropDuplicates([id_, t1, t2]))
    return once.drop(id_, t1, t2, same)

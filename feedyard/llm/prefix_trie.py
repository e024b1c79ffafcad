"""The trie of all conversations' prefixes, with totals of every subtree.

A node is a distinct sequence of first turns; equal prefixes of different
conversations are one node. A prefix is known by a 128-bit key: the xor of
hashes of (position, role, text), so that keys of all prefixes are running
xors. They are taken in blocks of positions and carried over block borders,
and turns are numbered by ``row_numbers``, so a conversation of any length is
spread over tasks.

Subtree totals come from parallel tree contraction (``subtree_totals``):
every round rakes all leaves into their parents, then compresses chains by
splicing out unary nodes that are local minima of a hash. A constant share
of the nodes goes each round, however deep the tree. Going back through the
rounds re-expands the spliced nodes. Each round is written to the shared
folder; links and nodes never reach the driver.

Defined results: a null role or text is empty; turns are ordered by turn (null
first), turns of equal number by role and then by a hash of the text, so
repeated rows are repeated turns; rows without a conversation id belong to no
conversation; extra columns are not read; texts and conversations of any
length are used whole; an empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedyard.llm.common import landed
from feedyard.operators.paging import row_numbers
from feedyard.session import scratch_path

#: Positions that one running xor spans.
BLOCK_BITS = 10
#: Neighbouring conversation ids in one piece of a digest's input.
PIECE_BITS = 10

WORD = r"[^\x20\x09-\x0D]+"  # fixed value: what counts as a word


# -- turns ------------------------------------------------------------------------
def numbered_turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """c, i (from 1), two hashes of (role, text), words of the text."""
    said = [F.coalesce(F.col(x).cast("string"), F.lit("")) for x in (role, text)]
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("c"), F.col(turn).alias("t"), said[0].alias("role"),
        F.xxhash64(F.lit(1), *said).alias("h1"), F.xxhash64(F.lit(2), *said).alias("h2"),
        F.regexp_count(said[1], F.lit(WORD)).cast("long").alias("words"))
    return row_numbers(rows, "c", [F.asc_nulls_first("t"), "role", "h1", "h2"], "i", _ranges(turns)).select("c", "i", "h1", "h2", "words")


def _ranges(df: DataFrame) -> int:
    """Numbering goes by ranges at any size: one conversation may be long."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def rebuilt_turns(numbered: DataFrame, head: Column, donor: Column, most_head: int) -> DataFrame:
    """Every conversation's turns after its first ``head`` behind the first
    ``head`` turns of conversation ``donor`` (both functions of c)."""
    own = numbered.where(F.col("i") > head).withColumn("part", F.lit(1))
    convs = numbered.select("c").distinct().select("c", head.alias("head"), donor.alias("donor")).where("head > 0")
    heads = numbered.where(F.col("i") <= most_head).withColumnRenamed("c", "donor")
    taken = convs.join(heads, "donor").where("i <= head").withColumn("part", F.lit(0)).select(*own.columns)
    return row_numbers(own.unionByName(taken), "c", ["part", "i"], "depth", _ranges(numbered)).select("c", "depth", "h1", "h2", "words")


def prefix_keys(turns: DataFrame) -> DataFrame:
    """c, depth, words, the prefix's key (k1, k2) and its parent's (p1, p2)."""
    own = turns.select("c", "depth", "words", F.shiftright("depth", BLOCK_BITS).alias("block"),
                       F.xxhash64("depth", "h1").alias("z1"), F.xxhash64("depth", "h2").alias("z2"))
    so_far = Window.partitionBy("c", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = own.select("c", "depth", "words", "block", "z1", "z2",
                     F.bit_xor("z1").over(so_far).alias("r1"), F.bit_xor("z2").over(so_far).alias("r2"))
    before = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = own.groupBy("c", "block").agg(F.bit_xor("z1").alias("b1"), F.bit_xor("z2").alias("b2")).select(
        "c", "block", F.bit_xor("b1").over(before).alias("b1"), F.bit_xor("b2").over(before).alias("b2")).where("block > 0")
    keyed = run.join(carried, ["c", "block"], "left")
    k1, k2 = (F.col(f"r{n}").bitwiseXOR(F.coalesce(f"b{n}", F.lit(0).cast("long"))) for n in "12")
    return keyed.select("c", "depth", "words", k1.alias("k1"), k2.alias("k2"),
                        k1.bitwiseXOR(F.col("z1")).alias("p1"), k2.bitwiseXOR(F.col("z2")).alias("p2"))


# -- tree contraction -----------------------------------------------------------------
def _same(a: DataFrame, left: Sequence[str], b: DataFrame, right: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[x] == b[y] for x, y in zip(left, right)])


def _landed_round(alive: DataFrame) -> tuple[str, DataFrame]:
    """One round written with its leaves (no ``n``) in a folder of their own."""
    spark = alive.sparkSession
    path = scratch_path(spark, "llm-trie-round")
    alive.withColumn("leaf", F.col("n").isNull()).write.partitionBy("leaf").parquet(path)
    return path, spark.read.schema(alive.schema.add("leaf", "boolean")).parquet(path)


def _read(spark: SparkSession, paths: list[str], schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths)


def subtree_totals(tree: DataFrame, values: Sequence[str]) -> DataFrame:
    """Sums of ``values`` (long) over every node's subtree, itself included.

    ``tree``: one row per node, id (c, d) and parent (pc, pd), null at a
    root. Returns c, d and the sums. Alive nodes hold what was raked into
    them (a value) and what was spliced out above them (``up_`` value).
    """
    values = list(values)
    up = [f"up_{v}" for v in values]
    off = [f"off_{v}" for v in values]
    nothing = F.lit(0).cast("long")
    alive = tree.select("c", "d", "pc", "pd", *values, *[nothing.alias(u) for u in up],
                        *[F.lit(None).cast("long").alias(x) for x in ("uc", "ud", *off)])
    spark = tree.sparkSession
    if tree.isEmpty():
        return tree.select("c", "d", *values)
    rounds: list[tuple[str, DataFrame]] = []
    while True:
        kids = alive.where("pc is not null").groupBy("pc", "pd").agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor("c").alias("xc"), F.bit_xor("d").alias("xd")).toDF("kc", "kd", "n", "xc", "xd")
        path, met = _landed_round(
            alive.join(kids, _same(alive, ("c", "d"), kids, ("kc", "kd")), "left").drop("kc", "kd"))
        rounds.append((path, met))
        if met.where("not leaf").isEmpty():
            break
        # rake: leaves give all they hold to their parents
        given = met.where("leaf and pc is not null").groupBy("pc", "pd").agg(
            *[F.sum(F.col(v) + F.col(u)).alias(f"g_{v}") for v, u in zip(values, up)],
            F.count(F.lit(1)).alias("gn"), F.bit_xor("c").alias("gc"), F.bit_xor("d").alias("gd")).withColumnsRenamed({"pc": "kc", "pd": "kd"})
        inner = met.where("not leaf")
        rest = landed(inner.join(given, _same(inner, ("c", "d"), given, ("kc", "kd")), "left").select(
            "c", "d", "pc", "pd", *[(F.col(v) + F.coalesce(f"g_{v}", nothing)).alias(v) for v in values], *up,
            (F.col("n") - F.coalesce("gn", nothing)).alias("n"),
            F.col("xc").bitwiseXOR(F.coalesce("gc", nothing)).alias("xc"),
            F.col("xd").bitwiseXOR(F.coalesce("gd", nothing)).alias("xd")), "trie-raked")
        # compress: a unary node (its only child is what the xor leaves) whose
        # hash is below its neighbours' goes; no two of those are neighbours
        coin = F.lit(len(rounds))
        low = F.xxhash64(coin, "c", "d")
        goes = (F.col("n") == 1) & F.col("pc").isNotNull() & (low < F.xxhash64(coin, "pc", "pd")) & (low < F.xxhash64(coin, "xc", "xd"))
        spliced = rest.where(goes).select(
            F.col("c").alias("uc"), F.col("d").alias("ud"), F.col("pc").alias("upc"), F.col("pd").alias("upd"),
            F.col("xc").alias("sc"), F.col("xd").alias("sd"), *[F.col(v).alias(f"s_{v}") for v in values],
            *[F.col(u).alias(f"s_{u}") for u in up])
        stays = rest.where(~F.coalesce(goes, F.lit(False))).drop("n", "xc", "xd")
        over = F.col("uc").isNotNull()
        alive = stays.join(spliced, _same(stays, ("c", "d"), spliced, ("sc", "sd")), "left").select(
            "c", "d", F.when(over, F.col("upc")).otherwise(F.col("pc")).alias("pc"),
            F.when(over, F.col("upd")).otherwise(F.col("pd")).alias("pd"), *values,
            *[(F.col(u) + F.coalesce(F.col(f"s_{v}") + F.col(f"s_{u}"), nothing)).alias(u) for v, u in zip(values, up)],
            "uc", "ud", *[(F.col(f"s_{v}") + F.col(u)).alias(o) for v, u, o in zip(values, up, off)])
    # re-expand, last round first: a spliced node's total is its child's and
    # what stood between; totals are read as one scan of all that is done
    totals = tree.select("c", "d", *values).schema
    done = [f"{rounds[-1][0]}/leaf=true"]
    for (before, _), (_, after) in zip(rounds[-2::-1], rounds[:0:-1]):
        known = _read(spark, done, totals)
        below = after.where("uc is not null").select("c", "d", "uc", "ud", *off)
        found = scratch_path(spark, "llm-trie-expanded")
        below.join(known, ["c", "d"]).select(
            F.col("uc").alias("c"), F.col("ud").alias("d"), *[(F.col(v) + F.col(o)).alias(v) for v, o in zip(values, off)]).write.parquet(found)
        done += [found, f"{before}/leaf=true"]
    return _read(spark, done, totals)


# -- digests of id lists ----------------------------------------------------------------
def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (c, d, ids) in order -> one digest per node; holds one hash state."""
    now, state = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([now[0]], pa.int64()), pa.array([now[1]], pa.int64()), pa.array([state.hexdigest()])], names=["c", "d", "ends"])

    for batch in batches:
        out = []
        for c, d, ids in zip(*(x.to_pylist() for x in batch.columns)):
            if (c, d) != now:
                if now is not None:
                    out.append((now[0], now[1], state.hexdigest()))
                now, state = (c, d), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=["c", "d", "ends"])
    if now is not None:
        yield row()


def ends_digests(ends: DataFrame) -> DataFrame:
    """ends (c, d, member) -> c, d, ends: SHA-256 of the members' decimal ids,
    ascending, comma-joined. Neighbouring ids are joined to pieces of bounded
    size first; the pieces stream through one hash state per node."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("member")), lambda m: m.cast("string")), ",")
    pieces = ends.groupBy("c", "d", F.shiftright("member", PIECE_BITS).alias("piece")).agg(joined.alias("ids"))
    return pieces.repartition("c", "d").sortWithinPartitions("c", "d", "piece").select("c", "d", "ids").mapInArrow(
        _digests, "c long, d long, ends string")


# -- the operator ---------------------------------------------------------------------------
def prefix_trie(turns: DataFrame, conv: str, turn: str, role: str, text: str,
                head: Column | None = None, donor: Column | None = None, most_head: int = 0) -> DataFrame:
    """Per node: conv_id (its smallest member), depth, parent_conv_id (null at
    the root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``saved_tokens`` sums (n_convs - 1) x words of the node's last text over
    its subtree. With ``head`` and ``donor`` (columns over the conversation id
    ``c``; ``head`` at most ``most_head``) the conversations are rebuilt first.
    """
    numbered = numbered_turns(turns, conv, turn, role, text)
    convs = landed(numbered.select("c").distinct(), "trie-conversations")
    said = rebuilt_turns(numbered, head, donor, most_head) if head is not None else numbered.withColumnRenamed("i", "depth")
    keyed = landed(prefix_keys(said), "trie-prefixes")

    none = F.lit(0).cast("long")
    deeper = keyed.groupBy("depth", "k1", "k2").agg(
        F.min("c").alias("c"), F.count(F.lit(1)).alias("n_convs"), F.min("words").alias("words"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"))
    root = convs.agg(F.min("c").alias("c"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        none.alias("depth"), none.alias("k1"), none.alias("k2"), "c", "n_convs", none.alias("words"),
        F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"))
    nodes = landed(deeper.unionByName(root), "trie-nodes")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("c").alias("pc"))
    linked = nodes.join(above, ["depth", "p1", "p2"], "left").withColumn("pd", F.when(F.col("pc").isNotNull(), F.col("depth") - 1))
    kids = linked.where("pc is not null").groupBy("pc", "pd").agg(F.count(F.lit(1)).alias("n_children")).toDF("c", "depth", "n_children")
    tree = landed(linked.join(kids, ["c", "depth"], "left").select(
        "c", F.col("depth").alias("d"), "pc", "pd", "k1", "k2", "n_convs", F.coalesce("n_children", none).alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")), "trie-tree")

    totals = subtree_totals(tree, ["n_leaves", "saved_tokens"])
    last = keyed.groupBy("c").agg(F.max_by(F.struct("depth", "k1", "k2"), "depth").alias("at")).select("c", "at.*")
    member = convs.join(last, "c", "left").select(
        F.col("c").alias("member"), *[F.coalesce(x, none).alias(y) for x, y in (("depth", "d"), ("k1", "k1"), ("k2", "k2"))])
    ends = ends_digests(member.join(tree.select("c", "d", "k1", "k2"), ["d", "k1", "k2"]).select("c", "d", "member"))
    return tree.drop("n_leaves", "saved_tokens").join(totals, ["c", "d"]).join(ends, ["c", "d"], "left").select(
        F.col("c").alias("conv_id"), F.col("d").alias("depth"), F.col("pc").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"))

"""Prefix trie, token counts and whitening against plain models; nulls in any
column, empty and long texts, ties, repeated rows, empty tables, clashing
columns, hot groups."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedyard.llm import prefix_trie, queries, token_counts, whitening

# --- op11 -------------------------------------------------------------------
TURNS = "conv_id long, turn long, role string, text string, c string, depth string, n int"


def head_of(c):
    return crc32(str(c).encode()) % 4


def plain_trie(rows):
    """conv_id, turn, role, text rows (distinct turns per conversation) -> nodes."""
    own = defaultdict(list)
    for c, t, r, x in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own[c].append((r or "", x or ""))
    built = {c: own.get(c - c % 20, [])[:head_of(c)] + turns[head_of(c):] for c, turns in own.items()}
    members = defaultdict(list)
    for c, turns in sorted(built.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = {}
    for node, convs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        kids = [n for n in below if len(n) == len(node) + 1]
        words = {n: len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0 for n in below}
        ends = ",".join(str(c) for c in convs if len(built[c]) == len(node))
        out[convs[0], len(node)] = (
            members[node[:-1]][0] if node else None, len(convs), len(kids),
            sum(not any(k[:-1] == n for k in members if k) for n in below),
            sum((len(members[n]) - 1) * words[n] for n in below), hashlib.sha256(ends.encode()).hexdigest())
    return out


def run_trie(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], TURNS)
    c = F.col("c")
    made = prefix_trie.prefix_trie(df, "conv_id", "turn", "role", "text", F.crc32(c.cast("string")) % 4, c - c % 20, 3)
    return {(r.conv_id, r.depth): tuple(r)[2:] for r in made.collect()}


def test_trie_against_brute_force(spark):
    rnd = random.Random(4)
    said = ["a b", "", None, "c\td  e", "é x", "long " * 500]
    rows = []
    for c in [*range(0, 60), 1000, 1001]:  # 1000 is there, 980 and 1020 are not
        if c == 20:
            continue  # a donor that is absent
        for t in [None, *range(rnd.randint(0, 5))]:
            rows.append((c, t, rnd.choice(["user", "user", None]), rnd.choice(said[:3]) if rnd.random() < 0.8 else rnd.choice(said)))
    rows += [(None, 0, "user", "no conversation"), (25, 99, "user", "last")]
    got = run_trie(spark, rows)
    assert got == plain_trie(rows)
    assert any(n_children > 3 for _, _, n_children, *_ in got.values())


def test_trie_chains_and_copies(spark, monkeypatch):
    """A long conversation over many blocks, and many copies of one."""
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", 3)
    monkeypatch.setattr(prefix_trie, "PIECE_BITS", 2)
    rows = [(7, t, "user", f"turn {t}") for t in range(120)]
    rows += [(c, t, "user", f"copy {t}") for c in range(40, 60) for t in range(4)]
    rows += [(c, t, "user", f"turn {t}") for c in (8, 9) for t in range(60)]
    assert run_trie(spark, rows) == plain_trie(rows)


def test_trie_edges(spark):
    assert run_trie(spark, []) == {}
    assert run_trie(spark, [(None, 1, "user", "x")]) == {}
    one = run_trie(spark, [(20, None, None, None)])
    assert one == plain_trie([(20, None, None, None)])
    # equal turns are repeated turns, in a defined order
    twice = run_trie(spark, [(0, 1, "user", "x"), (0, 1, "user", "x")])
    assert sorted(twice) == [(0, 0), (0, 1), (0, 2)]


def test_subtree_totals_of_shapes(spark):
    rnd = random.Random(2)
    shapes = {
        "path": [(k, k - 1) for k in range(1, 200)], "star": [(k, 0) for k in range(1, 200)],
        "random": [(k, rnd.randrange(k)) for k in range(1, 200)], "comb": [(k, k - 2 if k % 2 and k > 1 else k - 1) for k in range(1, 150)],
    }
    for links in shapes.values():
        parent = {0: None} | dict(links)
        value = {v: rnd.randrange(100) for v in parent}
        total = dict(value)
        for v in sorted(parent, reverse=True):  # parents have smaller numbers
            if parent[v] is not None:
                total[parent[v]] += total[v]
        tree = spark.createDataFrame(
            [(v, 5, p, None if p is None else 5, value[v]) for v, p in parent.items()], "c long, d long, pc long, pd long, w long")
        got = {r.c: r.w for r in prefix_trie.subtree_totals(tree, ["w"]).collect()}
        assert got == total


# --- op12 -------------------------------------------------------------------
def model_file():
    return pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


def test_pre_tokens_count_like_the_library():
    sentencepiece = pytest.importorskip("sentencepiece")
    with open(model_file(), "rb") as f:
        counter = token_counts.PieceCounter(f.read())
    library = sentencepiece.SentencePieceProcessor(model_file=model_file())
    rnd = random.Random(1)
    parts = [*" ▁  ab.,the\n\té́ßж中🙂\x000129-ABin '", "the ", "in", "  ", " <s> ", "</s>", "<unk>", "<0x41>", "　", "\xa0", "...", "!!", " ."]
    for _ in range(20_000):
        text = "".join(rnd.choices(parts, k=rnd.randint(0, 30)))
        assert sum(counter.count(counter.split(text))) == len(library.encode(text)), text


def test_cut_rules():
    assert token_counts.cut_rule(["▁ab", "ab", "c"]).findall("▁▁abcab▁.") == ["▁▁ab", "c", "ab", "▁", "."]
    # a piece with a space after something else: no cut there
    assert token_counts.cut_rule(["a▁b"]).findall("▁a▁bc") == ["▁a▁b", "c"]
    assert token_counts.cut_rule([]).findall("▁▁a") == ["▁▁", "a"]
    assert token_counts.cut_rule(["▁."]).findall("▁.a.") == ["▁.", "a", "."]


@pytest.mark.parametrize("block_chars", [50, 16_000_000])
def test_token_counts(spark, block_chars):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=model_file())
    rows = [(1, None), (2, ""), (3, " "), (None, "no id"), (4, "tie"), (4, "tie"), (None, None), (5, "word " * 30_000),
            (6, "é中\U0001f600 \x00 <s>it's 1234\r\n\n x"), (7, "x" * 50_000)]
    rows += [(k, "the common text of all") for k in range(100, 140)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, piece string, block int, n int").repartition(3)
    got = sorted(map(tuple, token_counts.count_tokens(df, "doc_id", "text", model_file(), block_chars).collect()), key=str)
    assert got == sorted(((i, len((t or "").encode()), len(library.encode(t or ""))) for i, t in rows), key=str)
    assert token_counts.count_tokens(df.limit(0), "doc_id", "text", model_file()).count() == 0


def test_op12_on_the_table(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=model_file())
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.QUERIES["op12_token_counts"](spark, "/root/testdata/sf0.001").collect()}
    assert got == {i: (len(t.encode()), n := len(library.encode(t)), n > 4096) for i, t in texts.items()}


# --- op13 -------------------------------------------------------------------
def plain_whitening(vectors, most=8):
    x = np.floor(1024 * np.array(vectors, np.float64)) + 100_000
    n = len(x)
    y = x - x.mean(axis=0)
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    whole = x.astype(np.int64).astype(object)
    deviation = ((n * whole - whole.sum(axis=0)) ** 2).sum(axis=1)
    return y @ u / np.sqrt(e), e / np.trace(v), deviation


def check_whitening(rows, vectors):
    """rows of ids 0.. against the plain model, signs aside."""
    want, explained, deviation = plain_whitening(vectors)
    by = {(r[0], r[1]): r for r in rows}
    assert len(by) == len(rows) == want.size
    for c in range(want.shape[1]):
        got = np.array([by[k, c + 1][4] for k in range(len(vectors))])
        np.testing.assert_allclose(got * np.sign(got @ want[:, c]), want[:, c], atol=1e-8)
        assert abs(by[0, c + 1][5] - explained[c]) <= 1e-10
    assert [by[k, 1][3] for k in range(len(vectors))] == list(deviation)
    assert {r[2] for r in rows} == {len(vectors)} and all(r[6] < 1e-9 for r in rows)


def test_whitening_against_brute_force(spark):
    rnd = np.random.default_rng(3)
    wide = rnd.normal(size=(300, 12)) @ np.diag(np.linspace(1, 5, 12))
    narrow = rnd.normal(size=(50, 3))
    far = rnd.normal(size=(40, 4)) + 1e6  # a mean that dwarfs the spread
    for vectors in (wide, narrow, far):
        df = spark.createDataFrame([(k, v.tolist(), "x", 1) for k, v in enumerate(vectors)], "vec_id long, e array<double>, v string, id int")
        check_whitening([tuple(r) for r in whitening.whiten(df.repartition(5), "vec_id", "e").collect()], vectors)


def test_whitening_awkward_rows(spark):
    schema = "vec_id long, e array<double>"
    good = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [5.0, 2.0])]
    bad = [(3, None), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [1.0, None]), (7, [1e300, 1.0]), (8, [1.0]), (9, [])]
    rows = whitening.whiten(spark.createDataFrame(good + bad, schema), "vec_id", "e").collect()
    # one direction varies, so there is one component
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component, r.n) for r in rows) == [
        (False, 1, 1, 4), (False, 2, 1, 4), (False, 2, 1, 4), (True, 0, 1, 4)]
    assert all(abs(r.explained - 1) < 1e-12 for r in rows)
    for none in ([], bad[:4], good[:1], good[:2], [(1, [])]):
        assert whitening.whiten(spark.createDataFrame(none, schema), "vec_id", "e").count() == 0
    huge = whitening.whiten(spark.createDataFrame([(1, [4e12]), (2, [-4e12])], schema), "vec_id", "e").collect()
    assert [r.deviation for r in huge] == [None, None] and all(abs(abs(r.whitened) - 1) < 1e-12 for r in huge)


def test_cholesky_and_rotations():
    rnd = np.random.default_rng(0)
    for rank, d in ((3, 6), (6, 6), (1, 5)):
        half = rnd.normal(size=(d, rank)) * 10.0 ** -np.arange(rank)
        a = half @ half.T
        factor, order = whitening.pivoted_cholesky(a)
        assert factor.shape == (d, rank)
        np.testing.assert_allclose(factor @ factor.T, a[np.ix_(order, order)], atol=1e-12)
        values, vectors = whitening.components(a)
        np.testing.assert_allclose(values, np.linalg.eigvalsh(a)[::-1][:rank], rtol=1e-9, atol=1e-13)
        np.testing.assert_allclose(vectors.T @ vectors, np.eye(rank), atol=1e-9)
    assert whitening.components(np.zeros((3, 3)))[0].size == 0


def test_op13_on_the_table(spark):
    vectors = [r.embedding for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").orderBy("vec_id").collect()]
    check_whitening([tuple(r) for r in queries.QUERIES["op13_whitening"](spark, "/root/testdata/sf0.001").collect()], vectors)

"""The pipeline: every stage against its predecessor's rows, and the SQL
oracles of the registered queries."""

from __future__ import annotations

import os
import re
import sys
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from feedyard.llm import queries  # noqa: E402
from feedyard.llm.common import landed  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    start = spark.read.parquet(f"{SF}/documents.parquet")
    passage = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    extra = [
        (9001, None, "en", "s1", 0), (9002, "12 34 !!", "en", "s1", 8), (9003, "Some passage first. " + passage, "en", "s2", 0),
        (9004, "a quite short clean text about nothing", None, None, None), (None, "another clean text without any id", "en", "s1", 0),
    ]
    copy = " ".join(f"copyword{k}" for k in range(80))
    extra += [(9100 + k, copy + (f" tail{k}" if k else ""), "en", "s3", 0) for k in range(3)]
    docs = landed(start.unionByName(spark.createDataFrame(extra, start.schema)), "test-docs")
    columns, names = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, landed(stage(spark, docs, SF), "test-stage")
        names.append((name, docs))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    after = {name: {r.doc_id for r in df.select("doc_id").collect()} for name, df in names}
    assert not after["language"] & {9001, 9002}
    assert {9003, 9004, None} <= after["line_dedup"]
    assert after["near_duplicates"] & {9100, 9101, 9102} == {9100}
    assert 9003 in after["near_duplicates"] and 9003 not in after["decontaminate"]
    assert {9004, None, 9100} <= after["tokenize"]
    assert names[-1][1].columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_run_matches_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert 0 < out.count() <= spark.read.parquet(f"{SF}/documents.parquet").count()


def model_of_the_pipeline(docs, items):
    """The five stages in plain Python: (doc_id, text, source) rows with
    distinct ids -> what ``run`` returns."""
    tokenizers, public_tokenizers = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    docs = [(i, t, s) for i, t, s in docs if any(c.isalpha() for c in t or "")]
    # lines on 8 sites or more go, but for the first in order of id
    sites, first = defaultdict(set), {}
    for i, t, s in sorted(docs):
        for p, line in enumerate(t.split("\n")):
            line = line.strip(" ")
            if line.count(" ") >= 2 or len(line.split()) >= 3 or len(re.findall("[\u4e00-\u9fff]", line)) >= 5:
                sites[line].add(s)
                first.setdefault(line, (i, p))
    kept = []
    for i, t, _ in sorted(docs):
        lines = [x for p, x in enumerate(t.split("\n")) if len(sites[x.strip(" ")]) < 8 or first[x.strip(" ")] == (i, p)]
        if "".join(lines).strip() or len(lines) == len(t.split("\n")):
            kept.append((i, "\n".join(lines)))
    # classes over links at a similarity of 0.8, of which the smallest id stays
    sets = []
    for _, t in kept:
        w = re.findall(r"\w+", t.lower())
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(kept)))
    for a in range(len(kept)):
        for b in range(a):
            if label[a] != label[b] and sets[a] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
    kept = [doc for k, doc in enumerate(kept) if label[k] == k]
    # windows of 10 words, or the whole of a shorter item
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t))
    windows = {tuple(w[k:k + 10]) for w in map(words, items) for k in range(max(1, len(w) - 9)) if w}
    out = Counter()
    for i, t in kept:
        w = words(t)
        if not any(tuple(w[k:k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w) - n + 1)):
            ids = library.encode(t, add_special_tokens=False).ids
            told = library.decode(ids, skip_special_tokens=False)
            out[i, len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256(told.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("labelled", [True, False])
def test_run_against_brute_force(spark, tmp_path, labelled):
    start = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    words = ["alpha", "beta", "gamma", "delta", "omega"]
    han, tabbed = "\u672c\u7ad9\u6240\u6709\u5185\u5bb9\u7248\u6743\u6240\u6709", "all\trights\treserved"
    texts = [f"{han}\n{' '.join(f'{w}{k}' for w in words * 2)}\n{tabbed}\nshared closing line here" for k in range(20)]
    texts += [han, "shared closing line here\n \t", "12 34 !!", "", None, "Read more", "\u2460\u2461 a", "\U0001f600"]
    texts += [" ".join(f"copy{k}" for k in range(60)) + tail for tail in ("", " x", " y z", " \u00bd")]
    texts += [f"Before it. {items.first().text} After it."]
    extra = [(9000 + k, t, None if k % 3 else "en", f"t{k % 11}", len(t or "")) for k, t in enumerate(texts)]
    docs = start.unionByName(spark.createDataFrame(extra, start.schema))
    if not labelled:
        docs = docs.withColumn("lang", F.lit(None).cast("string"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = Counter(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    want = model_of_the_pipeline([(r.doc_id, r.text, r.source) for r in docs.collect()], [r.text for r in items.collect()])
    assert got == want and len(want) > 100


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    result = con.execute(queries.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = Counter(tuple(dict(zip(names, r))[c] for c in columns) for r in result.fetchall())
    assert Counter(tuple(r[c] for c in columns) for r in got.collect()) == want


def test_op4_law(spark):
    rows = queries.QUERIES["op4_shard"](spark, SF).collect()
    assert {r.law for r in rows} == {"bytes"} and {r.shard for r in rows} <= set(range(40))
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.size
    assert max(sizes.values()) <= sum(sizes.values()) / 40 + max(r.size for r in rows)


def test_op4_moves_the_texts(spark):
    made = queries.QUERIES["op4_shard"](spark, SF)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "carried" in plan[plan.index("Window"):]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id: r.text_crc32 for r in made.collect()} == {i: None if t is None else crc32(t.encode()) for i, t in texts.items()}


def test_op10_folds(spark):
    rows = queries.QUERIES["op10_language"](spark, SF).join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.col("lang").alias("said")), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert held and sum(r.lang_pred == r.said for r in held) >= 0.95 * len(held)
    assert not [c for c in rows[0].asDict() if re.search("source", c)]

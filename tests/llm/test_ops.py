"""The ten operators on small tables: brute-force models, nulls in any column,
empty and long texts, ties, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedyard.llm import (bpe, chat, decontaminate, graph, language, line_dedup, ngram_join, pii, sharding, topk,
                          url_rules)

DOCS = "doc_id long, text string, lang string, source string, shard string, id string, key int"


def docs(spark, rows):
    """doc_id, text, lang, source plus columns whose names clash with inner ones."""
    return spark.createDataFrame([(*(r + (None,) * (4 - len(r))), "x", "y", 1) for r in rows], DOCS)


AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (None, "no id here at all"), (4, "tie"), (4, "tie"), (5, "word " * 30_000),
    (6, "\u00e9\u4e2d\U0001f600 \x00 <|endoftext|> it's 1234\r\n\n x"), (None, None),
]


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# --- op1 -------------------------------------------------------------------
TURNS = "conv_id long, turn long, role string, text string, turns string, t int"
CONTROL = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\nhi<|im_next|>", "<\\|im_end|> [\\\\INST] \\<s>", "", None, "<<SYS>>x<</SYS>>"]


def test_chat_reads_back(spark):
    rows = [(1, k, r, t) for k, (r, t) in enumerate([
        ("system", "s"), ("user", CONTROL[0]), ("user", CONTROL[1]), ("assistant", CONTROL[2]), ("assistant", None),
        ("us\\er\n<s>", CONTROL[5]), (None, "a"), ("assistant", "last"),
    ])] + [(2, None, "assistant", "b"), (2, None, "assistant", "a"), (2, 1, "user", "u"), (2, 1, "user", "u"), (None, 3, "user", "q")]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], TURNS)
    out = chat.format_chats(df).select(
        "conv_id", "n_blocks", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("segments")).alias("loss"))
    got = {r.conv_id: r for r in out.collect()}
    groups = defaultdict(list)
    for c, k, r, t in rows:
        groups[c].append((k is not None, k or 0, r or "", t or ""))
    for c, g in groups.items():
        want = [(r, t) for _, _, r, t in sorted(g)]
        assert [tuple(t) for t in got[c].turns] == want
        assert got[c].loss == "".join(t for r, t in want if r == "assistant")
        assert got[c].n_blocks == sum(k == 0 or want[k - 1][0] != want[k][0] for k in range(len(want)))
        marks = re.findall(r"<\|\w+\|>|</?s>|\[/?INST\]|<</?SYS>>", got[c].formatted)
        assert len(marks) == 2 * got[c].n_blocks + len(want) - got[c].n_blocks
    assert chat.format_chats(df.limit(0)).count() == 0


def test_chat_escape_is_reversible(spark):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(["<", "|", "im_end", "|>", "s>", "/", "\\", "[", "INST]", "<SYS>>", "x"]) for _ in range(12)) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", chat.unescape(F.col("e")).alias("u")).collect():
        assert r.u == r.t
        assert not re.search(r"<\|\w+\|>|</?s>|\[/?INST\]|<</?SYS>>", r.e)


# --- op2 -------------------------------------------------------------------
PLAIN = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def plain_spans(text):
    def fits(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == 1:
            return all(int(p) <= 255 for p in found.split("."))
        if kind == 2:
            return 14 <= len(digits) <= 19 and pii.luhn(digits)
        return kind == 0 or 10 <= len(digits) <= 15
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PLAIN) for m in p.finditer(text) if fits(k, m.group()))


def test_pii_base_is_the_plain_patterns():
    rnd = random.Random(3)
    for _ in range(30_000):
        pool = rnd.choice(["a@b.-%_ 1", "0123. ", "0123456789 -", "+1 ().-23", "a1@.+- 0(\u00e9\n", "\u06631.2+ "])
        text = "".join(rnd.choice(pool) for _ in range(rnd.randint(0, 45)))
        assert pii.base_spans(text) == plain_spans(text), text
    for long in ("a" * 200_000, "1" * 200_000, "1.2." * 50_000, "a@" * 50_000, "+1 " * 50_000):
        pii.base_spans(long)


def test_pii_viterbi_is_the_best_path():
    rnd = np.random.default_rng(1)
    moves, start = rnd.normal(size=(3, 3)), rnd.normal(size=3)
    length = np.array([1, 4, 3, 5])
    first = np.cumsum(np.r_[0, length[:-1]])
    scores = rnd.normal(size=(length.sum(), 3))
    got = pii.viterbi(scores, first, length, moves, start)
    import itertools
    for a, n in zip(first, length):
        def value(path):
            return start[path[0]] + sum(scores[a + t, p] for t, p in enumerate(path)) + sum(moves[p, q] for p, q in zip(path, path[1:]))
        best = max(itertools.product(range(3), repeat=int(n)), key=value)
        assert tuple(got[a:a + n]) == best


def test_pii_learns_and_adds(spark):
    rnd = random.Random(2)
    words = "the of and er ing tion wh ou".split()

    def line(k):
        w = [rnd.choice(words) for _ in range(9)]
        w[4] = ["ab%d@mail%d.example.com" % (k, k), "10.20.%d.%d" % (k % 250, k % 99), "+1 (555) %03d-%04d" % (k, k), "x"][k % 4]
        return " ".join(w)
    made = docs(spark, [(k, "\n".join(line(k + j) for j in range(3))) for k in range(160)] + AWKWARD + [
        (900, "the of and er ab12@mail_1.example.com, ing tion er wh")])
    lines = pii.labelled_lines(made.where("doc_id < 900"), "doc_id", "text")
    out = pii.find_personal_data(made, "doc_id", "text", labelled=lines)
    got = {(r.doc_id, r.n): r for r in out.withColumn("n", F.monotonically_increasing_id()).collect()}
    assert len(got) == made.count()
    texts = Counter((r.doc_id, r.text or "") for r in made.collect())
    for r in got.values():
        assert [s for s in r.base if s not in r.spans] == []
        assert any(r.doc_id == i and [(s.start, pii.KINDS.index(s.kind), s.end) for s in r.base] == plain_spans(t) for i, t in texts)
    extra = [r for r in got.values() if r.doc_id == 900][0]
    assert [(s.kind, s.start, s.end) for s in extra.spans] == [("email", 14, 37)]
    assert pii.find_personal_data(made.limit(0), "doc_id", "text").count() == 0


# --- op3 -------------------------------------------------------------------
def judge(url, rules):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if ("." + host).endswith("." + r[0]) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


def test_urls_against_brute_force(spark):
    rnd = random.Random(4)
    labels = ["a", "b", "com", "a-b", "", "x2", "com2"]
    rules = sorted({(".".join(rnd.choice(labels[:4]) for _ in range(rnd.randint(1, 3))), "/" + "/".join(rnd.choice("ab") for _ in range(rnd.randint(0, 2))))
                    for _ in range(25)})
    rules = [(h, p, rnd.choice(["allow", "block"])) for h, p in rules]
    urls = [rnd.choice(["http://", "://", "", "x://y://"]) + ".".join(rnd.choice(labels) for _ in range(rnd.randint(1, 4)))
            + rnd.choice(["", "/", "/a/b", "/a", "?q", "#/a", "/b/a?x#y", ":80/a", "/\n/a"]) for _ in range(600)]
    urls += ["HTTP://A.B.COM/a", None, "", "no", "http://b.com" + "/a" * 20_000] + ["http://a.com/a"] * 50
    pages = spark.createDataFrame([(k if k % 7 else None, u, "h", "r") for k, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    given = spark.createDataFrame(rules + [(None, "/", "block")], "host string, path string, verdict string")
    got = rows_of(url_rules.judge_urls(pages, given, "page_id", "url"))
    want = [(k if k % 7 else None, *judge(u, rules)) for k, u in enumerate(urls)]
    assert Counter(got) == Counter(want)
    assert url_rules.judge_urls(pages.limit(0), given, "page_id", "url").count() == 0
    assert {r[3] for r in rows_of(url_rules.judge_urls(pages, given.limit(0), "page_id", "url"))} == {None}


# --- op4 -------------------------------------------------------------------
@pytest.mark.parametrize("hot", [0, 400])
def test_shards(spark, hot):
    rnd = random.Random(6)
    rows = [(k, "x" * rnd.randint(0, 900)) for k in range(800)] + [(5000 + k, "same text " * 30) for k in range(hot)] + AWKWARD[:5]
    made = docs(spark, rows)
    got = sharding.shard_rows(made, "doc_id", "text", n_shards=7, row_cost=16, carry=("text",)).collect()
    assert Counter((r.doc_id, r.carried.text) for r in got) == Counter(rows)
    sizes, slots = Counter(), defaultdict(list)
    for r in got:
        text = (r.carried.text or "").encode()
        assert r.size == len(text) + 16
        assert r.text_crc32 == (None if r.carried.text is None else zlib.crc32(text))
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(sizes) == set(range(7))
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in got)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_rows(made.limit(0), "doc_id", "text", 7).count() == 0


@pytest.mark.parametrize("part_bytes, candidates", [(1 << 40, 200_000), (700, 8)])
def test_shards_against_a_plain_model(spark, monkeypatch, part_bytes, candidates):
    """Shards are runs of the key order cut nearest to equal bytes; slots count within them, however fine the parts."""
    monkeypatch.setattr(sharding, "PART_BYTES", part_bytes)
    monkeypatch.setattr(sharding, "CANDIDATES", candidates)
    rnd = random.Random(7)
    rows = [(k, f"{k} " + "x" * rnd.randint(0, 900)) for k in range(900)] + [(2000, "long " * 3000)]
    made = docs(spark, rows)
    n = 5
    got = {r.doc_id: (r.shard, r.slot) for r in sharding.shard_rows(made, "doc_id", "text", n, row_cost=16).collect()}
    keyed = rows_of(made.select(F.xxhash64("text"), "doc_id", F.octet_length("text") + 16))
    total, below, shard, slots = sum(s for *_, s in keyed), 0, 0, Counter()
    for _, doc_id, size in sorted(keyed):
        at, slot = got[doc_id]
        for s in range(shard, at):  # the cut before this row is off by half a row and the tolerance at most
            assert abs(below - total * (s + 1) / n) <= max(size, before) / 2 + sharding.TOLERANCE * total / n + 1
        assert at >= shard and slot == slots[at]
        shard, before, below = at, size, below + size
        slots[at] += 1
    assert shard == n - 1 and len(got) == len(rows)
    _, _, fine = sharding.find_cuts(spark.createDataFrame(keyed, "key long, row long, size long"), n)
    assert fine == max(sharding.FINE, -(-total // (n * part_bytes)))


# --- op5 -------------------------------------------------------------------
tokenizers = pytest.importorskip("tokenizers")
VOCAB = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_bpe_is_the_library(spark):
    library = tokenizers.Tokenizer.from_file(VOCAB)
    rnd = random.Random(1)
    pools = ["ab aaaa", "'s't're 'll  \n\t\x85\xa0\u3000", "\u00e9\u00e8\u00f1\u00df \u4e2d\U0001f600\U0001d7d8\u00b2\u00bd\u2167", "0123 4\u0663",
             "<|endoftext|><|end", "the and ing tion er th!!??..--__", "\x00\x1c\x1d\x7f\u200b"]
    cases = []
    for _ in range(4000):
        pool = "".join(rnd.sample(pools, rnd.randint(1, 3)))
        s = "".join(rnd.choice(pool) for _ in range(rnd.randint(0, 40)))
        cases.append(s[:10] + "<|endoftext|>" + s[10:] if rnd.random() < 0.1 else s)
    cases += ["a" * 5000, " " * 3000, "\n" * 500 + "x", "ha" * 5000]
    made = docs(spark, [(k, c) for k, c in enumerate(cases)] + [(None, None), (7, "tie"), (7, "tie")])
    got = Counter((r.doc_id, tuple(r.ids), r.decoded) for r in bpe.encode_texts(made, "doc_id", "text", VOCAB).collect())
    want = Counter()
    for r in made.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want[(r.doc_id, tuple(ids), library.decode(ids, skip_special_tokens=False))] += 1
    assert got == want
    told = bpe.encode_texts(made, "doc_id", "text", VOCAB, digest=True).where("doc_id = 7").collect()
    ids = np.array(library.encode("tie").ids, "<u4").tobytes()
    assert (7, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(b"tie").hexdigest()) in [tuple(r) for r in told]
    assert bpe.encode_texts(made.limit(0), "doc_id", "text", VOCAB).count() == 0


# --- op6 -------------------------------------------------------------------
def test_topk_against_brute_force(spark):
    rnd = np.random.default_rng(2)
    base = rnd.normal(size=(6, 12))
    vectors = [(k, (base[k % 6] * (1 + k % 5) + 0.05 * rnd.normal(size=12)).astype(np.float32).tolist()) for k in range(700)]
    vectors += [(2000 + k, vectors[0][1]) for k in range(20)]
    vectors += [(50, None), (100, [1.0, None]), (150, [float("nan")] * 12), (200, [float("inf")] * 12), (None, vectors[1][1]),
                (3000, []), (3001, [1.0]), (3050, [-1e-20] * 12), (3100, [1e17] * 12), (7, vectors[7][1])]
    df = spark.createDataFrame([(i, v, 0, "s") for i, v in vectors], "vec_id long, embedding array<float>, rank int, score string")
    q = topk.quantised(df, "vec_id", "embedding", 256)
    got = rows_of(topk.exact_topk(q.where("id % 50 = 0"), q, 5))
    whole = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in vectors
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for i, v in whole:
        if i % 50 == 0:
            scored = sorted(((-sum(a * b for a, b in zip(v, w)), j) for j, w in whole if j != i))[:5]
            want += [(i, r + 1, j, max(-2**63 + 1, min(2**63 - 1, -s))) for r, (s, j) in enumerate(scored)]
    huge = {3100}  # beyond a long: scores are cut to it, so only the others are compared
    assert sorted(r for r in got if r[0] not in huge and r[2] not in huge) == sorted(r for r in want if r[0] not in huge and r[2] not in huge)
    assert topk.exact_topk(q.limit(0), q.limit(0), 5).count() == 0


def test_topk_pruning_keeps_all_that_reach_the_floor():
    rnd = np.random.default_rng(3)
    parts = np.round(rnd.normal(size=(400, 8)) * 50 + 200 * rnd.normal(size=8))
    norms = np.sqrt((parts ** 2).sum(axis=1))
    order = np.argsort(-norms)
    parts, norms = parts[order], norms[order]
    for k in range(0, 400, 9):
        q = parts[k]
        scores = parts @ q
        for floor in (np.sort(scores)[-5], np.sort(scores)[-1], np.sort(scores)[0]):
            left = topk._survivors(q, np.sqrt(q @ q), floor, norms, parts)
            kept = set(np.arange(400)[left])
            assert set(np.flatnonzero(scores >= floor)) <= kept


@pytest.mark.parametrize("sign", [1, -1])
def test_topk_with_a_dominant_coordinate(spark, sign):
    # long vectors at a cosine near 0.9 fill the lead bucket; the best matches lie in the buckets after it
    rnd = np.random.default_rng(4)
    n_long, n_near = topk.BLOCK_ROWS + 50, topk.BLOCK_ROWS + 900
    side = rnd.normal(size=(n_long, 8))
    far = np.c_[np.full(n_long, 900), 550 * side / np.sqrt((side ** 2).sum(axis=1))[:, None]]
    near = np.c_[np.full(n_near, 990), 25 * rnd.normal(size=(n_near, 8))]
    whole = np.round(np.r_[far, near] * [sign, *[1] * 8])
    whole = whole[rnd.permutation(len(whole))]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(whole)], "id long, vector array<double>")
    got = rows_of(topk.exact_topk(df.where("id % 50 = 0"), df, 5))
    want = []
    for i in range(0, len(whole), 50):
        scores = (whole @ whole[i]).astype(int)
        want += [(i, r + 1, j, scores[j]) for r, j in enumerate(sorted(set(range(len(whole))) - {i}, key=lambda j: (-scores[j], j))[:5])]
    assert sorted(got) == sorted(want)
    norms = np.sqrt((near ** 2).sum(axis=1))
    near = (near * [sign, *[1] * 8])[np.argsort(-norms)]
    norms = np.sort(norms)[::-1]
    for q in near[::300]:
        floor = 0.92 * np.sqrt(q @ q) * norms[0]
        kept = set(np.arange(n_near)[topk._survivors(q, np.sqrt(q @ q), floor, norms, near)])
        assert set(np.flatnonzero(near @ q >= floor)) <= kept


# --- op7 -------------------------------------------------------------------
def test_lines_against_brute_force(spark):
    rnd = random.Random(8)
    shared = [f"shared line number {k} here" for k in range(12)] + ["two words", "All rights reserved."]
    rows = []
    for k in range(300):
        lines = [f"own line of document {k} {j}" for j in range(2)] + rnd.sample(shared, rnd.randint(0, 4))
        rnd.shuffle(lines)
        rows.append((k, "\n".join(lines), "en", rnd.choice([f"s{j}" for j in range(rnd.choice([3, 12]))] + [None])))
    rows += [(1000, None, None, "s1"), (1001, "", None, "s1"), (None, "shared line number 1 here", None, "s2"), (None, "shared line number 1 here", None, "s2"),
             (1002, "\n".join(["shared line number 2 here"] * 500), None, "s3")]
    for limit in (3, 8):
        got = line_dedup.remove_boilerplate(docs(spark, rows), "doc_id", "text", "source", min_sites=limit).collect()
        sites, first = defaultdict(set), {}
        for i, t, _, s in rows:
            for p, line in enumerate((t or "").split("\n") if t is not None else []):
                line = line.strip(" ")
                if line.count(" ") >= 2:
                    if s is not None:
                        sites[line].add(s)
                    at = (i is not None, i or 0, p)
                    first[line] = min(first.get(line, at), at)
        def kept(i, t):
            if t is None:
                return None
            return "\n".join(line for p, line in enumerate(t.split("\n")) if not (
                len(sites.get(line.strip(" "), ())) >= limit and first[line.strip(" ")] != (i is not None, i or 0, p)))
        assert Counter((r.doc_id, r.text) for r in got) == Counter((i, kept(i, t)) for i, t, _, _ in rows)
        assert {r.shard for r in got} == {"x"}
    assert line_dedup.remove_boilerplate(docs(spark, rows).limit(0), "doc_id", "text", "source").count() == 0


def test_lines_of_any_script_are_boilerplate(spark):
    gone = ["\u672c\u7ad9\u6240\u6709\u5185\u5bb9\u7248\u6743\u6240\u6709" * 40, "\u30d7\u30e9\u30a4\u30d0\u30b7\u30fc\u30dd\u30ea\u30b7\u30fc\u306f\u3053\u3061\u3089",
            "\u0e2a\u0e07\u0e27\u0e19\u0e25\u0e34\u0e02\u0e2a\u0e34\u0e17\u0e18\u0e34\u0e4c\u0e15\u0e32\u0e21\u0e01\u0e0e\u0e2b\u0e21\u0e32\u0e22",
            "all\trights\treserved", "tous\u00a0droits\u00a0r\u00e9serv\u00e9s", "read more here"]
    stay = ["\u9690\u79c1\u653f\u7b56", "Read more", "Read\tmore", "\u00abA.\u00bb - b", "***", "\u8c22\u8c22\u3002"]
    rows = [(k, "\n".join([f"own line of {k}", *gone, *stay]), None, f"s{k}") for k in range(9)]
    got = {r.doc_id: r.text.split("\n") for r in line_dedup.remove_boilerplate(docs(spark, rows), "doc_id", "text", "source").collect()}
    # "\u00abA.\u00bb - b" has two spaces: three words by spaces
    assert got == {k: [f"own line of {k}", *(x for x in gone + stay if not k or x in stay and x.count(" ") < 2)] for k in range(9)}


@pytest.mark.parametrize("doc_id", [None, 7])
def test_one_text_keeps_a_line_where_ids_repeat(spark, doc_id):
    rows = [(doc_id, f"a shared header line\nown text of {k}", None, f"s{k}") for k in range(12)]
    got = line_dedup.remove_boilerplate(docs(spark, rows + rows[:1]), "doc_id", "text", "source").collect()
    assert {r.text.split("\n")[-1] for r in got} == {t.split("\n")[1] for _, t, _, _ in rows} and len(got) == 13
    assert len({r.text for r in got if r.text.startswith("a shared")}) == 1


# --- op8 -------------------------------------------------------------------
def plain_windows(text, items):
    def words(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return [(m.group(), m.span()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)]
    ws = [w for w, _ in words(text)]
    hit, names = set(), set()
    for name, item in items:
        iw = [w for w, _ in words(item)]
        n = min(10, len(iw))
        wins = {tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for i in range(len(ws) - n + 1 if n else 0):
            if tuple(ws[i:i + n]) in wins:
                hit.update(range(i, i + n))
                names.add("null" if name is None else str(name))
    return len(ws), len(hit), sorted(names)


@pytest.mark.parametrize("group", [20_000_000, 120])
def test_windows_against_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(decontaminate, "GROUP_CHARS", group)
    rnd = random.Random(9)
    vocab = ["a", "b", "C", "d\u00c9", "e-f", "\u4e2d"]
    items = [(k if k else None, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([1, 3, 10, 12, 14])))) for k in range(8)]
    items += [(20, None), (21, "--"), (3, items[3][1]), (None, "zz yy")]
    items = [x for x in items if len((x[1] or "").split()) != 1]
    rows = [(k, " ".join(rnd.choice(vocab) for _ in range(40)) + " " + (rnd.choice(items)[1] or "")) for k in range(60)] + AWKWARD
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n_words int")
    found = decontaminate.find_windows(docs(spark, rows), bench, "doc_id", "text", "item_id", "text").collect()
    texts = defaultdict(list)
    for r in found:
        for s in r.spans:
            part = (r.text or "")[s.start:s.end]
            assert len(decontaminate.words_of(part)) == s.last - s.first
        texts[(r.doc_id, r.text)].append((r.n_words, sum(s.last - s.first for s in r.spans), r["items"]))
    for i, t in rows:
        assert all(x == plain_windows(t, items) for x in texts[(i, t)])
    assert sum(map(len, texts.values())) == len(rows)
    left = decontaminate.drop_hit(docs(spark, rows), bench, "doc_id", "text", "item_id", "text").collect()
    assert Counter((r.doc_id, r.text) for r in left) == Counter((i, t) for i, t in rows if not plain_windows(t, items)[1])
    assert decontaminate.find_windows(docs(spark, rows).limit(0), bench, "doc_id", "text", "item_id", "text").count() == 0
    none = decontaminate.find_windows(docs(spark, rows), bench.limit(0), "doc_id", "text", "item_id", "text")
    assert none.where(F.size("items") > 0).count() == 0


# --- op9 -------------------------------------------------------------------
def plain_links(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"\w+", (t or "").lower())
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    links, parent = [0] * len(rows), list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and len(sets[i] & sets[j]) * 10 >= 8 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[find(i)].append(d)
    return Counter((rows[i][0], min((d for d in ids[find(i)] if d is not None), default=None), links[i]) for i in range(len(rows)))


@pytest.mark.parametrize("block", [1024, 7])
def test_near_duplicates_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rnd = random.Random(10)
    rows, k = [], 0
    for _ in range(12):
        words = [f"w{rnd.randint(0, 4000)}" for _ in range(rnd.choice([3, 8, 60, 200]))]
        for _ in range(rnd.choice([1, 2, 9])):
            copy = list(words)
            for _ in range(rnd.randint(0, 3)):
                copy[rnd.randrange(len(copy))] = f"v{rnd.randint(0, 9)}"
            rows.append((k, " ".join(copy) + rnd.choice(["", ".", "!\n"])))
            k += 1
    rows += [(900 + j, "One Two three four") for j in range(4)] + [(None, "one two three four"), (None, "alone without any id")]
    rows += [(950, "one two three four")] * 2 + [(960, None), (961, ""), (962, "... !"), (970, "word " * 30_000)]
    got, keep = ngram_join.similar_groups(docs(spark, rows), "doc_id", "text")
    found = Counter(rows_of(got))
    assert found == plain_links(rows)
    classes = {c for i, c, _ in found if i not in (960, 961, 962)}
    left = ngram_join.drop_similar(docs(spark, rows), "doc_id", "text").collect()
    assert len(left) == len(classes) + 3
    assert ngram_join.similar_groups(docs(spark, rows).limit(0), "doc_id", "text")[0].count() == 0


@pytest.mark.parametrize("block", [512, 5])
def test_chain_of_near_copies(spark, monkeypatch, block):
    """A long chain is verified by its buckets, not by all its pairs; links and classes are those of brute force."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "SHIP", 0)
    rnd = random.Random(12)
    words = [f"w{rnd.randint(0, 9000)}" for _ in range(1300)]
    rows = [(k, " ".join(words[4 * k:4 * k + 100])) for k in range(300)] + [(500, " ".join(words[:100]) + ".")]
    base = [f"x{rnd.randint(0, 9000)}" for _ in range(90)]
    rows += [(600 + k, " ".join(base[:-1] + [f"y{k}"])) for k in range(20)]
    seen = []
    cells = ngram_join.candidate_cells
    monkeypatch.setattr(ngram_join, "candidate_cells", lambda *a: seen.append((a, cells(*a))) or seen[-1][1])
    got = ngram_join.similar_groups(docs(spark, rows), "doc_id", "text")[0]
    assert Counter(rows_of(got)) == plain_links(rows)
    (classes, _, groups), placed = seen[0]
    bands = {r.band for r in placed.collect()}
    assert -1 in bands and len(bands) > 10
    chain = groups.groupBy("label").count().orderBy(F.desc("count")).first()["count"]
    assert chain == 300 and classes.count() == 320
    sizes = placed.where("band >= 0 and i = j and block = i").groupBy("band", "cell").agg(F.countDistinct("node").alias("n"))
    done = sizes.agg(F.sum(F.col("n") * F.col("n"))).first()[0]
    print("comparisons", done, chain ** 2)
    assert done < chain ** 2 / 2


def test_blocks_by_shingles(spark, monkeypatch):
    """Long texts make more blocks; results stay."""
    rnd = random.Random(13)
    long = [f"w{rnd.randint(0, 90000)}" for _ in range(3000)]
    rows = [(k, " ".join(long[:-1] + [f"z{k}"])) for k in range(9)] + [(20, "a b c d e f g"), (21, "a b c d e f g!")]
    placed = []
    cells = ngram_join.candidate_cells
    monkeypatch.setattr(ngram_join, "candidate_cells", lambda *a: placed.append(cells(*a)) or placed[-1])
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", 9000)
    got = ngram_join.similar_groups(docs(spark, rows), "doc_id", "text")[0]
    assert Counter(rows_of(got)) == plain_links(rows)
    assert placed[0].agg(F.max("j")).first()[0] == 2


def test_near_duplicates_of_signs_and_marks(spark):
    worded = ["\U0001f600\U0001f601", "\u2460\u2461", "\u00bd", "plain words"]
    without = ["\u0301\u0301", "\u203f", "...", "", None]
    rows = [(10 * k + j, t) for k, t in enumerate(worded + without) for j in range(1 + k % 2 * 2)] + [(None, "\u203f"), (80, ""), (80, "")]
    left = ngram_join.drop_similar(docs(spark, rows), "doc_id", "text").collect()
    want = [(10 * k, t) for k, t in enumerate(worded)] + [r for r in rows if r[1] in without]
    assert Counter((r.doc_id, r.text) for r in left) == Counter(want)


def test_bands_reach_the_recall():
    for s in (0.5, 0.8, 0.95):
        rows, bands = ngram_join.choose_bands(s, 0.999, 300)
        assert rows * bands <= 300 or rows == 1
        assert 1 - (1 - s ** rows) ** bands >= 0.999


def test_components(spark):
    rnd = random.Random(11)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(200)] + [(1000 + k, 1001 + k) for k in range(60)] + [(5000, 5000)]
    got = dict(rows_of(graph.components(spark.createDataFrame(edges, "a long, b long"))))
    parent = {v: v for e in edges for v in e}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for a, b in edges:
        parent[find(a)] = find(b)
    groups = defaultdict(set)
    for v, label in got.items():
        groups[label].add(v)
    want = defaultdict(set)
    for v in parent:
        want[find(v)].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


# --- op10 ------------------------------------------------------------------
def test_language_held_out_accuracy(spark):
    rnd = random.Random(12)
    parts = {"en": ["the", "th", "ing", "wh", "ou"], "de": ["der", "sch", "\u00fc", "ein", "ch"], "fr": ["le", "eau", "\u00e9", "qu", "oi"], "es": ["el", "ci\u00f3n", "\u00f1", "ado", "rr"]}
    rows = []
    for k in range(400):
        lang = rnd.choice(sorted(parts))
        text = " ".join("".join(rnd.choice(parts[lang]) for _ in range(rnd.randint(1, 3))) for _ in range(30))
        rows.append((k, text, lang if k % 9 else None, lang))
    made = docs(spark, rows + AWKWARD + [(2000, "12345 !?"), (2001, "_ 9")])
    out = language.detect(made, "doc_id", "text", "lang", may_train=F.col("doc_id") % 4 != 2)
    got = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
    held = [r for r in rows if r[0] % 4 == 2 or r[2] is None]
    assert sum(got[i].lang_pred == lang for i, _, _, lang in held if i not in (1, 2, 3, 4, 5, 6)) >= 0.95 * len(held) - 6
    assert all(0 <= r.score <= 1 for r in got.values())
    for i in (2000, 2001):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    left = language.keep_identified(made, "doc_id", "text", "lang", may_train=F.col("doc_id") % 4 != 2)
    assert left.columns == made.columns
    assert left.where("doc_id = 2000").count() == 0 and left.count() == out.where("lang_pred <> 'und'").count()
    nothing = language.detect(made, "doc_id", "text", "lang", may_train=F.lit(False))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}
    assert language.detect(made.limit(0), "doc_id", "text", "lang", may_train=F.lit(True)).count() == 0


def test_identified_documents_are_kept_and_named(spark):
    words = {"en": "the thing with their house", "de": "der sch\u00f6ne gro\u00dfe Wald ich"}
    rows = [(k, f"{words[lang]} {k}", lang) for k in range(60) for lang in [sorted(words)[k % 2]]]
    rows += [(100, words["en"], None), (101, words["de"], None), (102, "12 !?", None), (None, words["de"], None), (103, words["en"], "xx")]
    made = docs(spark, rows)
    want = Counter((i, t, lang or ("en" if t == words["en"] else "de")) for i, t, lang in rows if i != 102)
    got = language.keep_identified(made, "doc_id", "text", "lang", may_train=F.col("doc_id") < 100)
    assert Counter((r.doc_id, r.text, r.lang) for r in got.collect()) == want and got.columns == made.columns
    # nothing to learn from: labels null throughout, or none may be used
    for bare, allowed in ((made.withColumn("lang", F.lit(None).cast("string")), F.lit(True)), (made, F.lit(False))):
        left = language.keep_identified(bare, "doc_id", "text", "lang", may_train=allowed).collect()
        want = Counter((r.doc_id, r.text, r.lang) for r in bare.collect() if r.doc_id != 102)
        assert Counter((r.doc_id, r.text, r.lang) for r in left) == want


# --- helper columns never meet the documents' own ---------------------------------
CLASHING = ("_row1", "_row2", "_gone", "_t1", "_t2", "_same", "_id", "_hit1", "_hit2", "_said", "_identified", "__gone")


def test_filters_keep_columns_of_any_name(spark):
    long = " ".join(f"w{k}" for k in range(30))
    given = [(1, f"{long}\nshared closing line", "en", "s1"), (2, long + "\nx y", "en", "s2"), (3, "other words here", None, "s3")]
    df = spark.createDataFrame([(*r, *[f"{r[0]}{c}" for c in CLASHING]) for r in given],
                               "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in CLASHING))
    items = spark.createDataFrame([(1, "other words here")], "item_id long, text string")
    made = {
        "lines": line_dedup.remove_boilerplate(df, "doc_id", "text", "source").drop("lines_removed"),
        "near": ngram_join.drop_similar(df, "doc_id", "text"),
        "hit": decontaminate.drop_hit(df, items, "doc_id", "text", "item_id", "text"),
        "lang": language.keep_identified(df, "doc_id", "text", "lang", F.lit(True)),
    }
    for name, out in made.items():
        assert sorted(out.columns) == sorted(df.columns), name
        for r in out.collect():
            assert [r[c] for c in CLASHING] == [f"{r.doc_id}{c}" for c in CLASHING], name
    assert {r.doc_id for r in made["hit"].collect()} == {1, 2}


def test_lines_of_a_long_text(spark):
    lines = [f"a boilerplate line number {k}" for k in range(12_000)]
    rows = [(k, "\n".join(lines), None, f"s{k}") for k in range(9)]
    out = {r.doc_id: r for r in line_dedup.remove_boilerplate(docs(spark, rows), "doc_id", "text", "source").collect()}
    assert out[0].text == rows[0][1] and all(out[k].text == "" and len(out[k].lines_removed) == 12_000 for k in range(1, 9))


def test_texts_without_letters(spark):
    for text in ("\u00bd \u00b2", "\u2460", "\u2167", "12_3", "", None, "\U0001f600"):
        assert not language.has_letters(text)
    for text in ("1a", "\u4e2d", "\u00aa", "_x_"):
        assert language.has_letters(text)


def test_labels_follow_confident_predictions(spark):
    rnd = random.Random(6)
    words = {"en": "the and of with that have from".split(), "de": "der und die nicht sich auch eine".split()}
    rows = [(k, " ".join(rnd.choices(words[lang], k=60)), lang, "s") for k in range(80) for lang in [("en", "de")[k % 2]]]
    rows += [(900, " ".join(words["en"] * 9), "de", "s"), (901, " ".join(words["de"] * 9), None, "s"), (902, "12 !", "en", "s")]
    out = {r.doc_id: r.lang for r in language.keep_identified(docs(spark, rows), "doc_id", "text", "lang", F.col("doc_id") < 900).collect()}
    assert out[900] == "en" and out[901] == "de" and 902 not in out and len(out) == 82
    # without a learned language nothing changes
    kept = language.keep_identified(docs(spark, rows), "doc_id", "text", "lang", F.lit(False)).collect()
    assert {r.doc_id: r.lang for r in kept} == {r[0]: r[2] for r in rows if r[0] != 902}


def test_window_letters(spark):
    """One letter a word, or two where one cannot name all: same hits."""
    rnd = random.Random(8)
    items = [(k, " ".join(rnd.choices("abcdefghij", k=rnd.randint(0, 14)))) for k in range(30)]
    texts = [" ".join(rnd.choices("abcdefghijX", k=200)) for _ in range(30)]
    plain = decontaminate.WindowScanner(items, 4)
    assert plain.wide == 1
    most, decontaminate.LETTERS = decontaminate.LETTERS, 8
    try:
        wide = decontaminate.WindowScanner(items, 4)
    finally:
        decontaminate.LETTERS = most
    assert wide.wide == 2 and [wide.scan(t) for t in texts] == [plain.scan(t) for t in texts]
    windows = {(n, tuple(w[i:i + n])): set() for k, t in items for w in [t.split()] for n in [min(4, len(w))] if w for i in range(len(w) - n + 1)}
    for k, t in items:
        w = t.split()
        for i in range(len(w) - min(4, len(w)) + 1 if w else 0):
            windows[min(4, len(w)), tuple(w[i:i + min(4, len(w))])].add(str(k))
    for t in texts:
        w = t.lower().split()
        hit, names = set(), set()
        for (n, win), owners in windows.items():
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) == win:
                    hit |= set(range(i, i + n))
                    names |= owners
        got = plain.scan(t)
        assert {x for a, b in got[1] for x in range(a, b)} == hit and got[2] == names and got[0] == len(w)


# --- op2: what the field finds -----------------------------------------------------
def test_hand_labelled_lines_parse():
    rows = pii.hand_labelled()
    assert len(rows) > 40 and not any("{{" in line or "}}" in line for line, _ in rows)
    kinds = Counter(pii.ALL_KINDS[k] for _, spans in rows for _, k, _ in spans)
    assert kinds["secret"] >= 15 and sum(not spans for _, spans in rows) >= 15
    line, [(start, kind, end)] = rows[0]
    assert pii.ALL_KINDS[kind] == "secret" and re.fullmatch("[0-9a-f]{40}", line[start:end])


def test_secrets_on_held_out_lines(spark):
    """Trained on three quarters of the hand-labelled lines, judged on the rest."""
    rows = pii.hand_labelled()
    made = docs(spark, [(k, "the of and 10.20.30.40 er\nsome plain words without any number") for k in range(40)])
    auto = [(r.line, [(s.start, s.kind, s.end) for s in r.spans]) for r in pii.labelled_lines(made, "doc_id", "text").collect()]
    right = found = wanted = 0
    for fold in range(4):
        scores = pii.Scores(pii.train([r for k, r in enumerate(rows) if k % 4 != fold] * pii.HAND_WEIGHT + auto))
        for line, spans in rows[fold::4]:
            got = {s for s in pii.decode(scores, line) if pii.ALL_KINDS[s[1]] == "secret"}
            want = {s for s in spans if pii.ALL_KINDS[s[1]] == "secret"}
            right, found, wanted = right + len(got & want), found + len(got), wanted + len(want)
    assert right >= 0.8 * wanted and right >= 0.8 * found


def test_secrets_of_documents_are_added(spark):
    rnd = random.Random(9)
    token = "".join(rnd.choice("0123456789abcdef") for _ in range(40))
    plain = " ".join(rnd.choice("the of and er ing tion wh ou".split()) for _ in range(40))
    rows = [(1, f'{plain} token = "{token}" {plain}'), (2, plain), (3, f"{plain} 12 of 1995, see 4.2 {plain}"), (4, None), (5, f"mail a.b@example.com {plain}")]
    got = {r.doc_id: r for r in pii.find_personal_data(docs(spark, rows), "doc_id", "text").collect()}
    at = rows[0][1].index(token)
    assert [(s.kind, s.start, s.end) for s in got[1].spans] == [("secret", at, at + 40)] and got[1].base == []
    assert [len(got[k].spans) for k in (2, 3, 4, 5)] == [0, 0, 0, 1]
    assert got[5].spans == got[5].base


def test_the_field_fits_its_lines():
    rows = [("a 10.2.3.4 b", [(2, 1, 10)]), ("c d e", []), ('x = "0123456789abcdef0123"', [(5, 4, 25)])]
    scores = pii.Scores(pii.train(rows * 5))
    assert [pii.decode(scores, line) for line, _ in rows] == [spans for _, spans in rows]

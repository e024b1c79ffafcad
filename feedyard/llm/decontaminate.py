"""Benchmark decontamination with one Aho-Corasick automaton.

Texts are normalised to words (A-Z lower-cased; a word is a run of characters
outside the ASCII non-alphanumerics). Every window of 10 consecutive words of
a test item (the whole item, if shorter) is a pattern of one automaton. Each
word of the benchmark has a letter of its own and all other words share one
more, so a text is a string with a letter per word, and one scan of it finds
all windows. Hits are kept as word ranges and mapped back to character offsets
of the original.

The automaton is built from the benchmark's distinct texts on the driver and
sent to the workers, behind a check of its size. A larger benchmark is cut
into groups of items, each small enough (an item beyond the bound is a group
by itself), that are scanned one after another; the hits of all groups are
merged per document.

Defined results: a null text has no words and no hits; items without words
have no windows; items with null ids hit like others and are listed as
``null``; repeated items count once; repeated documents are judged row by row
(with grouped benchmarks, rows equal in id and text share their hits); an
empty benchmark hits nothing; other columns are not read; ids must be whole
numbers.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedyard.llm.common import free_names, landed

#: Words of a window.
WINDOW = 10
#: Benchmark text that one automaton may hold (characters).
GROUP_CHARS = 20_000_000

# fixed values: the normalisation
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Bytes of UTF-8: A-Z lower-cased, what ends a word made a space.
PLAIN = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c > 0x7F or chr(c).isalnum() else 0x20 for c in range(256))

#: Letters of the automaton: the private characters beyond U+FFFF.
FIRST, LETTERS = 0x10000, 0x100000
OTHER = "\0"

SPAN = "array<struct<first:int,last:int,start:int,end:int>>"
HITS = f"id long, text string, n_words long, spans {SPAN}, items array<string>"


def words_of(text: str | None) -> list[bytes]:
    """The words in order, as UTF-8."""
    return (text or "").encode().translate(PLAIN).split()


class WindowScanner:
    """Finds the windows of benchmark items in texts."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW) -> None:
        split = [(item, ws) for item, text in items if (ws := words_of(text))]
        known = {w: k for k, w in enumerate(dict.fromkeys(w for _, ws in split for w in ws))}
        # two letters a word, from halves that don't mix, if one can't name them all
        self.wide = 1 if len(known) <= LETTERS else 2
        half = LETTERS // 2
        self.letter = {
            w: chr(FIRST + k) if self.wide == 1 else chr(FIRST + k // half) + chr(FIRST + half + k % half) for w, k in known.items()}
        owners: dict[str, set[str]] = {}
        for item, ws in split:
            letters, n = self._letters(ws), min(window, len(ws)) * self.wide
            for i in range(0, len(letters) - n + 1, self.wide):
                owners.setdefault(letters[i:i + n], set()).add("null" if item is None else str(item))
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_STRING)
        for letters, names in owners.items():
            self.automaton.add_word(letters, (len(letters) // self.wide, tuple(names)))
        self.any = bool(owners)
        if self.any:
            self.automaton.make_automaton()

    def _letters(self, words: list[bytes]) -> str:
        return "".join(map(self.letter.get, words, repeat(OTHER * self.wide)))

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, merged hit word ranges (end exclusive), item names."""
        ws = words_of(text)
        spans: list[tuple[int, int]] = []
        names: set[str] = set()
        if self.any and ws:
            for end, (n, owners) in self.automaton.iter(self._letters(ws)):
                last = end // self.wide
                names.update(owners)
                first = last - n + 1
                while spans and spans[-1][0] >= first:
                    spans.pop()
                if spans and spans[-1][1] >= first:
                    first = spans.pop()[0]
                spans.append((first, last + 1))
        return len(ws), spans, names


def char_offsets(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character ranges of word ranges, in the original text."""
    if not spans:
        return []
    places = [m.span() for m in WORD.finditer(text.encode().lower().decode())]  # bytes lower only A-Z
    return [(places[a][0], places[b - 1][1]) for a, b in spans]


_SCANNERS: dict[str, WindowScanner] = {}


def _scan(pickled):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = hashlib.sha256(pickled.value).hexdigest()
        if name not in _SCANNERS:
            _SCANNERS.clear()
            _SCANNERS[name] = WindowScanner(pickle.loads(pickled.value))
        scanner = _SCANNERS[name]
        schema = pa.schema([
            ("id", pa.int64()), ("text", pa.string()), ("n_words", pa.int64()),
            ("spans", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))),
            ("items", pa.list_(pa.string())),
        ])
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts, spans, items = [], [], []
            for text in texts:
                n, found, names = scanner.scan(text)
                counts.append(n)
                spans.append([
                    {"first": a, "last": b, "start": s, "end": e}
                    for (a, b), (s, e) in zip(found, char_offsets(text or "", found))
                ])
                items.append(sorted(names))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.string()), pa.array(counts, pa.int64()),
                pa.array(spans, schema.field("spans").type), pa.array(items, schema.field("items").type),
            ], schema=schema)
    return run


def _merged(spans):
    """Sorted spans with those that overlap or touch made one."""
    def add(done, s):
        last = F.get(done, F.size(done) - 1)
        longer = F.struct(
            last["first"].alias("first"), F.greatest(last["last"], s["last"]).alias("last"),
            last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when(
            (F.size(done) > 0) & (s["first"] <= last["last"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer)),
        ).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.sort_array(spans), F.array().cast(SPAN), add)


def find_windows(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str) -> DataFrame:
    """Per document: id_col, text, n_words, spans, items.

    ``spans``: merged hit ranges, as words (first, last exclusive) and as
    character offsets (start, end exclusive) of the text. ``items``: the
    names of the items with occurring windows, sorted as strings.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text).alias("text")).where(
        F.col("text").rlike("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]")).distinct()
    size = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    spark = docs.sparkSession

    def scanned(part: DataFrame) -> DataFrame:
        rows = [(r.item, r.text) for r in part.collect()]
        return given.mapInArrow(_scan(spark.sparkContext.broadcast(pickle.dumps(rows))), HITS)

    if size <= GROUP_CHARS:
        return scanned(items).withColumnRenamed("id", id_col)
    n_groups = -(-2 * size // GROUP_CHARS)
    group = F.pmod(F.xxhash64("item", "text"), F.lit(n_groups))
    key = [F.xxhash64("id", "text").alias("k1"), F.xxhash64("text", "id").alias("k2")]
    hits = None
    for g in range(n_groups):  # one automaton at a time
        found = landed(scanned(items.where(group == g)).where(F.size("items") > 0).select(*key, "spans", "items"), "window-hits")
        hits = found if hits is None else hits.unionByName(found)
    each = hits.groupBy("k1", "k2").agg(
        _merged(F.flatten(F.collect_set("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")
    )
    none = spark.range(0).select(F.lit(None).cast("string").alias("item"), F.lit(None).cast("string").alias("text"))
    return (
        scanned(none).drop("spans", "items").withColumns({"k1": key[0], "k2": key[1]})
        .join(each, ["k1", "k2"], "left").drop("k1", "k2")
        .withColumns({"spans": F.coalesce("spans", F.array().cast(SPAN)), "items": F.coalesce("items", F.array().cast("array<string>"))})
        .withColumnRenamed("id", id_col)
    )


def drop_hit(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str) -> DataFrame:
    """``docs``, all columns, without the documents that a window occurs in."""
    hits = find_windows(docs, benchmark, id_col, text_col, item_col, item_text)
    hit1, hit2 = free_names(docs, "hit1", "hit2")
    bad = hits.where(F.size("spans") > 0).select(
        F.xxhash64(F.lit(1), id_col, "text").alias(hit1), F.xxhash64(F.lit(2), id_col, "text").alias(hit2)).distinct()
    as_long = F.col(id_col).cast("long")
    keyed = docs.withColumns({
        hit1: F.xxhash64(F.lit(1), as_long, F.col(text_col)), hit2: F.xxhash64(F.lit(2), as_long, F.col(text_col))})
    return keyed.join(landed(bad, "hit-documents"), [hit1, hit2], "left_anti").select(*docs.columns)

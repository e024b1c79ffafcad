"""BPE encoding and decoding by prefix-sharing trie traversal.

The distinct words of a batch, in byte order, are a trie walked depth first:
a word shares the path of its common prefix with the word before it. Each
node keeps the last token of its prefix's encoding; that one token fixes the
whole encoding, since what remains without it is another node on the path.
The last token of a longer prefix is the one suffix token that may follow
the last token of the node before it, so a shared prefix is encoded once.

Two tokens may stand side by side if no merge across their border would come
earlier than the merges that close the border's pieces (``Vocabulary.joins``).

Words come from the vocabulary's own splitting rule, and special token
strings inside a text become their own id, as the library does it. A word's
tokens depend on the word alone, so each Python worker keeps a bounded cache.
The operator is map-only: no shuffle, and a lost task is simply run again.

Defined results: null text is empty (no tokens, empty decoded text); ids,
ties and repeated rows pass through row by row; other columns are not read;
texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words (and pieces, in each of two generations) that a worker keeps.
CACHE_WORDS = 300_000
#: Documents encoded at once.
SLICE_ROWS = 1_000
#: Words of a text that are joined at once: bounds the memory of long texts.
SLICE_WORDS = 200_000

DIGEST = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
FULL = "id long, ids array<int>, decoded string"

#: Token pairs remembered of either kind.
MOST_PAIRS = 500_000

NEVER = 1 << 60

# fixed values: the suffixes and white space of the byte-level splitting rule
SUFFIXES = "s|t|re|ve|m|ll|d"
SPACE = "\t-\r \x85\xa0  -     　"


def byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable characters stand for their own byte,
    the other bytes for the characters from U+0100 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = (b for b in range(256) if b not in set(printable))
    return {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


def _char_class(kind: str, last: int) -> str:
    """Regex class body of all characters up to ``last`` in category ``kind``."""
    parts, start = [], None
    for c in range(last + 2):
        has = c <= last and unicodedata.category(chr(c))[0] == kind
        if has and start is None:
            start = c
        elif not has and start is not None:
            parts.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return "".join(parts)


@lru_cache
def splitter(wide: bool) -> re.Pattern:
    """The splitting rule; ``wide`` also knows characters beyond U+FFFF."""
    last = 0x10FFFF if wide else 0xFFFF
    letter, number = _char_class("L", last), _char_class("N", last)
    return re.compile(
        rf"'(?:{SUFFIXES})| ?[{letter}]+| ?[{number}]+| ?[^{SPACE}{letter}{number}]+"
        rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
    )


def split_words(text: str) -> list[str]:
    narrow = text.isascii() or len(text.encode("utf-16-le")) == 2 * len(text)
    return splitter(not narrow).findall(text)


class Vocabulary:
    """Tokens, merge order and token borders of a byte-level BPE file."""

    def __init__(self, data: bytes) -> None:
        spec = json.loads(data)
        letters = byte_letters()
        ids = spec["model"]["vocab"]
        self.bytes_of: dict[int, bytes] = {i: bytes(letters[c] for c in t) for t, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.spoken = self.bytes_of | {i: t.encode() for t, i in self.special.items()}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        self.rank: dict[tuple[int, int], int] = {}
        halves: dict[int, tuple[int, int]] = {}
        for k, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right, made = ids[a], ids[b], ids[a + b]
            self.rank.setdefault((left, right), k)
            halves.setdefault(made, (left, right))
        # pieces that touch a token's right (left) border, with the merge that closes each
        self.right_edge = {t: self._edge(t, halves, 1) for t in self.bytes_of}
        self.left_edge = {t: self._edge(t, halves, 0) for t in self.bytes_of}
        # pairs met so far that may, and that may not, stand side by side
        self.good: set[int] = set()
        self.bad: set[int] = set()
        # every ending of a token: its id if it is a token itself, else -1
        self.tail = {b[-k:]: -1 for b in self.id_of for k in range(1, len(b) + 1)} | self.id_of

    def _edge(self, token: int, halves: dict[int, tuple[int, int]], side: int) -> list[tuple[int, int]]:
        pieces, closes = [], NEVER
        while True:
            pieces.append((token, closes))
            if token not in halves:
                return pieces
            closes = self.rank[halves[token]]
            token = halves[token][side]

    def joins(self, a: int, b: int) -> bool:
        """May token b follow token a in an encoding?

        Not if some merge across their border comes before both border pieces
        are closed by merges of their own. Of equal merges the left one comes
        first, so a tie closes a's piece first but not b's.
        """
        pair = a << 32 | b
        if pair in self.good or pair in self.bad:
            return pair in self.good
        crossed = any(
            (r := self.rank.get((x, y), NEVER)) < x_closes and r <= y_closes and r < NEVER
            for x, x_closes in self.right_edge[a]
            for y, y_closes in self.left_edge[b]
        )
        kept = self.bad if crossed else self.good
        if len(kept) > MOST_PAIRS:
            kept.clear()
        kept.add(pair)
        return not crossed

    def encode_words(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """Encode distinct words as one depth-first walk over their trie."""
        order = sorted((w.encode(), w) for w in words)
        last: list[int] = [-1]  # last[i]: last token of the path's first i bytes
        start: list[int] = [0]  # where that token starts
        path = b""
        tail, good, joins = self.tail.get, self.good, self.joins
        for word, name in order:
            shared = 0
            for x, y in zip(path, word):
                if x != y:
                    break
                shared += 1
            del last[shared + 1:], start[shared + 1:]
            path = word
            for i in range(shared + 1, len(word) + 1):
                # exactly one suffix token fits; mostly the node before's last token grows
                k = start[-1]
                token = tail(word[k:i], -1)
                if token < 0 or k and (last[k] << 32 | token) not in good and not joins(last[k], token):
                    k = i - 1
                    while (token := tail(word[k:i])) is not None:
                        if token >= 0 and (not k or (last[k] << 32 | token) in good or joins(last[k], token)):
                            break
                        k -= 1
                    if token is None or k < 0:
                        raise ValueError(f"no token ends at byte {i} of {word!r}")
                last.append(token)
                start.append(k)
            tokens, i = [], len(word)
            while i:
                tokens.append(last[i])
                i = start[i]
            tokens.reverse()
            yield name, tokens

    def decode(self, ids: Iterable[int]) -> str:
        """Bytes of all tokens as UTF-8; what is not valid becomes U+FFFD."""
        return b"".join(map(self.spoken.__getitem__, ids)).decode("utf-8", "replace")


class Encoder:
    """Encodes texts with one vocabulary; keeps the words and pieces it met last.

    A word border lies before every space that something other than white
    space follows, so a text is cut there first (a plain split), and what
    lies between is looked up as a whole; only unknown pieces are split into
    words, and only unknown words are walked.
    """

    def __init__(self, vocab: Vocabulary) -> None:
        self.vocab = vocab
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}  # without the space before them
        self.old: dict[str, bytes] = {}
        names = sorted(vocab.special, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None

    def forget(self) -> None:
        """Drop what was met; the vocabulary stays."""
        self.words, self.pieces, self.old = {}, {}, {}
        self.vocab.good.clear()
        self.vocab.bad.clear()

    def _learn_words(self, words: set[str]) -> None:
        for w, ids in self.vocab.encode_words(words.difference(self.words)):
            self.words[w] = struct.pack(f"<{len(ids)}I", *ids)

    def _learn_pieces(self, pieces: set[str]) -> None:
        split = {}
        for p in pieces.difference(self.pieces):
            if (kept := self.old.get(p)) is not None:
                self.pieces[p] = kept
            else:
                split[p] = split_words(" " + p)
        self._learn_words({w for ws in split.values() for w in ws})
        for p, ws in split.items():
            self.pieces[p] = b"".join(map(self.words.__getitem__, ws))

    def _plain(self, text: str) -> bytes:
        words = split_words(text)
        out = []
        for k in range(0, len(words), SLICE_WORDS):
            some = words[k:k + SLICE_WORDS]
            if len(self.words) > CACHE_WORDS:
                self.words = {}
            self._learn_words(set(some))
            out.append(b"".join(map(self.words.__getitem__, some)))
        return b"".join(out)

    def _cut(self, text: str) -> list[str] | None:
        """At the spaces; None where that wouldn't be word borders."""
        if _ODD_SPACE.search(text) or self.marks and self.marks.search(text):
            return None
        return text.split(" ")

    def meet(self, texts: list[str]) -> None:
        """Learn the new pieces of many texts in one walk: they share prefixes."""
        if len(self.pieces) > CACHE_WORDS:
            self.old, self.pieces = self.pieces, {}
            self.words = {}
        met: set[str] = set()
        for text in texts:
            if (cut := self._cut(text)) is not None:
                met.update(cut[1:])
                if len(met) > CACHE_WORDS:
                    self._learn_pieces(met)
                    met.clear()
        self._learn_pieces(met)

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each whole text as little-endian unsigned 32-bit integers."""
        for text in texts:
            if (parts := self._cut(text)) is None:
                done = []
                for part in self.marks.split(text) if self.marks else [text]:
                    own = self.vocab.special.get(part)
                    done.append(self._plain(part) if own is None else struct.pack("<I", own))
                yield b"".join(done)
                continue
            head = self._plain(parts.pop(0))
            try:
                yield head + b"".join(map(self.pieces.__getitem__, parts))
            except KeyError:
                self._learn_pieces(set(parts))
                yield head + b"".join(map(self.pieces.__getitem__, parts))


_ODD_SPACE = re.compile(r" (?:\s|\Z)")

_ENCODERS: dict[str, Encoder] = {}


def _encoder(data: bytes) -> Encoder:
    name = hashlib.sha256(data).hexdigest()
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(Vocabulary(data))
    return _ENCODERS[name]


def _run(vocab, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocab.value)
        try:
            yield from encoded(encoder, batches)
        finally:
            encoder.forget()  # a worker is used again, by other stages too

    def encoded(encoder: Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, SLICE_ROWS) for b in batches for k in range(0, b.num_rows, SLICE_ROWS)):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            rows: list[tuple] = []
            encoder.meet(texts)
            for ids in encoder.encode_all(texts):
                numbers = memoryview(ids).cast("I") if ids else ()
                decoded = encoder.vocab.decode(numbers)
                if digest:
                    rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
                else:
                    rows.append((list(numbers), decoded))
            columns = list(zip(*rows)) or [()] * (3 if digest else 2)
            if digest:
                out = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())]
                names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            else:
                out = [pa.array(columns[0], pa.list_(pa.int32())), pa.array(columns[1], pa.string())]
                names = ["id", "ids", "decoded"]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *out], names=names)

    return run


def encode_texts(docs: DataFrame, id_col: str, text_col: str, vocab_file: str, digest: bool = False) -> DataFrame:
    """id, ids and decoded text of every whole text, or digests of both.

    ``vocab_file`` is a byte-level BPE file on the driver; its bytes (a few
    MB by nature) go to the workers as a broadcast.
    """
    with open(vocab_file, "rb") as f:
        vocab = docs.sparkSession.sparkContext.broadcast(f.read())
    out = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _run(vocab, digest), DIGEST if digest else FULL
    )
    return out.withColumnRenamed("id", id_col)

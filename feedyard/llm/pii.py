"""Personal data: fixed patterns, and a linear-chain CRF for what they miss.

The patterns (email, ip, card, phone) find the base spans of every whole
text. A conditional random field over white-space separated words adds spans
of the same kinds: each word has one label (none or a kind), scored by its
word shape (counts of digits, letters, dots, signs; first and last character)
and the shapes of its neighbours, plus label transitions. It is trained on a
small labelled table of lines (``pii_lines.txt``, labelled by hand, for what
the patterns miss and its look-alikes; crops of the documents with the
patterns' own matches for the rest), by gradient steps on the exact likelihood
(forward-backward), and decoded by Viterbi, both in numpy over batches of
lines. Decoded words become spans, less the punctuation around them; a span
that touches a base span or (secrets aside) a match that a pattern's own check
refused (card digits that fail Luhn, say), or has neither digit nor ``@``, is
not added.

Lines are the CRF's sequences; a line of more than ``LINE_WORDS`` words is
decoded in consecutive parts. Base patterns see the whole text at once and
take time linear in it.

Defined results: null text counts as empty; rows pass through one by one, so
ids, ties and repeated rows are unrestricted; without training lines no spans
are added; other columns are not read.
"""

from __future__ import annotations

import pickle
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedyard.llm.common import PIECE_CHARS, text_groups

KINDS = ("email", "ip", "card", "phone")
#: What the field also finds: keys and passwords, which have no fixed form.
ALL_KINDS = (*KINDS, "secret")
#: Lines labelled by hand, and how often each counts in training.
LABELLED_LINES = Path(__file__).with_name("pii_lines.txt")
HAND_WEIGHT = 12

#: Documents that training lines are drawn from, lines kept, words of a line.
TRAIN_DOCS = 4_000
TRAIN_LINES = 2_000
TRAIN_WORDS = 16
STEPS = 60
LINE_WORDS = 512

OUT = "id long, base array<struct<kind:string,start:int,end:int>>, spans array<struct<kind:string,start:int,end:int>>"

Span = tuple[int, int, int]  # start, kind number, end

# --- base patterns -------------------------------------------------------
# Each matches what its plain form matches; the runs are possessive and start
# only where a run starts, so no position is tried twice.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9](?<![0-9]{2})[0-9]*+(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def matches(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, matches that their pattern's check refused), by start, then kind."""
    found: list[Span] = []
    refused: list[Span] = []
    if "@" in text:
        free = 0  # end of the last match: its characters are used up
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                found.append((start, 0, m.end()))
                free = m.end()
    for m in _IP.finditer(text):
        fits = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split("."))
        (found if fits else refused).append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            fits = 14 <= len(digits) <= 19 and luhn(digits)
            (found if fits else refused).append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            fits = 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15
            (found if fits else refused).append((m.start(), 3, m.end()))
    found.sort()
    refused.sort()
    return found, refused


def base_spans(text: str) -> list[Span]:
    return matches(text)[0]


# --- word shapes ---------------------------------------------------------
# A word's shape is a mixed-radix number of these parts (name -> values).
PARTS = {"digits": 10, "letters": 3, "at": 3, "dots": 5, "signs": 4, "other": 2, "first": 5, "last": 4}
#: Parts (or products of two) that score the word itself, and its neighbours.
OWN = [("digits",), ("letters",), ("at",), ("dots",), ("signs",), ("other",), ("first",), ("last",),
       ("digits", "dots"), ("digits", "signs"), ("digits", "letters"), ("at", "dots")]
NEAR = [("digits",), ("at",), ("signs",), ("first",)]
N_SHAPES = int(np.prod(list(PARTS.values())))
EDGE = N_SHAPES  # the shape beyond either end of a line
N_LABELS = len(ALL_KINDS) + 1


def _char_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By character (all from 255 on count as letters): packed counts of
    digits, letters and other characters, of at, dots and signs; first and
    last character classes; white space."""
    counts, marks = np.zeros(256, np.int64), np.zeros(256, np.int64)
    first, last, space = np.full(256, 4), np.full(256, 3), np.zeros(256, bool)
    for c in range(256):
        ch = chr(c)
        space[c] = ch.isspace()
        if ch.isdigit() and c < 128:
            counts[c], first[c], last[c] = 1, 0, 0
        elif ch.isalpha() or c == 255:
            counts[c], first[c], last[c] = 1 << 21, 1, 1
        elif ch == "@":
            marks[c] = 1
        elif ch == ".":
            marks[c], last[c] = 1 << 21, 2
        elif ch in "+-()":
            marks[c], first[c] = 1 << 42, {"+": 2, "(": 3}.get(ch, 4)
        else:
            counts[c] = 1 << 42
            last[c] = 2 if ch in ",;:!?" else 3
    return counts, marks, first, last, space


_COUNTS, _MARKS, _FIRST, _LAST, _SPACE = _char_tables()
_FIELD = (1 << 21) - 1
_DIGIT_STEPS = np.array([0, 1, 2, 3, 4, 5, 7, 10, 14, 20])
_LETTER_STEPS = np.array([0, 1, 4])


def words_and_shapes(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, ends, shapes, and the number of newlines before each word."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    low = np.minimum(codes, 255).astype(np.uint8)
    edge = np.diff(np.concatenate([[True], _SPACE[low], [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    counts, marks = np.add.reduceat(_COUNTS[low], starts), np.add.reduceat(_MARKS[low], starts)
    values = {
        "digits": np.searchsorted(_DIGIT_STEPS, counts & _FIELD, "right") - 1,
        "letters": np.searchsorted(_LETTER_STEPS, counts >> 21 & _FIELD, "right") - 1,
        "at": np.minimum(marks & _FIELD, 2),
        "dots": np.minimum(marks >> 21 & _FIELD, 4),
        "signs": np.minimum(marks >> 42, 3),
        # white space after the word is counted with it: its own class is 'other'
        "other": ((counts >> 42) - (np.r_[starts[1:], len(low)] - ends) > 0).astype(np.int64),
        "first": _FIRST[low[starts]],
        "last": _LAST[low[ends - 1]],
    }
    # white space before the first word belongs to no word; reduceat starts at it
    shape = np.zeros(len(starts), np.int64)
    for name, n in PARTS.items():
        shape = shape * n + values[name]
    return starts, ends, shape, np.cumsum(low == 10)[starts]


def _part_values() -> dict[str, np.ndarray]:
    codes, out = np.arange(N_SHAPES), {}
    for name, n in reversed(PARTS.items()):
        codes, out[name] = codes // n, codes % n
    return out


def _columns(features: list[tuple[str, ...]]) -> tuple[list[np.ndarray], int]:
    """For each feature the weight row of every shape; number of weight rows."""
    values, rows, n = _part_values(), [], 0
    for parts in features:
        at, size = np.zeros(N_SHAPES, np.int64), 1
        for p in parts:
            at, size = at * PARTS[p] + values[p], size * PARTS[p]
        rows.append(np.r_[at, size] + n)  # the edge has a row of its own
        n += size + 1
    return rows, n


@dataclass
class Model:
    """Weights per feature value and label; label transitions and starts."""

    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    moves: np.ndarray
    start: np.ndarray


class Scores:
    """A model's scores by shape: label scores of a word, and what it adds to
    the word after and before it."""

    def __init__(self, model: Model) -> None:
        own, near = _columns(OWN)[0], _columns(NEAR)[0]
        self.own = sum(model.own[r] for r in own).astype(np.float32)
        self.before = sum(model.before[r] for r in near).astype(np.float32)
        self.after = sum(model.after[r] for r in near).astype(np.float32)
        self.moves, self.start = model.moves.astype(np.float32), model.start.astype(np.float32)

    def words(self, shape: np.ndarray, opens: np.ndarray, closes: np.ndarray) -> np.ndarray:
        left = np.where(opens, EDGE, np.r_[EDGE, shape[:-1]])
        right = np.where(closes, EDGE, np.r_[shape[1:], EDGE])
        return self.own[shape] + self.before[left] + self.after[right]


def viterbi(scores: np.ndarray, first: np.ndarray, length: np.ndarray, moves: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Best labels of all sequences (``first``, ``length`` into ``scores``).

    All sequences step together, longest first, so the ones still running
    are always a prefix.
    """
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    labels = np.zeros(len(scores), np.uint8)
    if not len(first):
        return labels
    running = np.searchsorted(-length, -np.arange(length[0]), "left")  # sequences longer than t
    back = np.zeros((len(scores), scores.shape[1]), np.uint8)
    best = np.ascontiguousarray((scores[first] + start).T)
    final = best.copy()
    for t in range(1, length[0]):
        n = running[t]
        into = best[:, None, :n] + moves[:, :, None]  # from, to, sequence
        at = into.argmax(axis=0)
        best = np.take_along_axis(into, at[None], axis=0)[0] + scores[first[:n] + t].T
        back[first[:n] + t] = at.T
        final[:, :n] = best
    label = final.argmax(axis=0).astype(np.uint8)
    for t in range(length[0] - 1, -1, -1):
        n = running[t]
        at = first[:n] + t
        labels[at] = label[:n]
        if t:
            label[:n] = back[at, label[:n]]
    return labels


def line_parts(newlines: np.ndarray, most: int = LINE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(first word, length) of each sequence: lines, cut after ``most`` words."""
    n = len(newlines)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lines = np.flatnonzero(np.r_[True, newlines[1:] != newlines[:-1]])
    sizes = np.diff(np.r_[lines, n])
    parts = -(-sizes // most)
    k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    first = np.repeat(lines, parts) + k * most
    return first, np.minimum(most, np.repeat(lines + sizes, parts) - first)


def decode(scores: Scores, text: str) -> list[Span]:
    """Spans that the model sees in a piece of text."""
    starts, ends, shape, newlines = words_and_shapes(text)
    first, length = line_parts(newlines)
    opens, closes = np.zeros(len(shape), bool), np.zeros(len(shape), bool)
    opens[first], closes[first + length - 1] = True, True
    labels = viterbi(scores.words(shape, opens, closes), first, length, scores.moves, scores.start)
    hit = np.flatnonzero(labels)
    spans: list[Span] = []
    for k in hit:
        kind = int(labels[k]) - 1
        if spans and k and labels[k - 1] == labels[k] and not opens[k]:
            spans[-1] = (spans[-1][0], kind, int(ends[k]))
        else:
            spans.append((int(starts[k]), kind, int(ends[k])))
    return [s for s in (_trimmed(text, *s) for s in spans) if s]


_CORE = re.compile(r"[+(]?[^\W_](?:.*[^\W_])?", re.S)


def _trimmed(text: str, start: int, kind: int, end: int) -> Span | None:
    m = _CORE.search(text, start, end)
    if not m or not any(c == "@" or "0" <= c <= "9" for c in m.group()):
        return None
    return m.start(), kind, m.end()


# --- training ------------------------------------------------------------

def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(rows: list[tuple[str, list[Span]]]) -> Model | None:
    """Fit the CRF to lines with their spans (start, kind number, end)."""
    shapes, labels = [], []
    for line, spans in rows:
        starts, ends, shape, _ = words_and_shapes(line.replace("\n", " "))
        if not len(shape):
            continue
        label = np.zeros(len(shape), np.int64)
        for a, kind, b in spans:
            label[(starts < b) & (ends > a)] = kind + 1
        shapes.append(shape[:TRAIN_WORDS * 2])
        labels.append(label[:TRAIN_WORDS * 2])
    if not shapes:
        return None
    n, width = len(shapes), max(map(len, shapes))
    x, y = np.full((n, width + 2), EDGE), np.zeros((n, width), np.int64)
    size = np.array([len(s) for s in shapes])
    for k, (s, lab) in enumerate(zip(shapes, labels)):
        x[k, 1:len(s) + 1], y[k, :len(lab)] = s, lab
    real = np.arange(width) < size[:, None]
    own_rows, n_own = _columns(OWN)
    near_rows, n_near = _columns(NEAR)
    met, at = np.unique(x, return_inverse=True)
    at = at.reshape(x.shape)
    own = np.zeros((len(met), n_own))
    near = np.zeros((len(met), n_near))
    for r in own_rows:
        own[np.arange(len(met)), r[met]] = 1
    for r in near_rows:
        near[np.arange(len(met)), r[met]] = 1
    sizes = [n_own * N_LABELS, n_near * N_LABELS, n_near * N_LABELS, N_LABELS * N_LABELS, N_LABELS]
    cuts = np.cumsum([0, *sizes])
    w = np.zeros(cuts[-1])
    gold = np.eye(N_LABELS)[y] * real[:, :, None]
    pairs = real[:, 1:]

    def parts(v):
        a, b, c, d, e = (v[cuts[i]:cuts[i + 1]] for i in range(5))
        return a.reshape(-1, N_LABELS), b.reshape(-1, N_LABELS), c.reshape(-1, N_LABELS), d.reshape(N_LABELS, N_LABELS), e

    def gradient(v):
        a, b, c, moves, start = parts(v)
        emit = (own @ a)[at[:, 1:-1]] + (near @ b)[at[:, :-2]] + (near @ c)[at[:, 2:]]
        ahead = np.zeros_like(emit)
        ahead[:, 0] = emit[:, 0] + start
        for t in range(1, width):
            step = _log_sum(ahead[:, t - 1, :, None] + moves, 1) + emit[:, t]
            ahead[:, t] = np.where(real[:, t, None], step, ahead[:, t - 1])
        total = _log_sum(ahead[:, -1], 1)
        behind = np.zeros_like(emit)
        for t in range(width - 2, -1, -1):
            step = _log_sum(moves + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(real[:, t + 1, None], step, 0)
        here = np.exp(ahead + behind - total[:, None, None]) * real[:, :, None]
        both = np.exp(
            ahead[:, :-1, :, None] + moves + (emit[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
        ) * pairs[:, :, None, None]
        miss = gold - here

        def by_shape(places):
            out = np.zeros((len(met), N_LABELS))
            np.add.at(out, places.ravel(), miss.reshape(-1, N_LABELS))
            return out

        seen = (gold[:, :-1, :, None] * gold[:, 1:, None, :]).sum((0, 1))
        return np.concatenate([
            (own.T @ by_shape(at[:, 1:-1])).ravel(), (near.T @ by_shape(at[:, :-2])).ravel(),
            (near.T @ by_shape(at[:, 2:])).ravel(), (seen - both.sum((0, 1))).ravel(), (gold[:, 0] - here[:, 0]).sum(0),
        ]) / n - 1e-4 * v

    slope, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):  # Adam
        g = gradient(w)
        slope = 0.9 * slope + 0.1 * g
        square = 0.99 * square + 0.01 * g * g
        w += 0.2 * (slope / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    return Model(*parts(w))


def _unjudged(line: str, found: list[tuple[int, int]]) -> bool:
    """Holds a word full of digits that no pattern took: that it is nothing
    cannot be said, so the line teaches nothing."""
    return any(
        sum("0" <= c <= "9" for c in m.group()) >= 8 and not any(s < m.end() and e > m.start() for s, e in found)
        for m in re.finditer(r"\S+", line))


def hand_labelled(path: Path = LABELLED_LINES) -> list[tuple[str, list[Span]]]:
    """The lines labelled by hand, with their spans."""
    rows = []
    for line in path.read_text(encoding="utf-8").splitlines():
        if line.startswith("#"):
            continue
        text, spans = "", []
        for plain, kind, marked in re.findall(r"(.*?)(?:\{\{(\w+):(.*?)\}\}|$)", line):
            text += plain
            if kind:
                spans.append((len(text), ALL_KINDS.index(kind), len(text) + len(marked)))
                text += marked
        rows.append((text, spans))
    return rows


def _training_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Crops of lines around base spans, and as many crops without any."""
    word = re.compile(r"\S+")
    for batch in batches:
        lines, spans, hard = [], [], []
        for text in batch.column(0).to_pylist():
            plain = 0
            for line in (text or "").split("\n"):
                found = base_spans(line)
                if not found and (plain >= 2 or not line.strip()):
                    continue
                plain += not found
                middle = found[0][0] if found else 0
                left = [m.start() for m in word.finditer(line, max(0, middle - 400), middle)][-TRAIN_WORDS // 2:]
                a = left[0] if left else middle
                right = [m.end() for m in word.finditer(line, middle, middle + 400)][:TRAIN_WORDS]
                b = max([right[-1] if right else middle, *(e for s, _, e in found[:1])])
                if _unjudged(line[a:b], [(s - a, e - a) for s, _, e in found]):
                    continue
                lines.append(line[a:b])
                spans.append([{"start": s - a, "kind": k, "end": e - a} for s, k, e in found if s >= a and e <= b])
                hard.append(bool(found))
        yield pa.RecordBatch.from_arrays([
            pa.array(lines, pa.string()),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))),
            pa.array(hard, pa.bool_()),
        ], names=["line", "spans", "hit"])


def labelled_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The small labelled table: line, spans. At most TRAIN_LINES lines from
    the TRAIN_DOCS documents whose ids hash lowest, those with spans first."""
    place = F.xxhash64(F.lit("pii"), F.col(id_col))
    chosen = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), place.alias("_place")).orderBy("_place", "_id").limit(TRAIN_DOCS)
    given = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text"))
    texts = given.join(F.broadcast(chosen.select("_id").distinct()), F.col("_doc") == F.col("_id")).select("text")
    lines = texts.mapInArrow(_training_lines, "line string, spans array<struct<start:int,kind:int,end:int>>, hit boolean")
    mixed = F.xxhash64("line")
    return lines.orderBy(F.when(F.col("hit"), F.pmod(mixed, F.lit(2))).otherwise(F.lit(1)), mixed, "line").limit(TRAIN_LINES).select("line", "spans")


# --- the operator --------------------------------------------------------

def added_spans(taken: list[Span], more: list[Span]) -> list[Span]:
    """``more`` without the spans that touch one of ``taken``."""
    merged: list[list[int]] = []
    for s, _, e in sorted(taken):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    ends = [e for _, e in merged]
    out = []
    for s, kind, e in more:
        k = bisect_right(ends, s)  # the first that ends after s
        if k == len(merged) or merged[k][0] >= e:
            out.append((s, kind, e))
    return out


def _pieces(text: str) -> Iterator[tuple[int, str]]:
    """A long text in pieces that end after a newline, if there is one near."""
    start = 0
    while start < len(text):
        end = start + PIECE_CHARS
        if end < len(text):
            cut = text.rfind("\n", start + PIECE_CHARS // 2, end)
            cut = cut if cut >= 0 else text.rfind(" ", start + PIECE_CHARS // 2, end)
            end = cut + 1 if cut >= 0 else end
        yield start, text[start:end]
        start = end


def _find(pickled):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(pickled.value)
        scores = Scores(model) if model is not None else None
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

        def named(spans):
            return [{"kind": ALL_KINDS[k], "start": s, "end": e} for s, k, e in spans]

        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            base, refused = zip(*map(matches, texts)) if texts else ((), ())
            more: list[list[Span]] = [[] for _ in texts]
            if scores is not None:
                for first, end in text_groups(texts):
                    if end - first == 1:
                        for offset, piece in _pieces(texts[first]):
                            more[first] += [(s + offset, k, e + offset) for s, k, e in decode(scores, piece)]
                        continue
                    # many texts at once, as lines of one string
                    begins = np.cumsum([0] + [len(t) + 1 for t in texts[first:end]])
                    for s, k, e in decode(scores, "\n".join(texts[first:end])):
                        at = int(np.searchsorted(begins, s, "right")) - 1
                        more[first + at].append((s - int(begins[at]), k, e - int(begins[at])))
            # digits that a pattern refused may still be part of a secret
            every = [
                sorted(b + added_spans(b + r, [x for x in m if x[1] < len(KINDS)]) + added_spans(b, [x for x in m if x[1] >= len(KINDS)]))
                for b, r, m in zip(base, refused, more)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(pa.int64()),
                pa.array([named(b) for b in base], kind), pa.array([named(s) for s in every], kind),
            ], names=["id", "base", "spans"])
    return run


def find_personal_data(docs: DataFrame, id_col: str, text_col: str, labelled: DataFrame | None = None) -> DataFrame:
    """id_col, base, spans (base and added) of every whole text.

    ``labelled``: line, spans (start, kind number, end) to train from; by
    default the lines labelled by hand and ``labelled_lines`` of the documents
    themselves.
    """
    table = labelled if labelled is not None else labelled_lines(docs, id_col, text_col)
    rows = sorted((r.line, [(s.start, s.kind, s.end) for s in r.spans]) for r in table.limit(TRAIN_LINES).collect())
    if labelled is None:
        rows += hand_labelled() * HAND_WEIGHT
    model = docs.sparkSession.sparkContext.broadcast(pickle.dumps(train(rows)))
    out = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(_find(model), OUT)
    return out.withColumnRenamed("id", id_col)

"""Language identification by hierarchical discrimination.

A text is first assigned to a language family, then one-versus-one linear
support vector machines separate the languages within that family (and, by
the same scheme, the families). Features are the square roots of the relative
frequencies (so of length one) of hashed letter bigrams and trigrams of the
lower-cased text, with every run of other characters read as one space; ids,
sources and labels are no features.

Training takes a bounded sample of labelled rows: ``PER_LANGUAGE`` rows of
each language, chosen by a hash of their id over all labelled rows. Machines
are fitted to the squared hinge loss by accelerated gradient steps in numpy. Prediction is map-only
and reads whole texts in pieces, so its memory is bounded.

Defined results: a text that is null or has no letter is ``und`` with score
0; so is every text if nothing could be learned; with a single learned
language every text with letters gets it. Votes that tie go to the larger
summed margin, then the first language in order. Ids, repeated rows and
nulls in ids pass through row by row; other columns are not read.
"""

from __future__ import annotations

import itertools
import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedyard.llm.common import PIECE_CHARS, free_names

#: Labelled rows per language used for training.
PER_LANGUAGE = 400
#: Hashed grams.
DIMENSIONS = 1 << 13
#: Gradient steps per machine.
STEPS = 200
#: Score from which a prediction replaces a label that it contradicts.
SURE_FROM = 0.9
#: Weight decay of the machines.
DECAY = 1e-4

UNKNOWN = "und"
#: Families of language codes; a code that is not listed is its own family.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "pl", "cs", "uk", "bg", "sk", "sl", "hr", "sr"),
    "finnic": ("fi", "et"),
    "semitic": ("ar", "he"),
    "indic": ("hi", "bn", "ur", "mr", "pa"),
}

OUT = "id long, lang_pred string, score double"

_OTHER = re.compile(r"[\W\d_]+")


def has_letters(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def family_of(lang: str, families: dict[str, tuple[str, ...]] = FAMILIES) -> str:
    return next((f for f, members in families.items() if lang in members), lang)


def grams(letters: str) -> np.ndarray:
    """Hashed bigrams (lower half) and trigrams (upper half) of a piece."""
    c = np.frombuffer(letters.encode("utf-32-le"), dtype=np.uint32)
    half = np.uint32(DIMENSIONS // 2)
    two = c[:-1] * np.uint32(0x9E3779B1) + c[1:] * np.uint32(0x85EBCA6B)
    three = two[:-1] * np.uint32(31) + c[2:] * np.uint32(0xC2B2AE35)
    two ^= two >> np.uint32(15)
    three ^= three >> np.uint32(15)
    return np.concatenate([two % half, half + three % half])


def pieces(text: str) -> Iterator[str]:
    """The text as letters and single spaces; neighbours share no gram."""
    for k in range(0, len(text), PIECE_CHARS):
        yield " " + _OTHER.sub(" ", text[k:k + PIECE_CHARS].lower()).strip() + " "


@dataclass
class Machines:
    """One-versus-one linear machines over ``classes``."""

    classes: list[str]
    weights: np.ndarray = field(default=None)  # one row per pair
    bias: np.ndarray = field(default=None)

    @property
    def pairs(self) -> list[tuple[int, int]]:
        return list(itertools.combinations(range(len(self.classes)), 2))

    def fit(self, x: np.ndarray, y: list[str]) -> None:
        at = np.array([self.classes.index(v) for v in y], dtype=np.int64)
        self.weights = np.zeros((len(self.pairs), DIMENSIONS), dtype=np.float32)
        self.bias = np.zeros(len(self.pairs), dtype=np.float32)
        for k, (a, b) in enumerate(self.pairs):
            rows = np.flatnonzero((at == a) | (at == b))
            self.weights[k], self.bias[k] = fit_svm(x[rows], np.where(at[rows] == a, 1.0, -1.0).astype(np.float32))

    def choose(self, margins: np.ndarray) -> tuple[str, float]:
        """Most votes, then the larger summed margin; confidence in 0 to 1."""
        votes, total = np.zeros(len(self.classes)), np.zeros(len(self.classes))
        least = np.full(len(self.classes), np.inf)
        for (a, b), m in zip(self.pairs, margins):
            votes[a if m >= 0 else b] += 1
            total[a] += m
            total[b] -= m
            least[a], least[b] = min(least[a], m), min(least[b], -m)
        best = max(range(len(self.classes)), key=lambda i: (votes[i], total[i], -i))
        sure = 1.0 if len(self.classes) == 1 else float(1 / (1 + np.exp(-4.0 * np.clip(least[best], -50, 50))))
        return self.classes[best], sure


def features(text: str) -> np.ndarray:
    counts = np.zeros(DIMENSIONS, dtype=np.int64)
    for piece in pieces(text):
        counts += np.bincount(grams(piece), minlength=DIMENSIONS)
    return np.sqrt(counts / max(1, counts.sum())).astype(np.float32)


def fit_svm(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """A linear machine for the squared hinge loss, both sides weighted alike."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    # rows have length one and weights sum to one, which bounds the curvature
    rate = np.float32(1 / (4 + DECAY))
    w = ahead = np.zeros(x.shape[1], np.float32)
    b = b_ahead = np.float32(0)
    for step in range(1, STEPS + 1):
        short = np.maximum(0, 1 - y * (x @ ahead + b_ahead)) * weight * y * np.float32(2)
        new_w = ahead - rate * (np.float32(DECAY) * ahead - short @ x)
        new_b = b_ahead + rate * short.sum()
        push = np.float32((step - 1) / (step + 2))
        ahead, b_ahead = new_w + push * (new_w - w), new_b + push * (new_b - b)
        w, b = new_w, new_b
    return w, float(b)


@dataclass
class LanguageModel:
    families: Machines
    members: dict[str, Machines]

    @property
    def stacked(self) -> tuple[list[Machines], np.ndarray, np.ndarray]:
        machines = [self.families, *self.members.values()]
        return machines, np.concatenate([m.weights for m in machines]), np.concatenate([m.bias for m in machines])


def train(rows: list[tuple[str, str]], families: dict[str, tuple[str, ...]] = FAMILIES) -> LanguageModel | None:
    """Fit from (text, language) rows; None if no row has a letter."""
    kept = [(t, lang) for t, lang in rows if has_letters(t)]
    if not kept:
        return None
    x = np.stack([features(text) for text, _ in kept])
    langs = [lang for _, lang in kept]
    kinds = [family_of(lang, families) for lang in langs]
    top = Machines(sorted(set(kinds)))
    top.fit(x, kinds)
    members = {}
    for kind in top.classes:
        rows_of = [k for k, v in enumerate(kinds) if v == kind]
        members[kind] = Machines(sorted({langs[k] for k in rows_of}))
        members[kind].fit(x[rows_of], [langs[k] for k in rows_of])
    return LanguageModel(top, members)


class Predictor:
    def __init__(self, model: LanguageModel) -> None:
        self.model = model
        machines, self.weights, self.bias = model.stacked
        ends = np.cumsum([len(m.pairs) for m in machines])
        self.part = {id(m): slice(e - len(m.pairs), e) for m, e in zip(machines, ends)}

    def predict(self, text: str | None) -> tuple[str, float]:
        if not has_letters(text):
            return UNKNOWN, 0.0
        margins = self.weights @ features(text) + self.bias
        kind, sure = self.model.families.choose(margins[self.part[id(self.model.families)]])
        inner = self.model.members[kind]
        lang, inner_sure = inner.choose(margins[self.part[id(inner)]])
        return lang, sure * inner_sure


def _identify(pickled, sure_from: float):
    """Predicts every row and passes on those with letters; the last two
    columns are the text and the label. The label becomes the prediction where
    it is null, or a learned language contradicted with a score from
    ``sure_from`` on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(pickled.value)
        predictor = Predictor(model) if model is not None else None
        learned = {lang for m in model.members.values() for lang in m.classes} if model is not None else set()
        for batch in batches:
            texts, labels = batch.columns[-2].to_pylist(), batch.columns[-1].to_pylist()
            kept = [has_letters(t) for t in texts]
            said = list(labels)
            for k, (text, label, keep) in enumerate(zip(texts, labels, kept)):
                if predictor and keep:
                    lang, score = predictor.predict(text)
                    if label is None or label in learned and score >= sure_from:
                        said[k] = lang
            filled = pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(said, batch.columns[-1].type)], schema=batch.schema)
            yield filled.filter(pa.array(kept, pa.bool_()))
    return run


def _predict(pickled):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(pickled.value)
        predictor = Predictor(model) if model is not None else None
        for batch in batches:
            said = [predictor.predict(t) if predictor else (UNKNOWN, 0.0) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(pa.int64()),
                pa.array([s[0] for s in said], pa.string()), pa.array([s[1] for s in said], pa.float64()),
            ], names=["id", "lang_pred", "score"])
    return run


def training_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, may_train: Column, per_language: int = PER_LANGUAGE) -> DataFrame:
    """text, lang of at most ``per_language`` labelled rows of each language.

    Rows come in order of a hash of their id. A first pass counts rows per
    language (few by nature: the model keeps a machine per pair), so that the
    hash alone thins each language to about twice its bound where it is read;
    only that reaches the exact cut, and no language is gathered whole.
    """
    rows = docs.where(may_train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).agg(F.count("*")).collect()}
    share = F.create_map(*[F.lit(v) for lang, n in sorted(counts.items()) for v in (lang, (2.0 * per_language + 50) / n)])
    place = F.pmod(F.xxhash64(F.lit("train"), F.col(id_col)), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(id_col).alias("_id"), place.alias("_place"))
    thin = chosen.where(F.col("_place") < F.try_element_at(share, F.col("lang"))) if counts else chosen
    order = Window.partitionBy("lang").orderBy("_place", "_id")
    return thin.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= per_language).select("text", "lang")


def _learned(docs: DataFrame, id_col: str, text_col: str, lang_col: str, may_train: Column, per_language: int):
    sample = training_sample(docs, id_col, text_col, lang_col, may_train, per_language).collect()
    return docs.sparkSession.sparkContext.broadcast(pickle.dumps(train(sorted((r.text, r.lang) for r in sample))))


def keep_identified(docs: DataFrame, id_col: str, text_col: str, lang_col: str, may_train: Column, per_language: int = PER_LANGUAGE,
                    sure_from: float = SURE_FROM) -> DataFrame:
    """``docs``, all columns, without the rows that have no letter (``und``).

    Every text is predicted. ``lang_col`` becomes the predicted language where
    it is null, or where the prediction contradicts it with a score of
    ``sure_from`` or more. A language that was not learned is never predicted,
    so its labels are not contradicted; if nothing could be learned all stay.
    """
    model = _learned(docs, id_col, text_col, lang_col, may_train, per_language)
    # text and label come twice: in their places, and last for the predictor
    text, said = free_names(docs, "identified", "said")
    wide = docs.select("*", F.col(text_col).alias(text), F.col(lang_col).cast("string").alias(said))
    return wide.mapInArrow(_identify(model, sure_from), wide.schema).select(
        *[F.col(said).alias(c) if c == lang_col else F.col(c) for c in docs.columns])


def detect(docs: DataFrame, id_col: str, text_col: str, lang_col: str, may_train: Column, per_language: int = PER_LANGUAGE) -> DataFrame:
    """id_col, lang_pred, score of every row; learns where ``may_train`` holds."""
    sent = _learned(docs, id_col, text_col, lang_col, may_train, per_language)
    out = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(_predict(sent), OUT)
    return out.withColumnRenamed("id", id_col)

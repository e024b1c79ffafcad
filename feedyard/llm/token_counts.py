"""Token counts by distinct pre-tokens, for a SentencePiece model file.

No piece of the vocabulary reaches across a pre-token border (``cut_rule``),
so the tokens of a text are the sum of those of its pre-tokens. The documents
are read once, in blocks of bounded size; a block keeps its distinct
pre-tokens and, per document, how often it has each of them (places in the
block's list, never ids of tokens). Then:

* the blocks' pre-tokens meet by an exchange on a hash of the pre-token (its
  shelf; a block sends what it has of a shelf as one row), and the library
  counts each distinct pre-token once;
* the counts return to their blocks and are joined to the documents'
  frequencies: a sum of count x frequency per document.

What travels is each block's distinct pre-tokens, not the words of its texts,
and a frequent pre-token travels once a block. The blocks are written once to
the shared folder, so a lost executor re-reads them.

Defined results: null text is empty; an empty text has no tokens and no
bytes; ids (null and repeated ones too) pass through row by row; other columns
are not read; texts of any length are counted whole (a longer text is a block
of its own); an empty table gives no rows.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedyard.llm.common import landed

#: Characters of text in a block: bounds a worker's memory.
BLOCK_CHARS = 32_000_000
#: Shelves that pre-tokens are hashed to: a task holds one shelf at a time.
SHELVES = 4096

SPACE = "▁"  # fixed value: the sign that stands for a space

BLOCKS = ("block long, ids array<long>, n_bytes array<long>, n_pieces int, n_pairs long, sizes binary, places binary, "
          "times binary, shelves binary, pieces array<struct<shelf:int,start:int,pieces:array<string>>>")
COUNTS = "block long, start int, n binary"
TOTALS = "id long, n_bytes long, n_tokens long"


class PieceCounter:
    """The library's token counts for pre-tokens of one model."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(model)
        norm = spec.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models that leave texts as they are have local pre-tokens")
        if spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models with white space before words")
        self.prefixed = norm.add_dummy_prefix
        kinds = spec.SentencePiece
        self.cut = cut_rule([p.piece for p in spec.pieces if p.type in (kinds.NORMAL, kinds.USER_DEFINED)])
        # the text's first pre-token gets the prefix here, so that no other one does
        norm.add_dummy_prefix = False
        self.library = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())

    def split(self, text: str) -> list[str]:
        """The pre-tokens of a whole text; together they are the text as the model sees it."""
        if not text:
            return []
        text = text.replace(" ", SPACE)
        return self.cut.findall(SPACE + text if self.prefixed else text)

    def count(self, pieces: list[str]) -> list[int]:
        return [len(ids) for ids in self.library.encode(pieces, num_threads=1)]


def cut_rule(vocabulary: list[str]) -> re.Pattern:
    """Where no piece can reach across, as a pattern that finds pre-tokens.

    Characters that stand side by side in some piece belong together, and so
    do those that belong to the same third one; a run of characters that
    belong together is a pre-token, with the spaces before it unless a piece
    has a space after something else. All other characters stand alone.
    """
    group: dict[str, str] = {}

    def top(c: str) -> str:
        while group.setdefault(c, c) != c:
            group[c] = c = group[group[c]]
        return c

    joined = any(a != SPACE and b == SPACE for p in vocabulary for a, b in zip(p, p[1:]))
    for p in vocabulary:
        for a, b in zip(p, p[1:]):
            if b == SPACE and not joined:
                continue  # spaces beside spaces
            group[top(a if a != SPACE or joined else b)] = top(b)
    members: dict[str, list[str]] = {}
    for c in sorted(group):
        members.setdefault(top(c), []).append(c)
    runs = "|".join(f"[{''.join(map(re.escape, m))}]+" for m in sorted(members.values(), key=len, reverse=True))
    spaces = "" if joined else f"{SPACE}+(?:{runs})?|" if runs else f"{SPACE}+|"
    return re.compile(f"{spaces}{runs}{'|' if runs else ''}.", re.DOTALL)


def _packed(numbers) -> bytes:
    """Whole numbers below 2^32, by byte planes, which are mostly alike."""
    x = np.asarray(numbers, np.uint32)
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, "zstd"), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view(np.uint32).ravel().astype(np.int64)


class Block:
    """The distinct pre-tokens of some documents, and their frequencies."""

    def __init__(self) -> None:
        self.chars = 0
        self.ids: list[int | None] = []
        self.n_bytes: list[int] = []
        self.place: dict[str, int] = {}
        self.sizes, self.steps, self.times = array("I"), array("I"), array("I")

    def add(self, doc: int | None, text: str, n_bytes: int, pieces: list[str]) -> None:
        place = self.place
        pairs = sorted([(place.setdefault(p, len(place)), n) for p, n in Counter(pieces).items()])
        last = 0
        for at, n in pairs:  # places in order, as steps from the one before
            self.steps.append(at - last)
            self.times.append(n)
            last = at
        self.ids.append(doc)
        self.n_bytes.append(n_bytes)
        self.sizes.append(len(pairs))
        self.chars += len(text)

    def row(self, number: int) -> pa.RecordBatch:
        shelf = np.fromiter((crc32(p.encode()) % SHELVES for p in self.place), np.int64, len(self.place))
        order = np.argsort(shelf, kind="stable")
        names = list(self.place)
        cuts = np.flatnonzero(np.diff(shelf[order], prepend=-1)).tolist()
        shelves = [
            {"shelf": int(shelf[order[a]]), "start": a, "pieces": [names[k] for k in order[a:b]]}
            for a, b in zip(cuts, [*cuts[1:], len(names)])
        ]
        kind = pa.list_(pa.struct([("shelf", pa.int32()), ("start", pa.int32()), ("pieces", pa.list_(pa.string()))]))
        return pa.RecordBatch.from_arrays([
            pa.array([number], pa.int64()), pa.array([self.ids], pa.list_(pa.int64())),
            pa.array([self.n_bytes], pa.list_(pa.int64())), pa.array([len(names)], pa.int32()), pa.array([len(self.steps)], pa.int64()),
            *[pa.array([_packed(x)], pa.binary()) for x in (self.sizes, self.steps, self.times, shelf)], pa.array([shelves], kind),
        ], names=["block", "ids", "n_bytes", "n_pieces", "n_pairs", "sizes", "places", "times", "shelves", "pieces"])


def _blocks(model, block_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = PieceCounter(model.value).split
        number = TaskContext.get().partitionId() << 32
        block = Block()
        for batch in batches:
            n_bytes = pc.fill_null(pc.binary_length(batch.column(1).cast(pa.large_string())), 0).to_pylist()
            for doc, text, n in zip(batch.column(0).to_pylist(), batch.column(1), n_bytes):
                text = text.as_py() or ""
                if block.ids and block.chars + len(text) > block_chars:
                    yield block.row(number)
                    number, block = number + 1, Block()
                block.add(doc, text, n, split(text))
        if block.ids:
            yield block.row(number)

    return run


def _count(model):
    """Rows (shelf, block, start, pieces), shelf by shelf -> (block, start, n)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(model.value)
        shelf, known = None, {}
        for batch in batches:
            counts = []
            for at, pieces in zip(batch.column(0).to_pylist(), batch.column(3)):
                if at != shelf:
                    shelf, known = at, {}
                pieces = pieces.as_py()
                new = [p for p in pieces if p not in known]
                known.update(zip(new, counter.count(new)))
                counts.append(np.fromiter(map(known.__getitem__, pieces), np.uint32, len(pieces)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(counts, pa.binary())], names=["block", "start", "n"])

    return run


def _sums(key, blocks: pa.Table, counts: pa.Table) -> pa.Table:
    """count x frequency, summed per document of one block."""
    block = blocks.slice(0, 1).to_pylist()[0]
    shelved = np.zeros(block["n_pieces"], np.int64)
    for start, n in zip(counts["start"].to_pylist(), counts["n"].to_pylist()):
        part = np.frombuffer(n, np.uint32)
        shelved[start:start + len(part)] = part
    n = np.zeros(block["n_pieces"], np.int64)
    n[np.argsort(_unpacked(block["shelves"], block["n_pieces"]), kind="stable")] = shelved
    sizes = _unpacked(block["sizes"], len(block["ids"]))
    steps, times = (_unpacked(block[c], block["n_pairs"]) for c in ("places", "times"))
    ends = np.cumsum(sizes)
    starts = ends - sizes
    # running places, less what the documents before have summed up
    summed = np.concatenate(([0], np.cumsum(steps)))
    places = summed[1:] - np.repeat(summed[starts], sizes)
    running = np.concatenate(([0], np.cumsum(n[places] * times)))
    return pa.table({
        "id": pa.array(block["ids"], pa.int64()), "n_bytes": pa.array(block["n_bytes"], pa.int64()),
        "n_tokens": pa.array(running[ends] - running[starts], pa.int64()),
    })


def count_tokens(docs: DataFrame, id_col: str, text_col: str, model_file: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """id_col, n_bytes (UTF-8) and n_tokens of every whole text.

    ``model_file`` is a SentencePiece model on the driver; its bytes (under a
    MB by nature) go to the workers as a broadcast. Ids must be whole numbers.
    """
    with open(model_file, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    blocks = landed(given.mapInArrow(_blocks(model, block_chars), BLOCKS), "token-blocks")
    met = blocks.select("block", F.explode("pieces").alias("p")).select("p.shelf", "block", "p.start", "p.pieces")
    counts = met.repartition("shelf").sortWithinPartitions("shelf").mapInArrow(_count(model), COUNTS)
    return (
        blocks.drop("pieces").groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(_sums, TOTALS)
        .withColumnRenamed("id", id_col)
    )

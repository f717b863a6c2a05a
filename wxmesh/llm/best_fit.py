"""Packing whole documents into training windows by vector best-fit.

1. Tokenise each whole document in Arrow batches, append the end id, and cut
   only what is longer than a window. Each piece gets a running number among
   the pieces of its length in its task; the pieces are written once, so that
   number is fixed whatever is lost later.
2. A piece is a vector (tokens, documents, attention cost) that follows from its
   length ``n``: ``(n, 1, n * n)``. Only counts of lengths are needed to plan:
   at most ``capacity`` numbers, whatever the number of documents.
3. Longest first, each piece goes to the open window with the smallest weighted
   norm of what would be left of the three capacities, among those with room in
   all three; a new window opens only if there is none. Windows in the same
   state are handled as one class, and equal pieces together: a window that has
   just taken a piece has the smallest norm of its class, so it takes further
   ones while they fit, and then the next window does.
4. Several weightings are planned; the one with the fewest windows is used.
5. The number of a piece among all of its length gives window and offset.

Token ids are those of the ``tokenizers`` library for the given JSON file, whose
words are encoded one by one; so each worker remembers the ids of the words it
has seen. That needs texts whose characters have settled Unicode classes and
case; any other text is given to ``tokenizers`` as a whole. Strings of special
tokens are ordinary text.

Defined results: null text counts as empty; an empty document is one piece that
holds the end id. Rows repeated in the input are packed each. Other columns,
whatever their names, play no part. An empty table gives an empty one.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wxmesh.llm.common import as_texts, column_of, record, slices
from wxmesh.session import materialise

CAPACITY = 4096
END_ID = 1
#: Weights of tokens, documents and attention cost in the norm of what is left.
WEIGHTINGS = ((1.0, 0.0, 0.0), (1.0, 0.1, 0.1), (1.0, 0.0, 1.0))
#: Words that a worker remembers at most.
REMEMBERED = 500_000

PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("part", pa.int64()), ("number", pa.int64())])
PIECES_DDL = "doc_id long, piece long, start long, length long, ids_crc32 long, part long, number long"
PACKED = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
PACKED_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

#: Characters with the same class and lower case in every Unicode version in use, which normalisation leaves alone.
SETTLED_RANGES = "\t-\n \r-\r \x20-\x7E \u00A1-\u012F \u0131-\u0233 \u0400-\u0481 \u2010-\u2027 \u2030-\u205E " \
                 "\u20AC-\u20AC \u3041-\u3096 \u30A1-\u30FA \u4E00-\u9FA5 \uAC00-\uD7A3"


def _ranges() -> Iterator[tuple[int, int]]:
    for found in re.finditer("(.)-(.)", SETTLED_RANGES, re.DOTALL):
        yield ord(found[1]), ord(found[2])


def _characters(kinds: str) -> str:
    """The settled characters whose class begins with one of ``kinds``, as ranges of a pattern."""
    out = []
    for lo, hi in _ranges():
        for same, run in groupby(range(lo, hi + 1), lambda c: unicodedata.category(chr(c))[0] in kinds):
            if same:
                run = list(run)
                out.append(f"\\u{run[0]:04x}-\\u{run[-1]:04x}")
    return "".join(out)


SETTLED = re.compile(f"[{''.join(f'\\u{lo:04x}-\\u{hi:04x}' for lo, hi in _ranges())}]*")
#: How the vocabulary splits words (fixed value), with the classes written out for the settled characters.
WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_characters('L')}]+|[{_characters('N')}]|[{_characters('MPS')}\u00AD]+")


class WordIds(dict):
    """Ids of a word as little-endian 32-bit numbers, asked of ``tokenizers`` once."""

    def __init__(self, encode: Callable[[str], bytes]):
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = self.encode(word)
        return found


@cache
def encoder(json_path: str) -> Callable[[str], bytes]:
    """``text -> ids`` as little-endian 32-bit numbers."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(json_path)
    whole.encode_special_tokens = True
    exact = lambda text: np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    words = WordIds(exact)
    return lambda text: (b"".join(map(words.__getitem__, WORD.findall(text.lower()))) if SETTLED.fullmatch(text)
                         else exact(text))


def cut(docs: DataFrame, json_path: str, capacity: int, end_id: int) -> DataFrame:
    """One row per piece, numbered among the pieces of its length in its task."""
    end = int(end_id).to_bytes(4, "little")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(json_path)
        part, numbers = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in slices(batches, 512):
            rows = []
            for doc, text in zip(column_of(batch, "doc_id").to_pylist(), as_texts(column_of(batch, "text"))):
                ids = encode(text) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at:at + 4 * capacity]
                    n = len(own) // 4
                    rows.append((doc, k, at // 4, n, zlib.crc32(own), part, int(numbers[n])))
                    numbers[n] += 1
            if rows:
                yield record(PIECES, *zip(*rows))

    return docs.select("doc_id", "text").mapInArrow(pieces, PIECES_DDL)


class BestFit:
    """Windows for ``counts[length]`` pieces of each length, as runs of piece numbers of each length.

    A run says: piece number ``first + k`` of ``length`` goes to window
    ``window + k // each`` at ``offset + (k % each) * length``.
    """

    def __init__(self, counts: np.ndarray, capacities: Sequence[int], weights: Sequence[float]):
        full = np.array(capacities, np.int64)
        weights = np.array(weights) / full.astype(float) ** 2
        window, size = np.zeros(0, np.int64), np.zeros(0, np.int64)  # first window and number of windows of each class
        left = np.zeros((0, 3), np.int64)
        runs: list[np.ndarray] = []
        self.windows = 0
        for length in np.flatnonzero(counts)[::-1].tolist():
            item = np.array((length, 1, length * length), np.int64)
            need, number = int(counts[length]), 0
            fits = (left // item).min(axis=1)
            room = np.flatnonzero(fits > 0)
            norm = (weights * (left[room] - item).astype(float) ** 2).sum(axis=1)
            room = room[np.argsort(norm, kind="stable")]
            each, held = fits[room], fits[room] * size[room]
            ends = np.cumsum(held)
            used = int(np.searchsorted(ends, need, side="right"))  # classes that are filled as far as they go
            new: list[tuple[int, int, np.ndarray]] = []
            if used:
                own = room[:used]
                runs.append(np.stack((np.full(used, length), ends[:used] - held[:used], window[own], each[:used],
                                      full[0] - left[own, 0]), axis=1))
                left[own] -= each[:used, None] * item
                number = int(ends[used - 1])
            if number < need and used < len(room):  # one class is filled in part: it comes apart
                c, k = int(room[used]), int(each[used])
                whole, some = divmod(need - number, k)
                runs.append(np.array([(length, number, window[c], k, full[0] - left[c, 0])]))
                for bins, pieces in ((whole, k), (int(some > 0), some)):
                    if bins:
                        new.append((int(window[c]), bins, left[c] - pieces * item))
                        window[c] += bins
                        size[c] -= bins
                number = need
            if number < need:
                k = int((full // item).min())
                if not k:
                    raise ValueError(f"a piece of {length} tokens exceeds the capacities {tuple(capacities)}")
                whole, some = divmod(need - number, k)
                runs.append(np.array([(length, number, self.windows, k, 0)]))
                for bins, pieces in ((whole, k), (int(some > 0), some)):
                    if bins:
                        new.append((self.windows, bins, full - pieces * item))
                        self.windows += bins
            keep = (size > 0) & (left > 0).all(axis=1)
            window = np.concatenate((window[keep], [w for w, _, _ in new])).astype(np.int64)
            size = np.concatenate((size[keep], [s for _, s, _ in new])).astype(np.int64)
            left = np.concatenate((left[keep], np.array([r for _, _, r in new], np.int64).reshape(-1, 3)))
        table = np.concatenate(runs).astype(np.int64) if runs else np.zeros((0, 5), np.int64)
        table = table[np.lexsort((table[:, 1], table[:, 0]))]
        self.key = (table[:, 0] << 48) | table[:, 1]
        self.first, self.window, self.each, self.offset = table[:, 1:].T.copy()

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (length << 48) | number, side="right") - 1
        k = number - self.first[at]
        return self.window[at] + k // self.each[at], self.offset[at] + k % self.each[at] * length


def plan(counts: np.ndarray, capacity: int, max_documents: int | None = None, max_cost: int | None = None,
         weightings: Sequence[Sequence[float]] = WEIGHTINGS) -> BestFit:
    """The plan with the fewest windows of those that ``weightings`` give (of equal ones the first).

    Left out, the other two capacities are what a window of ``capacity`` tokens can
    need at most, so they weigh in the choice but forbid nothing.
    """
    capacities = (capacity, max_documents or capacity, max_cost or capacity * capacity)
    return min((BestFit(counts, capacities, w) for w in weightings), key=lambda p: p.windows)


def pack(docs: DataFrame, json_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         max_documents: int | None = None, max_cost: int | None = None) -> DataFrame:
    """Per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    ``max_cost`` must leave room for the longest piece, whose cost is its length squared.
    """
    pieces = materialise(cut(docs, json_path, capacity, end_id), "pieces")
    per_task = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["n"]
    best = plan(counts, capacity, max_documents, max_cost)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).select("part", "length", "base")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number, ahead = (column_of(batch, c).to_numpy(zero_copy_only=False) for c in ("length", "number", "base"))
            if len(length):
                yield record(PACKED, *(column_of(batch, c) for c in PACKED.names[:5]), *best.place(length, number + ahead))

    return pieces.join(base, ["part", "length"]).mapInArrow(placed, PACKED_DDL)

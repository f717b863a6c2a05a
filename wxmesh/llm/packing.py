"""Packing documents into training windows by minimum bin slack.

1. Tokenise each whole document in Arrow batches, append the end id, and cut it
   into full windows and one remainder. Each piece gets a running number among
   the pieces of its length in its task; the pieces are written once, so that
   number is fixed whatever is lost later.
2. Count the pieces of each length: at most ``capacity`` numbers, so the
   packing itself is planned on the driver over that histogram, whatever the
   number of documents. For the longest remaining length a bitset subset-sum
   finds the multiset of remaining lengths whose sum comes closest to the
   window; backtracking gives how many of each length. The pattern is used as
   often as the counts allow.
3. Where no multiset fills a window exactly, the remaining pieces are laid end
   to end and cut at the window, so nothing is padded; the last, partial window
   becomes windows whose sizes are powers of two.
4. The global number of a piece among those of its length gives its window and
   its offset by arithmetic.

Token ids are those of the ``tokenizers`` library for the given JSON file. The
ids come from ``tiktoken`` over the same vocabulary, which is several times
faster; a text with a character where the two may split words differently is
given to ``tokenizers`` itself. Strings of special tokens are ordinary text.

Defined results: null text counts as empty; an empty document is one piece that
holds the end id. Rows repeated in the input are packed each. Other columns,
whatever their names, play no part.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wxmesh.llm.common import as_texts, column_of, pack_arrays, record, slices, unpack_arrays
from wxmesh.session import materialise

CAPACITY = 2048
END_ID = 1
PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("part", pa.int64()), ("number", pa.int64()), ("ids", pa.binary())])
PACKED = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
DDL = {"int64": "long", "binary": "binary"}
#: Characters whose class (letter, number, space) is the same in every Unicode version in use:
#: ASCII, Latin, Greek, Cyrillic, general punctuation and the common CJK and Hangul ranges.
SETTLED = re.compile("[\\x00-\\u024F\\u0391-\\u03A1\\u03A3-\\u03CE\\u0400-\\u0481\\u048A-\\u04FF\\u2010-\\u2027"
                     "\\u2030-\\u205E\\u20AC\\u3041-\\u3096\\u30A1-\\u30FA\\u4E00-\\u9FA5\\uAC00-\\uD7A3]*")


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"`{f.name}` {DDL[str(f.type)]}" for f in schema)


@cache
def encoder(json_path: str, ranks_path: str | None):
    """``text -> ids`` as the ``tokenizers`` library gives them for the file ``json_path``."""
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(json_path)
    slow.encode_special_tokens = True
    exact = lambda text: np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)
    if ranks_path is None:
        return exact
    import public_tokenizers

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: (np.array(fast.encode_ordinary(text), np.uint32) if SETTLED.fullmatch(text) else exact(text))


def cut(docs: DataFrame, json_path: str, ranks_path: str | None, capacity: int, end_id: int) -> DataFrame:
    """One row per piece; ``ids`` (of remainders only) are kept for a later cut."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(json_path, ranks_path)
        part, numbers = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in slices(batches, 512):
            rows = []
            for doc, text in zip(column_of(batch, "doc_id").to_pylist(), as_texts(column_of(batch, "text"))):
                ids = np.append(encode(text), np.uint32(end_id)).astype("<u4")
                for at in range(0, len(ids), capacity):
                    own = ids[at:at + capacity]
                    n = len(own)
                    rows.append((doc, at, n, zlib.crc32(own), len(ids), part, int(numbers[n]),
                                 None if n == capacity else pack_arrays(own if own.max() > 65535 else own.astype("<u2"))))
                    numbers[n] += 1
            if rows:
                yield record(PIECES, *zip(*rows))

    return docs.select("doc_id", "text").mapInArrow(pieces, _ddl(PIECES))


def best_fill(counts: np.ndarray, room: int) -> dict[int, int]:
    """The multiset of lengths (within ``counts``) whose sum is the largest that is at most ``room``.

    Bit s of ``reach`` says that s is a sum. Counts are split into powers of
    two, so that each step is one shift of the bitset; the steps are walked
    back to find what was taken.
    """
    steps, reach, mask, goal = [], 1, (1 << (room + 1)) - 1, 1 << room
    for length in np.flatnonzero(counts[:room + 1])[::-1].tolist():
        left, take = min(int(counts[length]), room // length), 1
        while left > 0 and not reach & goal:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, take = left - take, take * 2
        if reach & goal:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


class Plan:
    """Windows for ``counts[length]`` pieces of each length, as rank intervals of each length.

    An interval says: piece number ``first + k`` of ``length`` goes to window
    ``window + k // each`` at ``offset + (k % each) * length``.
    """

    def __init__(self, counts: np.ndarray, capacity: int):
        self.capacity = capacity
        left, used, rows = counts.copy(), np.zeros_like(counts), []
        window = int(counts[capacity])
        if window:
            rows.append((capacity, 0, 0, 1, 0))
        used[capacity], left[capacity] = counts[capacity], 0
        streamed = np.zeros_like(counts)
        while left.any():
            longest = int(np.flatnonzero(left)[-1])
            left[longest] -= 1
            pattern = best_fill(left, capacity - longest)
            left[longest] += 1
            pattern[longest] = pattern.get(longest, 0) + 1
            if sum(n * k for n, k in pattern.items()) < capacity:
                # Not even the closest multiset fills a window with this length: its pieces are cut instead.
                streamed[longest], left[longest] = left[longest], 0
                continue
            times, offset = min(int(left[n]) // k for n, k in pattern.items()), 0
            for n, k in sorted(pattern.items(), reverse=True):
                rows.append((n, int(used[n]), window, k, offset))
                used[n] += k * times
                left[n] -= k * times
                offset += n * k
            window += times
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 5)
        self.key = (table[:, 0] << 48) | table[:, 1]
        self.first, self.window, self.each, self.offset = table[:, 1:].T
        self.used, self.stream_window = used, window
        #: Where the pieces of each length that are cut begin in the stream of such pieces.
        lengths = np.arange(len(counts))
        self.stream_at = np.concatenate(([0], np.cumsum((streamed * lengths))))[:-1]
        self.stream_total = int((streamed * lengths).sum())

    def place(self, length: np.ndarray, number: np.ndarray):
        """Window and offset of whole pieces; -1 where a piece is part of the stream."""
        if not len(self.key):
            return np.full(len(length), -1), np.zeros(len(length), np.int64)
        at = np.maximum(np.searchsorted(self.key, (length << 48) | number, side="right") - 1, 0)
        k = number - self.first[at]
        whole = number < self.used[length]
        return (np.where(whole, self.window[at] + k // self.each[at], -1),
                np.where(whole, self.offset[at] + k % self.each[at] * length, 0))

    def stream_cuts(self, begin: int, length: int) -> Iterator[tuple[int, int, int, int]]:
        """``(start in the piece, length, window, offset)`` for a piece that begins at ``begin`` of the stream."""
        full = self.stream_total // self.capacity * self.capacity
        rest, edges, at = self.stream_total - full, [], full
        while rest:  # windows of the last part: powers of two, the largest first
            size = 1 << (rest.bit_length() - 1)
            edges.append((at, at + size))
            at, rest = at + size, rest - size
        here, end = begin, begin + length
        while here < end:
            if here < full:
                k = here // self.capacity
                lo, hi = k * self.capacity, (k + 1) * self.capacity
            else:
                k, (lo, hi) = next((full // self.capacity + i, e) for i, e in enumerate(edges) if e[0] <= here < e[1])
            stop = min(end, hi)
            yield here - begin, stop - here, self.stream_window + k, here - lo
            here = stop


def pack(docs: DataFrame, json_path: str, ranks_path: str | None = None, capacity: int = CAPACITY,
         end_id: int = END_ID) -> DataFrame:
    """Per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    pieces = materialise(cut(docs, json_path, ranks_path, capacity, end_id), "pieces")
    per_task = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["n"]
    plan = Plan(counts, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).select("part", "length", "base")
    numbered = pieces.drop("ids").join(base, ["part", "length"]).withColumn("number", F.col("number") + F.col("base"))

    def whole(batches):
        for batch in batches:
            length, number = (column_of(batch, c).to_numpy(zero_copy_only=False) for c in ("length", "number"))
            window, offset = plan.place(length, number)
            keep = pa.array(window >= 0)
            columns = [column_of(batch, c) for c in PACKED.names[:5]] + [pa.array(window), pa.array(offset)]
            yield record(PACKED, *(c.filter(keep) for c in columns))

    placed = numbered.mapInArrow(whole, _ddl(PACKED))
    if not plan.stream_total:
        return placed

    cut_lengths = [n for n in range(1, capacity) if counts[n] > plan.used[n]]
    rest = pieces.filter(F.col("length").isin(cut_lengths)).join(base, ["part", "length"]) \
        .withColumn("number", F.col("number") + F.col("base"))

    def streamed(batches):
        for batch in slices(batches, 512):
            rows = []
            for doc, start, length, total, number, blob in zip(*(column_of(batch, c).to_pylist() for c in (
                    "doc_id", "start", "length", "doc_tokens", "number", "ids"))):
                over = number - int(plan.used[length])
                if over < 0:
                    continue
                ids = unpack_arrays(blob)[0].astype("<u4")
                for at, n, window, offset in plan.stream_cuts(int(plan.stream_at[length]) + over * length, length):
                    rows.append((doc, start + at, n, zlib.crc32(np.ascontiguousarray(ids[at:at + n])), total, window, offset))
            if rows:
                yield record(PACKED, *zip(*rows))

    return placed.unionByName(rest.mapInArrow(streamed, _ddl(PACKED)))

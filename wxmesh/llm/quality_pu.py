"""Quality classifier by positive-unlabelled learning.

A linear model over style bins and hashed byte n-grams minimises the
non-negative unbiased risk ``pi R_p(+) + max(0, R_u(-) - pi R_p(-))`` with the
logistic loss. Trusted positives are the rows labelled 1, at most ``cap`` of them;
the unlabelled text is every document of the learning folds without a label, each
distinct text once, so a group of copies weighs as one.

1. The features of every document are computed once and written.
2. Bin edges are quantiles of the style values over all distinct unlabelled texts,
   from counts of their 16-bit values.
3. Distinct unlabelled texts fall into at most ``CELLS`` cells by which of their
   style values lie in either tail; a cell is the number and the mean of its texts, from
   exact integer sums. The risk of the unlabelled side is that of the cells.
4. The class prior ``pi`` is estimated from the scores of all distinct unlabelled
   texts: the least ratio, over score thresholds that enough positives reach, of the share of
   unlabelled texts at or above it to that of the positives (what is
   unlabelled cannot hold more positives than that). The model is then fitted
   again with it. Labelled negatives are used for nothing.

Defined results: null text counts as empty and gets the score of an empty
text; without a positive every score is 0.5. Several labels of one document
count as their maximum; labels that are null, or have a null ``doc_id``, are
ignored. Without unlabelled documents all labelled ones stand in for them.
Other columns of either table, whatever their names, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxmesh.llm.common import as_bytes, column_of, crc_fold, pack_arrays, record, slices, unpack_arrays
from wxmesh.llm.features import STYLE, hashed_grams, style
from wxmesh.llm.linear import bounded_rows, minimise, sigmoid
from wxmesh.session import materialise

BITS, BINS, CELLS = 9, 8, 1024
TAILS = (0.02, 0.05, 0.95, 0.98)
#: The prior before any score is known, and the share of positives that a threshold must keep to count.
FIRST_PRIOR, ENOUGH = 0.5, 0.5
#: Bits of the table of hashes that occur more than once.
TABLE_BITS = 24
WHOLE = 65535  # n-gram shares are kept as multiples of 1 / WHOLE
OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])
VECTORS = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("text_hash", pa.int64()), ("s", pa.binary()), ("g", pa.binary())])


def featured(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, text_hash`` and the features: style values as 16-bit floats, n-gram shares as 16-bit numbers."""
    def rows(batches):
        for batch in slices(batches, 512):
            raw = as_bytes(column_of(batch, "text"))
            s = [np.minimum(style(b), 6e4).astype(np.float16).tobytes() for b in raw]
            g = [np.rint(hashed_grams(b, (3,), BITS) * WHOLE).astype(np.uint16).tobytes() for b in raw]
            yield record(VECTORS, *(column_of(batch, c) for c in VECTORS.names[:3]), s, g)

    return docs.select("doc_id", "held_out", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text") \
        .mapInArrow(rows, "doc_id long, held_out boolean, text_hash long, s binary, g binary")


def distinct_texts(vectors: DataFrame) -> DataFrame:
    """Features of each distinct text once. Only texts that may have copies meet in a shuffle.

    A bit table of fixed size holds the hashes that occur more than once; a text whose bit is not set has no copy.
    """
    twice = vectors.groupBy("text_hash").agg(F.count("*").alias("n")).filter("n > 1")
    bit = F.pmod(F.col("text_hash"), F.lit(1 << TABLE_BITS))
    words = twice.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(text_hash, {1 << TABLE_BITS}) & 63 as int))")).alias("bits"))
    table = np.zeros(1 << TABLE_BITS - 6, np.int64)
    for r in words.collect():  # at most the table
        table[r["word"]] = r["bits"]

    def picked(copies: bool):
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = column_of(batch, "text_hash").to_numpy() & ((1 << TABLE_BITS) - 1)
                yield batch.filter(pa.array((table[at >> 6] >> (at & 63) & 1 == 1) == copies))

        return vectors.select("text_hash", "s", "g").mapInArrow(rows, "text_hash long, s binary, g binary")

    return picked(False).unionByName(picked(True).dropDuplicates(["text_hash"])).select("s", "g")


def values_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    s, g = (b"".join(column_of(batch, c).to_pylist()) for c in "sg")
    return (np.frombuffer(s, np.float16).reshape(-1, len(STYLE)).astype(np.float32),
            np.frombuffer(g, np.uint16).reshape(-1, 1 << BITS))


def edges_of(texts: DataFrame) -> np.ndarray:
    """Quantiles of each style value, with edges in the tails, where junk is: (style values, edges)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = values_of(batch)[0]
            for k in range(len(STYLE)):
                value, n = np.unique(s[:, k], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), k, np.int64)), pa.array(value), pa.array(n)], ["k", "v", "n"])

    got = texts.select("s", "g").mapInArrow(count, "k long, v float, n long").groupBy("k", "v").agg(F.sum("n").alias("n")).collect()
    places = np.sort(np.append(np.linspace(0, 1, BINS + 1)[1:-1], TAILS))  # of values there are at most 2**15 a feature
    table = np.array(sorted((r["k"], r["v"], r["n"]) for r in got), np.float64)
    out = []
    for k in range(len(STYLE)):
        _, value, n = table[table[:, 0] == k].T
        out.append(value[np.searchsorted(np.cumsum(n), places * n.sum())])
    return np.array(out, np.float32)


def expand(s: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Style values as steps over the edges, so that a linear model can follow any shape."""
    return (s[:, :, None] > edges).reshape(len(s), -1)


def cells_of(texts: DataFrame, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of texts of each cell that has any, and their mean features."""
    tails = edges[:, [0, 1, -2, -1]]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in slices(batches, 2048):
            s, g = values_of(batch)
            level = (s[:, :, None] > tails).sum(axis=2).astype(np.uint64)
            code = (level * np.uint64(5) ** np.arange(len(STYLE), dtype=np.uint64)).sum(axis=1) * np.uint64(0x9E3779B97F4A7C15)
            cell = (code >> np.uint64(54)).astype(np.int64) % CELLS
            own, back = np.unique(cell, return_inverse=True)
            member = np.zeros((len(own), len(cell)))
            member[back, np.arange(len(cell))] = 1  # sums of whole numbers below 2**53 are exact in any order
            both = member @ np.hstack((np.ones((len(s), 1)), expand(s, edges), g)).astype(np.float64)
            for c, row in zip(own.tolist(), both.astype(np.int64)):
                sums[c] = sums[c] + row if c in sums else row
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([pack_arrays(v) for v in sums.values()], pa.binary())],
                                         ["cell", "sums"])

    def merge(group: pa.Table) -> pa.Table:
        total = sum(unpack_arrays(b)[0] for b in group["sums"].to_pylist())
        return pa.table({"cell": group["cell"][:1], "sums": pa.array([pack_arrays(total)], pa.binary())})

    got = texts.select("s", "g").mapInArrow(add, "cell long, sums binary").groupBy("cell").applyInArrow(merge, "cell long, sums binary")
    rows = np.array([unpack_arrays(bytes(r["sums"]))[0] for r in got.orderBy("cell").collect()], np.float64)  # at most CELLS
    n = rows[:, 0]
    mean = rows[:, 1:] / n[:, None]
    mean[:, edges.size:] /= WHOLE
    return n, mean.astype(np.float32)


class Model:
    def __init__(self, pos: tuple[np.ndarray, np.ndarray], edges: np.ndarray, cells: tuple[np.ndarray, np.ndarray], prior: float):
        self.edges, self.prior = edges, prior
        p, (size, u) = self.features(*pos), cells
        share = (size / size.sum()).astype(np.float64)

        def gradient(w):
            zp, zu = p @ w[:-1].astype(np.float32) + w[-1], u @ w[:-1].astype(np.float32) + w[-1]
            side = lambda x, e: np.append(x.T @ e.astype(np.float32), e.sum())
            up, down = -sigmoid(-zp) / len(p), sigmoid(zp) / len(p)
            negative = share @ np.logaddexp(0, zu) - prior * np.logaddexp(0, zp).mean()
            push = side(u, share * sigmoid(zu)) - prior * side(p, down)
            g = prior * side(p, up) + (push if negative >= 0 else -push)
            return g + 1e-3 * np.append(w[:-1], 0)

        self.w = minimise(gradient, np.zeros(p.shape[1] + 1), 400, 0.05).astype(np.float32)

    def features(self, s: np.ndarray, g: np.ndarray) -> np.ndarray:
        return np.hstack((expand(s, self.edges).astype(np.float32), g.astype(np.float32) / np.float32(WHOLE)))

    def score(self, s: np.ndarray, g: np.ndarray) -> np.ndarray:
        return sigmoid(self.features(s, g) @ self.w[:-1] + self.w[-1]).astype(np.float64)


def estimated_prior(model: Model, texts: DataFrame, pos: tuple[np.ndarray, np.ndarray], steps: int = 200) -> float:
    """The share of positives that the scores of all unlabelled texts leave room for."""
    def count(batches):
        for batch in slices(batches, 2048):
            step = np.minimum(model.score(*values_of(batch)) * steps, steps - 1).astype(np.int64)
            own, n = np.unique(step, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(n)], ["step", "n"])

    free, trusted = np.zeros(steps), np.zeros(steps)
    for r in texts.select("s", "g").mapInArrow(count, "step long, n long").groupBy("step").agg(F.sum("n").alias("n")).collect():
        free[r["step"]] = r["n"]
    np.add.at(trusted, np.minimum(model.score(*pos) * steps, steps - 1).astype(np.int64), 1)
    free, trusted = (np.cumsum(x[::-1])[::-1] / x.sum() for x in (free, trusted))
    enough = trusted >= ENOUGH
    return float(np.clip((free[enough] / trusted[enough]).min(), 0.01, 0.99))


def fit(vectors: DataFrame, labels: DataFrame, cap: int = 2000) -> Model | None:
    """``vectors`` as of ``featured`` and ``labels(doc_id, label)``, both of the learning folds."""
    known = labels.filter("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    positive = bounded_rows(known.filter("label = 1").select("doc_id"), cap, F.col("doc_id"))
    rows = vectors.join(F.broadcast(positive), "doc_id", "left_semi").select("s", "g").collect()  # copies of a row apart, at most ``cap``
    if not rows:
        return None
    held = sorted((bytes(r["s"]), bytes(r["g"])) for r in rows)
    pos = values_of(pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*held)], ["s", "g"]))
    free = vectors.filter("doc_id is not null").join(known, "doc_id", "left_anti")
    if free.isEmpty():
        free = vectors.filter("doc_id is not null")
    texts = materialise(distinct_texts(free), "unlabelled")
    edges = edges_of(texts)
    cells = cells_of(texts, edges)
    some, rest = (tuple(x[k::2] for x in pos) for k in (0, 1))  # the prior is estimated with positives that the scores were not fitted to
    first = Model(some, edges, cells, FIRST_PRIOR)
    return Model(pos, edges, cells, estimated_prior(first, texts, rest if len(rest[0]) else some))


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, threshold: float = 0.3,
             cap: int = 2000) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, score, predicted``. ``labels`` has ``doc_id`` and ``label``."""
    docs = docs.select("doc_id", "text").withColumn("held_out", crc_fold(F.col("doc_id"), folds) == held)
    learn = labels.select("doc_id", "label").filter(crc_fold(F.col("doc_id"), folds) != held)
    vectors = materialise(featured(docs), "features")
    model = fit(vectors.filter(~F.col("held_out")), learn, cap)

    def score(batches):
        for batch in slices(batches, 2048):
            value = model.score(*values_of(batch)) if model else np.full(batch.num_rows, 0.5)
            yield record(OUT, column_of(batch, "doc_id"), column_of(batch, "held_out"), value,
                         (value >= threshold).astype(np.int32))

    return vectors.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")

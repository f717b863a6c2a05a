"""Quality rules: fixed counts per document, and a calibrated logistic regression.

The counts (words, characters, symbols, repeated lines and repeated word
windows) decide ``base_failed`` by fixed thresholds. The method's verdict is a
logistic regression over hashed words, word pairs and character n-grams,
trained on labelled quality rows and calibrated (Platt) on a fifth of them that
the regression did not see; it is scored in Arrow batches against ``keep_from``.

The fit sees at most ``cap`` labelled documents of each class.

Defined results: a null text has no words, so it fails the base rules. With
fewer than two classes of labels the verdict is "keep". Several labels of one
document count as their maximum; labels that are null, or have a null
``doc_id``, are ignored. Other columns, whatever their names, play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxmesh.llm.common import as_bytes, column_of, record, slices
from wxmesh.llm.features import hashed_grams, hashed_words
from wxmesh.llm.linear import bounded_sample, fit_logistic, fit_platt, sigmoid

BITS = 11
WINDOW = 8
KEEP_FROM = 0.5
SYMBOLS = b"#*$%&|<>"
OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
                 ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
                 ("kept", pa.bool_()), ("quality", pa.float64())])


def repeated(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    # Names for windows of 1, 2, 4, ... words by joining two neighbours: exact, no hashing.
    size, names = 1, ids
    while size < window:
        step = min(size, window - size)
        joined = names[:len(names) - step] * (names.max() + 1) + names[step:]
        kinds, names = np.unique(joined, return_inverse=True)
        size += step
        if len(kinds) == len(names):
            return 0  # all different already, so all longer windows are too
    twice = np.bincount(names)[names] > 1
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(twice), 1)
    np.add.at(cover, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def counts(raw: bytes) -> tuple[int, int, int, int, int]:
    """Words, code points in them, symbols, repeated lines, repeated words of one text."""
    words = raw.split()  # bytes.split() cuts at exactly \x20 and \x09-\x0D
    inner = b"".join(words)
    chars = len(inner) - int((np.frombuffer(inner, np.uint8) & 0xC0 == 0x80).sum())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (len(words), chars, sum(raw.count(bytes([s])) for s in SYMBOLS),
            len(lines) - len(set(lines)), repeated(words))


def vector(raw: bytes) -> np.ndarray:
    return np.concatenate((hashed_words(raw, BITS), hashed_grams(raw, (3, 4), BITS)))


class Model:
    def __init__(self, x: np.ndarray, label: np.ndarray):
        tuned = np.arange(len(x)) % 5 == 0
        balance = np.where(label == 1, 0.5 / max(1, label.sum()), 0.5 / max(1, (1 - label).sum()))
        self.w = fit_logistic(x[~tuned], label[~tuned], balance[~tuned]).astype(np.float32)
        self.slope, self.offset = fit_platt(x[tuned] @ self.w[:-1] + self.w[-1], label[tuned])

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * (x @ self.w[:-1] + self.w[-1]) + self.offset).astype(np.float64)


def fit(docs: DataFrame, labels: DataFrame, cap: int = 2000) -> Model | None:
    known = labels.filter("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    known = bounded_sample(known, "label", cap, F.col("doc_id"))

    def rows(batches):
        for batch in slices(batches, 512):
            yield pa.RecordBatch.from_arrays([
                column_of(batch, "label").cast(pa.int32()),
                pa.array([vector(b).astype(np.float16).tobytes() for b in as_bytes(column_of(batch, "text"))], pa.binary())],
                ["label", "x"])

    got = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("label", "text") \
        .mapInArrow(rows, "label int, x binary").collect()
    if len({r["label"] for r in got}) < 2:
        return None
    got.sort(key=lambda r: r["x"])
    return Model(np.stack([np.frombuffer(r["x"], np.float16) for r in got]).astype(np.float32),
                 np.array([float(r["label"] == 1) for r in got]))


def assess(docs: DataFrame, labels: DataFrame, keep_from: float = KEEP_FROM, cap: int = 2000) -> DataFrame:
    """Per row of ``docs``: the counts, ``base_failed``, ``kept`` and the calibrated ``quality``."""
    model = fit(docs, labels.select("doc_id", "label"), cap)

    def score(batches):
        for batch in slices(batches, 512):
            raw = as_bytes(column_of(batch, "text"))
            n = np.array([counts(b) for b in raw], np.int64).reshape(-1, 5)
            value = model.score(np.stack([vector(b) for b in raw])) if model and raw else np.ones(len(raw))
            failed = (n[:, 0] < 20) | (100 * n[:, 4] > 30 * n[:, 0])
            yield record(OUT, column_of(batch, "doc_id"), *n.T, failed, ~failed & (value >= keep_from), value)

    return docs.select("doc_id", "text").mapInArrow(
        score, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
               "base_failed boolean, kept boolean, quality double")

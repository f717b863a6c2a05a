"""Language ID by hierarchical discrimination.

A softmax model over hashed byte n-grams of the lower-cased text picks the
language family; inside the family one linear support vector machine for each
pair of its languages votes. The n-grams come from the whole text.

The fit sees at most ``cap`` labelled documents of each language. Which family
a language belongs to is the lookup ``FAMILY``; a language that is not in it is
a family of its own.

Defined results: ``und`` and score 0 for a null text or one without a letter,
and for every row when there is nothing to learn from. A null ``doc_id`` is in
no fold, so such a row is learned from if it has a language. Repeated rows are
scored each. Only ``doc_id``, ``text`` and ``lang`` are read; other columns,
whatever their names, play no part.

Whether a text is in a learned language at all is told by ``Likeness``: the
cosine between the n-grams of its different words and the mean of the language
it is taken for, against a low quantile of the cosines of learning texts of that
language that are not in the mean, cut to the same size. It doesn't depend on how
many languages or families there are. Words that come again, marks and digits
play no part. Under 16 bytes, or with fewer than 100 learning texts of the
language to compare with, there is no evidence against a text.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxmesh.llm.common import as_texts, column_of, crc_fold, record, slices
from wxmesh.llm.features import hashed_grams
from wxmesh.llm.linear import bounded_classes, fit_svm, minimise, sigmoid

#: Families of common language codes.
FAMILY = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "pl", "cs", "sk", "uk", "bg", "sr", "hr", "sl"),
    "uralic": ("fi", "hu", "et"),
    "turkic": ("tr", "az", "kk"),
}
BITS, ORDERS = 12, (1, 2, 3, 4)
LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
#: Sizes in bytes at which likeness is calibrated, and what is below nearly all learning texts of a size.
SIZES, MIN_TEXTS, QUANTILE, SLACK = (16, 32, 64, 128, 256, 512, 1024, 2048, 4096), 100, 0.01, 0.2


def family_of(lang: str) -> str:
    return next((name for name, members in FAMILY.items() if lang in members), lang)


def vector(text: str) -> np.ndarray:
    return hashed_grams(f" {text.lower()} ".encode(), ORDERS, BITS)


def plain_words(text: str) -> bytes:
    """The different words of a text in the order they come, lower-cased."""
    return f" {' '.join(dict.fromkeys(LETTERS.findall(text.lower())))} ".encode()


def piece(raw: bytes, size: int) -> bytes:
    """``size`` bytes from the middle."""
    at = (len(raw) - size) // 2
    return raw[at:at + size]


class Likeness:
    """How like its language a text is, beside what learning texts of that size are."""

    def __init__(self, langs: list[str], means: np.ndarray):
        self.langs = langs
        self.means = (means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-9)).astype(np.float32)
        self.floors: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def of(self, raw: bytes, lang: int) -> float:
        return float(self.means[lang] @ hashed_grams(raw, ORDERS, BITS))

    def calibrate(self, lang: np.ndarray, size: np.ndarray, value: np.ndarray) -> Likeness:
        """From the likeness to their own language of pieces of texts."""
        for g in range(len(self.langs)):
            found = [(np.log2(n), np.quantile(own, QUANTILE) * (1 - SLACK))
                     for n in SIZES for own in [value[(lang == g) & (size == n)]] if len(own) >= MIN_TEXTS]
            if found:
                self.floors[g] = tuple(np.array(found).T)
        return self

    def enough(self, text: str, lang: int) -> bool:
        raw = plain_words(text)
        if lang not in self.floors or len(raw) < SIZES[0]:
            return True
        return self.of(raw, lang) >= np.interp(np.log2(len(raw)), *self.floors[lang])


class Hierarchy:
    """Families, and pairs of languages within each; scores a matrix of texts."""

    def __init__(self, x: np.ndarray, langs: np.ndarray):
        self.langs = sorted(set(langs))
        self.families = sorted({family_of(g) for g in self.langs})
        members = [[k for k, g in enumerate(self.langs) if family_of(g) == f] for f in self.families]
        codes = np.array([self.langs.index(g) for g in langs])
        at = np.array([self.families.index(family_of(g)) for g in langs])
        self.top = self._fit_top(x, at)
        self.pairs = [[(i, j, fit_svm(x[own], np.where(codes[own] == i, 1.0, -1.0)).astype(np.float32))
                       for a, i in enumerate(group) for j in group[a + 1:]
                       for own in [(codes == i) | (codes == j)]] for group in members]
        self.members = members

    def _fit_top(self, x, at):
        k, dims = len(self.families), x.shape[1]
        want = np.eye(k, dtype=np.float32)[at]
        weight = (1 / np.bincount(at, minlength=k))[at] / k

        def gradient(w):
            w = w.reshape(k, dims + 1)
            z = x @ w[:, :-1].T.astype(np.float32) + w[:, -1]
            p = np.exp(z - z.max(1, keepdims=True))
            p = (p / p.sum(1, keepdims=True) - want) * weight[:, None]
            return np.hstack((p.T.astype(np.float32) @ x + 1e-5 * w[:, :-1], p.sum(0)[:, None])).ravel()

        return minimise(gradient, np.zeros(k * (dims + 1)), 250, 0.1).reshape(k, dims + 1).astype(np.float32)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = x @ self.top[:, :-1].T + self.top[:, -1]
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        best, score = p.argmax(1), p.max(1).astype(np.float64)
        lang = np.zeros(len(x), np.int64)
        for f, group in enumerate(self.members):
            own = np.flatnonzero(best == f)
            votes, sure = np.zeros((len(own), len(self.langs))), np.zeros((len(own), len(self.langs)))
            for i, j, w in self.pairs[f]:
                side = sigmoid(2 * (x[own] @ w[:-1] + w[-1]))
                votes[:, i] += side >= 0.5
                votes[:, j] += side < 0.5
                sure[:, i] += side
                sure[:, j] += 1 - side
            pick = np.array(group)[(votes + sure / (2 * len(group)))[:, group].argmax(1)] if len(own) else own
            lang[own] = pick
            if len(group) > 1 and len(own):
                score[own] *= sure[np.arange(len(own)), pick] / (len(group) - 1)
        return lang, np.clip(score, 0, 1)


def _learning_rows(docs: DataFrame, cap: int) -> DataFrame:
    rows = docs.filter("lang is not null and text is not null").select("doc_id", "lang", "text")
    ids = bounded_classes(rows.select("doc_id", "lang").filter("doc_id is not null").distinct(), "lang", cap, F.col("doc_id"))
    return rows.join(F.broadcast(ids), ["doc_id", "lang"], "left_semi")


def fit(docs: DataFrame, cap: int = 1000) -> Hierarchy | None:
    """Learn from the rows of ``docs(doc_id, text, lang)`` that have a language and a letter."""
    def vectors(batches):
        for batch in slices(batches, 512):
            texts = as_texts(column_of(batch, "text"))
            keep = [k for k, t in enumerate(texts) if LETTER.search(t)]
            yield pa.RecordBatch.from_arrays([
                column_of(batch, "lang").take(pa.array(keep, pa.int64())).cast(pa.string()),
                pa.array([vector(texts[k]).astype(np.float16).tobytes() for k in keep], pa.binary())], ["lang", "x"])

    got = _learning_rows(docs, cap).mapInArrow(vectors, "lang string, x binary").collect()
    if not got:
        return None
    got.sort(key=lambda r: (r["lang"], r["x"]))
    return Hierarchy(np.stack([np.frombuffer(r["x"], np.float16) for r in got]).astype(np.float32),
                     np.array([r["lang"] for r in got]))


def fit_likeness(docs: DataFrame, langs: list[str], cap: int = 1000) -> Likeness:
    """Means from one half of the learning rows of ``fit``, calibrated with the other."""
    rows, half = _learning_rows(docs, cap), F.crc32(F.concat(F.lit("half "), F.col("doc_id").cast("string")).cast("binary")) % 2
    rows = rows.withColumn("half", F.coalesce(half, F.lit(0)))

    def sums(batches):
        total = np.zeros((len(langs), 1 << BITS))
        for batch in slices(batches, 512):
            for lang, text in zip(column_of(batch, "lang").to_pylist(), as_texts(column_of(batch, "text"))):
                if lang in langs and LETTER.search(text):
                    total[langs.index(lang)] += hashed_grams(plain_words(text), ORDERS, BITS)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["x"])

    total = np.zeros((len(langs), 1 << BITS))
    for r in rows.filter("half = 0").select("lang", "text").mapInArrow(sums, "x binary").toLocalIterator():
        total += np.frombuffer(r["x"]).reshape(total.shape)
    like = Likeness(langs, total)

    def values(batches):
        for batch in slices(batches, 512):
            out = []
            for lang, text in zip(column_of(batch, "lang").to_pylist(), as_texts(column_of(batch, "text"))):
                raw = plain_words(text)
                if lang in langs:
                    g = langs.index(lang)
                    out += [(g, n, like.of(piece(raw, n), g)) for n in SIZES if n <= len(raw)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
                                              pa.array([r[2] for r in out], pa.float64())], ["lang", "size", "value"])

    got = rows.filter("half = 1").select("lang", "text").mapInArrow(values, "lang long, size long, value double").collect()
    return like.calibrate(*(np.array([r[c] for r in got]) for c in ("lang", "size", "value")))


def predict(docs: DataFrame, model: Hierarchy | None, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` with ``lang_pred string, score double``."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def score(batches):
        for batch in slices(batches, 512):
            texts = as_texts(column_of(batch, "text"))
            lang, value = [UNKNOWN] * len(texts), np.zeros(len(texts))
            known = [k for k, t in enumerate(texts) if LETTER.search(t)] if model else []
            if known:
                best, sure = model.predict(np.stack([vector(texts[k]) for k in known]))
                for k, b in zip(known, best):
                    lang[k] = model.langs[b]
                value[known] = sure
            yield pa.RecordBatch.from_arrays([*(column_of(batch, c) for c in keep), pa.array(lang, pa.string()),
                                              pa.array(value)], [*keep, "lang_pred", "score"])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(score, f"{kinds}, lang_pred string, score double")


def known_languages(docs: DataFrame, model: Hierarchy | None, like: Likeness | None) -> DataFrame:
    """The rows of ``docs``, all columns, that have a letter and are like the language they are taken for."""
    def keep(batches):
        for batch in slices(batches, 512):
            texts = as_texts(column_of(batch, "text"))
            good = np.zeros(len(texts), bool)
            known = [k for k, t in enumerate(texts) if LETTER.search(t)] if model else []
            if known:
                best = model.predict(np.stack([vector(texts[k]) for k in known]))[0]
                good[known] = [like.enough(texts[k], g) for k, g in zip(known, best.tolist())]
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)


def identify(docs: DataFrame, folds: int = 3, held: int = 1, cap: int = 1000) -> DataFrame:
    """Per row ``doc_id, held_out, lang_pred, score``; learned from the rows outside fold ``held``."""
    docs = docs.select("doc_id", "text", "lang").withColumn("held_out", crc_fold(F.col("doc_id"), folds) == held)
    return predict(docs, fit(docs.filter(~F.col("held_out")), cap), ["doc_id", "held_out"])

"""Benchmark decontamination by a BM25 index of the test items with block-max WAND.

The items are the indexed documents, and every passage of every training text
is a query. Words are runs of letters, marks and digits after compatibility
normalisation, in lower case, so no kind of space, quote or dash tells copies
apart; in scripts without spaces each character is a word. Items are taken by
length class (a power of two that bounds their words); a passage is two
neighbouring cells of that many words, so an item that occurs in a text lies in
a passage whole. A term's weight in an item is its BM25 weight over the
sum of the item's weights: a passage that holds all the item's words scores 1.
Document frequencies, the number of items and their mean length are those of
all items, counted in Spark.

Postings lie in blocks of neighbouring items and carry the largest weight in
the block. The terms of a passage are ordered by their largest weight anywhere;
the weakest ones, which together stay below the threshold, cannot bring an item
up to it alone, so only the blocks of the others are opened. The blocks' maxima and the
weak terms' largest weights are summed, and only where that reaches the threshold the
weak terms' own block maxima take their place (WAND's pivot, applied to blocks); where
it still does, the items of the block are scored. All pairs at or above the threshold are then
verified: the share of the item's five-word shingles that the passage holds,
and the overlap of its question (all but its last sentence) and its answer (the
last sentence) with the passage.

Items are taken in parts of at most ``part_bytes`` of text, one after the other; the
texts are read once for each part. The results are the same for every part size.

Defined results: null or empty texts and items match nothing; an item of fewer
than five words is one shingle. Rows repeated in the input are reported each;
items with the same id and text once. Other columns, whatever their names, play
no part, and ``clean`` hands them on unchanged.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxmesh.llm.common import as_texts, column_of, record, slices
from wxmesh.session import materialise

THRESHOLD, CONTAINMENT, PART_OVERLAP = 0.5, 0.8, 0.5
K1, B, BLOCK, SHINGLE = 1.2, 0.75, 8, 5
PART_BYTES = 8 << 20
#: Latin-1 characters that compatibility normalisation changes; all others it leaves alone.
CHANGED = re.compile("[¨ª¯²-µ¸-º¼-¾]")
#: Latin-1 text in lower case, with a space for what is no letter or digit.
PLAIN = bytes(ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(256))
#: Scripts written without spaces between words.
UNSPACED = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"
TERM = regex.compile(rf"(?V1)[{UNSPACED}]\p{{M}}*|[[\p{{L}}\p{{M}}\p{{N}}]--[{UNSPACED}]]+")
OUT = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("bm25", pa.float64()), ("containment", pa.float64()),
                 ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())])


def words_of(text: str) -> list[bytes]:
    if text.isascii():
        return text.encode().translate(PLAIN).split()
    try:
        if not CHANGED.search(text):
            return text.encode("latin-1").translate(PLAIN).decode("latin-1").encode().split()
    except UnicodeEncodeError:
        pass
    return [w.encode("utf-8", "replace") for w in TERM.findall(unicodedata.normalize("NFKC", text).lower())]


def shingles(words: list[bytes]) -> set[tuple[bytes, ...]]:
    return {tuple(words[k:k + SHINGLE]) for k in range(max(1, len(words) - SHINGLE + 1))} if words else set()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The words before the last sentence or line, and those of it; without one, two thirds and the rest."""
    parts = [w for w in map(words_of, re.split(r"(?<=[.!?:])\s+|\n+", text.strip())) if w]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    at = max(1, 2 * len(words) // 3)
    return words[:at], words[at:]


class Item:
    def __init__(self, item_id: int, text: str):
        self.item_id, self.words = item_id, words_of(text)
        self.shingles = shingles(self.words)
        question, answer = question_and_answer(text)
        self.question, self.answer = set(question), set(answer)

    def overlap(self, passage: list[bytes]) -> tuple[float, float, float]:
        """Containment of the shingles, and of the question's and the answer's words."""
        have, words = shingles(passage), set(passage)
        if len(self.words) < SHINGLE:
            n = len(self.words)
            found = float(any(passage[k:k + n] == self.words for k in range(len(passage) - n + 1)))
        else:
            found = len(self.shingles & have) / len(self.shingles)
        share = lambda part: len(part & words) / len(part) if part else 1.0
        return found, share(self.question), share(self.answer)


class Statistics:
    """What BM25 needs to know of all items: their number, their mean length and how many hold each term."""

    def __init__(self, n: int, mean: float, df: dict[bytes, int]):
        self.n, self.mean, self.df = n, mean, df

    @staticmethod
    def of(items: list[Item]) -> Statistics:
        items = [x for x in items if x.words]
        return Statistics(len(items), sum(len(x.words) for x in items) / max(1, len(items)),
                          Counter(t for x in items for t in set(x.words)))


class Index:
    """Inverted index with block maxima. Postings of a term are in item order, so in block order."""

    def __init__(self, items: list[Item], known: Statistics, longest: int):
        # Items that share rare words lie next to each other, which makes the block maxima tight.
        df, self.longest = known.df, longest
        self.items = sorted((x for x in items if x.words),
                            key=lambda x: (sorted(x.words, key=lambda t: (-df[t], t))[0], len(x.words), x.item_id))
        n = len(self.items)
        self.term = {t: k for k, t in enumerate(sorted({t for x in self.items for t in x.words}))}
        rows = []
        for at, item in enumerate(self.items):
            weight = {}
            for t, tf in Counter(item.words).items():
                idf = np.log(1 + (known.n - df[t] + 0.5) / (df[t] + 0.5))
                weight[t] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(item.words) / known.mean))
            total = sum(weight.values())
            rows += [(self.term[t], at, w / total) for t, w in weight.items()]
        rows.sort()
        table = np.array(rows, np.float64).reshape(-1, 3)
        term, self.item, self.weight = table[:, 0].astype(np.int64), table[:, 1].astype(np.int64), table[:, 2]
        self.blocks = -(-max(1, n) // BLOCK)
        key = term * self.blocks + self.item // BLOCK
        first = np.flatnonzero(np.diff(key, prepend=-1))
        self.block, self.at = self.item[first] // BLOCK, np.append(first, len(key))
        self.most = np.maximum.reduceat(self.weight, first) if len(first) else self.weight
        #: Block postings of term t are own[t] to own[t + 1]; no item gives it more than top[t].
        self.own = np.searchsorted(term[first], np.arange(len(self.term) + 1))
        self.top = np.maximum.reduceat(self.most, self.own[:-1]) if len(self.term) else self.most

    def search(self, passage: np.ndarray, term: np.ndarray, n: int, threshold: float):
        """``(passage, item, score)`` of all pairs that reach the threshold; the (passage, term) pairs are distinct and in order of passages."""
        got, least = [], threshold - 1e-9
        step = max(1, (2 << 20) // self.blocks)
        bounds = np.searchsorted(passage, np.arange(0, n + step, step))
        for k, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
            p, t = passage[lo:hi] - k * step, term[lo:hi]
            if not len(p):
                continue
            order = np.lexsort((self.top[t], p))  # weakest terms of each passage first
            p, t = p[order], t[order]
            top = self.top[t]
            total = np.cumsum(top)
            begin = np.searchsorted(p, p)
            weak = total - (total[begin] - top[begin]) < least
            rest = np.bincount(p[weak], top[weak], minlength=int(p[-1]) + 1)
            of, entry = _expand(self.own[t[~weak]], self.own[t[~weak] + 1])
            pair = p[~weak][of] * self.blocks + self.block[entry]
            opened, back = np.unique(pair, return_inverse=True)
            bound = np.bincount(back, self.most[entry], minlength=len(opened))
            kept = bound + rest[opened // self.blocks] >= least
            opened, bound = opened[kept], bound[kept]
            if not len(opened):
                continue
            passed = np.zeros(len(rest), bool)
            passed[opened // self.blocks] = True
            weak &= passed[p]
            of, more = _expand(self.own[t[weak]], self.own[t[weak] + 1])
            weak_pair = p[weak][of] * self.blocks + self.block[more]
            at = np.minimum(np.searchsorted(opened, weak_pair), len(opened) - 1)
            same = opened[at] == weak_pair
            bound += np.bincount(at[same], self.most[more[same]], minlength=len(opened))
            opened = opened[bound >= least]
            if not len(opened):
                continue
            pair, entry = np.concatenate((pair, weak_pair[same])), np.concatenate((entry, more[same]))
            at = np.minimum(np.searchsorted(opened, pair), len(opened) - 1)
            same = opened[at] == pair
            pair, entry = pair[same], entry[same]
            of, posting = _expand(self.at[entry], self.at[entry + 1])
            row = pair[of] // self.blocks * len(self.items) + self.item[posting]
            hits, back = np.unique(row, return_inverse=True)
            score = np.bincount(back, self.weight[posting])
            keep = score >= least
            got.append((hits[keep] // len(self.items) + k * step, hits[keep] % len(self.items), score[keep]))
        return [np.concatenate(x) for x in zip(*got)] if got else [np.zeros(0, np.int64)] * 3


def _expand(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges ``lo[k]:hi[k]`` in a row, and the k of each."""
    size = hi - lo
    of = np.repeat(np.arange(len(size)), size)
    return of, np.arange(len(of)) + np.repeat(lo - (np.cumsum(size) - size), size)


def cells_of(words: int) -> int:
    """Words of a cell for items of so many words: the power of two that bounds them."""
    return 1 << max(0, words - 1).bit_length()


class Part:
    """Some of the items, with an index for each length class, so that a long item makes no other item's passages longer."""

    def __init__(self, items: list[Item], known: Statistics):
        classes = defaultdict(list)
        for item in items:
            if item.words:
                classes[cells_of(len(item.words))].append(item)
        self.indexes = [Index(own, known, size) for size, own in sorted(classes.items())]
        self.term = {t: k for k, t in enumerate(sorted({t for index in self.indexes for t in index.term}))}
        #: The number of each term in each index; -1 where it has none.
        self.local = [np.fromiter((index.term.get(t, -1) for t in self.term), np.int64, len(self.term)) for index in self.indexes]


def matches(texts: list[str], part: Part, threshold: float, containment: float):
    """``(position in texts, Item, score, overlaps)`` of the verified pairs, each once."""
    docs, get = [words_of(t) for t in texts], part.term.get
    lengths = np.array([len(w) for w in docs], np.int64)
    term = np.fromiter((get(w, -1) for d in docs for w in d), np.int64, int(lengths.sum()))
    known = term >= 0
    doc_of = np.repeat(np.arange(len(docs)), lengths)
    place = (np.arange(len(term)) - np.repeat(np.cumsum(lengths) - lengths, lengths))[known]
    term, doc_of = term[known], doc_of[known]
    out = []
    for index, local in zip(part.indexes, part.local):
        size, own = index.longest, local[term]
        held = own >= 0
        own, doc, cells = own[held], doc_of[held], np.maximum(1, -(-lengths // size))
        first_cell = np.cumsum(cells) - cells
        cell = first_cell[doc] + place[held] // size
        # Passage c is cells c and c + 1 of one text.
        back = cell > first_cell[doc]
        key = np.unique(np.concatenate((cell, cell[back] - 1)) * len(index.term) + np.concatenate((own, own[back])))
        hit, item, score = index.search(key // len(index.term), key % len(index.term), int(cells.sum()), threshold)
        best = {}
        for p, k, s in zip(hit.tolist(), item.tolist(), score.tolist()):
            d = int(np.searchsorted(first_cell, p, side="right")) - 1
            at = (p - int(first_cell[d])) * size
            found = index.items[k].overlap(docs[d][at:at + 2 * size])
            if found[0] >= containment and min(found[1:]) >= PART_OVERLAP:
                best[d, k] = max(best.get((d, k), (0.0,)), (s, *found))
        out += [(d, index.items[k], *values) for (d, k), values in best.items()]
    return sorted(out, key=lambda row: row[0])


def indexes(items: DataFrame, part_bytes: int = PART_BYTES) -> Iterator[Part]:
    """The indexes of one part of the items after the other; a part is bounded, so it can be broadcast.

    BM25's statistics are counted over all items; of the document frequencies a part gets those of its own terms.
    """
    items = items.select("item_id", "text").filter("text is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-total // part_bytes)
    if not parts:
        return

    def terms(batches):
        schema = pa.schema([("part", pa.int64()), ("term", pa.binary()), ("size", pa.int64())])
        for batch in slices(batches, 256):
            rows = [(p, t, len(words)) for p, text in zip(column_of(batch, "part").to_pylist(), as_texts(column_of(batch, "text")))
                    for words in [words_of(text)] for t in {*words, None} if words]  # null: the item itself
            if rows:
                yield record(schema, *zip(*rows))

    items = items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
    counted = materialise(items.mapInArrow(terms, "part long, term binary, size long").groupBy("part", "term")
                          .agg(F.count("*").alias("n"), F.sum("size").alias("size")), "item-terms")
    whole = counted.filter("term is null").agg(F.sum("n"), F.sum("size")).first()
    if not whole[0]:
        return
    df = counted.filter("term is not null").groupBy("term").agg(F.sum("n").alias("df"))
    for k in range(parts):
        rows = items.filter(F.col("part") == k).select("item_id", "text").collect()
        own = counted.filter((F.col("part") == k) & F.col("term").isNotNull()).select("term").join(df, "term").collect()
        known = Statistics(whole[0], whole[1] / whole[0], {bytes(r["term"]): r["df"] for r in own})
        yield Part([Item(r["item_id"], r["text"]) for r in rows], known)


def _over_parts(docs: DataFrame, items: DataFrame, part_bytes: int, task: Callable[[object], DataFrame]) -> list[DataFrame]:
    """``task(broadcast index)`` for each part; with several, each result is written before the next index is built."""
    done: list[DataFrame] = []
    waiting = None
    for index in indexes(items, part_bytes):
        if waiting is not None:
            done.append(materialise(task(waiting), "part"))
            waiting.unpersist()
        waiting = docs.sparkSession.sparkContext.broadcast(index)
    return done + [task(waiting)] if waiting is not None else done


def contamination(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, containment: float = CONTAINMENT,
                  part_bytes: int = PART_BYTES) -> DataFrame:
    """Verified pairs: ``doc_id, item_id, bm25, containment, question_overlap, answer_overlap``."""
    ddl = "doc_id long, item_id long, bm25 double, containment double, question_overlap double, answer_overlap double"

    def task(shared) -> DataFrame:
        def rows(batches):
            for batch in slices(batches, 128):
                ids = column_of(batch, "doc_id").to_pylist()
                found = matches(as_texts(column_of(batch, "text")), shared.value, threshold, containment)
                if found:
                    yield record(OUT, *zip(*((ids[d], item.item_id, *values) for d, item, *values in found)))

        return docs.select("doc_id", "text").mapInArrow(rows, ddl)

    found = _over_parts(docs, items, part_bytes, task)
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], ddl)


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, containment: float = CONTAINMENT,
          part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item."""
    left = docs
    for k, index in enumerate(indexes(items, part_bytes)):
        if k:
            left = materialise(left, "left")
            shared.unpersist()
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def rows(batches, shared=shared):
            for batch in slices(batches, 128):
                hit = {d for d, *_ in matches(as_texts(column_of(batch, "text")), shared.value, threshold, containment)}
                yield batch.filter(pa.array([k not in hit for k in range(batch.num_rows)], pa.bool_()))

        left = left.mapInArrow(rows, docs.schema)
    return left

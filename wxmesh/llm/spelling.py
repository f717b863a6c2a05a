"""Spelling variants: words one edit apart, found over variable-length grams.

1. Words are counted in tasks and added up; rare ones go.
2. Gram dictionary: all substrings of up to half a word are counted. A gram is
   extended only while more than ``frequent`` words' places hold it, so the
   dictionary is frequency-pruned: rare grams have no longer ones.
3. A word is decomposed into variable grams: at each place the shortest gram that
   is not frequent (or the longest allowed), unless an earlier gram covers it.
4. Affected grams: a gram stays as it is, and stays in the decomposition, after an
   edit right of it, or after an edit that ends at least the longest gram's length
   before its end. For each word the largest number of grams that one edit can affect
   is counted over all its places. So one of the rarest (that number + 1) grams is in
   both words, at the same place or one further on; with grams of at most half the
   longer word there is always one left, so no pair needs another way.
5. The lists of these grams are merged: an equi-join on word length, gram and place,
   in which each meeting is verified as one code point inserted, deleted or replaced.

Words of n code points meet words of n and of n + 1. For the first both sides are decomposed
with grams of up to n // 2, for the second with grams of up to (n + 1) // 2.

Defined results: null texts hold no words; a null id stands as empty text in the hash of the
planted slips; repeated rows count each; very long words are words like others (grams have at
most ``LONGEST`` code points); ties go to the word that is smaller in code-point order; other
columns, whatever their names, play no part; an empty table gives an empty one.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxmesh.llm.common import as_texts, column_of, record, slices
from wxmesh.session import materialise

#: Letters of words (fixed value).
LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH, MIN_COUNT, SLIP, TIMES = 6, 5, 199, 5
#: Grams that more places hold are extended.
FREQUENT = 100
LONGEST = 8
#: Words that a task counts before it hands them on.
HELD = 400_000
#: Places of grams in one batch, or those of one word.
PLACED = 100_000
COUNTED = pa.schema([("word", pa.string()), ("n", pa.int64())])
PLACES = pa.schema([("id", pa.int64()), ("gram", pa.string()), ("place", pa.int32())])
LISTED = pa.schema([("length", pa.int32()), ("gram", pa.string()), ("place", pa.int32()), ("word", pa.string()),
                    ("n", pa.int64()), ("shorter", pa.bool_())])


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, slip: int = SLIP) -> DataFrame:
    """``word, n`` over whole texts. One in ``slip`` (document, word) pairs, by hash, loses a letter (0: none does)."""
    run = re.compile(f"[{LETTERS}]{{{min_length},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in slices(batches, 256):
            for doc, text in zip(column_of(batch, "doc_id").to_pylist(), as_texts(column_of(batch, "text"))):
                seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                lower = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z only
                for word, n in Counter(run.findall(lower)).items():
                    if slip:
                        h = zlib.crc32(word.encode(), seed)
                        if h % slip == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < min_length:
                                continue
                    held[word] += n
            if len(held) >= HELD:
                yield record(COUNTED, list(held), list(held.values()))
                held.clear()
        yield record(COUNTED, list(held), list(held.values()))

    return docs.select("doc_id", "text").mapInArrow(count, "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def shuffled(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join by shuffling and sorting both sides, whatever Spark takes their sizes for.

    Spark takes grams for as many as the words that they are cut from, and a table for the size of its compressed
    files: either way it would broadcast what is a hundred times larger in the driver's memory.
    """
    return left.hint("merge").join(right.hint("merge"), on, how)


def longest(length: int) -> int:
    """Code points of a gram at most, where the longer word has ``length``."""
    return min(LONGEST, length // 2)


def numbered(words: DataFrame) -> DataFrame:
    """``(word, n)`` with a number, so that places of grams need not repeat long words; written, so the number stays."""
    return materialise(words.select("word", "n").withColumn("id", F.monotonically_increasing_id()), "words")


def grams_of(words: DataFrame, shortest: int) -> DataFrame:
    """Every place of every gram of each word: ``id, gram, place``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ([], [], [])
        for batch in batches:
            for number, word in zip(column_of(batch, "id").to_pylist(), column_of(batch, "word").to_pylist()):
                n = len(word)
                for size in range(shortest, min(n, longest(n + 1)) + 1):
                    rows[0].extend([number] * (n - size + 1))
                    rows[1].extend([word[at:at + size] for at in range(n - size + 1)])
                    rows[2].extend(range(n - size + 1))
                if len(rows[0]) >= PLACED:
                    yield record(PLACES, *rows)
                    rows = ([], [], [])
        yield record(PLACES, *rows)

    return words.select("id", "word").mapInArrow(cut, "id long, gram string, place int")


def dictionary(words: DataFrame, shortest: int) -> DataFrame:
    """``gram, n``: how many places hold each gram; counted in tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in slices(batches, 2048):
            for word in column_of(batch, "word").to_pylist():
                n = len(word)
                for size in range(shortest, longest(n + 1) + 1):
                    held.update([word[at:at + size] for at in range(n - size + 1)])
            if len(held) >= HELD:
                yield record(COUNTED, list(held), list(held.values()))
                held.clear()
        yield record(COUNTED, list(held), list(held.values()))

    return words.select("word").mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def decompose(word: str, n_of: dict[tuple[int, int], int], shortest: int, top: int, frequent: int) -> list[tuple[int, int, bool]]:
    """Variable grams as ``(begin, end, open)``; ``open``: only the end of the word stopped it.

    ``n_of`` has the number of places of the gram at (place, size).
    """
    out, covered = [], 0
    for at in range(len(word) - shortest + 1):
        size = shortest
        while size < top and n_of[at, size] > frequent:
            if at + size == len(word):
                break
            size += 1
        if at + size > covered:
            covered = at + size
            out.append((at, covered, covered == len(word) and size < top and n_of[at, size] > frequent))
    return out


def affected(grams: list[tuple[int, int, bool]], length: int, top: int, replaced: int) -> int:
    """The most grams that one edit can affect: ``replaced`` is 1 if it takes a code point away, 0 if it only inserts one.

    An edit at ``i`` affects a gram that ends after ``i``, unless it begins at or after ``i + replaced``
    and ends ``top`` or more beyond that; what is inserted at the end also affects a gram that the end had stopped.
    """
    steps = [0] * (length + 2)
    for begin, end, is_open in grams:
        first = max(0, end - replaced - top + 1)
        last = length - replaced if is_open and not replaced else min(end - 1, length - replaced)
        steps[first] += 1
        steps[last + 1] -= 1
    most = running = 0
    for step in steps:
        running += step
        most = max(most, running)
    return most


def rarest(word: str, n_of: dict[tuple[int, int], int], shortest: int, top: int, frequent: int, replaced: int) -> list[tuple[str, int]]:
    """The grams of a word whose lists must be merged, with their places.

    Equal grams rank by place: what two words share keeps its order, so the first gram shared is in both selections.
    """
    grams = decompose(word, n_of, shortest, top, frequent)
    bound = affected(grams, len(word), top, replaced)
    ranked = sorted((n_of[begin, end - begin], word[begin:end], begin) for begin, end, _ in grams)
    return [(gram, begin) for _, gram, begin in ranked[:bound + 1]]  # there is one beyond the affected ones, see above


def lists(words: DataFrame, shortest: int, frequent: int) -> DataFrame:
    """List entries: a word under the length of the longer word of a pair, a gram and its place there."""
    places = shuffled(grams_of(words, shortest), dictionary(words, shortest), "gram") \
        .select("id", F.struct("place", F.char_length("gram").alias("size"), F.col("n").alias("n")).alias("_gram"))
    known = shuffled(places.groupBy("id").agg(F.collect_list("_gram").alias("grams")), words, "id")

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            rows = []
            column = column_of(batch, "grams")
            ends = column.offsets.to_numpy() - column.offsets[0].as_py()
            held = column.flatten()
            place, size, n = (held.field(k).to_pylist() for k in range(3))
            for k, (word, count) in enumerate(zip(column_of(batch, "word").to_pylist(), column_of(batch, "n").to_pylist())):
                lo, hi = int(ends[k]), int(ends[k + 1])
                n_of = dict(zip(zip(place[lo:hi], size[lo:hi]), n[lo:hi]))
                length = len(word)
                for gram, at in rarest(word, n_of, shortest, longest(length), frequent, 1):
                    rows.append((length, gram, at, word, count, False))
                for gram, at in rarest(word, n_of, shortest, longest(length + 1), frequent, 0):
                    rows.append((length + 1, gram, at, word, count, True))
                    rows.append((length + 1, gram, at + 1, word, count, True))
            if rows:
                yield record(LISTED, *zip(*rows))

    return known.mapInArrow(entries, "length int, gram string, place int, word string, n long, shorter boolean")


def near_pairs(words: DataFrame, min_length: int = MIN_LENGTH, frequent: int = FREQUENT) -> DataFrame:
    """Pairs of different words one edit apart, once each: ``a, n_a, b, n_b``.

    ``words`` are ``(id, word, n)``, each word once, with at least ``min_length`` code points.
    """
    listed = materialise(lists(words, max(1, min(3, min_length // 2)), frequent), "gram-lists")
    one = listed.select("length", "gram", "place", F.col("word").alias("a"), F.col("n").alias("n_a"), "shorter")
    two = listed.filter("not shorter").select(F.col("length").alias("length_b"), F.col("gram").alias("gram_b"),
                                              F.col("place").alias("place_b"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    met = shuffled(one, two, (F.col("length") == F.col("length_b")) & (F.col("gram") == F.col("gram_b"))
                   & (F.col("place") == F.col("place_b")) & (F.col("shorter") | (F.col("a") < F.col("b")))
                   & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "n_a", "b", "n_b").distinct()


def group(words: DataFrame, min_length: int = MIN_LENGTH, times: int = TIMES, frequent: int = FREQUENT) -> DataFrame:
    """Per word of ``(word, n)``: ``word, form, root, n, n_near, form_n``."""
    words = numbered(words)
    pairs = near_pairs(words, min_length, frequent)
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("near")).alias("other")),
        F.struct(F.col("b").alias("word"), F.struct((-F.col("n_a")).alias("less"), F.col("a").alias("near")).alias("other"))))
        .alias("_side")).select("_side.*")
    best = sides.groupBy("word").agg(F.min("other").alias("_best"), F.count("*").alias("n_near"))
    is_form = -F.col("_best.less") >= times * F.col("n")
    told = materialise(shuffled(words, best, "word", "left").select(
        "word", F.when(is_form, F.col("_best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, -F.col("_best.less")).alias("form_n")), "forms")
    up = told.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:  # each round doubles the steps; counts grow ``times``-fold a step, so few rounds are needed
        beyond = up.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        up = materialise(shuffled(up, beyond, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        if up.filter("moved").isEmpty():
            break
        up = up.select("word", "root")
    return shuffled(told, up.select("word", "root"), "word", "left") \
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

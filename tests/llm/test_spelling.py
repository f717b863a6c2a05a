import random
import re
import zlib
from collections import Counter

import pytest

from llm_helpers import awkward, documents, empty
from wxmesh.llm import spelling


def edits(word, letters):
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    return ({a + b[1:] for a, b in cuts if b} | {a + c + b[1:] for a, b in cuts if b for c in letters}
            | {a + c + b for a, b in cuts for c in letters}) - {word}


def grouped(words, times=5):
    letters, out = set("".join(words)), {}
    for w, n in words.items():
        near = sorted((e for e in edits(w, letters) if e in words), key=lambda e: (-words[e], e))
        form = near[0] if near and words[near[0]] >= times * n else None
        out[w] = [form, w, n, len(near), words[form] if form else None]
    for w in out:
        while out[out[w][1]][0]:
            out[w][1] = out[out[w][1]][0]
    return {w: tuple(v) for w, v in out.items()}


def counted(rows):
    words = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            words[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    return {w: n for w, n in words.items() if len(w) >= 6 and n >= 5}


def collected(frame):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in frame.collect()}


@pytest.mark.parametrize("seed,letters,frequent", [(1, "ab", 3), (2, "abé", 0), (3, "abcdefÿ", 20), (4, "a", 1)])
def test_every_near_pair_is_found(spark, seed, letters, frequent):
    """Few letters make repeated grams, frequent grams and many neighbours; every edit of some words is there too."""
    rng, words = random.Random(seed), {}
    for _ in range(500):
        w = "".join(rng.choice(letters) for _ in range(rng.randrange(6, 20)))
        words[w] = rng.choice([5, 6, 25, 130, 700])
    for w in rng.sample(sorted(words), min(12, len(words))):
        words |= {e: rng.choice([5, 30]) for e in edits(w, letters) if len(e) >= 6}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert collected(spelling.group(frame, frequent=frequent)) == grouped(words)


def test_bound_leaves_a_gram_for_every_word():
    for seed in range(3000):
        rng = random.Random(seed)
        word = "".join(rng.choice("abc") for _ in range(rng.randrange(6, 24)))
        n_of = {(at, size): rng.choice([1, 500]) for size in range(3, 9) for at in range(len(word) - size + 1)}
        for top, replaced in ((spelling.longest(len(word)), 1), (spelling.longest(len(word) + 1), 0)):
            grams = spelling.decompose(word, n_of, 3, top, 100)
            assert spelling.affected(grams, len(word), top, replaced) < len(grams)


def test_words_and_slips_of_texts(spark):
    rng = random.Random(5)
    stems = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(4, 9))) for _ in range(40)]
    rows = [(k, " ".join(rng.choice(stems).upper() if rng.random() < 0.3 else rng.choice(stems) for _ in range(60)) + "Ünïted×÷x1long_worded")
            for k in range(300)] + [(None, None), (7, ""), (None, "nothing " * 6), (8, "endless" * 3000 + " " + "endless" * 3000)]
    words = counted(rows)
    got = collected(spelling.group(spelling.vocabulary(documents(spark, rows, extra=True))))
    assert got == grouped(words) and len(got) > 30


def test_very_long_words(spark):
    long = "".join(random.Random(6).choice("abcdefgh") for _ in range(20_000))
    words = {long: 500, long[:9000] + long[9001:]: 100, long + "x": 20, "a" * 15_000: 9, "a" * 15_001: 50, "shorter": 5}
    got = collected(spelling.group(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert {w: v[3] for w, v in got.items()} == dict(zip(words, [2, 1, 1, 1, 1, 0]))
    assert got["a" * 15_000][:2] == ("a" * 15_001,) * 2 and got[long + "x"][1] == long


def test_no_join_is_broadcast(spark):
    """Grams and forms look small to Spark, cut from few words or read from compressed files; the driver must hold none."""
    words = spelling.numbered(spark.createDataFrame([("kitten", 50), ("kittens", 9), ("mitten", 5)], "word string, n long"))
    frames = [spelling.lists(words, 3, 100), spelling.near_pairs(words), spelling.group(words.select("word", "n"))]
    for frame in frames:
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_awkward_and_empty(spark):
    docs = awkward(spark)
    assert collected(spelling.group(spelling.vocabulary(docs, min_count=1))) is not None
    assert spelling.group(spelling.vocabulary(empty(spark))).count() == 0

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_helpers import awkward, documents, empty
from wxmesh.llm import best_fit

JSON = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return t


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def check(pieces, rows, tokenizer, capacity):
    """Every id in one piece, only long documents cut, windows without gaps, and not more than the area asks for."""
    whole, windows = defaultdict(list), defaultdict(list)
    for p in pieces:
        whole[p["doc_id"]].append((p["piece"], p["start"], p["length"], p["ids_crc32"]))
        windows[p["sequence_id"]].append((p["offset"], p["length"]))
    want = defaultdict(list)
    for doc, text in rows:
        ids = ids_of(tokenizer, text)
        want[doc] += [(k, at, len(ids[at:at + capacity]), zlib.crc32(ids[at:at + capacity].tobytes()))
                      for k, at in enumerate(range(0, len(ids), capacity))]
    assert {d: sorted(v) for d, v in whole.items()} == {d: sorted(v) for d, v in want.items()}
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(windows)


def test_whole_documents_and_few_windows(spark, tokenizer):
    words = ["alpha", "beta", "Gamma's", "12 345", "\n\n", "été", "中文", "İstanbul", "ΟΔΟΣ", "don't!!", "\u0085", "²½"]
    rng = np.random.default_rng(3)
    rows = [(k, " ".join(rng.choice(words, int(n)))) for k, n in enumerate(rng.integers(0, 600, 150))]
    rows.append((150, "word " * 3000))
    pieces = best_fit.pack(documents(spark, rows), JSON, 512).collect()
    total = sum(len(ids_of(tokenizer, t)) for _, t in rows)
    assert check(pieces, rows, tokenizer, 512) <= 1.05 * total / 512 + 1


def test_awkward_and_empty(spark, tokenizer):
    docs = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check(best_fit.pack(docs, JSON).collect(), rows, tokenizer, 4096)
    assert best_fit.pack(empty(spark), JSON).count() == 0


def test_remembered_words_are_the_librarys(tokenizer, monkeypatch):
    monkeypatch.setattr(best_fit, "REMEMBERED", 3)
    encode = best_fit.encoder(JSON)
    for text in ["", "Hello world's  END\n\n\n x", "é́ İstanbul ẞ กำ \U0001F468‍\U0001F469", "<|endoftext|> <|startoftext|>", "'SD''ll's",
                 "a b c　d\x0b\x0c\x1c\x85e", "१२ ²½ Ⅷ", " " * 50 + "x" * 300, "ÀÉ×÷ªº¼¾µ­-", "Жук ёлка ЁЖ", "ひらがなカタカナ漢字한글"]:
        assert encode(text) == ids_of(tokenizer, text)[:-1].tobytes(), text


def one_by_one(lengths, capacities, weights):
    """Each piece, longest first, to the window with the smallest norm of what is left; the earliest of equal ones."""
    bins = []
    weights = [w / c ** 2 for w, c in zip(weights, capacities)]
    for n in sorted(lengths, reverse=True):
        item = (n, 1, n * n)
        best = None
        for k, left in enumerate(bins):
            after = [a - b for a, b in zip(left, item)]
            if min(after) >= 0:
                norm = sum(w * a * a for w, a in zip(weights, after))
                if best is None or norm < best[0] - 1e-15:
                    best = (norm, k, after)
        if best is None:
            bins.append([a - b for a, b in zip(capacities, item)])
        else:
            bins[best[1]] = best[2]
    return sorted(map(tuple, bins))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=60), st.sampled_from([(16, 16, 256), (16, 3, 256), (16, 16, 300), (16, 5, 260)]),
       st.sampled_from([(1, 0, 0), (1, 0.5, 0.25)]))
def test_plan_is_the_item_by_item_choice(lengths, capacities, weights):
    counts = np.bincount(lengths, minlength=17).astype(np.int64) if lengths else np.zeros(17, np.int64)
    plan, held = best_fit.BestFit(counts, capacities, weights), defaultdict(list)
    for length in range(1, 17):
        for number in range(int(counts[length])):
            window, offset = (int(x[0]) for x in plan.place(np.array([length]), np.array([number])))
            held[window].append((offset, length))
    assert set(held) == set(range(plan.windows))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
    left = sorted((capacities[0] - sum(n for _, n in v), capacities[1] - len(v), capacities[2] - sum(n * n for _, n in v))
                  for v in held.values())
    assert all(min(r) >= 0 for r in left)
    assert left == one_by_one(lengths, capacities, weights)


def test_every_capacity_binds():
    counts = np.zeros(101, np.int64)
    counts[1], counts[50] = 1000, 10
    assert best_fit.plan(counts, 100).windows == 15
    assert best_fit.plan(counts, 100, max_documents=10).windows >= 101
    assert best_fit.plan(counts, 100, max_cost=2600).windows >= 10
    with pytest.raises(ValueError):
        best_fit.plan(counts, 100, max_cost=2000)

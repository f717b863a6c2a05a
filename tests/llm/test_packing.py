import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_helpers import awkward, documents, empty
from wxmesh.llm import packing

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return t


def check(pieces, docs, tokenizer, capacity=2048):
    """Every id lies in one piece with the right checksum; sequences have no gaps and no padding."""
    want = sorted(zlib.crc32(np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes())
                  for _, t in docs)
    whole = defaultdict(list)
    for p in pieces:
        whole[p["doc_id"]].append(p)
    assert sum(p["length"] for p in pieces) == sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in docs)
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    assert set(by_sequence) == set(range(len(by_sequence)))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity and at & (at - 1) == 0
    return want


def test_every_id_once_and_no_padding(spark, tokenizer):
    words = ["alpha", "beta", "Gamma's", "12 345", "\n\n", "été", "中文"]
    rng = np.random.default_rng(3)
    rows = [(k, " ".join(rng.choice(words, int(n)))) for k, n in enumerate(rng.integers(0, 3000, 120))]
    pieces = packing.pack(documents(spark, rows), JSON, RANKS).collect()
    check(pieces, rows, tokenizer)
    for doc, text in rows:
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [1], "<u4")
        own = sorted((p for p in pieces if p["doc_id"] == doc), key=lambda p: p["start"])
        at = 0
        for p in own:
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)


def test_awkward_and_empty(spark, tokenizer):
    docs = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    pieces = packing.pack(docs, JSON, RANKS).collect()
    check(pieces, rows, tokenizer)
    assert sum(p["doc_id"] == 4 for p in pieces) >= 2  # repeated rows are packed each
    assert packing.pack(empty(spark), JSON, RANKS).count() == 0


def test_fast_ids_are_the_librarys(tokenizer):
    encode = packing.encoder(JSON, RANKS)
    for text in ["", "Hello world's  end\n\n\n x", "é́ İstanbul ẞ กำ \U0001F468‍\U0001F469", "<|endoftext|>",
                 "a b c　d\x0b\x0c\x1c\x85e", "१२ ²½ Ⅷ", " " * 50 + "x" * 300]:
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 4), max_size=6), st.integers(1, 30))
def test_best_fill_is_the_closest(multiset, room):
    counts = np.zeros(40, np.int64)
    for length, n in multiset.items():
        counts[length] = n
    sums = {0}
    for length, n in multiset.items():
        sums = {s + length * k for s in sums for k in range(n + 1)}
    got = packing.best_fill(counts, room)
    assert all(k <= counts[length] for length, k in got.items())
    assert sum(length * k for length, k in got.items()) == max(s for s in sums if s <= room)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=60))
def test_plan_places_every_piece(lengths):
    counts = np.bincount(lengths, minlength=17).astype(np.int64) if lengths else np.zeros(17, np.int64)
    plan, spans = packing.Plan(counts, 16), []
    for length in range(1, 17):
        for number in range(int(counts[length])):
            window, offset = (int(x[0]) for x in plan.place(np.array([length]), np.array([number])))
            if window >= 0:
                spans.append((window, offset, length))
            else:
                over = number - int(plan.used[length])
                spans += [(w, o, n) for _, n, w, o in plan.stream_cuts(int(plan.stream_at[length]) + over * length, length)]
    ends = defaultdict(int)
    for window, offset, length in sorted(spans):
        assert offset == ends[window]
        ends[window] += length
    assert sum(ends.values()) == sum(lengths) and set(ends) == set(range(len(ends)))
    assert all(n <= 16 and n & (n - 1) == 0 for n in ends.values())

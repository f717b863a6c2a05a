import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_helpers import awkward, documents, empty, fold
from wxmesh.llm import katz


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["</s>"]


class Brute:
    """The model in dictionaries: counts of every n-gram by its history, evaluated by recursion."""

    def __init__(self, texts, order):
        self.uni, self.order = Counter(), order
        self.after = {k: defaultdict(Counter) for k in range(2, order + 1)}
        for t in texts:
            w = tokens(t)
            self.uni.update(w)
            for h, x in self.places(w):
                for k in self.after:
                    self.after[k][h[len(h) - k + 1:]][x] += 1
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        count = lambda values: katz.counts_of_counts(np.array(list(values), np.int64))
        self.unigram = katz.Unigram(self.n, self.v, count(self.uni.values()))
        self.d = {k: katz.discounts(count(c for x in t.values() for c in x.values())) for k, t in self.after.items()}

    def places(self, w):
        padded = ["<s>"] * (self.order - 1) + w
        return [(tuple(padded[i:i + self.order - 1]), x) for i, x in enumerate(w)]

    def p(self, h, w):
        if not h:
            return float(self.unigram.p(np.array([self.uni.get(w, 0)]))[0])
        k = len(h) + 1
        seen = self.after[k].get(h)
        if not seen:
            return self.p(h[1:], w)
        total = sum(seen.values())
        full = min(seen.values()) > katz.CUTOFF
        if w in seen:
            return self.d[k][min(seen[w], katz.CUTOFF + 1)] * seen[w] / total * (total / (total + 1) if full else 1)
        left = 1 / (total + 1) if full else (total - sum(self.d[k][min(c, katz.CUTOFF + 1)] * c for c in seen.values())) / total
        return left / (1 - sum(self.p(h[1:], x) for x in seen)) * self.p(h[1:], w)

    def score(self, text):
        return sum(math.log10(self.p(h, x)) for h, x in self.places(tokens(text)))


def corpus(n=300):
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(400)]
    weights = [1 / (k + 1) for k in range(400)]
    rows = [(k, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(60)))) for k in range(n)]
    rows += [(n + k, "always the same words here") for k in range(12)]
    return rows


@pytest.mark.parametrize("order, batch_bytes", [(1, 400), (2, 400), (3, 1 << 20), (3, 400), (4, 400)])
def test_against_brute_force(spark, monkeypatch, order, batch_bytes):
    monkeypatch.setattr(katz, "BATCH_BYTES", batch_bytes)
    rows = corpus()
    got = {r["doc_id"]: r for r in katz.score(documents(spark, rows), order=order).collect()}
    model = Brute((t for i, t in rows if fold(i, 7) != 2), order)
    for k, table in model.after.items():
        for h in [*list(table)[:12], ("<s>",) * (k - 1), ("always", "the", "same")[:k - 1]]:
            everything = sum(model.p(h, w) for w in model.uni) + model.p(h, "never seen")
            assert abs(everything - 1) < 1e-9, h
    for i, t in rows:
        w, r = tokens(t), got[i]
        assert r["held_out"] == (fold(i, 7) == 2) and r["n_tokens"] == len(w) and r["train_tokens"] == model.n
        assert r["n_known"] == sum(x in model.uni for x in w)
        base = sum(math.log10((model.uni.get(x, 0) + 1) / (model.n + model.v + 1)) for x in w)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and math.isclose(r["score"], model.score(t), rel_tol=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_hot_histories_change_nothing(spark, monkeypatch, order):
    """Every second word hot, and half of the longer histories; shards of one and of more groups."""
    rows = corpus(80)
    docs = documents(spark, rows)
    monkeypatch.setattr(katz, "BATCH_BYTES", 900)
    plain = lambda: {r["doc_id"]: r["score"] for r in katz.score(docs, order=order).collect()}
    monkeypatch.setattr(katz, "hot_histories", lambda docs, shards, width: katz.Hot())
    model = Brute((t for i, t in rows if fold(i, 7) != 2), order)
    want = {i: model.score(t) for i, t in rows}
    assert all(math.isclose(s, want[i], rel_tol=1e-9) for i, s in plain().items())
    found = {}
    _, *before = katz.contexts(*katz.hashes_of([t.encode() for _, t in rows]), max(order, 2), katz.BEGIN)
    for k, codes in enumerate(katz.histories(before), 1):
        found.update({c: k for c in codes[codes % np.uint64(2) == 0].tolist() + [int(katz.BEGIN)] * (k == 1)})
    monkeypatch.setattr(katz, "hot_histories", lambda docs, shards, width: katz.Hot(list(found), list(found.values())))
    monkeypatch.setattr(katz, "GROUP_BYTES", 1000)
    assert all(math.isclose(s, want[i], rel_tol=1e-9) for i, s in plain().items())


def test_one_text_a_third_of_all_rows(spark):
    """Real hot histories: copies of one text, one word over and over, found by the sample."""
    rows = corpus(60) + [(1000 + k, "same " * 40) for k in range(120)]
    docs = documents(spark, rows)
    assert set(katz.hot_histories(docs, 16, 3).lengths.tolist()) == {1, 2}
    model = Brute((t for i, t in rows if fold(i, 7) != 2), 3)
    assert all(math.isclose(r["score"], model.score(dict(rows)[r["doc_id"]]), rel_tol=1e-9) for r in katz.score(docs).collect())


def test_discounts_without_the_counts_they_need():
    for n in ([0] * 6, [1, 0, 0, 0, 0, 0], [5, 0, 0, 0, 0, 9], [1, 9, 1, 9, 1, 9]):
        d = katz.discounts(np.array(n, np.int64))
        assert all(0 < x < 1 for x in d[1:-1]) and d[-1] == 1


def test_awkward_and_empty(spark):
    docs = awkward(spark)
    got = katz.score(docs).collect()
    assert len(got) == docs.count()
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)
    blank = [r for r in got if r["doc_id"] in (1, 2, 3)]
    assert {r["n_tokens"] for r in blank} == {1}
    assert katz.score(empty(spark)).count() == 0
    held = next(k for k in range(100) if fold(k, 7) == 2)
    only = katz.score(documents(spark, [(held, "nothing to learn from")])).collect()[0]
    assert (only["train_tokens"], only["n_known"], only["n_tokens"], only["score"]) == (0, 0, 5, 0.0)

import random
import re

import numpy as np
import xxhash

from llm_helpers import awkward, documents, empty
from wxmesh.llm import simhash


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k:k + 3]).encode(), 42) for k in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(codes, max_bits=2):
    """Smallest id reachable; ``codes``: id -> fingerprint."""
    label = {i: i for i in codes}
    changed = True
    while changed:
        changed = False
        for i, x in codes.items():
            for j, y in codes.items():
                if (x ^ y).bit_count() <= max_bits and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_against_brute_force(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(4))
    base = [[word() for _ in range(200)] for _ in range(12)]
    rows = []
    for k in range(150):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2, 30])):
            words[rng.randrange(len(words))] = word()
        rows.append((k, " ".join(words)))
    got = simhash.near_duplicates(documents(spark, rows), shard=16).collect()
    codes = {i: brute_fingerprint(t) for i, t in rows}
    assert {r["doc_id"]: int(r["fingerprint"], 16) for r in got} == codes
    want = brute_components(codes)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert len(set(want.values())) < 150


def test_shell_of_close_fingerprints():
    """A group that no vantage splits, large enough for the lookup of changed fingerprints, joined by chains only."""
    rng = np.random.default_rng(1)
    centre = np.uint64(0x0123456789ABCDEF)
    bits = rng.permutation(64)[:14].astype(np.uint64)
    masks = np.array([sum(int(np.uint64(1) << bits[b]) for b in range(14) if k >> b & 1) for k in range(1 << 13)], np.uint64)
    codes = np.unique(masks ^ centre)
    assert set(simhash.link(codes, 2)) == {0}
    alone = np.unique(np.append(codes, ~centre))
    assert len(set(simhash.link(alone, 2))) == 2


def test_chains_become_one_component(spark):
    edges = spark.createDataFrame([(k + 1, k) for k in range(40)] + [(100, 101), (103, 101), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert got == {**{k: 0 for k in range(1, 41)}, 101: 100, 103: 100}


def test_awkward_and_empty(spark):
    docs = awkward(spark)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert {r["component_id"] for r in by[1] + by[2] + by[3]} == {1} and by[1][0]["fingerprint"] == "0" * 16
    assert by[5][0]["component_id"] == by[6][0]["component_id"] == 5
    assert len(by[4]) == 2 and {r["component_id"] for r in by[4]} == {4}
    assert all(r["component_id"] is None for r in by[None])
    assert simhash.near_duplicates(empty(spark)).count() == 0

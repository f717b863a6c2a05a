import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from wxmesh.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, path string, part string"


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own[c].append((turn is not None, turn or 0, role, digest, text))
    own = {c: [(r, t) for _, _, r, _, t in sorted(v)] for c, v in own.items()}
    members = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        path = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append((c, len(path) == d))
    out, kids = {}, defaultdict(list)
    for path in sorted(members, key=len, reverse=True):
        m = members[path]
        leaves = sum(out[k][5] for k in kids[path]) or 1
        saved = sum(out[k][6] for k in kids[path]) + ((len(m) - 1) * len(path[-1][1].encode()) if path else 0)
        ends = ",".join(str(c) for c in sorted(c for c, last in m if last))
        parent = min(c for c, _ in members[path[:-1]]) if path else None
        out[path] = (min(c for c, _ in m), len(path), parent, len(m), len(kids[path]), leaves, saved,
                     hashlib.sha256(ends.encode()).hexdigest())
        if path:
            kids[path[:-1]].append(path)
    return sorted(out.values(), key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def corpus(seed, n=300, turns=14, kinds=3):
    """Few kinds of turns, so conversations share long prefixes; copies, gaps, nulls and repeated turns."""
    rng, rows = random.Random(seed), []
    for c in range(-20, n):
        if rng.random() < 0.15:
            continue
        like = random.Random(rng.randrange(12)) if rng.random() < 0.6 else rng
        for t in range(like.randrange(turns)):
            rows.append((c, t if rng.random() < 0.95 else None, like.choice(["user", "assistant", None]),
                         like.choice(["ä" * k for k in range(kinds)] + [None])))
    rng.shuffle(rows)
    return rows + rows[:7] + [(None, 1, "user", "no conversation")]


@pytest.mark.parametrize("parts,block,fan", [(1, 1 << 15, 64), (8, 1 << 15, 2), (8, 9, 3), (3, 1, 64)])
def test_equals_every_prefix_counted(spark, parts, block, fan):
    rows = corpus(parts * 100 + fan)
    assert got(prefix_trie.trie(prefix_trie.rebuilt(rows_of(spark, rows)), parts, block, fan)) == brute(rows)


def test_copies_of_one_conversation_fill_many_parts(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 2000, 5) for t in range(12)] + \
           [(c, t, "user", f"turn {t} of {c}") for c in (7, 1003) for t in range(40)]
    assert got(prefix_trie.trie(prefix_trie.rebuilt(rows_of(spark, rows)), 16)) == brute(rows)


def test_plain_paths_without_borrowing(spark):
    """The operator takes any digests; ``lends=1`` lends nothing."""
    rows = [(1, 0, "a", "x"), (1, 1, "b", "y"), (2, 0, "a", "x"), (3, 5, "a", "x" * 100_000)]
    nodes = {(r["conv_id"], r["depth"]): r for r in prefix_trie.trie(prefix_trie.rebuilt(rows_of(spark, rows), lends=1)).collect()}
    assert set(nodes) == {(1, 0), (1, 1), (1, 2), (3, 1)}
    assert nodes[1, 1]["n_convs"] == 2 and nodes[1, 1]["saved_tokens"] == 1 and nodes[1, 0]["n_leaves"] == 2


def test_awkward_and_empty(spark):
    rows = [(1, None, None, None), (1, None, None, None), (1, 0, "", ""), (6, 0, "user", "only its base lends"), (None, 0, "a", "b"),
            (11, 0, "u", ""), (12, 0, "u", None), (-3, 2, "u", "é\U0001F600"), (2 ** 62, 0, "u", "big")]
    assert got(prefix_trie.trie(prefix_trie.rebuilt(rows_of(spark, rows)))) == brute(rows)
    assert prefix_trie.trie(prefix_trie.rebuilt(rows_of(spark, []))).count() == 0
    turnless = [(c, 0, "u", "t") for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9]
    out = got(prefix_trie.trie(prefix_trie.rebuilt(rows_of(spark, turnless))))
    assert len(out) == 1 and out == brute(turnless)

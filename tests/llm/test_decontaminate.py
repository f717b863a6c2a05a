import math
import random
import unicodedata
from collections import Counter

import numpy as np

from llm_helpers import awkward, documents, empty
from wxmesh.llm import decontaminate
from wxmesh.llm.decontaminate import Index, Item, Part, Statistics

ITEMS = "item_id long, text string"


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.choice([2, 3, 5])))
    common = [word() for _ in range(60)]
    text = lambda n: [rng.choice(common) if rng.random() < 0.5 else word() for _ in range(n)]
    items = [(k, " ".join(text(rng.randrange(8, 60))) + ". " + " ".join(text(rng.randrange(1, 9))) + ".") for k in range(70)]
    rows, planted = [], set()
    for k in range(160):
        words = text(rng.randrange(0, 500))
        if rng.random() < 0.4:
            item = rng.choice(items)
            at = rng.randrange(len(words) + 1)
            words[at:at] = item[1].upper().split() if rng.random() < 0.3 else item[1].split()
            planted.add((k, item[0]))
        rows.append((k, " ".join(words)))
    return items, rows, planted


def brute(items, rows):
    """Pairs by scoring every item in every passage, without an index: BM25 written out over all items."""
    made = [x for x in (Item(*i) for i in items) if x.words]
    n, mean = len(made), sum(len(x.words) for x in made) / len(made)
    df = Counter(t for x in made for t in set(x.words))
    out = set()
    for item in made:
        tf = Counter(item.words)
        weight = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(item.words) / mean))
                  for t, f in tf.items()}
        size = 1
        while size < len(item.words):
            size *= 2
        for doc, text in rows:
            words = decontaminate.words_of(text)
            for at in range(0, max(1, len(words)), size):
                passage = words[at:at + 2 * size]
                have = set(passage)
                if sum(w for t, w in weight.items() if t in have) >= 0.5 * sum(weight.values()) - 1e-9:
                    found = item.overlap(passage)
                    if found[0] >= 0.8 and min(found[1:]) >= 0.5:
                        out.add((doc, item.item_id))
    return out


def test_against_brute_force_at_every_part_size(spark):
    items, rows, planted = corpus()
    want = brute(items, rows)
    values = set()
    for part_bytes in (8 << 20, 9000, 3000):
        found = decontaminate.contamination(documents(spark, rows), spark.createDataFrame(items, ITEMS), part_bytes=part_bytes).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == want and planted <= want
        values.add(tuple(sorted((r["doc_id"], r["item_id"], round(r["bm25"], 9), r["containment"]) for r in found)))
    assert len(values) == 1  # not even a score depends on the parts
    for part_bytes in (8 << 20, 9000):
        kept = decontaminate.clean(documents(spark, rows), spark.createDataFrame(items, ITEMS), part_bytes=part_bytes)
        assert {r["doc_id"] for r in kept.collect()} == {k for k, _ in rows} - {d for d, _ in want}


def test_spaces_quotes_dashes_and_scripts_hide_no_copy(spark):
    item = "what is the name of the river that doesn't flow through the old town - near the northern hills? It is the Silver Brook."
    chinese = "北京是中华人民共和国的首都，也是一座有着三千多年历史的古城。这座城市的中心是什么？紫禁城。"
    thai = "กรุงเทพมหานครเป็นเมืองหลวงของประเทศไทยและมีประชากรมากที่สุด แม่น้ำเจ้าพระยาไหลผ่าน"
    french = "où se trouve l'église où naquit l'évêque très célèbre de la ville? À côté de l'hôtel, près du château."
    pad = " ".join(["something else that is no item at all and goes on"] * 30)
    hide = {1: item, 2: item.replace(" ", "\u00a0"), 3: item.replace("'", "\u2019").replace(" the ", " \u201cthe\u201d "),
            4: item.replace(" the", "\u2014the"), 5: item.replace(" ", "\u2003 \u2009"), 6: "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in item),
            11: chinese, 12: "前面还有别的话" + chinese.replace("，", "") + "后面也有", 13: thai, 14: "และก่อนหน้านี้" + thai.replace(" ", "") + "แล้ว",
            15: french, 16: unicodedata.normalize("NFD", french), 17: french.upper().replace(" ", "\u202f")}
    rows = [(k, f"{pad} {t} {pad}") for k, t in hide.items()] + [(99, pad), (98, "上海也是一座城市。" * 20)]
    items = [(1, item), (2, chinese), (3, thai), (4, french)]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contamination(documents(spark, rows), spark.createDataFrame(items, ITEMS)).collect()}
    assert got == {*((k, 1) for k in range(1, 7)), (11, 2), (12, 2), (13, 3), (14, 3), (15, 4), (16, 4), (17, 4)}
    assert got == brute(items, rows)


def test_a_long_item_leaves_other_passages_short():
    known = [Item(1, "a b c d e f"), Item(2, "word " * 50_000)]
    assert [index.longest for index in Part(known, Statistics.of(known)).indexes] == [8, 65536]


def test_block_bounds_lose_nothing():
    """The scores found are those of an exhaustive pass, for several thresholds."""
    items, rows, _ = corpus(3)
    made = [Item(*x) for x in items]
    index = Index(made, Statistics.of(made), 64)
    dense = np.zeros((len(index.term), len(index.items)))
    for k in range(len(index.term)):
        for e in range(index.own[k], index.own[k + 1]):
            own = slice(index.at[e], index.at[e + 1])
            dense[k, index.item[own]] = index.weight[own]
    assert np.allclose(dense.sum(0), 1)
    rng = np.random.default_rng(0)
    terms = [np.unique(rng.integers(0, len(index.term), 40)) for _ in range(50)]
    passage, term = np.repeat(np.arange(50), [len(t) for t in terms]), np.concatenate(terms)
    full = np.stack([dense[t].sum(0) for t in terms])
    for threshold in (0.05, 0.2, 0.4):
        p, i, s = index.search(passage, term, 50, threshold)
        want = np.argwhere(full >= threshold)
        assert sorted(zip(p.tolist(), i.tolist())) == sorted(map(tuple, want.tolist()))
        assert np.allclose(s, full[p, i])


def test_near_copies_and_parts(spark):
    item = "what is the name of the river that flows through the old town near the northern hills. It is the Silver Brook."
    words = item.split()
    edited = [*words[:3], "changed", *words[4:]]
    rows = [(1, " ".join(["pad"] * 100 + words + ["pad"] * 100)), (2, " ".join(edited)), (3, " ".join(words[:9])),
            (4, " ".join(reversed(words))), (5, item.replace(" ", "\n\n").upper() + "!!!")]
    got = decontaminate.contamination(documents(spark, rows), spark.createDataFrame([(7, item)], ITEMS)).collect()
    assert {r["doc_id"] for r in got} == {1, 5} | ({2} if any(r["doc_id"] == 2 for r in got) else set())
    assert all(r["item_id"] == 7 and r["containment"] >= 0.8 for r in got)


def test_awkward_and_empty(spark):
    docs = awkward(spark)
    items = spark.createDataFrame([(1, None), (2, ""), (3, "a"), (3, "a"), (None, "same text as another one here"), (5, "!!")], ITEMS)
    got = sorted((r["doc_id"] or 0, r["item_id"] or 0) for r in decontaminate.contamination(docs, items).collect())
    assert got == [(0, 3), (4, 3), (4, 3), (5, 0), (6, 0)]
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 7, 8, 9]
    assert decontaminate.contamination(empty(spark), items).count() == 0
    assert decontaminate.contamination(docs, items.limit(0)).count() == 0
    assert decontaminate.clean(docs, items.limit(0)).count() == docs.count()

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import awkward, documents, empty, fold, labels
from wxmesh.llm import language_id, quality_pu, quality_rules, toxicity
from wxmesh.llm.common import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")



def auc(score, want):
    kinds, back, n = np.unique(score, return_inverse=True, return_counts=True)
    rank = (np.cumsum(n) - (n - 1) / 2)[back]
    pos = np.asarray(want) == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_language_on_held_out_rows(spark, docs):
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (fold(r["doc_id"], 3) == 1) for r in got) and len(got) == docs.count()
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_ignores_what_it_must(spark, docs):
    """Ids, sources and the held-out rows' languages play no part."""
    part = docs.limit(200).cache()
    plain = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(part).collect()}
    wrong = part.withColumn("source", F.lit("x")).withColumn(
        "lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit("zz")).otherwise(F.col("lang")))
    assert {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(wrong).collect()} == plain


def test_language_awkward(spark):
    docs = awkward(spark)
    got = language_id.identify(docs).collect()
    assert len(got) == docs.count()
    assert {r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3, 9)} == {"und"}
    assert all(r["lang_pred"] != "und" for r in got if r["doc_id"] in (4, 5, 6, 7))
    odd = documents(spark, [(k, t, "en") for k, t in enumerate(["words here", "½ ² ¾", "Ⅷ ⅷ", "① ②", "٣٤", "ª", "ß"])])
    assert {r["doc_id"] for r in language_id.identify(odd).collect() if r["lang_pred"] == "und"} == {1, 2, 3, 4}
    assert language_id.identify(empty(spark)).count() == 0
    unlabelled = language_id.identify(documents(spark, [(1, "words"), (2, "more words")])).collect()
    assert {(r["lang_pred"], r["score"]) for r in unlabelled} == {("und", 0.0)}
    one = language_id.identify(documents(spark, [(k, f"words {k}", "en") for k in range(9)])).collect()
    assert {r["lang_pred"] for r in one} == {"en"}


def test_language_families_of_unlisted_codes(spark):
    rows = [(k, "".join(random.Random(k).choices(letters, k=40)), lang) for k, (letters, lang) in enumerate(
        [("abc ", "x1"), ("def ", "x2"), ("ghi ", "en"), ("jkl ", "nl"), ("mno ", "de")] * 30)]
    got = language_id.identify(documents(spark, rows)).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got} == {i: lang for i, _, lang in rows}


def test_quality_on_held_out_rows(spark, docs):
    known = table(spark, SF, "labels").selectExpr("doc_id", "quality as label")
    got = quality_pu.classify(docs, known).join(known, "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert auc([r["score"] for r in held], [r["label"] for r in held]) >= 0.97
    assert sum(r["predicted"] == r["label"] for r in held) >= 0.93 * len(held)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in got)


def test_quality_never_sees_negatives_or_held_out_labels(spark, docs):
    known = table(spark, SF, "labels").selectExpr("doc_id", "quality as label")
    plain = {r["doc_id"]: r["score"] for r in quality_pu.classify(docs, known).collect()}
    flipped = known.withColumn("label", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
                                               1 - F.col("label")).otherwise(F.col("label")))
    assert {r["doc_id"]: r["score"] for r in quality_pu.classify(docs, flipped).collect()} == plain


def test_quality_parts_against_plain_sums(spark):
    """Edges, cells, prior and scores recomputed text by text, without grouping or hashing of texts."""
    import math

    rng = random.Random(2)
    junk = ["$$$ BUY | " * 9, "word", "A fine sentence, of the kind that is here. " * 5, "x\ny\nx\n" * 7, "1234 " * 30]
    rows = [(k, " ".join(rng.choice(junk) for _ in range(rng.randrange(1, 6)))) for k in range(150)] + [(200, None), (201, "")]
    rows += [(300 + k, rows[k % 7][1]) for k in range(60)]  # copies weigh as one text
    made = quality_pu.featured(documents(spark, rows).withColumn("held_out", F.lit(False)))
    texts = quality_pu.distinct_texts(made)
    assert texts.count() == len({t or "" for _, t in rows})
    plain = [t.encode() for t in sorted({t or "" for _, t in rows})]
    s = np.array([np.minimum(quality_pu.style(t), 6e4).astype(np.float16).astype(np.float32) for t in plain])
    g = np.array([np.rint(quality_pu.hashed_grams(t, (3,), quality_pu.BITS) * 65535).astype(np.uint16) for t in plain])
    edges = quality_pu.edges_of(texts)
    for k in range(s.shape[1]):
        column, places = sorted(s[:, k].tolist()), sorted([j / 8 for j in range(1, 8)] + [0.02, 0.05, 0.95, 0.98])
        assert edges[k].tolist() == [next(v for v in column if sum(x <= v for x in column) >= q * len(column)) for q in places]
    size, mean = quality_pu.cells_of(texts, edges)
    assert size.sum() == len(plain)
    everything = np.hstack((quality_pu.expand(s, edges), g / 65535))
    assert np.allclose((size[:, None] * mean).sum(0), everything.sum(0), atol=1e-3)
    pos = (s[:40], g[:40])
    model = quality_pu.Model(pos, edges, (size, mean), 0.6)
    score = model.score(s, g)
    for k in range(0, len(plain), 9):
        x = [float(v > e) for j, v in enumerate(s[k]) for e in edges[j]] + [v / 65535 for v in g[k].tolist()]
        assert score[k] == pytest.approx(1 / (1 + math.exp(-sum(a * b for a, b in zip(x, model.w[:-1].tolist())) - float(model.w[-1]))), abs=1e-4)
    step = [min(int(v * 200), 199) for v in score]
    ratios = [(sum(x >= t for x in step) / len(step)) / (sum(x >= t for x in step[:40]) / 40)
              for t in range(200) if sum(x >= t for x in step[:40]) >= 20]
    assert quality_pu.estimated_prior(model, texts, pos) == pytest.approx(min(max(min(ratios), 0.01), 0.99))


def test_quality_long_text_counts_whole(spark):
    """Two long texts that differ only after the first million bytes get different scores; copies the same."""
    rows = [(k, "a plain sentence of words, as it is. " * (k % 9 + 1)) for k in range(60)]
    long = "a plain sentence of words, as it is. " * 30_000
    rows += [(100, long + "$$$ |||| " * 30_000), (101, long), (102, long)]
    got = {r["doc_id"]: r["score"] for r in quality_pu.classify(documents(spark, rows), labels(spark, [(k, 1) for k in range(0, 60, 2)])).collect()}
    assert got[101] == got[102] != got[100]


def test_quality_awkward(spark):
    docs = awkward(spark)
    got = quality_pu.classify(docs, labels(spark, [(4, 1), (4, 0), (5, 0), (None, 1), (6, None)])).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    blank = {r["score"] for r in got if r["doc_id"] in (1, 2)}
    assert len(blank) == 1
    none = quality_pu.classify(docs, labels(spark, [])).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality_pu.classify(empty(spark), labels(spark, [(1, 1)])).count() == 0


def brute_counts(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
    cover = set()
    for k, w in enumerate(windows):
        if windows.count(w) > 1:
            cover.update(range(k, k + 8))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            sum(x in lines[:k] for k, x in enumerate(lines)), len(cover))


def test_rules_counts_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(k, "".join(rng.choice(["a ", "b ", "é ", "a b a b a b a b c ", "\n", "x#$ ", " \x0b\x0c\r\t", "\x85w", "|<>", "\x1cq "])
                        for _ in range(rng.randrange(90)))) for k in range(200)]
    got = quality_rules.assess(documents(spark, rows), labels(spark, [])).collect()
    for r in got:
        want = brute_counts(rows[r["doc_id"]][1])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, r["doc_id"]
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and r["kept"] == (not r["base_failed"])


def test_rules_verdict_on_held_out_rows(spark):
    big = "/root/testdata/sf0.1"
    known = table(spark, big, "labels").selectExpr("doc_id", "quality as label")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = quality_rules.assess(table(spark, big, "documents"), known.filter(~held)).join(known.filter(held), "doc_id")
    got = [r for r in got.collect() if not r["base_failed"]]
    assert sum(r["kept"] == bool(r["label"]) for r in got) >= 0.97 * len(got)
    good = [r for r in got if r["label"] == 1]
    assert sum(r["kept"] for r in good) >= 0.99 * len(good)


def test_rules_awkward(spark):
    docs = awkward(spark)
    got = quality_rules.assess(docs, labels(spark, [(4, 1), (5, 0), (None, 1), (6, None)])).collect()
    assert len(got) == docs.count()
    assert all(r["base_failed"] and not r["kept"] for r in got if r["doc_id"] in (1, 2, 3))
    assert next(r for r in got if r["doc_id"] == 7)["n_words"] == 30_002
    assert quality_rules.assess(empty(spark), labels(spark, [])).count() == 0


def test_toxicity_on_held_out_rows(spark, docs):
    known = table(spark, "/root/testdata/sf0.1", "labels").selectExpr("doc_id", "toxic as label")
    got = toxicity.classify(table(spark, "/root/testdata/sf0.1", "documents"), known).join(known, "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert auc([r["score"] for r in held], [r["label"] for r in held]) >= 0.94
    toxic, clean = [r for r in held if r["label"] == 1], [r for r in held if r["label"] == 0]
    assert sum(r["predicted"] for r in toxic) >= 0.85 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.01 * len(clean)


def test_toxicity_without_labels_and_awkward(spark):
    docs = awkward(spark).unionByName(documents(spark, [(50, "you are a stupid idiot and a moron"), (51, "a kind word")], extra=True))
    for known in (labels(spark, []), labels(spark, [(4, 1), (5, 0), (None, 1), (6, None), (4, 0)])):
        got = toxicity.classify(docs, known).collect()
        assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
        score = {r["doc_id"]: r["score"] for r in got}
        assert score[50] > score[51] and score[1] == score[2]
    assert toxicity.classify(empty(spark), labels(spark, [(1, 1)])).count() == 0


def test_posterior_is_bayes_rule_over_the_voters():
    """For every firing pattern the posterior follows from the fitted rates and dampings, voter by voter."""
    import math

    rng = np.random.default_rng(1)
    pattern, n = np.unique(rng.integers(0, 1 << len(toxicity.VOTERS), 200), return_counts=True)
    model = toxicity.LabelModel(pattern, n, n // 2, n // 3)
    for p in pattern.tolist():
        odds = math.log(model.balance / (1 - model.balance))
        for v in range(len(toxicity.VOTERS)):
            clean, toxic = (float(r[v]) if p >> v & 1 else 1 - float(r[v]) for r in model.rate)
            odds += float(model.damp[v]) * math.log(toxic / clean)
        assert model.posterior[p] == pytest.approx(1 / (1 + math.exp(-max(-40, min(40, odds)))), abs=1e-9)


def test_label_model_discounts_repeated_voters():
    """Two voters that always agree weigh less each than one that stands alone."""
    rng = np.random.default_rng(0)
    y = rng.random(20_000) < 0.3
    fire = lambda p: (rng.random(len(y)) < np.where(y, p, 0.03))
    first, alone = fire(0.7), fire(0.7)
    votes = np.zeros((len(y), len(toxicity.VOTERS)), bool)
    votes[:, 1], votes[:, 2], votes[:, 3] = first, first, alone
    pattern, n = np.unique(votes @ (1 << np.arange(len(toxicity.VOTERS))), return_counts=True)
    model = toxicity.LabelModel(pattern, n, 0 * n, 0 * n)
    assert abs(model.rate[1][3] - 0.7) < 0.1 and model.rate[0][3] < 0.08
    assert model.damp[1] < 0.6 and model.damp[2] < 0.6 and model.damp[3] > 0.8

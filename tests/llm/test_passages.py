"""A toxic passage counts however long the text around it is."""

from pyspark.sql import functions as F

from wxmesh.llm import toxicity
from wxmesh.llm.common import table

PARAGRAPH = " ".join(f"You {w}, you are {v} and {w}." for w, v in zip(("idiot", "moron", "loser", "bastard", "clown") * 2,
                                                                    ("stupid", "worthless", "pathetic", "dumb", "disgusting") * 2))


def test_one_toxic_paragraph_in_a_long_clean_text(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text")
    known = table(spark, "/root/testdata/sf0.1", "labels").selectExpr("doc_id", "toxic as label")
    clean = docs.join(known.filter("label = 0"), "doc_id").orderBy("doc_id").limit(200).collect()
    words = " ".join(r["text"] for r in clean).split()
    longs = [words[k:k + 5_000] for k in range(0, 30_000, 5_000)]
    assert len(longs[-1]) == 5_000
    rows = [(10**9 + k, " ".join(w)) for k, w in enumerate(longs)]
    rows += [(2 * 10**9 + k, " ".join([*w[:2_400], PARAGRAPH, *w[2_400:]])) for k, w in enumerate(longs)]
    got = toxicity.classify(docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string")), known)
    got = {r["doc_id"]: r for r in got.filter(F.col("doc_id") >= 10**9).collect()}
    assert [got[10**9 + k]["predicted"] for k in range(6)] == [0] * 6, got
    assert [got[2 * 10**9 + k]["predicted"] for k in range(6)] == [1] * 6, got


def test_windows_of_a_lexicon():
    import numpy as np

    lexicon = toxicity.Lexicon(toxicity.single_codes(["rotten"]), np.zeros(1, np.int64))
    long = ["word"] * 5_000
    at = lambda *places: " ".join("rotten" if k in places else w for k, w in enumerate(long))
    texts = [at(), at(4_000), at(195, 205, 290), at(100, 2_000, 4_900), at(*range(50, 5_000, 190)), "rotten word", ""]
    dense, votes = lexicon.find(texts)
    assert votes[:, 1].tolist() == [False, False, True, False, True, True, False]
    assert dense[:, 0].tolist() == [0, 85, 255, 85, 255, 255, 0]

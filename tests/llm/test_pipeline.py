import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from llm_helpers import awkward, documents
from test_simhash import brute_components, brute_fingerprint
from test_suffix_dedup import brute as brute_suffix
from test_suffix_dedup import edited
from wxmesh.llm import decontaminate
from wxmesh.llm.decontaminate import Item, Part, Statistics

ITEM = "what is the name of the river that flows through the old town near the northern hills. It is the Silver Brook."
ALPHABETS = {"en": "the of and to in a is that it was".split(), "de": "der die und das ist nicht ein von zu".split(),
             "fr": "le la les et de un une est que pour".split()}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(9)
    rows = []
    word = lambda lang: rng.choice(ALPHABETS[lang]) if rng.random() < 0.4 else "".join(rng.choice("abcdefghij") for _ in range(6))
    for k in range(90):
        lang = rng.choice(list(ALPHABETS))
        rows.append((k, " ".join(word(lang) for _ in range(rng.randrange(30, 200))), lang))
    rows += [(100 + k, rows[k][1], rows[k][2]) for k in range(0, 20, 4)]
    rows += [(120 + k, rows[k][1] + " " + rows[k + 1][1][:160], rows[k][2]) for k in range(30, 36)]
    rows += [(140, rows[3][1][:50] + " " + ITEM, "en"), (141, "1234 5678 !!", None), (142, None, "en")]
    return rows


@pytest.fixture(scope="module")
def sf_dir(spark, corpus, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    documents(spark, corpus, extra=True).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_against_brute_force(spark, corpus, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, want, at = docs.columns, {i: t for i, t, _ in corpus}, {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != "packing":
            assert out.columns == columns
            out.write.parquet(path := f"{sf_dir}/out-{name}")
            docs = spark.read.parquet(path)
            at[name] = {r["doc_id"]: r for r in docs.collect()}
            assert docs.count() == len(at[name])
            assert all(r["score"] == "x" and r["fp"] == "x" for r in at[name].values())
    del want[141], want[142]
    assert set(at["language_id"]) == set(want)
    groups = brute_components({i: brute_fingerprint(t) for i, t in want.items()})
    want = {i: t for i, t in want.items() if groups[i] == i}
    assert {i: r["text"] for i, r in at["simhash"].items()} == want
    left = {i: (n, v[3].decode("utf-8", "ignore")) for i, v in brute_suffix(list(want.items())).items() for n in [v[1]]}
    want = {i: t for i, (n, t) in left.items() if not n or t.strip()}
    assert {i: r["text"] for i, r in at["suffix_dedup"].items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in at["suffix_dedup"].values())
    items = [Item(1, ITEM)]
    index = Part(items, Statistics.of(items))
    want = {i: t for i, t in want.items() if not decontaminate.matches([t], index, decontaminate.THRESHOLD, decontaminate.CONTAINMENT)}
    assert 140 not in want and set(at["decontamination"]) == set(want)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in want.items()}
    got = {}
    for r in out.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == tokens
    whole = {}
    for r in pipeline.run(spark, sf_dir).collect():
        whole[r["doc_id"]] = whole.get(r["doc_id"], 0) + r["length"]
    assert whole == tokens


def test_awkward_and_empty(spark, tmp_path):
    for name, docs in (("awkward", awkward(spark)), ("empty", documents(spark, []))):
        path = str(tmp_path / name)
        docs.write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
        got = pipeline.run(spark, path).collect()
        ids = {r["doc_id"] for r in got}
        assert ids == ({None, 4, 5, 7, 8} if name == "awkward" else set())


def test_registered(spark):
    import __spark_entry__ as entry

    assert [name for name, _ in pipeline.STAGES] == ["language_id", "simhash", "suffix_dedup", "decontamination", "packing"]
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_repeated_passages_of_edited_copies(spark):
    """The third stage on copies that the second leaves, with words changed and ends cut; and nothing of a plain copy."""
    rows = edited(21, 60)
    docs = documents(spark, [*rows, (10**6, rows[0][1])], extra=True).repartition(5, "doc_id")
    got = {r["doc_id"]: r for r in pipeline.without_repeated_passages(spark, docs, "").collect()}
    want = {k: v[3].decode() for k, v in brute_suffix([*rows, (10**6, rows[0][1])]).items() if not v[1] or v[3].strip()}
    assert {k: r["text"] for k, r in got.items()} == want and 10**6 not in want
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())

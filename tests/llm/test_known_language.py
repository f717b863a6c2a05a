"""Gibberish and languages that nothing was learned from go; short clean texts stay."""

import random

import pytest

import corpus_pipeline as pipeline
from llm_helpers import documents
from wxmesh.llm import language_id

SYLLABLES = {"en": "the th ing er and on re in ha ent st at ble wh ou", "de": "der ein sch ung ie ach ver keit tz pf heit zu ü ä ge",
             "fr": "le la que eux eau oi ment è ç tre ai des ou é elle", "es": "el ción que ll ñ os ar mente rr do as ez ó ía co",
             "it": "gli zio cch ggi tta vv sci per uo mma zza io nn lla pp", "fi": "kk aa ssa yy ää lli nen jo ö tuu kin mme vat oi hy",
             "pl": "szcz owi rz ć ł ny prz em dzi ż cz ą go ie wy"}
LEARNED = ("en", "de", "fr", "es")


def text(rng, lang, words):
    own = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(own) for _ in range(rng.choice((1, 1, 2, 3)))) for _ in range(words)).capitalize() + "."


@pytest.mark.parametrize("langs", [LEARNED, LEARNED[:2], LEARNED[:1]])
def test_only_learned_languages_stay(spark, langs):
    rng = random.Random(6)
    rows = [(k, text(rng, langs[k % len(langs)], rng.randrange(20, 300)), langs[k % len(langs)]) for k in range(400 * len(langs))]
    stay = [(10_000 + k, text(rng, langs[k % len(langs)], rng.randrange(2, 12)), None) for k in range(200)]
    stay += [(11_000, rows[0][1] + " 123 !! " * 500, None), (11_001, rows[0][1].upper(), None), (11_002, "The the " * 300 if "en" in langs else rows[0][1], None)]
    letters = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9)))
    go = [(20_000 + k, " ".join(letters() for _ in range(rng.randrange(12, 400))), None) for k in range(100)]
    go += [(21_000 + k, text(rng, ("it", "fi", "pl")[k % 3], rng.randrange(20, 300)), None) for k in range(90)]
    go += [(22_000, "кошка спит на стуле пока дождь тихо падает на крышу старого дома", None), (22_001, "1234 !!", None), (22_002, None, None)]
    got = {r["doc_id"] for r in pipeline.known_language(spark, documents(spark, rows + stay + go), "").select("doc_id").collect()}
    assert not got & {r[0] for r in go}
    assert {r[0] for r in stay} <= got
    assert len({r[0] for r in rows} - got) <= 0.002 * len(rows)


def test_few_learning_texts_reject_nothing(spark):
    rng = random.Random(7)
    docs = documents(spark, [(k, text(rng, "en", 30), "en") for k in range(60)] + [(100, "xqzv kjqx wvzq zzxk qqwx", None)])
    model = language_id.fit(docs)
    assert language_id.fit_likeness(docs, model.langs).floors == {}
    assert language_id.known_languages(docs, model, language_id.fit_likeness(docs, model.langs)).count() == 61

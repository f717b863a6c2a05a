"""Toxicity by weak supervision.

1. Lexicon: words and word beginnings that mark toxic texts are learned from
   the labelled rows of the learning folds (document frequencies in both
   classes; support, log-odds and likelihood ratio above a floor), and joined to a short fixed
   list of insults.
2. Voters: each is a share of the lexicon (fixed words, learned words in four
   groups, word beginnings by length) or a pattern (insult near an address,
   shouting, masked words, runs of marks), and fires or abstains on a text. A
   lexicon voter fires on hits all through a text or on a passage of ``SPAN``
   words that has some. One fires when no lexicon voter does.
3. Label model: the firing patterns of all texts of the learning folds are
   counted in Spark; at most ``2**voters`` counts reach the driver. Expectation
   maximisation over the counts estimates the class balance and how often each
   voter fires in either class (its accuracy). Correlations of the voters within
   the classes are estimated from the same counts, and a voter's evidence is
   divided by one plus its positive correlations, so voters that repeat each
   other do not count twice. Patterns of labelled rows anchor the classes.
4. Classifier: logistic regression on lexicon terms and voters, fitted to the
   posterior labels, scores every text.

The lexicon is learned from at most ``cap`` labelled rows of a class, the
classifier from at most ``cap`` texts on either side of posterior one half; the
pattern counts cover every text.

Defined results: null text counts as empty and gets the score of a text without
findings. Several labels of one document count as their maximum; null labels
and labels with a null ``doc_id`` are ignored. Without labels the fixed lexicon
and patterns remain. Other columns, whatever their names, play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxmesh.llm.common import MIX, as_texts, column_of, crc_fold, record, slices
from wxmesh.llm.features import WORD, prefix_codes, spans, word_codes
from wxmesh.llm.linear import bounded_sample, fit_logistic, sigmoid
from wxmesh.session import materialise

#: Common insults in four languages, and words that address the reader.
INSULTS = ("idiot idiots moron morons stupid dumb loser losers scum trash pathetic worthless disgusting clown imbecile "
           "bastard bitch asshole fuck fucking shit crap retard retarded whore slut cunt dickhead jerk "
           "trottel idiotin arschloch scheisse scheiße dummkopf drecksau wichser hurensohn blödmann abschaum "
           "connard connasse salope imbécile crétin merde abruti enculé débile ordure "
           "idiota imbécil estúpido estúpida cabrón puta mierda gilipollas pendejo basura").split()
ADDRESS = "you your you're youre u du dich dir dein deine ihr tu toi te ton ta vous votre tú usted tus eres".split()
PREFIXES = (4, 5, 6, 7, 8)
SPAN = 200
DENSE = 3  # hits in one window that are more than chance, however long the text is
PRIOR = 20.0
MIN_SUPPORT, MIN_LOG_ODDS, MIN_G2 = 5, 3.0, 30.0
VOTERS = ("fixed", "words_0", "words_1", "words_2", "words_3", "begin_4", "begin_5", "begin_6", "begin_7", "begin_8",
          "addressed", "shouting", "masked", "marks", "nothing")
MARKS = np.frombuffer(b"!?*#$%&", np.uint8)


def single_codes(words: list[str]) -> np.ndarray:
    raw = " ".join(words).encode()
    return word_codes(raw, *spans(WORD[np.frombuffer(raw, np.uint8)]))


INSULT_CODES, ADDRESS_CODES = np.sort(single_codes(INSULTS)), np.sort(single_codes(ADDRESS))


class Words:
    """The words of a batch of texts, with the number of the text that each is in."""

    def __init__(self, texts: list[str]):
        self.n = len(texts)
        plain = [t.encode("utf-8", "replace") for t in texts]
        low = [t.lower().encode("utf-8", "replace") for t in texts]
        self.raw = b"\n".join(low)
        self.starts, self.ends = spans(WORD[np.frombuffer(self.raw, np.uint8)])
        edge = np.cumsum([len(b) + 1 for b in low])
        self.text = np.searchsorted(edge, self.starts, side="right")
        self.codes = word_codes(self.raw, self.starts, self.ends)
        self.place = np.arange(len(self.text)) - np.searchsorted(self.text, self.text)  # of a word in its text
        self.plain = plain

    def terms(self):
        """Codes of words, then of word beginnings, each with its word and kind (0: word, else the length)."""
        yield 0, self.codes, np.arange(len(self.codes))
        lengths = self.ends - self.starts
        for p in PREFIXES:
            own = np.flatnonzero(lengths > p)
            yield p, prefix_codes(self.raw, self.starts[own], np.minimum(lengths[own], p), p) * MIX + np.uint64(p), own

    def patterns(self) -> np.ndarray:
        """Firings of the pattern voters: addressed, shouting, masked, marks."""
        out = np.zeros((self.n, 4), bool)
        insult, address = member(self.codes, INSULT_CODES), member(self.codes, ADDRESS_CODES)
        near = np.zeros(len(insult), bool)
        for d in (1, 2, 3):
            near[d:] |= insult[d:] & address[:-d]
            near[:-d] |= insult[:-d] & address[d:]
        out[self.text[near], 0] = True
        for k, raw in enumerate(self.plain):
            a = np.frombuffer(raw, np.uint8)
            upper, lower = int(((a >= 65) & (a <= 90)).sum()), int(((a >= 97) & (a <= 122)).sum())
            marks = np.isin(a, MARKS)
            run = marks[2:] & marks[1:-1] & marks[:-2] if len(a) > 2 else marks[:0]
            out[k, 1] = upper > lower and upper > 20
            out[k, 2] = b"***" in raw
            out[k, 3] = run.sum() * 50 > len(a) if len(a) else False
        return out


def member(codes: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
    return known[at] == codes


class Lexicon:
    """Learned term codes (sorted) with their voters, and a bit table that settles most lookups."""

    def __init__(self, codes: np.ndarray, kinds: np.ndarray):
        order = np.argsort(codes)
        self.codes, kinds = codes[order], kinds[order]
        self.voter = np.where(kinds == 0, 1 + np.arange(len(codes)) % 4, 1 + kinds).astype(np.int64)
        self.bits = np.zeros(1 << 16, bool)
        self.bits[(self.codes * MIX) >> np.uint64(48)] = True

    def find(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How dense each term is in each text (0 to 255), and whether each voter fires on it.

        Both are measured over the whole text, in hits for ``SPAN`` words, and in
        windows of ``SPAN`` words that overlap by half; the larger counts. A text
        of up to ``SPAN`` words is one window, in which one hit is enough. A longer
        one meets a rare word by chance, so a window needs up to ``DENSE`` hits,
        and the terms are those of the window with the most hits.
        """
        words = Words(texts)
        n, half = words.n, SPAN // 2
        size = np.bincount(words.text, minlength=n)
        spans_ = np.maximum(1.0, size / SPAN)
        need = np.minimum(spans_, DENSE)
        edge = np.concatenate(([0], np.cumsum(np.maximum(1, -(-size // half)))))  # the first window of each text
        insults = np.flatnonzero(member(words.codes, INSULT_CODES))
        word, term, voter = [insults], [np.full(len(insults), -1)], [np.zeros(len(insults), np.int64)]
        for _, codes, own in words.terms():
            maybe = np.flatnonzero(self.bits[(codes * MIX) >> np.uint64(48)])
            if len(maybe):
                at = np.minimum(np.searchsorted(self.codes, codes[maybe]), len(self.codes) - 1)
                hit = self.codes[at] == codes[maybe]
                word.append(own[maybe[hit]])
                term.append(at[hit])
                voter.append(self.voter[at[hit]])
        word, term, voter = np.concatenate(word), np.concatenate(term), np.concatenate(voter)
        text, step = words.text[word], words.place[word] // half
        whole, near = np.zeros((n, 11)), np.zeros((edge[-1], 11))
        np.add.at(whole, (text, voter), 1)
        np.add.at(near, (edge[text] + step, voter), 1)
        np.add.at(near, (edge[text[step > 0]] + step[step > 0] - 1, voter[step > 0]), 1)
        densest = np.array([near[a:b].sum(1).argmax() for a, b in zip(edge, edge[1:])], np.int64)
        votes = np.zeros((n, len(VOTERS)), bool)
        if n:
            top = np.maximum.reduceat(near, edge[:-1])
            votes[:, :10] = ((whole >= spans_[:, None]) | (top >= need[:, None]))[:, :10]
        votes[:, 10:14] = words.patterns()
        votes[:, 14] = ~votes[:, :10].any(1)
        held, inside = np.zeros((n, len(self.codes))), np.zeros((n, len(self.codes)))
        learned = term >= 0
        np.add.at(held, (text[learned], term[learned]), 1)
        learned &= (step == densest[text]) | (step == densest[text] + 1)
        np.add.at(inside, (text[learned], term[learned]), 1)
        dense = np.maximum(held / spans_[:, None], inside / need[:, None])
        return (255 * np.minimum(1, dense)).astype(np.uint8), votes


def learn_lexicon(docs: DataFrame, known: DataFrame, cap: int) -> Lexicon:
    """``docs(doc_id, text)``; ``known(doc_id, label)`` of the learning folds."""
    sample = materialise(bounded_sample(known, "label", cap, F.col("doc_id")), "labelled")
    size = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    pos, neg = size.get(1, 0), size.get(0, 0)
    if not pos or not neg:
        return Lexicon(np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def rows(batches):
        for batch in slices(batches, 512):
            toxic = column_of(batch, "label").to_numpy() == 1
            words = Words(as_texts(column_of(batch, "text")))
            for kind, codes, own in words.terms():
                pair = np.unique(np.rec.fromarrays((codes, words.text[own])))
                code, back = np.unique(pair.f0, return_inverse=True)
                p = np.bincount(back, toxic[pair.f1]).astype(np.int64)
                n = np.bincount(back, ~toxic[pair.f1]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array(np.full(len(code), kind, np.int64)),
                                                  pa.array(p), pa.array(n)], ["code", "kind", "pos", "neg"])

    share = pos / max(1, pos + neg)
    seen = F.col("pos") + F.col("neg")
    g2 = 2 * (F.col("pos") * F.log(F.col("pos") / (seen * share))
              + F.when(F.col("neg") > 0, F.col("neg") * F.log(F.col("neg") / (seen * (1 - share)))).otherwise(0.0))
    odds = F.log((F.col("pos") + 0.5) / F.lit(pos + 1.0)) - F.log((F.col("neg") + 0.5) / F.lit(neg + 1.0))
    got = (docs.join(F.broadcast(sample), "doc_id").select("label", "text")
           .mapInArrow(rows, "code long, kind long, pos long, neg long")
           .groupBy("code", "kind").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
           .filter(F.col("pos") >= MIN_SUPPORT).filter(odds >= MIN_LOG_ODDS).withColumn("g2", g2).filter(F.col("g2") >= MIN_G2)
           .orderBy(F.desc("g2"), "code", "kind").collect())  # of at most ``cap`` rows a class
    codes = np.array([r["code"] for r in got], np.int64).view(np.uint64)
    return Lexicon(codes, np.array([r["kind"] for r in got], np.int64))


class LabelModel:
    """Posterior of the toxic class for each firing pattern."""

    def __init__(self, patterns: np.ndarray, free: np.ndarray, clean: np.ndarray, toxic: np.ndarray, rounds: int = 60):
        x = (patterns[:, None] >> np.arange(len(VOTERS)) & 1).astype(np.float64)
        total = free + clean + toxic
        # Begin with: any lexicon voter means toxic; labelled rows stay (almost) as they are labelled.
        belief = np.where(x[:, :10].any(1), 0.8, 0.05)
        damp = np.ones(len(VOTERS))
        names = np.array([v.partition("_")[0] for v in VOTERS])
        lexical = np.isin(names, ("fixed", "words", "begin", "addressed"))
        # What voters are expected to do counts as a few observations, which decide only where there is little data.
        prior = np.stack((np.where(lexical, 0.01, np.where(names == "nothing", 0.95, 0.05)),
                          np.where(lexical, 0.4, np.where(names == "nothing", 0.1, 0.1))))
        for _ in range(rounds):
            mass = np.stack((free * (1 - belief) + 0.98 * clean + 0.02 * toxic, free * belief + 0.02 * clean + 0.98 * toxic))
            size = mass.sum(1)
            rate = (mass @ x + PRIOR * prior) / (size[:, None] + PRIOR)  # how often each voter fires in either class
            self.balance = (size[1] + 1) / (size.sum() + 2)
            damp = 1 / (1 + self._correlation(x, mass, rate))
            evidence = (x * np.log(rate[1] / rate[0]) + (1 - x) * np.log((1 - rate[1]) / (1 - rate[0]))) * damp
            belief = sigmoid(evidence.sum(1) + np.log(self.balance / (1 - self.balance)))
        self.rate, self.damp = rate, damp
        self.posterior = dict(zip(patterns.tolist(), belief.tolist()))
        self.size = float(total.sum())

    @staticmethod
    def _correlation(x, mass, rate):
        """Sum over the other voters of the positive correlation within the classes."""
        out = np.zeros((x.shape[1], x.shape[1]))
        for k in (0, 1):
            centred = x - rate[k]
            spread = np.sqrt(rate[k] * (1 - rate[k])) + 1e-9
            out += (centred.T * mass[k]) @ centred / (spread[:, None] * spread) / max(1.0, mass.sum())
        np.fill_diagonal(out, 0)
        return np.maximum(out, 0).sum(1)


OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, threshold: float = 0.5,
             cap: int = 3000) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, score, predicted``. ``labels`` has ``doc_id`` and ``label``."""
    docs = docs.select("doc_id", "text").withColumn("held_out", crc_fold(F.col("doc_id"), folds) == held)
    learn = docs.filter(~F.col("held_out")).select("doc_id", "text")
    known = (labels.filter("doc_id is not null and label is not null").filter(crc_fold(F.col("doc_id"), folds) != held)
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    lexicon = learn_lexicon(learn, known, cap)
    power = 1 << np.arange(len(VOTERS))

    def fired(batches):
        for batch in slices(batches, 256):
            _, votes = lexicon.find(as_texts(column_of(batch, "text")))
            yield pa.RecordBatch.from_arrays([column_of(batch, "doc_id"), pa.array(votes @ power)], ["doc_id", "pattern"])

    votes = materialise(learn.mapInArrow(fired, "doc_id long, pattern long"), "votes")
    counts = (votes.join(known, "doc_id", "left").groupBy("pattern")
              .agg(F.sum(F.expr("cast(label is null as long)")).alias("free"),
                   F.sum(F.expr("cast(label is not null and label <> 1 as long)")).alias("clean"),
                   F.sum(F.expr("cast(label is not null and label = 1 as long)")).alias("toxic")).orderBy("pattern").collect())
    weights = None
    if counts:
        model = LabelModel(*(np.array([r[c] for r in counts], np.int64) for c in ("pattern", "free", "clean", "toxic")))
        toxic = [p for p, q in model.posterior.items() if q >= 0.5]
        ids = bounded_sample(votes.filter("doc_id is not null").select("doc_id", F.col("pattern").isin(toxic).alias("side")).distinct(),
                             "side", cap, F.col("doc_id"), (True, False)).select("doc_id").distinct()

        def found(batches):
            for batch in slices(batches, 256):
                held_terms, votes_ = lexicon.find(as_texts(column_of(batch, "text")))
                yield pa.RecordBatch.from_arrays([
                    pa.array((votes_ @ power).tolist(), pa.int64()),
                    pa.array([b.tobytes() for b in held_terms], pa.binary())], ["pattern", "x"])

        got = learn.join(F.broadcast(ids), "doc_id", "left_semi").select("text").mapInArrow(found, "pattern long, x binary").collect()
        got.sort(key=lambda r: (r["pattern"], r["x"]))
        if got:
            weights = _fit(got, len(lexicon.codes), model)

    def score(batches):
        for batch in slices(batches, 256):
            held_terms, votes_ = lexicon.find(as_texts(column_of(batch, "text")))
            x = np.hstack((held_terms / np.float32(255), votes_)).astype(np.float32)
            value = (sigmoid(x @ weights[:-1] + weights[-1]) if weights is not None else votes_[:, 0] * 0.9).astype(np.float64)
            yield record(OUT, column_of(batch, "doc_id"), column_of(batch, "held_out"), value, (value >= threshold).astype(np.int32))

    return docs.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")


def _fit(got, terms: int, model: LabelModel) -> np.ndarray:
    pattern = np.array([r["pattern"] for r in got])
    votes = (pattern[:, None] >> np.arange(len(VOTERS)) & 1).astype(np.float32)
    held = np.frombuffer(b"".join(r["x"] for r in got), np.uint8).reshape(len(got), terms) / np.float32(255)
    target = np.array([model.posterior[p] for p in pattern.tolist()])
    return fit_logistic(np.hstack((held, votes)), target, l2=1e-4, steps=400, rate=0.1)

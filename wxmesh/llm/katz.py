"""Language-model scoring: a Katz backoff model of n-grams, counted and applied in partitioned tables.

``P(w | h)`` is the Good-Turing discounted relative frequency of ``w`` after the
history ``h`` (the last ``order - 1`` tokens) if learning has seen it, else
``alpha(h) P(w | h')`` with the oldest token of ``h`` left out, and so on down to
single words. ``alpha(h)`` is exactly what the discounts of ``h`` leave free over
what ``P(. | h')`` gives to the words unseen after ``h``; a history that learning
has not seen has weight one. ``P(w)`` is the discounted unigram; what its
discounts leave is the probability of the one unknown word. If no n-gram of a
history is discounted, one count is set aside, so every distribution sums to one
and no word gets zero.

Words are known by their 64-bit XXH64, n-grams by a 64-bit hash of these; two
that share a hash count as one. The flow:

* Each Arrow batch of texts becomes one compressed value for each shard, with
  the n-grams whose previous word hashes there. So all tables of a history and
  of those that it backs off to lie in one shard. Histories that make up a large
  share of a sample of the texts ("hot" ones) are spread by one word more, in the
  end by the whole n-gram, so no shard gets all of one.
* The shards count their words, and the shorter n-grams of hot histories, and send
  the counts to owners, which add them up and answer each sender.
* With the answers and the counts of counts a shard goes down from the longest
  history of each token to the first that has seen it. It sends sums for each
  text back under the batch; the weights of hot histories, of which a shard has
  a share only, are added up first and applied last.

All counts are over all learning texts. The shuffle of n-grams is read three
times but written once. There are two shards a group of ``applyInArrow``, and as
many groups as the session has shuffle partitions, or more where a group would
have over ``GROUP_BYTES`` of text; owners are half the shuffle partitions.

Defined results: a null or empty text is the end token alone. Null ``doc_id``
rows are learned from and not held out. Rows repeated in the input are counted
and scored each. If there is nothing to learn from, every probability is 1.
Other columns, whatever their names, play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxmesh.llm.common import MIX, as_bytes, column_of, crc_fold, pack_arrays, smallest, unpack_arrays
from wxmesh.llm.linear import bounded_rows
from wxmesh.session import materialise

SEED = 20
BEGIN = np.uint64(0x243F6A8885A308D3)
END = np.uint64(0x13198A2E03707344)
CUTOFF = 5  # counts above it are not discounted
ORDER = 3  # words of the longest n-grams
HOT_SAMPLE = 400
BATCH_BYTES = 12 << 20
GROUP = 2  # shards of one group, which are worked on one after the other
GROUP_BYTES = 256 << 20  # of text a group at most, on average
ASK, STATS, META, SUMS, HOT = range(5)


def word_hashes(raw: bytes) -> np.ndarray:
    """Hashes of the lower-cased words and of the end."""
    words = raw.lower().split()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((*(digest(w, SEED) for w in words), int(END)), np.uint64, len(words) + 1)


def hashes_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of all texts, one after the other, and how many each has."""
    tokens = [word_hashes(t) for t in texts]
    return np.concatenate(tokens or [np.zeros(0, np.uint64)]), np.array([len(t) for t in tokens], np.int64)


def pair_hash(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    x = (v ^ (v >> np.uint64(31))) * MIX + w
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def contexts(tokens: np.ndarray, lengths: np.ndarray, width: int, begin) -> list[np.ndarray]:
    """The tokens of all texts, then the token one, two, ... ``width - 1`` places before each; ``begin`` before a text."""
    place = np.arange(len(tokens), dtype=np.int32) - np.repeat((np.cumsum(lengths) - lengths).astype(np.int32), lengths)
    return [tokens, *(np.where(place >= k, np.roll(tokens, k), tokens.dtype.type(begin)) for k in range(1, width))]


def histories(before: list[np.ndarray]) -> list[np.ndarray]:
    """Codes of the last one, two, ... tokens; a longer history's code is made from the shorter one's."""
    codes = before[:1]
    for older in before[1:]:
        codes.append(pair_hash(codes[-1], older))
    return codes


class Hot:
    """Codes of frequent histories (sorted) and how many tokens each has."""

    def __init__(self, codes=(), lengths=()):
        codes, lengths = np.array(codes, np.uint64), np.array(lengths, np.int64)
        order = np.argsort(codes)
        self.codes, self.lengths = codes[order], lengths[order]

    def __len__(self):
        return len(self.codes)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """The place of each code, -1 if it is none of these."""
        if not len(self.codes):
            return np.full(len(codes), -1)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, at, -1)


def hot_histories(docs: DataFrame, shards: int, width: int) -> Hot:
    """Histories that hold over a quarter of a shard's share in a hash sample; they only steer where n-grams go."""
    def counted(batches):
        for batch in batches:
            tokens, lengths = hashes_of(as_bytes(column_of(batch, "text")))
            _, *before = contexts(tokens, lengths, width, BEGIN)
            for k, codes in enumerate(histories(before), 1):
                code, n = np.unique(codes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), k)), pa.array(code.view(np.int64)), pa.array(n)],
                                                 ["length", "code", "n"])

    rows = bounded_rows(docs.select("doc_id", "text"), HOT_SAMPLE, F.col("doc_id")).select("text") \
        .mapInArrow(counted, "length long, code long, n long").groupBy("length", "code").agg(F.sum("n").alias("n"))
    total = rows.filter("length = 1").agg(F.sum("n")).first()[0] or 0
    hot = rows.filter(F.col("n") * 4 * shards > total).select("code", "length").collect()  # at most 4 * shards a length
    return Hot(np.array([r["code"] for r in hot], np.int64).view(np.uint64), [r["length"] for r in hot])


def ngrams(docs: DataFrame, shards: int, width: int, hot: Hot) -> DataFrame:
    """``shard, batch, kind, blob`` of ``docs(doc_id, text, held_out)``; kind META lists the texts of a batch."""

    def emit(batches):
        part, k = TaskContext.get().partitionId(), 0
        for whole in batches:
            size = np.cumsum([len(b) for b in as_bytes(column_of(whole, "text"))])
            lo = 0
            while lo < whole.num_rows:
                hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + BATCH_BYTES, side="right")))
                yield from _messages(whole.slice(lo, hi - lo), (part << 32) + k, shards, width, hot)
                lo, k = hi, k + 1

    return docs.mapInArrow(emit, "shard int, batch long, kind int, blob binary")


def _messages(batch: pa.RecordBatch, name: int, shards: int, width: int, hot: Hot):
    """One batch's n-grams for each shard, and the list of its texts."""
    tokens, lengths = hashes_of(as_bytes(column_of(batch, "text")))
    vocabulary, tokens = np.unique(tokens, return_inverse=True)
    grams = contexts(tokens.astype(np.int32), lengths, width, len(vocabulary))
    vocabulary = np.append(vocabulary, BEGIN)
    del tokens
    codes = histories([vocabulary[g] for g in grams[1:]])
    to, hot_so_far = codes[0].copy(), np.ones(len(codes[0]), bool)
    for code, longer in zip(codes, [*codes[1:], None] if len(hot) else []):
        hot_so_far &= hot.find(code) >= 0
        to[hot_so_far] = pair_hash(code[hot_so_far], vocabulary[grams[0][hot_so_far]]) if longer is None else longer[hot_so_far]
    shard = (to % np.uint64(shards)).astype(np.uint16 if shards < 1 << 16 else np.uint32)
    del codes, to, hot_so_far
    order = np.argsort(shard, kind="stable").astype(np.int32)
    edge = np.concatenate(([0], np.cumsum(np.bincount(shard, minlength=shards)))).tolist()
    text = np.repeat(np.arange(len(lengths), dtype=np.uint32), lengths)[order]
    grams = [g[order] for g in grams]
    learn = ~column_of(batch, "held_out").to_numpy(zero_copy_only=False)
    flags = np.packbits(learn)
    for s, (lo, hi) in enumerate(zip(edge, edge[1:])):
        if hi > lo:
            yield _row(s, name, ASK, _pack(vocabulary, [g[lo:hi] for g in grams], text[lo:hi], flags))
    ids = column_of(batch, "doc_id")
    yield _row(name % shards, name, META, pack_arrays(
        np.array(ids.fill_null(0)).astype(np.int64), np.array(ids.is_valid()).astype(np.uint8), (~learn).astype(np.uint8),
        lengths.astype(np.uint32)))


def _row(shard: int, batch: int, kind: int, blob: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([batch], pa.int64()), pa.array([kind], pa.int32()),
                                       pa.array([blob], pa.binary())], ["shard", "batch", "kind", "blob"])


def _pack(vocabulary: np.ndarray, grams: list, text: np.ndarray, flags: np.ndarray) -> bytes:
    """N-grams sorted by (previous word, word, older words): the words, each distinct n-gram once, and its texts."""
    used = np.zeros(len(vocabulary), bool)
    for g in grams:
        used[g] = True
    words, place = vocabulary[used], np.cumsum(used) - 1
    w, v, *older = (place[g] for g in grams)
    if len(words) ** len(grams) < 1 << 62:
        key = v
        for g in (w, *older):
            key = key * len(words) + g
        order = np.argsort(key, kind="stable")
        new = np.diff(key[order], prepend=-1) != 0
    else:
        order = np.lexsort((*older[::-1], w, v))
        new = np.append(True, np.any([g[order][1:] != g[order][:-1] for g in (v, w, *older)], axis=0))
    first = np.flatnonzero(new)
    at = order[first]
    return pack_arrays(np.diff(words, prepend=np.uint64(0)), smallest(np.bincount(v[at], minlength=len(words))), smallest(np.diff(np.append(first, len(order)))),
                       smallest(text[order]), flags, *(smallest(g[at]) for g in (w, *older)))


class Part:
    """One unpacked value of n-grams."""

    def __init__(self, blob: bytes):
        gaps, per_v, n, self.text, flags, w, *older = unpack_arrays(blob)
        self.words = np.cumsum(gaps, dtype=np.uint64)
        self.before = [np.repeat(np.arange(len(self.words), dtype=np.int32), per_v), *older]
        self.w = w
        self.learn = np.unpackbits(flags).astype(bool)
        self.gram = np.repeat(np.arange(len(w), dtype=np.int32), n)  # of each entry
        self.learned = np.bincount(self.gram, self.learn[self.text], minlength=len(w)).astype(np.int64)


class Level:
    """The distinct n-grams of one length in a shard: learning counts, their histories, and the shorter n-grams they end in."""

    def __init__(self, count, history, hot: Hot):
        self.count = count
        codes, self.history = np.unique(history, return_inverse=True)
        self.hot = hot.find(codes)              # of each history
        self.histories = len(codes)
        self.shared = self.hot[self.history] >= 0
        self.code = self.down = None


class Shard:
    """What a shard knows of its own: its words (sorted), and its distinct n-grams of each length from the longest down."""

    def __init__(self, blobs: list[bytes], width: int, hot: Hot):
        self.parts = [Part(b) for b in blobs]
        none = [np.zeros(0, np.uint64)]
        put = lambda make: np.concatenate([make(p) for p in self.parts] or none)
        w = put(lambda p: p.words[p.w])
        past = histories([put(lambda p, k=k: p.words[p.before[k]]) for k in range(width - 1)])
        count = np.concatenate([p.learned for p in self.parts] or [np.zeros(0, np.int64)])
        self.levels: dict[int, Level] = {}
        above = None
        for k in range(width, 1, -1):
            code, first, back = np.unique(pair_hash(past[k - 2], w), return_index=True, return_inverse=True)
            count = np.bincount(back, count, minlength=len(first)).astype(np.int64)
            if above is None:
                self.of = np.split(back.astype(np.int32), np.cumsum([len(p.w) for p in self.parts])[:-1]) if self.parts else []
            else:
                above.down = back
            w, past = w[first], [x[first] for x in past[:k - 1]]
            above = self.levels[k] = Level(count, past[k - 2], hot)
            above.code = code
        self.words, above.down = np.unique(w, return_inverse=True)
        self.word_count = np.bincount(above.down, count, minlength=len(self.words)).astype(np.int64)

    def asked(self, order: int) -> list[tuple[int, np.ndarray]]:
        """Lengths below the longest, and which of their n-grams other shards may have too."""
        return [(k, np.flatnonzero(level.shared)) for k, level in self.levels.items() if k < max(order, 2)]


def counts_of_counts(count: np.ndarray) -> np.ndarray:
    """How many have count 1, 2, ... CUTOFF + 1."""
    return np.bincount(np.minimum(count, CUTOFF + 2), minlength=CUTOFF + 3)[1:CUTOFF + 2].astype(np.int64)


def discounts(n: np.ndarray) -> np.ndarray:
    """Good-Turing discount (Katz's form) for counts 0 to CUTOFF + 1; the last is 1.

    Where the counts of counts give none between 0 and 1, absolute discounting
    with their estimate of the discount stands in.
    """
    d = np.ones(CUTOFF + 2)
    fixed = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    tail = (CUTOFF + 1) * n[CUTOFF] / n[0] if n[0] else 1.0
    for r in range(1, CUTOFF + 1):
        good = (r + 1) * n[r] / (r * n[r - 1]) if n[r - 1] else 0.0
        d[r] = (good - tail) / (1 - tail) if tail < 1 else 0.0
        if not 0 < d[r] < 1:
            d[r] = (r - fixed) / r if 0 < fixed < 1 else (r - 0.5) / r
    return d


class Unigram:
    """``P(w)`` from counts: discounted, the rest for the unknown word; and the add-one base."""

    def __init__(self, total: int, kinds: int, n: np.ndarray):
        self.total, self.kinds = total, kinds
        self.d = discounts(n)
        lost = sum((1 - self.d[r]) * r * int(n[r - 1]) for r in range(1, CUTOFF + 1))
        self.scale = 1.0 if lost > 0 else total / (total + 1)
        self.unknown = lost / total if lost > 0 else 1 / (total + 1)

    def p(self, count: np.ndarray) -> np.ndarray:
        if not self.total:
            return np.ones(len(count))
        return np.where(count > 0, self.d[np.minimum(count, CUTOFF + 1)] * count / self.total * self.scale, self.unknown)

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1) / (self.total + self.kinds + 1))


def _blobs(table: pa.Table, kind: int) -> list[tuple[int, bytes]]:
    return sorted((b, blob) for b, k, blob in zip(*(table.column(c).to_pylist() for c in ("batch", "kind", "blob"))) if k == kind)


def score(docs: DataFrame, folds: int = 7, held: int = 2, order: int = ORDER) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    spark = docs.sparkSession
    if order < 1:
        raise ValueError("the order of the model must be 1 or more")
    docs = docs.select("doc_id", "text").withColumn("held_out", crc_fold(F.col("doc_id"), folds) == held)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_bytes = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards, owners = GROUP * max(partitions, -(-n_bytes // GROUP_BYTES)), max(1, partitions // 2)
    width = max(order, 2)
    hot = hot_histories(docs, shards, width)
    sent = ngrams(docs, shards, width, hot)
    grouped = lambda df: df.withColumn("group", F.expr(f"shard div {GROUP}")).groupBy("group")
    by_group = grouped(sent)

    def ask(rows: pa.Table) -> pa.Table:
        """Each shard's words and shared n-grams for each of their owners, and its part of the statistics."""
        out = []
        for shard, own_rows in _by_shard(rows):
            own = Shard([b for _, b in _blobs(own_rows, ASK)], width, hot)
            to = (own.words % np.uint64(owners)).astype(np.int64)
            code, history, count = _shared(own, order)
            gram_to = (code % np.uint64(owners)).astype(np.int64)
            for u in np.unique(np.concatenate((to, gram_to))):
                mine, theirs = to == u, gram_to == u
                out.append((int(u), shard, ASK, pack_arrays(own.words[mine], smallest(own.word_count[mine]), code[theirs],
                                                            smallest(history[theirs]), smallest(count[theirs]))))
            out.append((shard % owners, shard, STATS, pack_arrays(_own_stats(own, order, hot))))  # any owner can pass it on
        return _table(out)

    def answer(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        """The total counts, to each asker in the order it asked; one asker counts for each shared n-gram."""
        owner = key[0].as_py()
        asked = [(b, *unpack_arrays(blob)) for b, blob in _blobs(rows, ASK)]
        put = lambda k: np.concatenate([a[k] for a in asked] or [np.zeros(0, np.uint64)])
        words, back = np.unique(put(1), return_inverse=True)
        total = np.bincount(back, put(2), minlength=len(words)).astype(np.int64)
        codes, first, gram_back = np.unique(put(3), return_index=True, return_inverse=True)
        gram_total = np.bincount(gram_back, put(5), minlength=len(codes)).astype(np.int64)
        history = put(4).astype(np.int64)[first]
        counts = np.zeros(len(gram_back), bool)
        counts[first] = True
        out, at, gram_at = [], 0, 0
        for asker, theirs, _, grams, *_ in asked:
            own, own_grams = slice(at, at + len(theirs)), slice(gram_at, gram_at + len(grams))
            out.append((asker, owner, ASK, pack_arrays(smallest(total[back[own]]), smallest(gram_total[gram_back[own_grams]]),
                                                       np.packbits(counts[own_grams]))))
            at, gram_at = own.stop, own_grams.stop
        stats = Stats(order, len(hot))
        stats.words += (total.sum(), (total > 0).sum())
        stats.kinds[0] += counts_of_counts(total)
        for k in range(2, order):
            stats.kinds[k - 1] += counts_of_counts(gram_total[hot.lengths[history] == k - 1])
        stats.discounted += np.bincount(history[(gram_total > 0) & (gram_total <= CUTOFF)], minlength=len(hot))
        passed = sum((unpack_arrays(b)[0] for _, b in _blobs(rows, STATS)), stats.vector())
        return _table([*out, (-1, owner, STATS, pack_arrays(passed))])

    replies = by_group.applyInArrow(ask, "shard int, batch long, kind int, blob binary") \
        .groupBy("shard").applyInArrow(answer, "shard int, batch long, kind int, blob binary")

    def add_up(rows: pa.Table) -> pa.Table:
        """One row of statistics becomes one for each shard."""
        total = sum((unpack_arrays(b)[0] for _, b in _blobs(rows, STATS)), Stats(order, len(hot)).vector())
        blob = pack_arrays(total)
        return _table([(s, 0, STATS, blob) for s in range(shards)])

    stats = replies.filter(f"kind = {STATS}").groupBy("kind").applyInArrow(add_up, "shard int, batch long, kind int, blob binary")
    replies = replies.filter(f"kind = {ASK}").unionByName(stats)

    def finish(rows: pa.Table, heard: pa.Table) -> pa.Table:
        told = dict(_by_shard(heard))
        out, sums = [], {}
        if 0 in told:                           # every shard has heard the same statistics: one hands them on
            known = Stats(order, len(hot), unpack_arrays(_blobs(told[0], STATS)[0][1])[0])
            out.append((0, -1, HOT, pack_arrays(-1 - np.arange(len(hot) + 1), np.append(known.words[0], known.total).astype(float),
                                                np.append(0, known.discounted).astype(float))))
        for shard, own_rows in _by_shard(rows):
            more, parts = _score_shard(shard, own_rows, told[shard], owners, order, hot)
            out += more
            for batch, part in parts:
                sums.setdefault(batch, []).append(part)
        return _table(out + [(-1, batch, SUMS, _add_sums(parts)) for batch, parts in sums.items()])

    done = by_group.cogroup(grouped(replies)).applyInArrow(finish, "shard int, batch long, kind int, blob binary")
    done = materialise(done, "scores")
    learned, log_alpha = _hot_alphas(done, len(hot))

    def collect(rows: pa.Table) -> pa.Table:
        meta = _blobs(rows, META)
        if not meta:
            return OUT.empty_table()
        ids, valid, held_out, lengths = unpack_arrays(meta[0][1])
        n = len(ids)
        known, base, model = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
        for blob in [unpack_arrays(b) for _, b in _blobs(rows, SUMS)]:
            text, k, b, m, hot_text, hot_history, hot_unseen = blob
            known[text] += k
            base[text] += b
            model[text] += m
            np.add.at(model, hot_text, hot_unseen * log_alpha[hot_history.astype(np.int64)])
        return pa.table([pa.array(ids, mask=valid == 0), pa.array(held_out.astype(bool)), pa.array(lengths.astype(np.int64)),
                         pa.array(known), pa.array(np.full(n, learned)), pa.array(base), pa.array(model)], schema=OUT)

    return done.filter(f"kind in ({META}, {SUMS})").select("batch", "kind", "blob").groupBy("batch").applyInArrow(
        collect, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                 ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
ROWS = pa.schema([("shard", pa.int32()), ("batch", pa.int64()), ("kind", pa.int32()), ("blob", pa.binary())])


def _table(rows: list) -> pa.Table:
    columns = list(zip(*rows)) or [[], [], [], []]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, ROWS)], schema=ROWS)


def _by_shard(rows: pa.Table):
    """The rows of each shard of a group."""
    column = rows.column("shard")
    for shard in sorted(set(column.to_pylist())):
        yield shard, rows.filter(pc.equal(column, shard))


def _add_sums(parts: list) -> bytes:
    """The sums of one batch's texts over the shards of a group, packed."""
    text, known, base, model, *hot = (np.concatenate(x) for x in zip(*parts))
    touched = np.flatnonzero(np.bincount(text))
    add = lambda x: np.bincount(text, x)[touched]
    return pack_arrays(touched.astype(np.uint32), smallest(add(known).astype(np.int64)), add(base), add(model),
                       *(smallest(h.astype(np.int64)) for h in hot))


class Stats:
    """Numbers of the whole corpus, which add up: tokens and distinct words; counts of counts for each
    length of n-grams; for each hot history its count and how many of its n-grams are discounted."""

    def __init__(self, order: int, hot: int, vector: np.ndarray | None = None):
        sizes = np.cumsum([2, order * (CUTOFF + 1), hot])
        self.words, kinds, self.total, self.discounted = np.split(
            np.zeros(sizes[-1] + hot, np.int64) if vector is None else vector, sizes)
        self.kinds = kinds.reshape(order, CUTOFF + 1)

    def vector(self) -> np.ndarray:
        return np.concatenate((self.words, self.kinds.ravel(), self.total, self.discounted))


def _own_stats(own: Shard, order: int, hot: Hot) -> np.ndarray:
    """What a shard can tell of n-grams that it alone has, and its part of the counts of hot histories."""
    stats = Stats(order, len(hot))
    for k, level in own.levels.items():
        if k > order:
            continue
        whole = np.full(len(level.count), k == order) | ~level.shared
        stats.kinds[k - 1] += counts_of_counts(level.count[whole])
        history = level.hot[level.history]
        stats.total += np.bincount(history[level.shared], level.count[level.shared], minlength=len(hot)).astype(np.int64)
        small = level.shared & whole & (level.count > 0) & (level.count <= CUTOFF)
        stats.discounted += np.bincount(history[small], minlength=len(hot))
    return stats.vector()


def _shared(own: Shard, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, hot histories and own counts of the n-grams that other shards may have too, length by length."""
    asked = [(own.levels[k], at) for k, at in own.asked(order)]
    put = lambda make, kind: np.concatenate([make(level, at) for level, at in asked] or [np.zeros(0, kind)])
    return (put(lambda level, at: level.code[at], np.uint64), put(lambda level, at: level.hot[level.history[at]], np.int64),
            put(lambda level, at: level.count[at], np.int64))


def _score_shard(shard: int, rows: pa.Table, heard: pa.Table, owners: int, order: int, hot: Hot) -> tuple[list, list]:
    """Rows to send on, and ``(batch, sums of its texts)``."""
    out = [(shard, b, META, blob) for b, blob in _blobs(rows, META)]
    sent, width = _blobs(rows, ASK), max(order, 2)
    if not sent:
        return out, []
    stats = Stats(order, len(hot), unpack_arrays(_blobs(heard, STATS)[0][1])[0])
    own = Shard([b for _, b in sent], width, hot)
    count, to = np.zeros(len(own.words), np.int64), (own.words % np.uint64(owners)).astype(np.int64)
    code, _, _ = _shared(own, order)
    gram_count, gram_to, mine = np.zeros(len(code), np.int64), (code % np.uint64(owners)).astype(np.int64), np.zeros(len(code), bool)
    for owner, blob in _blobs(heard, ASK):
        words, grams, counts = unpack_arrays(blob)
        count[to == owner] = words
        gram_count[gram_to == owner] = grams
        mine[gram_to == owner] = np.unpackbits(counts, count=len(grams)).astype(bool)
    counts_here, at = {}, 0                     # n-grams whose history's sums this shard answers for
    for k, places in own.asked(order):
        own.levels[k].count[places] = gram_count[at:at + len(places)]
        counts_here[k] = np.ones(len(own.levels[k].count), bool)
        counts_here[k][places] = mine[at:at + len(places)]
        at += len(places)

    unigram = Unigram(int(stats.words[0]), int(stats.words[1]), stats.kinds[0])
    base = unigram.base(count)
    p = unigram.p(count)                        # of the n-grams one shorter, where seen
    log_p = np.log10(p)                         # the same, seen or not, but for the weights of hot histories
    word = np.arange(len(count))                # the last word of each n-gram
    events = []                                 # for each length: hot history whose weight is still to be added, or -1
    for k in range(2, width + 1):
        level = own.levels[k]
        down, word = level.down, word[level.down]
        events = [e[down] for e in events]
        if k > order:                           # a model of single words: the pairs only carry them
            log_p = log_p[down]
            continue
        d = discounts(stats.kinds[k - 1])
        seen, is_hot = level.count > 0, level.hot >= 0
        sums = lambda x, at: np.bincount(level.history[at], x[at], level.histories).astype(np.float64)  # noqa: E731, B023
        total = sums(level.count.astype(np.float64), seen)
        fine = sums(np.ones(len(seen)), seen & (level.count <= CUTOFF))
        total[is_hot], fine[is_hot] = stats.total[level.hot[is_hot]], stats.discounted[level.hot[is_hot]]
        kept = d[np.minimum(level.count, CUTOFF + 1)] * level.count
        own_share = seen & counts_here.get(k, True)
        mass, covered = sums(kept, own_share), sums(p[down], own_share)
        learned = np.flatnonzero((total > 0) & ~is_hot)
        log_alpha = np.zeros(level.histories)
        log_alpha[learned] = _log_weight(total[learned], fine[learned], mass[learned], covered[learned])
        if is_hot.any():
            out.append((shard, -1, HOT, pack_arrays(level.hot[is_hot], mass[is_hot], covered[is_hot])))
        reserve = np.where(fine > 0, 1.0, total / (total + 1))
        safe = np.maximum(total, 1)
        p = kept / safe[level.history] * reserve[level.history]
        with np.errstate(divide="ignore"):
            log_p = np.where(seen, np.log10(p), log_p[down] + log_alpha[level.history])
        events.append(np.where(seen, -1, level.hot[level.history]))

    parts = []
    for (batch, _), part, gram in zip(sent, own.parts, own.of):
        entry = gram[part.gram]  # of each entry, its distinct n-gram
        n = len(part.learn)
        text, last = part.text.astype(np.int64), word[entry]
        touched = np.flatnonzero(np.bincount(text, minlength=n))
        add = lambda x: np.bincount(text, x, minlength=n)[touched]  # noqa: E731, B023
        pending = [(text[at], e[entry[at]]) for e in events for at in [np.flatnonzero(e[entry] >= 0)]]
        key = np.concatenate([t * len(hot) + h for t, h in pending] or [np.zeros(0, np.int64)])
        key, misses = np.unique(key, return_counts=True)
        parts.append((batch, (touched, add(count[last] > 0), add(base[last]), add(log_p[entry]),
                              key // max(1, len(hot)), key % max(1, len(hot)), misses)))
    return out, parts


def _log_weight(total, discounted, kept, covered) -> np.ndarray:
    """log10 of what a history's discounts leave, over what the shorter history gives to the words not seen after it."""
    left = np.where(discounted > 0, (total - kept) / np.maximum(total, 1), 1 / (total + 1))
    return np.log10(np.maximum(left, 1e-300) / np.maximum(1 - covered, 1e-300))


def _hot_alphas(done: DataFrame, hot: int) -> tuple[int, np.ndarray]:
    """The learning tokens, and the log10 weight of each hot history, from sums added up by Spark.

    History ``h`` has its discounted count and covered mass under ``h``, its count
    and number of discounted n-grams under ``-2 - h``; the tokens are under -1.
    """
    def rows_of(batches):
        for batch in batches:
            for blob in column_of(batch, "blob").to_pylist():
                h, a, b = unpack_arrays(blob)
                yield pa.RecordBatch.from_arrays([pa.array(h.astype(np.int64)), pa.array(a), pa.array(b)], ["h", "a", "b"])

    rows = done.filter(f"kind = {HOT}").select("blob").mapInArrow(rows_of, "h long, a double, b double") \
        .groupBy("h").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect()  # at most two a hot history
    sums = np.zeros((2, 2 * hot + 1))           # from the end: negative places
    for h, a, b in rows:
        sums[:, h] = a, b
    (kept, total), (covered, discounted) = ((x[:hot], x[hot:-1][::-1]) for x in sums)
    return int(sums[0, -1]), np.where(total > 0, _log_weight(total, discounted, kept, covered), 0.0)

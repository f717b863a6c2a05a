"""SimHash near-duplicates: fingerprints linked at a small Hamming distance.

Fingerprints are made in Arrow batches from the whole text. Equal ones are
collapsed first, so a group of copies is one fingerprint from then on. The
distinct fingerprints are partitioned by a vantage-point tree: a node holds a
vantage fingerprint and a distance; the triangle inequality says that two
fingerprints within ``max_bits`` of each other differ by at most ``max_bits`` in
their distance to the vantage, so sending those within half of it of the
boundary to both sides puts every linked pair in one shard. The shards are the
leaves of a tree built over a sample (one fingerprint in ``SHARD / 16``); in a
shard the same split goes on down to small buckets, where pairs are compared.
A shard gives back only a spanning forest of its links (at most one edge for
each fingerprint), and the forests are joined into components by contracting
stars, in rounds written to the shared folder.

Defined results: null or blank text has fingerprint zero and links like any
other. A row with a null ``doc_id`` gets its fingerprint, links to nothing and
has a null component. Rows repeated in the input are in one component. Other
columns, whatever their names, play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxmesh.llm.common import as_bytes, column_of, record
from wxmesh.session import materialise

SHARD, BUCKET = 16384, 128
SEED = 42
FORMS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])


def fingerprint(raw: bytes, words_in_shingle: int = 3) -> int:
    """Bits that are set in over half of the hashes of the word shingles."""
    words = raw.lower().split()  # bytes: lower() is A-Z only, split() is \x20 and \x09-\x0D
    if not words:
        return 0
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = ends - np.diff(ends, prepend=0)
    n = max(1, len(words) - words_in_shingle + 1)
    stops = (ends[words_in_shingle - 1:] - 1).tolist() if len(words) >= words_in_shingle else [len(text)]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    hashes = np.fromiter((digest(text[a:b], SEED) for a, b in zip(starts[:n].tolist(), stops)), "<u8", n)
    for at in range(0, n, 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words_in_shingle: int) -> DataFrame:
    def rows(batches):
        for batch in batches:
            codes = np.array([fingerprint(b, words_in_shingle) for b in as_bytes(column_of(batch, "text"))], np.uint64)
            yield record(FORMS, column_of(batch, "doc_id"), codes.view(np.int64))

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, fp long")


def distances(codes: np.ndarray, vantage) -> np.ndarray:
    return np.bitwise_count(codes ^ vantage).astype(np.int16)


def choose(codes: np.ndarray) -> tuple[np.uint64, int]:
    """Of a few fingerprints the one with the widest spread of distances, and the best boundary for it."""
    spread = [(float(distances(codes, v).std()), v) for v in codes[:: max(1, len(codes) // 8)][:8]]
    vantage = max(spread)[1]
    return vantage, int(np.median(distances(codes, vantage)))


def split(codes: np.ndarray, vantage, boundary: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks of the two sides; a fingerprint near the boundary is on both."""
    d = distances(codes, vantage)
    below = max_bits // 2
    return d <= boundary + max_bits - below, d > boundary - below


class Tree:
    """Top of the vantage-point tree, as arrays: node k has children 2k+1 and 2k+2."""

    def __init__(self, sample: np.ndarray, depth: int, max_bits: int):
        self.depth, self.max_bits = depth, max_bits
        size = (1 << depth) - 1
        self.vantage, self.boundary = np.zeros(size, np.uint64), np.full(size, 64, np.int64)
        own = {0: sample}
        for k in range(size):
            codes = own.pop(k)
            if len(codes) > 1:
                self.vantage[k], self.boundary[k] = choose(codes)
            inside = distances(codes, self.vantage[k]) <= self.boundary[k]
            own[2 * k + 1], own[2 * k + 2] = codes[inside], codes[~inside]

    def route(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``codes`` and the leaves that they go to."""
        at, node, below = np.arange(len(codes)), np.zeros(len(codes), np.int64), self.max_bits // 2
        for _ in range(self.depth):
            d = distances(codes[at], self.vantage[node])
            low = d <= self.boundary[node] + self.max_bits - below
            high = d > self.boundary[node] - below
            at, node = np.concatenate((at[low], at[high])), np.concatenate((2 * node[low] + 1, 2 * node[high] + 2))
        return at, node


class Forest:
    """Union-find over positions; the smallest position of a set is its root."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, k: int) -> int:
        p = self.parent
        while p[k] != k:
            p[k] = p[p[k]]
            k = p[k]
        return k

    def join(self, a, b) -> None:
        for x, y in zip(a.tolist(), b.tolist()):
            x, y = self.root(x), self.root(y)
            if x != y:
                self.parent[max(x, y)] = min(x, y)


def link(codes: np.ndarray, max_bits: int) -> np.ndarray:
    """Root position of each of the distinct, sorted ``codes`` under links of at most ``max_bits``."""
    forest, stack = Forest(len(codes)), [np.arange(len(codes))]
    while stack:
        own = stack.pop()
        part = codes[own]
        if len(own) > BUCKET:
            vantage, boundary = choose(part)
            low, high = split(part, vantage, boundary, max_bits)
            if max(low.sum(), high.sum()) < 0.9 * len(own):
                stack += [own[low], own[high]]
                continue
        # A small bucket, or one that no vantage splits: compare by rows, or where that is more
        # work than trying every change of up to two bits, look the changed fingerprints up.
        if len(own) <= 4096 or max_bits > 2:
            for at in range(0, len(own), 256):
                near = np.argwhere(np.bitwise_count(part[at:at + 256, None] ^ part[None, :]) <= max_bits)
                near = near[near[:, 0] + at < near[:, 1]]
                forest.join(own[near[:, 0] + at], own[near[:, 1]])
        else:
            bit = np.uint64(1) << np.arange(64, dtype=np.uint64)
            i, j = np.triu_indices(64, 1)
            masks = np.concatenate((bit if max_bits else bit[:0], bit[i] | bit[j] if max_bits > 1 else bit[:0]))
            for mask in masks:
                other = part ^ mask
                at = np.minimum(np.searchsorted(part, other), len(part) - 1)
                hit = np.flatnonzero((part[at] == other) & (part < other))
                forest.join(own[hit], own[at[hit]])
    return np.array([forest.root(k) for k in range(len(codes))], np.int64)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` (the smallest node reachable) for the nodes of ``edges(a, b)``, by contracting stars.

    Each round: every larger neighbour of a node is linked to its smallest
    neighbour, then every node and its smaller neighbours to the smallest of
    them. It ends when a round changes nothing. Each round is written to the
    shared folder, so a lost executor costs at most one round.
    """
    def checked(df):
        df = materialise(df.filter("a > b").distinct(), "stars")
        return df, df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges, state = checked(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    while state[0]:
        both = edges.select("a", "b").unionByName(edges.selectExpr("b as a", "a as b"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").selectExpr("b as a", "m as b").filter("a > b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").selectExpr("b as a", "m as b").unionByName(low.selectExpr("a", "m as b"))
        edges, now = checked(small)
        if now == state:
            break
        state = now
    return edges.selectExpr("a as node", "b as root")


def near_duplicates(docs: DataFrame, words_in_shingle: int = 3, max_bits: int = 2, shard: int = SHARD) -> DataFrame:
    """Per row of ``docs``: ``doc_id, fingerprint`` (hex), ``component_id`` (smallest reachable doc_id)."""
    forms = materialise(fingerprints(docs, words_in_shingle), "fingerprints")
    groups = materialise(forms.filter("doc_id is not null").groupBy("fp")
                         .agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "distinct")
    total = groups.count()
    depth = max(0, int(np.ceil(np.log2(max(1, total) / shard))))
    sample = groups.select("fp").filter(F.pmod(F.xxhash64("fp"), F.lit(max(1, shard // 16))) == 0).collect() if depth else []
    tree = Tree(np.sort(np.array([r["fp"] for r in sample], np.int64).view(np.uint64)), depth, max_bits)

    def routed(batches):
        for batch in batches:
            at, leaf = tree.route(column_of(batch, "fp").to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(leaf), column_of(batch, "fp").take(pa.array(at)),
                                              column_of(batch, "rep").take(pa.array(at))], ["leaf", "fp", "rep"])

    def forest(shard_rows: pa.Table) -> pa.Table:
        codes = shard_rows.column("fp").to_numpy().view(np.uint64)
        order = np.argsort(codes)
        rep = shard_rows.column("rep").to_numpy()[order]
        root = link(codes[order], max_bits)
        away = root != np.arange(len(root))
        return pa.table({"a": rep[away], "b": rep[root[away]]})

    edges = groups.select("fp", "rep").mapInArrow(routed, "leaf long, fp long, rep long") \
        .groupBy("leaf").applyInArrow(forest, "a long, b long")
    roots = components(edges)
    classes = groups.join(roots, groups["rep"] == roots["node"], "left") \
        .filter("n > 1 or root is not null").select("fp", F.coalesce("root", "rep").alias("least"))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return forms.join(classes, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), own.alias("component_id"))

"""The prefix trie of conversations, built by truncation peeling.

A turn stands as 16 bytes of the SHA-256 of its role and text, so the texts
never leave the task that reads them; a conversation is the string of its turns'
digests, and a trie node is a prefix of such strings.

1. Conversations are dealt by ranges of (digest string, id) and sorted: the
   members of a node then lie side by side, and a group of copies, however
   large, is spread over as many tasks as it needs.
2. A task takes its share in blocks. A block is peeled from its greatest depth
   down: the conversations that end at a depth join the nodes that survive from
   below, equal prefixes are grouped, the groups are nodes of that depth with
   all their sums, and the last turn is stripped. Groups are never looked up: two
   neighbours share a node exactly if the common prefix between them is long
   enough.
3. Only nodes that the first or the last conversation of a block passes through
   can go on in another block. They are peeled again, block by block and
   then task by task, from what each block knows of them: at most two rows per
   depth and block, whatever the block holds. All other nodes are finished.
4. The ids of the conversations that end at a node are hashed in ascending order:
   on the spot for a finished node, otherwise from one stretch of digits per
   block, streamed through the hash.

Defined results: turns are ordered by number, null first, then by role and by
digest, so repeated numbers have a fixed order and repeated rows are turns each;
null role or text counts as empty; rows without a conversation id belong to no
conversation and are left out; other columns, whatever their names, play no part.
An empty table has no node, not even the root. Two turns count as equal if
their 128-bit digests are. A conversation is one value of 24 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxmesh.llm.common import column_of, record
from wxmesh.session import materialise

DIGEST = 16
#: A block is closed once it holds this many conversations or bytes of digests.
BLOCK_ROWS, BLOCK_BYTES = 1 << 15, 1 << 23
#: Parts whose open nodes are peeled again in one task.
FAN_IN = 64
#: Rows of open nodes up to which their ids are sent to every task.
BROADCAST_ROWS = 1 << 17
EMPTY_HASH = hashlib.sha256().hexdigest()

#: ``node``: a finished node; ``open``: what a part of the conversations adds to a node that goes on in
#: other parts (without its open children); ``ends``: ids that end at such a node.
ROWS = pa.schema([("kind", pa.string()), ("part", pa.int64()), ("depth", pa.int64()), ("conv_id", pa.int64()),
                  ("parent_conv_id", pa.int64()), ("key", pa.binary()), ("parent_key", pa.binary()),
                  ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                  ("saved_tokens", pa.int64()), ("n_bytes", pa.int64()), ("goes_left", pa.bool_()),
                  ("goes_right", pa.bool_()), ("ends", pa.string()), ("at", pa.int64())])
DDL = ("kind string, part long, depth long, conv_id long, parent_conv_id long, key binary, parent_key binary, n_convs long, "
       "n_children long, n_leaves long, saved_tokens long, n_bytes long, goes_left boolean, goes_right boolean, "
       "ends string, at long")


def rebuilt(turns: DataFrame, share: int = 5, lends: int = 9) -> DataFrame:
    """Conversations that begin as another one does: ``conv_id, path, sizes``.

    Conversation c takes the first crc32(c) mod ``lends`` turns from conversation
    c - c mod ``share`` and goes on with its own turns after as many.
    ``path`` is the digests end to end, ``sizes`` the UTF-8 bytes of the texts.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256),
                         1, 2 * DIGEST)
    one = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.struct(F.col("turn"), role.alias("role"), digest.alias("digest"),
                                                F.octet_length(text).cast("long").alias("size")).alias("_turn"))
    own = one.groupBy("conv_id").agg(F.sort_array(F.collect_list("_turn")).alias("_own")) \
        .select("conv_id", F.col("_own.digest").alias("_digests"), F.col("_own.size").alias("_sizes"))
    own = materialise(own, "conversations")
    first = own.filter(F.col("conv_id") % share == 0).select(
        F.col("conv_id").alias("_from"), F.slice("_digests", 1, lends - 1).alias("_lent"),
        F.slice("_sizes", 1, lends - 1).alias("_lent_sizes"))
    n = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % lends).cast("int")
    both = own.withColumn("_from", F.col("conv_id") - F.col("conv_id") % share).join(first, "_from", "left")

    def spliced(lent: str, mine: str) -> Column:
        return F.concat(F.slice(F.coalesce(F.col(lent), F.array().cast(own.schema[mine].dataType)), F.lit(1), n),
                        F.slice(mine, n + 1, F.greatest(F.size(mine), F.lit(1))))

    return both.select("conv_id", F.unhex(F.array_join(spliced("_lent", "_digests"), "")).alias("path"),
                       spliced("_lent_sizes", "_sizes").alias("sizes"))


class Nodes:
    """Rows of ``ROWS``, gathered column by column."""

    def __init__(self):
        self.columns = {name: [] for name in ROWS.names}

    def add(self, n: int, **values) -> None:
        for name, held in self.columns.items():
            value = values.get(name)
            held.extend(value if isinstance(value, list) else [value] * n)

    def batch(self) -> pa.RecordBatch:
        columns, self.columns = self.columns, {name: [] for name in ROWS.names}
        return record(ROWS, *columns.values())


def _common(digests: np.ndarray, start: np.ndarray, turns: np.ndarray) -> np.ndarray:
    """Turns that each conversation shares with the one before it; -1 for the first."""
    common = np.zeros(len(turns), np.int64)
    alive, d = np.arange(1, len(turns)), 0
    while len(alive):
        alive = alive[(turns[alive] > d) & (turns[alive - 1] > d)]
        alive = alive[(digests[start[alive] + d] == digests[start[alive - 1] + d]).all(axis=1)]
        d += 1
        common[alive] = d
    common[0] = -1
    return common


def peel_block(conv: np.ndarray, paths: list[bytes], sizes: np.ndarray, part: int, out: Nodes) -> list[dict]:
    """Peel sorted conversations: finished nodes and stretches of ids go to ``out``, open nodes are returned."""
    turns = np.array([len(p) // DIGEST for p in paths], np.int64)
    start = np.concatenate(([0], np.cumsum(turns)))[:-1]
    digests = np.frombuffer(b"".join(paths), np.uint64).reshape(-1, 2)
    common = _common(digests, start, turns)
    last = len(conv) - 1

    # Ids that end at each distinct conversation, in ascending order.
    whole = np.flatnonzero(np.append(common[1:] < np.maximum(turns[1:], turns[:-1]), True))  # last row of each distinct one
    begin = np.concatenate(([0], whole[:-1] + 1))
    ids, ended = conv.tolist(), {}
    for lo, hi in zip(begin.tolist(), whole.tolist()):
        ended[lo] = ",".join(map(str, ids[lo:hi + 1]))

    # The keys of the nodes that may be open: all prefixes of the first and of the last conversation.
    keys = []
    for path in (paths[0], paths[last]):
        state, own = hashlib.sha256(), [hashlib.sha256().digest()[:DIGEST]]
        for at in range(0, len(path), DIGEST):
            state.update(path[at:at + DIGEST])
            own.append(state.digest()[:DIGEST])
        keys.append(own)

    by_depth = np.argsort(turns, kind="stable")
    edges = np.searchsorted(turns[by_depth], np.arange(int(turns.max()) + 2))
    none = np.zeros(0, np.int64)
    row, n, low, kids, leaves, saved, is_open = none, none, none, none, none, none, np.zeros(0, bool)
    waiting = None  # the finished nodes one turn deeper, whose parent is found next
    opened: list[dict] = []
    for depth in range(int(turns.max()), -1, -1):
        new = by_depth[edges[depth]:edges[depth + 1]]
        old, fresh = len(row), len(new)
        order = np.argsort(np.concatenate((row, new)), kind="stable")
        at = np.concatenate((row, new))[order]
        child = np.concatenate((np.ones(old, np.int64), np.zeros(fresh, np.int64)))[order]
        child[order < old] = ~is_open[order[order < old]]  # an open child is counted when it is finished
        head = common[at] < depth
        head[0] = True
        groups = np.flatnonzero(head)
        number = np.cumsum(head) - 1

        def merged(values, fill):
            return np.concatenate((values, np.full(fresh, fill, np.int64) if np.isscalar(fill) else fill))[order]

        n = np.add.reduceat(merged(n, 1), groups)
        low = np.minimum.reduceat(merged(low, conv[new]), groups)
        kids = np.add.reduceat(child, groups)
        leaves = np.add.reduceat(merged(leaves, 0), groups)
        saved = np.add.reduceat(merged(saved, 0), groups)
        row = at[groups]
        goes_left = np.zeros(len(row), bool)
        goes_left[0] = turns[0] >= depth
        goes_right = np.zeros(len(row), bool)
        goes_right[-1] = turns[last] >= depth
        is_open = goes_left | goes_right
        size = sizes[start[row] + depth - 1] if depth else np.zeros(len(row), np.int64)
        key_of = {}
        for g in np.flatnonzero(is_open).tolist():
            side = 0 if goes_left[g] else 1
            key_of[g] = keys[side][depth]
            opened.append({"part": part, "depth": depth, "key": keys[side][depth], "parent_key": keys[side][depth - 1] if depth else None,
                           "conv_id": int(low[g]), "n_convs": int(n[g]), "n_children": int(kids[g]), "n_leaves": int(leaves[g]),
                           "saved_tokens": int(saved[g]), "n_bytes": int(size[g]), "goes_left": bool(goes_left[g]),
                           "goes_right": bool(goes_right[g])})
            if turns[row[g]] == depth:
                out.add(1, kind="ends", part=part, depth=depth, key=keys[side][depth], ends=ended[int(row[g])], at=part)
        if waiting is not None:
            parent = number[np.searchsorted(at, waiting.pop("row"))]
            finished = [None if g in key_of else int(low[g]) for g in parent.tolist()]
            out.add(len(finished), kind="node", parent_conv_id=finished,
                    parent_key=[key_of.get(g) for g in parent.tolist()], **waiting)
        done = np.flatnonzero(~is_open)
        leaves[done] += kids[done] == 0
        saved[done] += (n[done] - 1) * size[done]
        waiting = {"row": row[done], "depth": depth, "conv_id": low[done].tolist(), "n_convs": n[done].tolist(),
                   "n_children": kids[done].tolist(), "n_leaves": leaves[done].tolist(), "saved_tokens": saved[done].tolist(),
                   "ends": [hashlib.sha256(ended[r].encode()).hexdigest() if t == depth else EMPTY_HASH
                            for r, t in zip(row[done].tolist(), turns[row[done]].tolist())]}
        for values in (n, kids, leaves, saved):  # what is open tells its own block's share only, so nothing of it is handed on
            values[is_open] = 0
    return opened


def peel_open(rows: list[dict], part: int, out: Nodes, final: bool) -> list[dict]:
    """Peel the open nodes of neighbouring parts: what now is finished goes to ``out``, the rest is returned."""
    first, last = min(r["part"] for r in rows), max(r["part"] for r in rows)
    by_depth = defaultdict(list)
    for r in rows:
        by_depth[r["depth"]].append(r)
    survivors: list[dict] = []
    opened = []
    for depth in range(max(by_depth), -1, -1):
        groups: dict[bytes, dict] = {}
        for r in by_depth[depth]:
            g = groups.get(r["key"])
            if g is None:
                g = groups[r["key"]] = r | {"part": part, "goes_left": False, "goes_right": False}
            else:
                g["conv_id"] = min(g["conv_id"], r["conv_id"])
                for name in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                    g[name] += r[name]
            if not final:
                g["goes_left"] |= r["goes_left"] and r["part"] == first
                g["goes_right"] |= r["goes_right"] and r["part"] == last
        for child in survivors:
            parent = groups[child["parent_key"]]
            parent["conv_id"] = min(parent["conv_id"], child["conv_id"])
            if not (child["goes_left"] or child["goes_right"]):
                parent["n_children"] += 1
                for name in ("n_convs", "n_leaves", "saved_tokens"):
                    parent[name] += child[name]
        for child in survivors:
            if not (child["goes_left"] or child["goes_right"]):
                parent = groups[child["parent_key"]]
                ahead = parent["goes_left"] or parent["goes_right"]
                out.add(1, **child | {"kind": "merged", "parent_conv_id": None if ahead else parent["conv_id"]})
        survivors = list(groups.values())
        for g in survivors:
            if g["goes_left"] or g["goes_right"]:
                opened.append(dict(g))
            else:
                g["n_leaves"] += g["n_children"] == 0
                g["saved_tokens"] += (g["n_convs"] - 1) * g["n_bytes"]
    for root in survivors:
        if not (root["goes_left"] or root["goes_right"]):
            out.add(1, **root | {"kind": "merged", "parent_conv_id": None})
    return opened


def _peel_sorted(block_rows: int):
    """Blocks of a task's share, and then the open nodes of these blocks as those of one part."""

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, opened = TaskContext.get().partitionId(), Nodes(), []
        held: list[pa.RecordBatch] = []
        rows = size = block = 0

        def peel() -> None:
            nonlocal opened, block
            lot = pa.Table.from_batches(held)
            sizes = pa.concat_arrays([c.flatten() for c in lot["sizes"].chunks]).to_numpy(zero_copy_only=False)
            mark = len(out.columns["kind"])
            more = peel_block(lot["conv_id"].to_numpy(), lot["path"].to_pylist(), sizes, block, out)
            for name, value in (("part", part), ("at", (part << 32) | block)):  # blocks are numbered within a task
                out.columns[name][mark:] = [value if kind == "ends" else None for kind in out.columns["kind"][mark:]]
            block += 1
            opened = peel_open(opened + more, block - 1, out, False) if opened else more
            for r in opened:
                r["part"] = block - 1

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, block_rows - rows)
                at += piece.num_rows
                held.append(piece)
                rows, size = rows + piece.num_rows, size + piece.nbytes
                if rows >= block_rows or size >= BLOCK_BYTES:
                    peel()
                    held, rows, size = [], 0, 0
                    yield out.batch()
        if held:
            peel()
        for r in opened:
            out.add(1, **r | {"kind": "open", "part": part})
        yield out.batch()

    return share


def _peel_parts(final: bool, fan_in: int):
    def peel(group: pa.Table) -> pa.Table:
        out = Nodes()
        rows = group.to_pylist()
        part = rows[0]["part"] // fan_in
        for r in peel_open(rows, part, out, final):
            out.add(1, **r | {"kind": "open", "part": part})
        return pa.Table.from_batches([out.batch()])

    return peel


def _hash_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash per key over its stretches of ids, which come in order."""
    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
    current, state = None, None
    for batch in batches:
        done = []
        for key, ends in zip(column_of(batch, "key").to_pylist(), column_of(batch, "ends").to_pylist()):
            if key != current:
                if current is not None:
                    done.append((current, state.hexdigest()))
                current, state = key, hashlib.sha256(ends.encode())
            else:
                state.update(b"," + ends.encode())
        if done:
            yield record(schema, *zip(*done))
    if current is not None:
        yield record(schema, [current], [state.hexdigest()])


def trie(conversations: DataFrame, parts: int | None = None, block_rows: int = BLOCK_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """Nodes of ``(conv_id, path, sizes)``: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    spark = conversations.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialise(conversations.select("conv_id", "path", "sizes"), "paths") \
        .repartitionByRange(parts, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    peeled = materialise(dealt.mapInArrow(_peel_sorted(block_rows), DDL), "peeled")
    opened, joined, n = peeled.filter("kind = 'open'"), peeled.filter("kind = 'merged'"), parts
    while True:  # as many rounds as it takes to bring the parts to one: two for 4096
        n = -(-n // fan_in)
        again = materialise(opened.groupBy((F.col("part") / fan_in).cast("long").alias("_to"))
                            .applyInArrow(_peel_parts(n == 1, fan_in), DDL), "peeled-again")
        joined = joined.unionByName(again.filter("kind = 'merged'"))
        if n == 1:
            break
        opened = again.filter("kind = 'open'")
    hashes = peeled.filter("kind = 'ends'").select("key", "at", "ends").repartition("key") \
        .sortWithinPartitions("key", "at").mapInArrow(_hash_stretches, "key binary, ends_sha256 string")
    joined = materialise(joined.drop("ends").join(hashes, "key", "left")
                         .withColumn("ends", F.coalesce("ends_sha256", F.lit(EMPTY_HASH))).drop("ends_sha256"), "joined")
    names = joined.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    if joined.count() <= BROADCAST_ROWS:
        names = F.broadcast(names)
    known = ["conv_id", "depth", "parent_conv_id", "parent_key", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    nodes = peeled.filter("kind = 'node'").select(known).unionByName(joined.select(known)).join(names, "parent_key", "left")
    return nodes.select("conv_id", "depth", F.coalesce("parent_conv_id", "_parent").alias("parent_conv_id"), "n_convs",
                        "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256"))

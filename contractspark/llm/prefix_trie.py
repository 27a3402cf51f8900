"""Prefix trie of conversations by a splitter skeleton: which turns conversations share from their start on, and what it saves.

A conversation is a path: 16 bytes a turn (MD5 of role and text, lengths included). Paths are ordered by bytes, then id, and
range-partitioned by sampled splitters. The trie of the splitters' paths is the skeleton. Only its nodes can have members in
more than one shard: if two rows below a node lie in different shards, the splitter between them begins with that node's path.
So the skeleton is broadcast, and each shard, sorted, finishes all other nodes in one pass with a stack of the open nodes; for
the skeleton's nodes it sends partial aggregates (of the few on the paths of its two splitters), which are summed by node and
then added up from the leaves to the root. Splitters are thinned until the skeleton has at most ``SKELETON`` nodes, which
bounds the broadcast and that last step at any size of the input; hot conversations are cut by their ids.

The digest of the ids that end at a node reads them in ascending order, a stream by its nature: in the shard, or, for a
skeleton node, from chunks of ids that shards send in order, read one by one.

A node row names its smallest member and its depth, which together locate its turns: the first ``depth`` of that conversation.

Defined cases: null role and text are empty; null turns come first, equal turns go by the MD5 of their content; rows without
id are in no conversation; repeated rows are turns of their own; without conversations there is no node, not even the root.
A conversation is one row of 20 bytes a turn, however long its texts are. The result has columns of its own only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractspark.llm.common import stored
from contractspark.llm.ranges import even_splitters, sampled, shard_of

#: Sampled paths per shard, bytes of all of them, and nodes of the skeleton, at most.
SAMPLED, SAMPLE_BYTES, SKELETON = 32, 64 << 20, 1 << 20
#: Characters of ids in a chunk of a skeleton node's ends.
CHUNK = 1 << 16
WIDTH = 16
NODE = "kind int, skel long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string"
RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
FINISHED, BELOW_SKELETON, PARTIAL, ENDS = range(4)
EMPTY = hashlib.sha256().hexdigest()


def conversation_paths(turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, path, words): a conversation's turns in order, 16 bytes each, and the number of words of each.

    Texts are hashed before they move, so a row of the exchange has a few dozen bytes.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    each = turns.select(F.col(f"`{id_col}`").cast("long").alias("conv_id"), F.struct(F.col(f"`{turn_col}`").alias("turn"), digest.alias("digest"), words.alias("words")).alias("t"))
    own = each.where("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return own.select("conv_id", F.unhex(F.array_join(F.col("t.digest"), "")).alias("path"), F.col("t.words").alias("words"))


def with_shared_heads(paths: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Each conversation c with the first ``crc32(c) % most`` turns of conversation ``c - c % every`` in place of its own."""
    n = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    heads = paths.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("_from"), F.substring("path", 1, WIDTH * (most - 1)).alias("_head"),
                                                              F.slice("words", 1, most - 1).alias("_words"))
    both = paths.join(heads, F.col("conv_id") - F.col("conv_id") % every == F.col("_from"), "left").withColumn("_n", n.cast("int"))
    whole = lambda c, empty: F.coalesce(c, empty)
    path = F.concat(whole(F.substring(F.col("_head"), F.lit(1), F.col("_n") * WIDTH), F.lit(b"")), F.substring(F.col("path"), F.col("_n") * WIDTH + 1, F.octet_length("path")))
    words = F.concat(whole(F.slice("_words", F.lit(1), F.col("_n")), F.array().cast("array<int>")), F.slice("words", F.col("_n") + 1, F.greatest(F.size("words"), F.lit(1))))
    return both.select("conv_id", path.alias("path"), words.alias("words"))


def shared(a: bytes, b: bytes) -> int:
    """Turns that two paths share from their start on."""
    most = min(len(a), len(b)) // WIDTH
    if a[:WIDTH * most] == b[:WIDTH * most]:
        return most
    x, y = (np.frombuffer(p, np.uint64, 2 * most) for p in (a, b))
    return int(np.flatnonzero(x != y)[0]) // 2


class Skeleton:
    """The trie of the splitters' paths; node 0 is the root."""

    def __init__(self, paths: list[bytes], words: list[list[int]]):
        self.paths, self.parent, self.words, self.depth, self.nodes = paths, [-1], [0], [0], []
        before, at = b"", [0]
        for path, own in zip(paths, words):
            at = at[:shared(before, path) + 1]
            for d in range(len(at), len(path) // WIDTH + 1):
                at.append(len(self.parent))
                self.parent.append(at[-2])
                self.words.append(own[d - 1])
                self.depth.append(d)
            self.nodes.append(np.array(at, np.int64))
            before = path

    def on(self, shard: int, path: bytes) -> np.ndarray:
        """The skeleton's nodes that a path of the shard begins with, from the root down."""
        best, depth = np.zeros(1, np.int64), 0
        for k in (shard - 1, shard):
            if 0 <= k < len(self.paths) and (d := shared(self.paths[k], path)) > depth:
                best, depth = self.nodes[k][:d + 1], d
        return best


class _Node:
    __slots__ = ("depth", "n", "least", "children", "leaves", "saved", "words", "ends", "rows")

    def __init__(self, depth: int, words: int):
        self.depth, self.words, self.n, self.least, self.children, self.leaves, self.saved = depth, words, 0, None, 0, 0, 0
        self.ends, self.rows = None, []  # rows: finished children, which wait for this node's smallest member

    def add(self, n: int, least: int, leaves: int, saved: int) -> None:
        self.n, self.leaves, self.saved = self.n + n, self.leaves + leaves, self.saved + saved
        self.least = least if self.least is None else min(self.least, least)


def finish_shard(skeleton: Skeleton, chunk: int):
    """The task over a sorted shard of (shard, path, conv_id, words): node rows, partial aggregates and ends (``NODE``)."""
    names = [c.split()[0] for c in NODE.split(", ")]

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        open_: list[_Node] = []  # the open nodes outside the skeleton, one below the other
        partial: dict[int, _Node] = {}
        ends: dict[int, tuple[int, list[str]]] = {}
        path, above = None, np.zeros(1, np.int64)

        def finished(node: _Node, parent: _Node | None) -> None:
            row = (node.least, node.depth, node.n, node.children, node.leaves or 1, node.saved + (node.n - 1) * node.words, node.ends and node.ends.hexdigest())
            out.extend((FINISHED, None, c, d, node.least, *rest) for c, d, *rest in node.rows)
            if parent is None:  # the skeleton's node gets it; its smallest member is known when all shards are
                skel = int(above[node.depth - 1])
                parent = partial.setdefault(skel, _Node(node.depth - 1, 0))
                out.append((BELOW_SKELETON, skel, row[0], row[1], None, *row[2:]))
            else:
                parent.rows.append(row)
            parent.add(node.n, node.least, row[4], row[5])
            parent.children += 1

        def close(depth: int) -> None:
            while open_ and open_[-1].depth > depth:
                node = open_.pop()
                finished(node, open_[-1] if open_ else None)

        def sent() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate([pa.int32(), *[pa.int64()] * 8, pa.string()])], names)
            out.clear()
            return batch

        for batch in batches:
            for shard, now, conv, words in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if now != path:
                    same, depth = (shared(path, now), len(now) // WIDTH) if path is not None else (0, len(now) // WIDTH)
                    close(same)
                    path, above = now, skeleton.on(shard, now)
                    for d in range(max(len(above), same + 1), depth + 1):
                        open_.append(_Node(d, words[d - 1]))
                if open_:
                    node = open_[-1]
                    if node.ends is None:
                        node.ends = hashlib.sha256(str(conv).encode())
                    else:
                        node.ends.update(b",%d" % conv)
                else:
                    skel = int(above[-1])
                    node = partial.setdefault(skel, _Node(len(above) - 1, 0))
                    first, ids = ends.setdefault(skel, (conv, []))
                    ids.append(str(conv))
                    if 12 * len(ids) > chunk:
                        out.append((ENDS, skel, first, *[None] * 6, ",".join(ids)))
                        del ends[skel]
                node.add(1, conv, 0, 0)
                if len(out) > 10_000:
                    yield sent()
        close(0)
        out.extend((ENDS, skel, first, *[None] * 6, ",".join(ids)) for skel, (first, ids) in ends.items())
        out.extend((PARTIAL, skel, p.least, p.depth, None, p.n, p.children, p.leaves, p.saved, None) for skel, p in partial.items())
        yield sent()

    return in_task


def reduce_skeleton(skeleton: Skeleton):
    """The task over all summed partial aggregates (at most a row per node of the skeleton): whole rows of its nodes."""
    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
        if not rows:
            return
        nodes = {skel: _Node(skeleton.depth[skel], skeleton.words[skel]) for skel in range(len(skeleton.parent))}
        for skel, least, n, children, leaves, saved in rows:
            nodes[skel].add(n, least, leaves, saved)
            nodes[skel].children += children
        for skel in range(len(nodes) - 1, 0, -1):  # children have higher numbers than their parents
            node, parent = nodes[skel], nodes[skeleton.parent[skel]]
            node.leaves = node.leaves or 1
            node.saved += (node.n - 1) * node.words
            parent.add(node.n, node.least, node.leaves, node.saved)
            parent.children += 1
        nodes[0].leaves = nodes[0].leaves or 1
        cols = [[skel for skel in nodes], [x.least for x in nodes.values()], [x.depth for x in nodes.values()],
                [nodes[p].least if p >= 0 else None for p in skeleton.parent], [x.n for x in nodes.values()], [x.children for x in nodes.values()],
                [x.leaves for x in nodes.values()], [x.saved for x in nodes.values()]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["skel", *RESULT[:-1]])

    return in_task


def hashed_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(skel, ends_sha256) from chunks of ids sorted by (skel, first id); only a running hash is held."""
    now, digest, done = None, None, []
    for batch in batches:
        for skel, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if skel == now:
                digest.update(b"," + ids.encode())
                continue
            if now is not None:
                done.append((now, digest.hexdigest()))
            now, digest = skel, hashlib.sha256(ids.encode())
    if now is not None:
        done.append((now, digest.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.int64()), pa.array([x for _, x in done], pa.string())], ["skel", "ends_sha256"])


def trie_nodes(paths: DataFrame, *, shards: int | None = None) -> DataFrame:
    """A row per distinct prefix of the paths (conv_id, path, words); see the columns in ``RESULT``."""
    spark = paths.sparkSession
    paths = stored(paths, "paths")
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows, size = paths.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("path")), F.lit(0))).first()
    want = min(SAMPLED * shards, max(1, SAMPLE_BYTES * rows // max(1, size)))
    sample = [(bytes(p), c, w) for p, c, w in sampled(paths.select("path", "conv_id", "words"), want, rows)]
    words = {(p, c): w for p, c, w in sample}
    weights = [len(p) // WIDTH + 1 for p, _, _ in sample]
    splitters = even_splitters([(p, c) for p, c, _ in sample], weights, shards)
    while sum(len(p) // WIDTH for p, _ in splitters) > SKELETON:
        splitters = splitters[1::2]
    skeleton = Skeleton([p for p, _ in splitters], [words[s] for s in splitters])
    dealt = paths.withColumn("shard", shard_of(splitters, F.col("path"), F.col("conv_id"))).repartitionById(shards, F.col("shard"))
    found = dealt.sortWithinPartitions("path", "conv_id").select("shard", "path", "conv_id", "words").mapInArrow(finish_shard(skeleton, CHUNK), NODE)
    found = stored(found, "nodes")

    summed = found.where(F.col("kind") == PARTIAL).groupBy("skel").agg(F.min("conv_id").alias("least"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    longs = ", ".join(f"{c} long" for c in ("skel", *RESULT[:-1]))
    top = stored(summed.repartition(1).mapInArrow(reduce_skeleton(skeleton), longs), "skeleton")
    chunks = found.where(F.col("kind") == ENDS).select("skel", "conv_id", "ends").repartition(shards, "skel").sortWithinPartitions("skel", "conv_id")
    ends = chunks.select("skel", "ends").mapInArrow(hashed_ends, "skel long, ends_sha256 string")
    hashes = lambda c: F.coalesce(c, F.lit(EMPTY)).alias("ends_sha256")
    skeleton_rows = top.join(F.broadcast(ends), "skel", "left").select(*RESULT[:-1], hashes(F.col("ends_sha256")))
    own = found.where(F.col("kind") == FINISHED).select(*RESULT[:-1], hashes(F.col("ends")))
    least = top.select("skel", F.col("conv_id").alias("_least"))  # at most SKELETON rows
    below = found.where(F.col("kind") == BELOW_SKELETON).join(F.broadcast(least), "skel").select(
        *[F.col("_least").alias(c) if c == "parent_conv_id" else F.col(c) for c in RESULT[:-1]], hashes(F.col("ends")))
    return own.union(below).union(skeleton_rows)


def prefix_trie(turns: DataFrame, **names: str) -> DataFrame:
    """The trie of the conversations as they are; ``names`` as in ``conversation_paths``."""
    return trie_nodes(conversation_paths(turns, **names))

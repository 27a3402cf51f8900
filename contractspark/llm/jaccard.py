"""N-gram Jaccard join: the blocked product of the sparse document by n-gram matrix with itself, and its components.

A document's row holds its distinct n-word shingles (64-bit hashes); rows with one shingle set are one class. Two rows
link when ``den * overlap >= num * union``. Forming every product entry would emit all pairs that share a common n-gram, so
entries are bounded away before they are formed:

* Size bound: the rows of a pair that links differ in at most ``k = (den - num) * size / num`` columns, size being the most
  that the smaller may have. Columns are dealt by hash into more than k blocks, so the two rows agree entirely in at least
  one block. A block's signature is a hash of its columns in the row; rows with no equal signature are never paired. Block
  counts depend on a row's size level; a row also signs for the level below if a smaller partner may be there. (A row with
  so many empty blocks that the agreeing ones might all be empty signs for an empty block as well; others needn't.)
* Signatures are dealt by range of (signature, class), which splits a hot one over tasks; only those that two classes share
  go on. Rows that link share all agreeing blocks that aren't empty, at least ``need`` of them: all blocks with columns, less
  the columns in which a row of this very size can differ, which are fewer than the ``k`` of its level. A row with fewer
  shared signatures than it needs links nothing and leaves; that may leave others with too few, so this is done twice.
* A group of one signature is represented by its lead, the row of the group whose signatures reach most rows (of a text and
  its edited copies that is the text). A row is first multiplied with the one lead that it shares most signatures with, then
  with its other leads outside its component if it shares enough with them, in 16 bits a column first: pairs that share too few
  of those don't link, the others are multiplied in full. Rows are sent once per lead, in parts of bounded size, each with the
  lead's row once.
* Groups that then still hold several components are open: pairs in them may link although neither links to the lead. Rows
  with enough signatures in groups of several components go by family (rows that open signatures connect) and blocks of one
  size class and bounded bytes; two blocks meet unless their sizes are too far apart or both belong to one component, which
  needs no more links. A task holds two blocks and accumulates the overlaps of their rows over all shared columns, discards
  what the bound excludes, and sends on only links that join two components. This last step is quadratic in the bytes of an
  open family.
* Stars and block products are sent in rounds of bounded bytes, a share of those of all rows; the shuffle files of a round
  are gone before the next, so time may grow with the square of an open family but disk doesn't.

Overlaps are counts over the full rows; components come from label propagation by joins. Intermediate tables are deleted as
soon as nothing reads them.

Defined cases: null or blank text has no shingles, size 0 and is its own component; every row gives a row of the result,
repeated ones too; the texts of one id are rows of their own, but a row's component is named by the least id among its rows;
a row without id links nothing, but takes the component of rows with its shingle set (null without any); an empty table gives
no rows. The result has columns of its own and the columns ``keep``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractspark.llm.common import blank_words, forget, stored, stored_in_turn
from contractspark.llm.decontaminate import expand

_MEMORY = 400_000
#: Ids (with class keys) of candidates that are broadcast to fetch their texts; with more, the texts are shuffled.
BROADCAST_IDS = 300_000
#: A round of products sends a quarter of the bytes of all rows at most, or these if they are more.
ROUND_SHARE, ROUND_BYTES = 4, 64 << 20
#: Bytes of rows in a batch of a star, and in one block of the product; rows that share a copy of their lead's row.
PRODUCT_BYTES, BLOCK_BYTES, STAR_ROWS = 8 << 20, 4 << 20, 512
_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x + np.uint64((seed * int(_ODD[3]) + int(_ODD[0])) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * _ODD[1]
    x = (x ^ (x >> np.uint64(27))) * _ODD[2]
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Rows of the incidence matrix: sorted distinct shingle hashes of texts."""

    def __init__(self, n: int):
        self.n, self.memory = n, {}

    def word_hashes(self, words: list[bytes]) -> np.ndarray:
        import xxhash

        memory = self.memory
        unseen = set(words).difference(memory)
        if unseen:
            if len(memory) + len(unseen) > _MEMORY:
                memory.clear()
                unseen = set(words)
            memory.update((w, xxhash.xxh3_64_intdigest(w)) for w in unseen)
        return np.fromiter(map(memory.__getitem__, words), np.uint64, len(words))

    def row(self, text: str | None) -> np.ndarray:
        words = blank_words(text)
        if not words:
            return np.zeros(0, np.uint64)
        h, n = self.word_hashes(words), min(self.n, len(words))
        s = np.full(len(words) - n + 1, n, np.uint64)
        for k in range(n):
            s = s * _ODD[0] + h[k:len(words) - n + 1 + k]
        return np.unique(mixed(s))


class Levels:
    """Size levels for the threshold num / den, and the number of column blocks of each."""

    def __init__(self, num: int, den: int, growth: Fraction = Fraction(8, 5)):
        self.num, self.den, self.growth = num, den, growth
        self.tops = [max(1, (num - 1) // max(1, den - num))]  # up to here rows must be equal to link: k is 0

    def level(self, size: int) -> int:
        while self.tops[-1] < size:
            self.tops.append(int(self.tops[-1] * self.growth) + 1)
        return next(i for i, t in enumerate(self.tops) if t >= size)

    def blocks(self, level: int) -> tuple[int, int]:
        """(number of blocks, k): a pair whose smaller row is of the level differs in at most k columns."""
        # overlap <= smaller size <= top; den * overlap >= num * (overlap + differing)
        k = (self.den - self.num) * self.tops[level] // self.num
        return k + 4 + k // 12, k

    def differing(self, size: int, other: int | None = None) -> int:
        """The most columns in which a row of the size differs from one that links: one of ``other`` columns at most, or any."""
        # den * overlap >= num * (size + other - overlap); without a limit other is up to den / num of the size
        return (self.den - self.num) * size // self.num if other is None else (self.den - self.num) * (size + other) // (self.den + self.num)

    def of(self, size: int) -> list[int]:
        """Levels to sign for: its own, and those of smaller rows that could link."""
        least = -(-self.num * size // self.den)
        own = self.level(size)
        return [i for i in range(self.level(least), own + 1)] if size else []


def signatures(row: np.ndarray, levels: Levels) -> tuple[np.ndarray, int]:
    """A row's signatures, and how many of them any row that links shares with it at least."""
    out, need, own_levels = [], [], levels.of(len(row))
    for level in own_levels:
        n, k = levels.blocks(level)
        if k == 0:
            continue  # only equal rows link, and those are one class
        block = (mixed(row, 2) % np.uint64(n)).astype(np.int64)
        order = np.argsort(block, kind="stable")
        own = block[order]
        at = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        sums = np.add.reduceat(mixed(row[order], 3), at)
        out.append(mixed(sums + own[at].astype(np.uint64) * _ODD[1], 100 + level))
        most = levels.differing(len(row), None if level == own_levels[-1] else levels.tops[level])
        need.append(max(1, len(at) - most))  # each column in which it differs touches one of its blocks at most
        if len(at) <= most:  # the agreeing blocks might all be empty
            empty = np.setdiff1d(np.arange(n), own[at]).astype(np.uint64)
            out.append(mixed(empty * _ODD[1], 100 + level))
    return (np.unique(np.concatenate(out)), min(need)) if out else (np.zeros(0, np.uint64), 0)


def class_key(row: np.ndarray) -> tuple[int, int]:
    """128 bits of a row's set; the size is part of it."""
    with np.errstate(over="ignore"):
        a = mixed(np.array([mixed(row, 4).sum(dtype=np.uint64) + np.uint64(len(row))], np.uint64), 5)
        b = mixed(np.array([mixed(row, 6).sum(dtype=np.uint64) ^ np.uint64(len(row))], np.uint64), 7)
    return int(a.view(np.int64)[0]), int(b.view(np.int64)[0])


def numbered(short: bytes) -> np.ndarray:
    """A short row's sorted 16-bit columns, told apart where they repeat: rows share as many of these as of their columns, or more."""
    x = np.frombuffer(short, np.uint16)
    return (x.astype(np.uint64) << np.uint64(32)) + (np.arange(len(x)) - np.searchsorted(x, x, "left")).astype(np.uint64)


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Entries of the product for pairs of rows: the shared columns of each, accumulated over all columns at once."""
    if not left:
        return np.zeros(0, np.int64)
    pair = np.repeat(np.arange(2 * len(left)) // 2, [len(x) for both in zip(left, right) for x in both])
    columns = np.concatenate([x for both in zip(left, right) for x in both])
    order = np.lexsort((columns, pair))
    pair, columns = pair[order], columns[order]
    same = (columns[1:] == columns[:-1]) & (pair[1:] == pair[:-1])
    return np.bincount(pair[1:][same], minlength=len(left))


class _Join:
    """One run of the join over (``_id``, ``_text``) rows."""

    def __init__(self, docs: DataFrame, n: int, num: int, den: int):
        self.docs, self.n, self.num, self.den = docs, n, num, den
        self.id = docs.schema["_id"].dataType
        self.parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def described(self) -> DataFrame:
        """The columns but the text, n_shingles, c1, c2, need and sigs of every row; a task gives a class's signatures once."""
        n, num, den = self.n, self.num, self.den
        carried = [f for f in self.docs.schema.fields if f.name != "_text"]
        src = self.docs.select(*[f.name for f in carried], "_text")

        def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shingler, levels, seen = Shingler(n), Levels(num, den), set()
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    sizes, keys, sigs, needs = [], [], [], []
                    for text in (x.as_py() for x in part.column(len(carried))):
                        row = shingler.row(text)
                        key = class_key(row)
                        own, need = (np.zeros(0, np.uint64), 0) if key in seen else signatures(row, levels)
                        sizes.append(len(row))
                        keys.append(key)
                        sigs.append(own)
                        needs.append(need)
                        seen.add(key)
                    ends = np.cumsum([0] + [len(s) for s in sigs]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sigs).view(np.int64)))
                    longs = [pa.array(x, pa.int64()) for x in (sizes, [k[0] for k in keys], [k[1] for k in keys], needs)]
                    yield pa.RecordBatch.from_arrays([*part.columns[:len(carried)], *longs, lists], [*(f.name for f in carried), *names, "sigs"])

        names = ("n_shingles", "c1", "c2", "need")
        return src.mapInArrow(in_task, T.StructType([*carried, *(T.StructField(c, T.LongType()) for c in names), T.StructField("sigs", T.ArrayType(T.LongType()))]))

    def shared_signatures(self, described: DataFrame) -> DataFrame:
        """(sig, c1) of the signatures of two classes or more; of those at a task's edges perhaps of one only."""
        def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sig, c, told = np.zeros(0, np.int64), np.zeros(0, np.int64), False
            first = True

            def out(sig: np.ndarray, c: np.ndarray, told: bool, first: bool, last: bool) -> pa.RecordBatch:
                new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (c[1:] != c[:-1])])
                new[0] = new[0] and not told
                group = np.concatenate([[0], np.cumsum(sig[1:] != sig[:-1])])
                many = np.bincount(group, np.concatenate([[0], c[1:] != c[:-1]]) * np.concatenate([[False], sig[1:] == sig[:-1]])) > 0
                many[0] |= told or first
                many[-1] |= last
                keep = new & many[group]
                return pa.RecordBatch.from_arrays([pa.array(sig[keep]), pa.array(c[keep])], ["sig", "c1"])

            for batch in batches:
                if not batch.num_rows:
                    continue
                sig = np.concatenate([sig, batch.column(0).to_numpy()])
                c = np.concatenate([c, batch.column(1).to_numpy()])
                cut = int(np.searchsorted(sig, sig[-1]))  # the last group may go on in the next batch
                if cut:
                    yield out(sig[:cut], c[:cut], told, first, False)
                    sig, c, told, first = sig[cut:], c[cut:], False, False
                if first or told or c[0] != c[-1]:  # already known to go on: nothing but its last row need wait
                    yield out(sig, c, told, True, False)
                    sig, c, told, first = sig[-1:], c[-1:], True, False
            if len(sig):
                yield out(sig, c, told, first, True)

        signed = described.select(F.explode("sigs").alias("sig"), "c1")
        dealt = signed.repartitionByRange(self.parts, "sig", "c1").sortWithinPartitions("sig", "c1")
        return dealt.mapInArrow(in_task, "sig long, c1 long")

    def rows(self, reps: DataFrame) -> DataFrame:
        """(node, row): the matrix rows of these classes (node, rep, c1, c2); a task may give one again."""
        n = self.n

        def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shingler, seen = Shingler(n), set()
            for batch in batches:
                got = []
                for node, c1, c2, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
                    if node not in seen and class_key(row := shingler.row(text)) == (c1, c2):
                        seen.add(node)
                        got.append((node, row.tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.binary())], ["node", "row"])

        small = reps.count() <= BROADCAST_IDS  # else the join is by shuffle, with the same rows
        texts = self.docs.join(F.broadcast(reps) if small else reps, F.col("_id") == F.col("rep")).select("node", "c1", "c2", "_text")
        return texts.mapInArrow(in_task, "node long, row binary")

    def likely(self, pairs: DataFrame, rows: DataFrame) -> DataFrame:
        """Of (a, b), the pairs that link and few others: by 16 bits a column, of which no pair shares less than of its columns."""
        def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                short = [(np.frombuffer(x, np.uint64) >> np.uint64(48)).astype(np.uint16).tobytes() for x in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(short, pa.binary())], ["node", "row"])

        return self.linked(pairs, rows.select("node", "row").mapInArrow(in_task, "node long, row binary"), numbered)

    def linked(self, pairs: DataFrame, rows: DataFrame, columns: Callable[[bytes], np.ndarray] = lambda x: np.frombuffer(x, np.uint64)) -> DataFrame:
        """Of (a, b), the pairs that link. A row ``b`` is sent once for each ``a``, the row ``a`` once for each part of them."""
        num, den = self.num, self.den

        def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lead, lead_row = None, None
            for batch in batches:
                ends = np.cumsum([len(x) for x in batch.column(2).to_pylist()]) // PRODUCT_BYTES
                edges = np.concatenate([[0], np.flatnonzero(np.diff(ends)) + 1, [batch.num_rows]]) if batch.num_rows else [0]
                for at, to in zip(edges[:-1], edges[1:]):
                    a, b, left, right = [], [], [], []
                    for x, y, row in zip(*(batch.column(k).slice(at, to - at).to_pylist() for k in range(3))):
                        row = columns(row)
                        if x == y:
                            lead, lead_row = x, row
                        elif lead == x and (not b or (a[-1], b[-1]) != (x, y)):
                            a.append(x)
                            b.append(y)
                            left.append(lead_row)
                            right.append(row)
                    both = overlaps(left, right)
                    union = np.array([len(x) + len(y) for x, y in zip(left, right)], np.int64) - both
                    keep = pa.array(den * both >= num * union)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()).filter(keep), pa.array(b, pa.int64()).filter(keep)], ["a", "b"])

        parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / STAR_ROWS).alias("parts"))
        dealt = pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), "parts").alias("part"))
        leads = parts.select("a", F.col("a").alias("b"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
        sent = dealt.union(leads).join(rows, F.col("b") == F.col("node")).select("a", "b", "row", "part")
        stars = sent.repartition(self.parts, "a", "part").sortWithinPartitions("a", "part", F.col("a") != F.col("b"), "b")
        return stars.select("a", "b", "row").mapInArrow(in_task, "a long, b long")


def in_rounds(work: DataFrame, size: str, by: list[str], most: int) -> Iterator[DataFrame]:
    """``work`` dealt by hash of ``by`` into as many parts as it takes for about ``most`` of the sum of ``size`` in each."""
    rounds = max(1, -(-int(work.agg(F.sum(size)).first()[0] or 0) // max(1, most)))
    for k in range(rounds):
        yield work.where(F.pmod(F.xxhash64(*by), F.lit(rounds)) == k) if rounds > 1 else work


def linked_blocks(num: int, den: int, block: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b) that join components, among the rows of blocks ``i`` and ``j``: a sparse product row by row.

    ``block``: i, j, blk, rep, comp and row of the rows of both blocks.
    """
    i, j = block["i"].iloc[0], block["j"].iloc[0]
    at = {blk: own for blk, own in block.groupby("blk", sort=False)}
    left, right = at[i], at[j]
    rows, reps = [np.frombuffer(x, np.uint64) for x in right["row"]], right["rep"].tolist()
    size = np.array([len(x) for x in rows], np.int64)
    columns, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), size)
    order = np.argsort(columns, kind="stable")
    columns, owner = columns[order], owner[order]
    root: dict[object, object] = {}

    def find(x: object) -> object:
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    links, comps = [], right["comp"].tolist()
    for rep, comp, x in zip(left["rep"], left["comp"], left["row"]):
        x = np.frombuffer(x, np.uint64)
        first = np.searchsorted(columns, x, "left")
        both = np.bincount(owner[expand(first, np.searchsorted(columns, x, "right") - first)], minlength=len(rows))
        for y in np.flatnonzero(den * both >= num * (len(x) + size - both)):
            p, q = find(comp), find(comps[y])
            if p != q:
                root[p] = q
                links.append((rep, reps[y]))
    return pd.DataFrame({"a": [x for x, _ in links], "b": [x for _, x in links]}, columns=["a", "b"]).astype(block["rep"].dtype)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, comp): a node of each node's component, the same for all of its nodes, over edges (a, b) of longs.

    Each round every node points to its least neighbour if that is less than itself; two steps along such pointers it meets a node
    that stands for it. Edges then join those, and edges within one go, so rounds work on ever fewer edges. What stands for
    what is kept and followed at the end. Every round is joins and partial minima, written to the shared folder.
    """
    def between(pairs: DataFrame) -> DataFrame:
        return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    left = stored(between(edges), "edges")
    steps: list[DataFrame] = []
    while left.limit(1).count():
        if len(steps) == max_rounds:
            raise RuntimeError("components did not settle")
        ends = left.select(F.col("a").alias("node"), F.col("b").alias("least")).union(left.select("b", "a"))
        point = stored(ends.groupBy("node").agg(F.least(F.col("node"), F.min("least")).alias("top")), "pointers")
        for _ in range(2):
            up = point.select(F.col("node").alias("top"), F.col("top").alias("over"))
            before, point = point, stored(point.join(up, "top").select("node", F.col("over").alias("top")), "pointers")
            forget(before)
        steps.append(point)
        of = lambda c: point.select(F.col("node").alias(c), F.col("top").alias(f"top_{c}"))
        now = left.join(of("a"), "a").join(of("b"), "b").select(F.col("top_a").alias("a"), F.col("top_b").alias("b"))
        before, left = left, stored(between(now), "edges")
        forget(before)
    forget(left)
    if not steps:  # nodes that are joined with themselves only
        return stored(edges.select(F.col("a").alias("node"), F.col("a").alias("comp")).distinct(), "labels")
    label = steps[0].withColumnRenamed("top", "comp")
    for step in steps[1:]:
        label = label.join(step.withColumnRenamed("node", "comp"), "comp", "left").select("node", F.coalesce("top", "comp").alias("comp"))
    label = stored(label, "labels")
    forget(*steps)
    return label


def enough(members: DataFrame, reps: DataFrame) -> DataFrame:
    """(sig, node) of the nodes that have as many signatures as they need, in groups of two such nodes or more."""
    able = members.groupBy("node").agg(F.count(F.lit(1)).alias("n")).join(reps, "node").where("n >= need").select("node")
    left = members.join(able, "node", "left_semi")
    groups = left.groupBy("sig").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("sig")
    return left.join(groups, "sig", "left_semi")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = 4, num: int = 85, den: int = 100,
                    keep: list[str] | None = None) -> DataFrame:
    """(id, n_shingles, component_id and the columns ``keep``) for every row of ``docs``; two rows link at Jaccard ``num / den`` or more."""
    kept = keep or []
    src = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"), *[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(kept)])
    join = _Join(src, n, num, den)
    described = stored(join.described(), "signatures")
    every = stored(described.drop("sigs", "need"), "classes")
    classes = described.where("n_shingles > 0 and _id is not null").groupBy("c1", "c2").agg(F.min("_id").alias("rep"), F.first("n_shingles").alias("size"), F.max("need").alias("need"))
    reps = stored(classes.withColumn("node", F.monotonically_increasing_id()), "reps")  # written once: a node's number is fixed
    nodes = reps.select("node", "size", "need")
    shared = stored(join.shared_signatures(described).join(reps, "c1").select("sig", "node").distinct(), "members")
    forget(described)
    once = stored(enough(shared, nodes), "members")
    forget(shared)
    twice = stored(enough(once, nodes), "members")
    forget(once)
    reach = twice.join(twice.groupBy("sig").agg(F.count(F.lit(1)).alias("n")), "sig").groupBy("node").agg(F.sum("n").alias("reach"))
    leads = twice.join(reach, "node").groupBy("sig").agg(F.max(F.struct("reach", (-F.col("node")).alias("last"))).alias("best"))
    members = stored(twice.join(leads.select("sig", (-F.col("best")["last"]).alias("lead")), "sig"), "members")
    forget(twice)
    most = max(ROUND_BYTES, int(nodes.agg(F.sum("size")).first()[0] or 0) * 8 // ROUND_SHARE)
    rows = stored(join.rows(reps.join(members.select("node").distinct(), "node").select("node", "rep", "c1", "c2")), "rows")

    # stars: each row with the lead it shares most with, then with the other leads it shares enough with
    lead = nodes.select(F.col("node").alias("lead"), F.col("size").alias("lead_size"), F.col("need").alias("lead_need"))
    fits = (F.least("size", "lead_size") * den >= F.greatest("size", "lead_size") * num) & (F.col("shared") >= F.greatest("need", "lead_need"))
    counted = members.where("node <> lead").groupBy("lead", "node").agg(F.count(F.lit(1)).alias("shared"))
    pairs = stored(counted.join(nodes, "node").join(lead, "lead").where(fits).select("lead", "node", "shared"), "pairs")
    best = pairs.groupBy("node").agg(F.max(F.struct("shared", (-F.col("lead")).alias("least"))).alias("best"))
    first = best.select((-F.col("best")["least"]).alias("a"), F.col("node").alias("b"))
    sized = nodes.select(F.col("node").alias("b"), "size")
    stars = lambda pairs, bytes_each: in_rounds(pairs.join(sized, "b"), "size", ["a", "b"], most // bytes_each)
    edges = stored_in_turn((join.linked(some.select("a", "b"), rows).distinct() for some in stars(first, 8)), "links")
    above = edges.select(F.col("b").alias("a"), F.col("a").alias("above"))  # a row has one link here at most: two steps up it
    tops = edges.join(above, "a", "left").select("b", F.coalesce("above", "a").alias("top"))
    of = lambda node, name: tops.select(F.col("b").alias(node), F.col("top").alias(name))
    apart = pairs.join(of("lead", "p"), "lead", "left").join(of("node", "q"), "node", "left").where(F.coalesce("p", "lead") != F.coalesce("q", "node"))
    others = apart.select(F.col("lead").alias("a"), F.col("node").alias("b")).join(first, ["a", "b"], "left_anti")
    others = stored(others, "others")
    likely = stored_in_turn((join.likely(some.select("a", "b"), rows).distinct() for some in stars(others, 2)), "likely")  # nearly all of the others don't link: a quarter of their bytes shows that
    more = stored_in_turn((join.linked(some.select("a", "b"), rows) for some in stars(likely, 8)), "links")
    comp = components(edges.union(more))
    forget(pairs, others, likely)

    # open groups: those whose rows without the lead are not one component
    rest = members.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = rest.groupBy("sig").agg(F.min("comp").alias("low"), F.max("comp").alias("high"),
                                    F.min(F.when(F.col("node") != F.col("lead"), F.col("comp"))).alias("rest_low"), F.max(F.when(F.col("node") != F.col("lead"), F.col("comp"))).alias("rest_high"))
    mixed = stored(rest.join(mixed.where("low < high").withColumn("open", F.col("rest_low") < F.col("rest_high")).drop("low", "high"), "sig"), "mixed")
    able = mixed.groupBy("node").agg(F.count(F.lit(1)).alias("n")).join(nodes, "node").where("n >= need").select("node", "size")
    untied = stored(mixed.where(F.col("open") & (F.col("node") != F.col("lead"))).join(able, "node").select("node", "size", "comp", "sig").distinct(), "open")
    groups = untied.groupBy("sig").agg(F.min("node").alias("head"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high")
    left = stored(untied.join(groups.select("sig", "head"), "sig").select("node", "size", "comp", "head").distinct(), "open")
    forget(members, mixed, untied)
    family = components(left.select(F.col("head").alias("a"), F.col("node").alias("b"))).select("node", F.col("comp").alias("fam"))
    # sizes of rows that link are within num / den of each other: in one size class or two neighbouring ones
    step = math.log(1.01 * den / num)
    own = left.select("node", "size", "comp").distinct().join(family, "node").withColumn("cls", F.floor(F.log("size") / step))
    # blocks: a component of more bytes than one has blocks of its own, the others of a family and class share theirs
    parts = own.groupBy("fam", "cls", "comp").agg((F.sum("size") * 8).alias("bytes"))
    alone = F.col("bytes") > BLOCK_BYTES
    pooled = parts.where(~alone).groupBy("fam", "cls").agg(F.ceil(F.sum("bytes") / BLOCK_BYTES).alias("n"))
    where = parts.join(pooled, ["fam", "cls"], "left").select("fam", "cls", "comp", F.when(alone, F.col("comp").cast("string")).otherwise(F.lit("")).alias("pool"),
                                                              F.when(alone, F.ceil(F.col("bytes") / BLOCK_BYTES)).otherwise(F.col("n")).alias("n"))
    dealt = own.join(where, ["fam", "cls", "comp"]).select("fam", "cls", "comp", "node", "size", F.concat_ws("/", "cls", "pool", F.pmod(F.xxhash64("node"), "n")).alias("blk"))
    dealt = stored(dealt, "blocks")
    blocks = dealt.groupBy("fam", "cls", "blk").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.sum("size").alias("size"))
    other = blocks.select("fam", F.col("cls").alias("cls_j"), F.col("blk").alias("j"), F.col("low").alias("low_j"), F.col("high").alias("high_j"), F.col("size").alias("size_j"))
    meet = blocks.withColumnRenamed("blk", "i").join(other, "fam").where("i <= j and abs(cls - cls_j) <= 1 and (low < high or low_j < high_j or low != low_j)")
    meet = stored(meet.select("fam", "i", "j", (F.col("size") + F.when(F.col("i") < F.col("j"), F.col("size_j")).otherwise(0)).alias("size")), "meet")
    open_rows = stored(rows.join(dealt.select("node"), "node", "left_semi").dropDuplicates(["node"]), "rows")
    forget(rows)

    def products(some: DataFrame) -> DataFrame:
        both = some.select("fam", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("blk")).join(dealt.drop("size"), ["fam", "blk"])
        both = both.join(open_rows, "node").select("fam", "i", "j", "blk", F.col("node").alias("rep"), "comp", "row")
        return both.groupBy("fam", "i", "j").applyInPandas(lambda block: linked_blocks(num, den, block), edges.schema)

    found = stored_in_turn((products(some) for some in in_rounds(meet, "size", ["fam", "i", "j"], most // 8)), "links")
    forget(left, open_rows, dealt, meet)
    comp = components(edges.union(more).union(found))
    forget(edges, more, found)

    classed = reps.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    named = classed.join(classed.groupBy("comp").agg(F.min("rep").alias("least")), "comp").select("c1", "c2", "least")
    out = every.join(named, ["c1", "c2"], "left")
    nothing = F.col("n_shingles") == 0
    return out.select(F.col("_id").alias(id_col), "n_shingles", F.when(nothing, F.col("_id")).otherwise(F.coalesce("least", "_id")).alias("component_id"),
                      *[F.col(f"_k{i}").alias(c) for i, c in enumerate(kept)])

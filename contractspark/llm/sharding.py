"""Sharding by histogram sort: splitters refined by exact byte counts, then one exchange.

Documents are ordered by (hash of the text, hash of the id), so equal texts are neighbours. Shards of the order should have
equal bytes. In each round every open splitter gets a few probe keys between the bounds known so far; all tasks count rows and
bytes between probes (small partial counts that are summed); bounds close in on the wanted count until within ``tolerance``
of a shard. Every splitter is first sought between texts (so that a group of equal texts stays whole); only if no boundary
between texts is near enough does it cut into a group by the hash of the id.

Then rows move once, into as many key ranges as the bytes need (``part_bytes``; a hot text is cut by the hash of the id), and
are sorted there. A row's place among the rows of its shard in its range is counted on the way; the counts per range and shard,
one or two rows a range, give the places before it. No task holds a shard.

Defined cases: null text has no bytes (size 1 with the separator) and the checksum of the empty text; null ids and repeated
rows are rows of their own (rows with the same id and text share a key, and the ties among them fall in any order, all with
equal columns); with fewer rows than shards some shards stay empty; an empty table gives no rows. All input columns are
carried; ``size``, ``shard`` and ``slot`` replace columns of those names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractspark.llm.common import forget, stored, without
from contractspark.llm.ranges import even_splitters, sampled, shard_of

_TEXT = 1 << 64  # a key is hash of the text * _TEXT + hash of id and text, both as unsigned numbers in signed order
_SIGN = 1 << 63


def text_size(text: Column) -> Column:
    """UTF-8 bytes and one for a separator."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def block_of(splitters: list[int]):
    """A function of (k1, k2): how many splitters are smaller than the key."""
    high, low = (np.array([f(s) for s in splitters], np.uint64) for f in (lambda s: s // _TEXT, lambda s: s % _TEXT))

    @F.pandas_udf("int")
    def block(k1: pd.Series, k2: pd.Series) -> pd.Series:
        k1, k2 = (k.to_numpy(np.int64).view(np.uint64) ^ np.uint64(_SIGN) for k in (k1, k2))
        out, end = np.searchsorted(high, k1, "left"), np.searchsorted(high, k1, "right")
        for i in np.flatnonzero(out < end):  # keys whose text a splitter cuts or ends at
            out[i] += np.searchsorted(low[out[i]:end[i]], k2[i], "left")
        return pd.Series(out.astype(np.int32))

    return block


def counts_at(keys: DataFrame, probes: list[int]) -> list[tuple[int, int]]:
    """Exact (rows, bytes) of the keys up to each of the sorted probes; tasks send a sum per probe, no keys."""
    rows, size = [0] * (len(probes) + 1), [0] * (len(probes) + 1)
    for r in keys.groupBy(block_of(probes)("_k1", "_k2").alias("b")).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("s")).collect():
        rows[r.b], size[r.b] = r.n, r.s
    return list(zip(accumulate(rows), accumulate(size)))[:-1]


def probes_between(low: int, high: int, n: int) -> list[int]:
    """Up to ``n`` keys strictly between: ends of texts as long as there are any, then keys within one text."""
    first, last = (low + 1) // _TEXT, high // _TEXT - 1
    if first <= last:
        return [t * _TEXT + _TEXT - 1 for t in sorted({first + (last - first) * j // (n + 1) for j in range(1, n + 1)})]
    return sorted({low + (high - low) * j // (n + 1) for j in range(1, n + 1)} - {low, high}) or ([low + 1] if high - low > 1 else [])


def within(ranges: list[tuple[int, int]]) -> Column:
    """Whether a key's text hash lies in one of the key ranges."""
    texts: list[list[int]] = []
    for first, last in sorted((max(0, a) // _TEXT, b // _TEXT) for a, b in ranges):
        if texts and first <= texts[-1][1]:
            texts[-1][1] = max(last, texts[-1][1])
        else:
            texts.append([first, last])
    return reduce(Column.__or__, (F.col("_k1").between(first - _SIGN, last - _SIGN) for first, last in texts))


def find_splitters(keys: DataFrame, blocks: int, slack: float, most_probes: int = 2048) -> list[tuple[int, int]]:
    """(key, rows up to it) that part the keys into ``blocks`` ranges, bytes up to each within ``slack`` of an equal share.

    Where rows are too large for that, the nearest key. A round counts only keys between the bounds of the open splitters, so
    the rounds after the first read little, and the fewer splitters are open, the more probes each has.
    """
    total_rows, total = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    want = [total * (i + 1) // blocks for i in range(blocks - 1)]
    low = [(-1, 0, 0)] * len(want)  # key, rows and bytes up to it, at most the bytes wanted
    high = [(_TEXT * _TEXT - 1, total_rows, total)] * len(want)
    final: dict[int, tuple[int, int]] = {}
    while len(final) < len(want):
        open_ = [i for i in range(len(want)) if i not in final]
        asked = {i: probes_between(low[i][0], high[i][0], max(8, most_probes // len(open_))) for i in open_}
        ask = sorted({p for i in open_ for p in (*asked[i], max(0, low[i][0]))})
        near = keys.where(within([(low[i][0], high[i][0]) for i in open_]))
        at = dict(zip(ask, counts_at(near, ask)))
        for i in open_:
            base, (_, rows, size) = at[max(0, low[i][0])] if low[i][0] >= 0 else (0, 0), low[i]
            for key in asked[i]:
                now = (key, rows + at[key][0] - base[0], size + at[key][1] - base[1])
                if now[2] > want[i]:
                    high[i] = now
                    break
                low[i] = now
            under, over = want[i] - low[i][2], high[i][2] - want[i]
            if min(under, over) <= slack or not asked[i]:
                final[i] = low[i][:2] if under <= over else high[i][:2]
    return sorted(final.values())


def _numbered(carried: int):
    """The task over a sorted range: rows of (carried columns, part, shard, size) with their place among those of the shard."""
    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            shard = batch.column(carried + 1).to_numpy()
            place = np.zeros(len(shard), np.int64)
            for s in np.unique(shard).tolist():
                own = np.flatnonzero(shard == s)
                place[own] = seen.get(s, 0) + np.arange(len(own))
                seen[s] = seen.get(s, 0) + len(own)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], [*batch.schema.names, "_place"])

    return in_task


def shard_by_bytes(docs: DataFrame, shards: int = 16, *, id_col: str = "doc_id", text_col: str = "text", tolerance: float = 0.005,
                   part_bytes: int = 128 << 20, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``size``, ``shard`` and ``slot``; shards differ in bytes by about ``tolerance``."""
    text = F.col(f"`{text_col}`").cast("string")
    own = {"_k1": F.xxhash64(text), "_k2": F.xxhash64(F.col(f"`{id_col}`").cast("string"), text), "_size": text_size(text)}
    base = without(docs, "size", "shard", "slot")
    names = base.columns if keep is None else keep
    keyed = base.select(*[F.col(f"`{c}`").alias(f"_c{k}") for k, c in enumerate(names)], *[v.alias(k) for k, v in own.items()])
    keys = stored(keyed.select("_k1", "_k2", F.col("_size").alias("size")), "keys")
    rows, total = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    splitters = find_splitters(keys, shards, tolerance * total / shards)
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // part_bytes))
    sample = sampled(keys.select("_k1", "_k2", "size"), 64 * parts, rows)
    ranges = even_splitters([k[:2] for k in sample], [k[2] for k in sample], parts)
    forget(keys)
    dealt = keyed.withColumn("_part", shard_of(ranges, F.col("_k1"), F.col("_k2"))).withColumn("_shard", block_of([k for k, _ in splitters])("_k1", "_k2"))
    moved = dealt.repartitionById(parts, F.col("_part")).sortWithinPartitions("_k1", "_k2").select(*[f"_c{k}" for k in range(len(names))], "_part", "_shard", "_size")
    placed = stored(moved.mapInArrow(_numbered(len(names)), T.StructType([*moved.schema.fields, T.StructField("_place", T.LongType())])), "placed")
    counts = placed.groupBy("_shard", "_part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("_shard").orderBy("_part")) - F.col("n")
    starts = counts.select("_shard", "_part", before.alias("_start"))  # a row per range, and one more per splitter
    return placed.join(F.broadcast(starts), ["_shard", "_part"]).select(
        *[F.col(f"_c{k}").alias(c) for k, c in enumerate(names)], F.col("_size").alias("size"), F.col("_shard").alias("shard"), (F.col("_start") + F.col("_place")).alias("slot"))

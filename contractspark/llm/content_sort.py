"""Exact dedup by content sort: sampled splitters range-partition normalised texts, a sort makes equal ones neighbours.

Texts are compared after each run of blanks (``[\\x20\\x09-\\x0D]+``) became one space. The order is (first 32 bytes, 64-bit
hash, all bytes, id), in which equal texts are adjacent. Splitters are keys of a bounded sample, (first 32 bytes, hash of the
text, hash of the id): of fixed size however long texts are, and, as the id counts, a hot text is cut into as many shards as
its rows need. A shard is sorted by Spark (external, it spills) and read once: each row is compared in full with its
neighbour.

A run of equal texts that may go on outside (the first and last of a shard) or that has ``part_rows`` rows or ``part_bytes``
of text is closed as a part; parts carry their text once and are grouped by it: two a shard, and one for every so many rows or
bytes of a run. Rows of a part get the group's size and least id by the part's number. All other runs are complete where they
are. So a task holds no more than a part besides its batch, and texts move once.

Defined cases: null text is empty; of equal texts the row with the smallest id stays (ids that are null come last), of repeated
rows with that id one; ``keep_id`` is null if no id of the group is set; every row of the input gives one row; an empty table
gives none. Result columns replace columns of their names; columns ``keep`` (default: all) are carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractspark.llm.common import stored, without
from contractspark.llm.ranges import even_splitters, sampled, shard_of

RESULT = ("keep_id", "group_size", "kept", "text_sha256")
#: Sampled keys per shard; 48 bytes each.
SAMPLED = 64


def normalised(text: Column) -> Column:
    """Each run of blanks as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def in_runs(part_rows: int, part_bytes: int, carried: int):
    """The task over a sorted shard: rows of (carried columns, id, shard, text) to rows with their run's result."""
    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str] = []
        slices: list[pa.RecordBatch] = []  # of the open run, without texts
        text, parts, shard, begun = None, 0, 0, True  # begun: the run may have rows before this part
        held, most = 0, part_rows

        def closed(edge: bool) -> pa.RecordBatch:
            nonlocal slices, parts
            rows = pa.Table.from_batches(slices).combine_chunks().to_batches()[0]
            n, ids = rows.num_rows, rows.column(carried)
            digest = hashlib.sha256(text).hexdigest()
            number = (shard << 32) + parts
            parts += edge
            own = [pa.array([ids[0].as_py()] * n, ids.type), pa.array([n] * n, pa.int64()), pa.array([True] + [False] * (n - 1)), pa.array([digest] * n),
                   pa.array([number if edge else None] * n, pa.int64()), pa.array([text if edge else None] + [None] * (n - 1), pa.binary())]
            slices = []
            return pa.RecordBatch.from_arrays([*(rows.column(k) for k in range(carried)), *own], [*names, *RESULT, "_part", "_part_text"])

        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.schema.names[:carried]
            texts, bare = batch.column(carried + 2), batch.select(list(range(carried + 1)))
            shard, at = batch.column(carried + 1)[0].as_py(), 0
            for row in range(batch.num_rows):
                now = texts[row].as_py()
                new = text is not None and now != text
                if new or held + row - at >= most:
                    if row > at:
                        slices.append(bare.slice(at, row - at))
                    yield closed(begun or not new)
                    at, held, begun = row, 0, not new
                if now is not text:
                    text, most = now, max(1, min(part_rows, part_bytes // (len(now) + 1)))
            slices.append(bare.slice(at))
            held += batch.num_rows - at
        if slices:
            yield closed(True)

    return in_task


def mark_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None,
                part_rows: int = 10_000, part_bytes: int = 64 << 20) -> DataFrame:
    """``docs`` (its columns ``keep``) with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` of the normalised text."""
    base = without(docs, *RESULT) if keep is None else docs.select(*[F.col(f"`{c}`") for c in keep])
    columns = [F.col(f"`{c}`") for c in base.columns]
    id_, text = F.col(f"`{id_col}`"), normalised(F.col(f"`{text_col}`"))
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def keyed(rows: DataFrame, *more: Column) -> DataFrame:
        key = rows.select(*more, id_.alias("_id"), text.cast("binary").alias("_text"))
        return key.withColumns({"_head": F.substring("_text", 1, 32), "_hash": F.xxhash64("_text"), "_tie": F.xxhash64("_id")})

    total = docs.count()
    sample = sampled(keyed(docs).select("_head", "_hash", "_tie"), SAMPLED * shards, total)
    splitters = even_splitters([(bytes(h), *rest) for h, *rest in sample], [1] * len(sample), shards)
    full = keyed(docs, *[c.alias(f"_c{k}") for k, c in enumerate(columns)])
    dealt = full.withColumn("_shard", shard_of(splitters, F.col("_head"), F.col("_hash"), F.col("_tie")))
    dealt = dealt.repartitionById(shards, F.col("_shard")).sortWithinPartitions("_head", "_hash", "_text", F.col("_id").asc_nulls_last())
    carried = [f"_c{k}" for k in range(len(columns))]
    fields = [dealt.schema[c] for c in carried]
    own = [T.StructField("keep_id", dealt.schema["_id"].dataType), T.StructField("group_size", T.LongType()), T.StructField("kept", T.BooleanType()),
           T.StructField("text_sha256", T.StringType()), T.StructField("_part", T.LongType()), T.StructField("_part_text", T.BinaryType())]
    runs = stored(dealt.select(*carried, "_id", "_shard", "_text").mapInArrow(in_runs(part_rows, part_bytes, len(carried)), T.StructType([*fields, *own])), "runs")

    parts = runs.where("_part_text is not null").select("_part", "_part_text", "text_sha256", "keep_id", "group_size")
    place = F.struct(F.col("keep_id").isNull(), "keep_id", "_part")  # ids that are null come last
    groups = parts.groupBy("text_sha256", "_part_text").agg(F.min(place).alias("least"), F.sum("group_size").alias("size"), F.collect_list("_part").alias("parts"))
    of_part = groups.select(F.explode("parts").alias("_part"), F.col("least")["keep_id"].alias("least_id"), F.col("least")["_part"].alias("owner"), "size")
    named = [F.col(c).alias(n) for c, n in zip(carried, base.columns)]
    whole = runs.where("_part is null").select(*named, *RESULT)
    edges = runs.where("_part is not null").join(of_part, "_part").select(
        *named, F.col("least_id").alias("keep_id"), F.col("size").alias("group_size"), (F.col("kept") & (F.col("owner") == F.col("_part"))).alias("kept"), "text_sha256")
    return whole.union(edges)


def drop_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, as they are."""
    marked = mark_copies(docs, id_col=id_col, text_col=text_col)
    return marked.where("kept").select(*[F.col(f"`{c}`") for c in without(docs, *RESULT).columns])

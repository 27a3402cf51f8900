"""Output files of about one size, with or without partition columns.

Without this a partitioned write makes a file for every task and partition value. Here rows are dealt before the write: the rows of
a partition value go to as many files as its share needs, one task writes one file, and a value that holds most rows has most
tasks. Bytes a row are measured on a bounded sample written in the output's format, rows per value are counted by one scan of the
partition columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import col
from .commit import _Files

#: Rows that are written to measure the size of one.
SAMPLE_ROWS = 20_000


def bytes_per_row(df: DataFrame, scratch: str, fmt: str = "parquet", rows: int = 0, partition_by=()) -> float:
    """The written size of a row, measured on ``SAMPLE_ROWS`` of the ``rows`` of ``df`` in a folder that goes again."""
    fraction = min(1.0, SAMPLE_ROWS / max(1, rows))
    sample = (df if fraction >= 1 else df.sample(fraction=fraction, seed=5)).drop(*partition_by).limit(2 * SAMPLE_ROWS)
    files, folder = _Files(df.sparkSession), f"{scratch.rstrip('/')}/_sample-{uuid.uuid4().hex}"
    try:
        sample.coalesce(1).write.format(fmt).save(folder)
        n = df.sparkSession.read.format(fmt).schema(sample.schema).load(folder).count()
        size = files.size(folder)
    finally:
        files.delete(folder)
    return size / max(1, n)


def sized(df: DataFrame, scratch: str, target_bytes: int = 256 << 20, partition_by=(), fmt: str = "parquet") -> DataFrame:
    """``df`` dealt so that a write (partitioned by ``partition_by``) makes files of about ``target_bytes``.

    ``scratch`` is a folder that driver and executors share, for the sample. Rows are dealt by a hash of all their columns that can
    be hashed, so repeated rows share a file.
    """
    keys = list(partition_by)
    counts = df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("__rows"))
    rows = counts.agg(F.sum("__rows")).first()[0] or 0
    if not rows:
        return df
    per_file = max(1.0, target_bytes / max(1e-9, bytes_per_row(df, scratch, fmt, rows, keys)))
    needs = F.greatest(F.lit(1), F.round(F.col("__rows") / per_file)).cast("long")
    hashable = [col(f.name) for f in df.schema.fields if f.name not in keys and "map" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    own = F.xxhash64(*hashable) if hashable else F.xxhash64(F.monotonically_increasing_id())
    if not keys:
        n = max(1, round(rows / per_file))
        return df.withColumn("__file", F.pmod(own, F.lit(n)).cast("int")).repartitionById(n, F.col("__file")).drop("__file")
    # the files of a value are numbered from the number of files of the values before it
    shares = counts.select(*[col(k).alias(f"__k{i}") for i, k in enumerate(keys)], needs.alias("__n"))
    told = shares.collect()  # a row per partition value, each of which is a folder of the output
    first, table = 0, []
    for r in sorted(told, key=lambda r: [(x is not None, str(x)) for x in r[:-1]]):
        table.append((*r[:-1], first, r["__n"]))
        first += r["__n"]
    places = df.sparkSession.createDataFrame(table, ", ".join([*(f"{c} {shares.schema[c].dataType.simpleString()}" for c in shares.columns[:-1]), "__first long", "__n long"]))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & col(k).eqNullSafe(F.col(f"__k{i}"))
    placed = df.join(F.broadcast(places), same).withColumn("__file", (F.col("__first") + F.pmod(own, F.col("__n"))).cast("int"))
    return placed.repartitionById(first, F.col("__file")).select(*[col(c) for c in df.columns])

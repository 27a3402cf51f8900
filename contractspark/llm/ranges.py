"""Range partitions with splitters from a sample: rows go to the shard between two splitters, in the order of their keys."""

from __future__ import annotations

from bisect import bisect_left

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sampled(df: DataFrame, rows: int, total: int, seed: int = 11) -> list[tuple]:
    """The rows of a sample of about ``rows`` of the ``total`` rows of ``df``, sorted. ``rows`` bounds what the driver gets."""
    fraction = min(1.0, 1.05 * rows / max(1, total))
    return sorted(tuple(r) for r in (df if fraction >= 1 else df.sample(fraction=fraction, seed=seed)).collect())


def even_splitters(keys: list[tuple], weights: list[int], shards: int) -> list[tuple]:
    """Up to ``shards - 1`` distinct keys that part the sorted sample into shares of about equal weight."""
    total, so_far, out = sum(weights), 0, []
    for key, weight in zip(keys, weights):
        so_far += weight
        if so_far * shards >= total * (len(out) + 1) and len(out) < shards - 1 and (not out or key > out[-1]):
            out.append(key)
    return out


def shard_of(splitters: list[tuple], *cols: Column) -> Column:
    """How many splitters are smaller than the key (``cols``, none of them null): equal keys share a shard."""
    @F.pandas_udf("int")
    def shard(*key: pd.Series) -> pd.Series:
        return pd.Series([bisect_left(splitters, k) for k in zip(*key)], dtype="int32")

    return shard(*cols)

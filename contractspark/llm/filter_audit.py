"""Filter interaction audit: what each filter of a cleaning chain removes, in every order of the filters, per part of the data.

Five conditions make a document fail: too few words (A), too few distinct words (B), too many capitals (C), a forbidden
character (D), and a text that a smaller id has too (E). A to D look at one text each. E is an existential self-join:
a left-semi join on hash, exact text and smaller id.

* Hashes that occur more than once are counted first; only texts with such a hash go further. On the join's right side a text
  needs one row, the one with its least id: whoever has any smaller id with this text has that one. So no pairs within a group
  of copies are formed.
* Hashes that hold more than a share ``1 / HOT`` of the rows, at most ``HOT`` of them, are the hot ones. Their rows are salted
  by id, the right side's few rows of them are repeated per salt.

The ids that E marks are united with the rows of all documents, which bring their own failure bits; the sum by document is
its combination of failures. Combinations are counted per part (32 at most) before anything else, and everything is derived
from these counts: an order's step keeps the combinations without a bit of its filters so far, removes those with its own
bit and none before. A filter removes a document in ``orders / (number of its failures)`` of all orders, which gives ``shapley``.

Defined cases: null text is empty, a null part is the empty string; a row without id has no smaller id and isn't one; rows of
one id and text aren't copies of each other and count each; a document labelled twice is good or toxic if any label says
so; an empty table gives no rows. The result has columns of its own only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractspark.llm.common import stored

FILTERS = "ABCDE"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Hot hashes hold more than this share of the rows each; parts that a hot hash's rows are salted into.
HOT, SALTS = 1024, 64
ALL = 1 << len(FILTERS)


@dataclass(frozen=True)
class Limits:
    """When a text fails the filters A to D."""

    least_words: int = 200
    distinct_percent: int = 50
    capitals_percent: int = 2
    forbidden: bytes = b"#$%&*|"

    def failures(self, text: bytes, n_chars: int) -> int:
        """Bits of the filters that a UTF-8 text fails; bytes.split() cuts at 0x20 and 0x09-0x0D."""
        words = text.split()
        capitals = len(text) - len(text.translate(None, CAPITALS))
        return ((len(words) < self.least_words) | (100 * len(set(words)) < self.distinct_percent * len(words)) << 1
                | (100 * capitals > self.capitals_percent * n_chars) << 2 | (len(text.translate(None, self.forbidden)) < len(text)) << 3)


def with_failures(docs: DataFrame, limits: Limits) -> DataFrame:
    """(_id, _part, _hash, _bits) of ``docs`` (_id, _part, _hash, _text)."""
    fields = docs.select("_id", "_part", "_hash").schema.fields

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [limits.failures(t.as_py(), n) for t, n in zip(batch.column(3), batch.column(4).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(bits, pa.int32())], [*(f.name for f in fields), "_bits"])

    src = docs.select("_id", "_part", "_hash", F.col("_text").cast("binary").alias("_text"), F.length("_text").alias("_n"))
    return src.mapInArrow(in_task, T.StructType([*fields, T.StructField("_bits", T.IntegerType())]))


def with_smaller_copy(docs: DataFrame) -> DataFrame:
    """The rows (_id, _part, _hash) of ``docs`` (_id, _part, _hash, _text) whose text a smaller id has as well."""
    counts = stored(docs.groupBy("_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "hashes")
    most = docs.count() // HOT
    hot = [r["_hash"] for r in counts.where(F.col("n") > max(most, 1000)).select("_hash").collect()]  # HOT rows at most
    is_hot = F.col("_hash").isin(hot) if hot else F.lit(False)
    salt = F.when(is_hot, F.pmod(F.xxhash64("_id"), F.lit(SALTS))).otherwise(0).cast("int")
    salts = F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    repeated = counts.select("_hash", salts.alias("_salt"))
    copies = stored(docs.withColumn("_salt", salt).join(repeated, ["_hash", "_salt"], "left_semi"), "copies")
    least = copies.groupBy("_hash", "_text").agg(F.min("_id").alias("_least")).withColumnsRenamed({"_hash": "_h", "_text": "_t"})
    least = least.select("_h", "_t", "_least", F.explode(F.when(F.col("_h").isin(hot) if hot else F.lit(False), F.sequence(F.lit(0), F.lit(SALTS - 1)))
                                                         .otherwise(F.array(F.lit(0)))).alias("_s"))
    same = (F.col("_hash") == F.col("_h")) & (F.col("_salt") == F.col("_s")) & (F.col("_text") == F.col("_t"))
    return copies.join(least, same & (F.col("_least") < F.col("_id")), "left_semi").select("_id", "_part", "_hash")


def combinations(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
                 limits: Limits = Limits()) -> DataFrame:
    """(part, failures, n, good, toxic): documents by part and combination of failures, as the bits of ``FILTERS``."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    own = {"_id": F.col(f"`{id_col}`"), "_part": F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")), "_hash": F.xxhash64(text), "_text": text}
    keyed = docs.select(*[c.alias(k) for k, c in own.items()])
    every = with_failures(keyed, limits).withColumn("_rows", F.lit(1))
    marked = with_smaller_copy(keyed).select("_id", "_part", "_hash", F.lit(1 << FILTERS.index("E")).alias("_bits"), F.lit(0).alias("_rows"))
    each = stored(every.union(marked).groupBy("_id", "_part", "_hash").agg(F.bit_or("_bits").alias("failures"), F.sum("_rows").alias("n")), "failures")
    told = (labels.where(F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").alias("_label_of"))
            .agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")))
    named = each.where("_id is not null").join(told, F.col("_id") == F.col("_label_of"), "left").select("_part", "failures", "n", "good", "toxic")
    unnamed = each.where("_id is null").select("_part", "failures", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic"))  # no label has their id
    share = lambda c: F.coalesce(F.sum(F.col("n") * F.col(c)), F.lit(0)).cast("long").alias(c)
    return named.union(unnamed).groupBy(F.col("_part").alias("part"), "failures").agg(F.sum("n").cast("long").alias("n"), share("good"), share("toxic"))


def audit(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """A row per part, order of the filters and step; counts as in the module's text. ``options`` as in ``combinations``."""
    by = combinations(docs, labels, **options)
    at = lambda c: F.array(*[F.sum(F.when(F.col("failures") == m, F.col(c)).otherwise(0)) for m in range(ALL)])
    cube = by.groupBy("part").agg(*[at(c).alias(f"_{c}") for c in ("n", "good", "toxic")])
    orders = F.explode(F.lit(["".join(p) for p in permutations(FILTERS)]))
    steps = cube.withColumn("filter_order", orders).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))

    def bits(letters: Column) -> Column:
        return sum((F.when(F.contains(letters, F.lit(x)), 1 << k).otherwise(0) for k, x in enumerate(FILTERS)), F.lit(0))

    now = steps.withColumns({"_own": bits(F.substring("filter_order", F.col("step"), F.lit(1))),
                             "_before": bits(F.substring("filter_order", F.lit(1), F.col("step") - 1))})
    has, earlier = (lambda m: m.bitwiseAND(F.col("_own")) != 0), (lambda m: m.bitwiseAND(F.col("_before")) != 0)

    def total(of: str, where) -> Column:
        masks = F.sequence(F.lit(0), F.lit(ALL - 1))
        return F.aggregate(masks, F.lit(0).cast("long"), lambda s, m: s + F.when(where(m), F.get(of, m)).otherwise(0))

    first_in = lambda m: F.floor(F.lit(factorial(len(FILTERS))) / F.greatest(F.bit_count(m), F.lit(1)))  # noqa: E731  orders
    each = F.aggregate(F.sequence(F.lit(0), F.lit(ALL - 1)), F.lit(0).cast("long"),
                       lambda s, m: s + F.when(has(m), F.get("_n", m) * first_in(m)).otherwise(0))
    return now.select("part", "filter_order", "step", total("_n", lambda m: ~has(m) & ~earlier(m)).alias("kept"),
                      total("_n", lambda m: has(m) & ~earlier(m)).alias("removed"), total("_n", lambda m: has(m) & earlier(m)).alias("redundant"),
                      total("_n", lambda m: m == F.col("_own")).alias("unique_fails"), total("_good", lambda m: has(m) & ~earlier(m)).alias("good_lost"),
                      total("_toxic", lambda m: has(m) & ~earlier(m)).alias("toxic_lost"), each.alias("shapley"))

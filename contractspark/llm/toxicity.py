"""Toxicity: a factorization machine over hashed terms.

score(x) = sigmoid(b + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if z_i)^2 - sum_i (v_if z_i)^2)), where x_i is 1 for each
distinct term bucket of the text and z_i = x_i / sqrt(number of buckets). The pairwise part learns what two terms mean
together (an insult next to a group mention), which additive weights miss; its row scaling keeps texts of 10 and of
20,000 words comparable.

Training reads at most ``max_rows`` labelled rows (a documented bound; those with the smallest hash of doc_id, so the
choice depends on nothing else) in one task, which holds their distinct buckets and never their texts together; scoring is a map over all documents with the model, whose size is fixed by
``bits`` and ``factors``, as a broadcast.

Defined cases: null or empty text has no terms and scores sigmoid(b); null doc_id is scored and is never learnt from;
repeated rows are scored each; a document labelled twice counts as toxic if any of its labels does; without labelled
rows (or with one class only) the model is the smoothed base rate; an empty table gives no rows. Columns of the input
are carried as they are; the two result columns (``names``) replace columns of those names.
"""

from __future__ import annotations

import io
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractspark.llm.common import held_out, per_process, without
from contractspark.llm.decontaminate import expand

#: Words that a worker process remembers the buckets of: about 250 bytes each.
_MEMORY = 500_000
WORD = re.compile(r"[^\W_]+")
#: Lengths of the character sequences that count as terms beside whole words.
GRAMS = (4, 5, 6)


@dataclass(frozen=True)
class FactorizationMachine:
    bits: int
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, buckets: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Probabilities of the rows whose buckets are ``buckets[starts[r]:starts[r + 1]]``."""
        return 1 / (1 + np.exp(-np.clip(_margins(self.bias, self.weights, self.factors, buckets, starts), -30, 30)))


def _row_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``values[starts[r]:starts[r + 1]]``; 0 for rows without any."""
    total = np.zeros((len(starts) - 1, *values.shape[1:]), values.dtype)
    some = np.flatnonzero(np.diff(starts))
    if len(some):
        total[some] = np.add.reduceat(values, starts[some], axis=0)
    return total


def _margins(bias, weights, factors, buckets, starts):
    counts = np.maximum(np.diff(starts), 1)
    v = factors.take(buckets, axis=0)
    sums = _row_sums(v, starts)
    squares = _row_sums(np.einsum("ij,ij->i", v, v), starts)
    pairs = 0.5 * ((sums * sums).sum(axis=1) - squares) / counts
    return bias + _row_sums(weights[buckets], starts) + pairs


def word_terms(word: str) -> set[str]:
    """The word and its inner character sequences of ``GRAMS`` lengths, with marks for its two ends.

    Sequences catch the stem of an inflected or compounded insult of which each form is rare.
    """
    marked = f"<{word}>"
    return {marked, *(marked[i:i + n] for n in GRAMS for i in range(len(marked) - n + 1))}


class TermMemory:
    """The term buckets of words seen so far, one after another in one array; only a speed matter.

    ``used`` (by bucket) leaves out the buckets whose parameters are all 0.
    """

    def __init__(self, bits: int, used: np.ndarray | None = None, most: int = _MEMORY):
        self.mask, self.used, self.most = (1 << bits) - 1, used, most
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.starts, self.flat, self.end = np.zeros(1024, np.int64), np.zeros(8192, np.int32), 0

    def learn(self, words: list[str]) -> None:
        crc = zlib.crc32
        for w in words:
            own = {crc(t.encode("utf-8", "replace")) & self.mask for t in word_terms(w)}
            own = [x for x in own if self.used is None or self.used[x]]
            at = len(self.place)
            if at + 2 > len(self.starts):
                self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            while self.end + len(own) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.flat[self.end:self.end + len(own)] = own
            self.end += len(own)
            self.starts[at + 1] = self.end
            self.place[w] = at

    def buckets(self, words: set[str]) -> np.ndarray:
        """The buckets of the words' terms, with repeats."""
        unseen = [w for w in words if w not in self.place]
        if unseen:
            if self.place and len(self.place) + len(unseen) > self.most:
                self.clear()
                unseen = list(words)
            self.learn(unseen)
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        first = self.starts[at]
        return self.flat[expand(first, self.starts[at + 1] - first)]


def row_terms(texts: Iterable[str | None], bits: int, memory: TermMemory | None = None) -> list[np.ndarray]:
    """Distinct hashed terms of each text, in rising order."""
    memory = memory or TermMemory(bits)
    found, hit = [], np.zeros(1 << bits, bool)
    for text in texts:
        hit[memory.buckets(set(WORD.findall((text or "").lower())))] = True
        found.append(np.flatnonzero(hit).astype(np.int32))
        hit[found[-1]] = False
    return found


def term_buckets(texts: list[str | None], bits: int, memory: TermMemory | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed terms of each text, one after another, and where each text's begin."""
    found = row_terms(texts, bits, memory)
    return (np.concatenate(found) if found else np.zeros(0, np.int32)), np.cumsum([0, *map(len, found)], dtype=np.int64)


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """The numbers below ``size`` in the narrowest type that holds them."""
    return values.astype(np.min_scalar_type(max(size - 1, 0)))


class _Batch:
    """Rows ``rows`` of ``terms`` as a sparse matrix over their own ``used`` buckets, laid out once for sums by row and by bucket.

    The rows' entries of ``terms`` are let go for what is held instead, an array a row again, which fits where they were.
    """

    def __init__(self, terms: list[np.ndarray], rows: np.ndarray, used: np.ndarray):
        own = [terms[r][used[terms[r]]] for r in rows]
        lengths = np.array([len(t) for t in own], np.int64)
        self.rows, self.counts = rows, np.maximum(lengths, 1)
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        self.buckets, at = np.unique(np.concatenate(own), return_inverse=True)
        at = _least(at, len(self.buckets))
        for r in rows:
            terms[r] = own[0][:0].copy()
        self.at = [at[s:e].copy() for s, e in zip(self.starts, self.starts[1:])]
        self.owner = np.repeat(_least(np.arange(len(rows)), len(rows)), lengths)[np.argsort(at, kind="stable")]
        held = np.bincount(at, minlength=len(self.buckets))
        self.first = (np.cumsum(held) - held).astype(np.int32)

    def by_row(self, values: np.ndarray) -> np.ndarray:
        """Sums of the values of each row's buckets."""
        return _row_sums(values.take(np.concatenate(self.at), axis=0), self.starts)

    def by_bucket(self, values: np.ndarray) -> np.ndarray:
        """Sums of the values of the rows that have a bucket."""
        return np.add.reduceat(values.take(self.owner, axis=0), self.first, axis=0) if len(self.first) else values[:0]


def fit(texts: list[str | None], labels: list[int], bits: int = 18, factors: int = 8, epochs: int = 12,
        rate: float = 0.3, l2: float = 1e-3, seed: int = 7, rare: int = 5, z: float = 3.0) -> FactorizationMachine:
    """``fit_terms`` on the terms of texts."""
    return fit_terms(row_terms(texts, bits), labels, bits, factors, epochs, rate, l2, seed, rare, z)


def fit_terms(terms: list[np.ndarray], labels: list[int], bits: int = 18, factors: int = 8, epochs: int = 12,
              rate: float = 0.3, l2: float = 1e-3, seed: int = 7, rare: int = 5, z: float = 3.0) -> FactorizationMachine:
    """AdaGrad on the logistic loss, in minibatches of rows that are dealt once and taken in another order in each epoch.

    ``terms`` (distinct buckets of each row) is used up: a row's array is let go once its minibatch is laid out. Buckets in fewer than ``rare`` training rows keep weight and factors of 0: they would only be learnt by heart. The
    others all have factors, as a term that is neutral alone may be toxic beside another one; those whose share of toxic
    rows lies within ``z`` standard errors of the base rate keep a weight of 0 only.
    """
    y = np.asarray(labels, np.float64)
    base = (y.sum() + 0.5) / (len(y) + 1)
    size, rng = 1 << bits, np.random.default_rng(seed)
    w, v = np.zeros(size), rng.normal(0, 0.05, (size, factors)).astype(np.float32)
    bias, seen, additive = float(np.log(base / (1 - base))), np.zeros(size, bool), np.zeros(size, bool)
    if 0 < y.sum() < len(y):
        rows_with, toxic_with = np.zeros(size, np.int64), np.zeros(size)
        for own, label in zip(terms, y):
            rows_with[own] += 1
            toxic_with[own] += label
        off = (toxic_with - base * rows_with) / np.sqrt(np.maximum(rows_with * base * (1 - base), 1e-9))
        seen = rows_with >= rare
        additive = seen & (np.abs(off) >= z)
        gw, gv, gb = np.full(size, 1e-3), np.full((size, factors), 1e-3, np.float32), 1e-3
        batches = [_Batch(terms, rows, seen) for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // 128))]
        for _ in range(epochs):
            for k in rng.permutation(len(batches)):
                batch = batches[k]
                uniq, counts, n = batch.buckets, batch.counts, len(batch.rows)
                vu = v.take(uniq, axis=0)
                got = batch.by_row(np.column_stack([vu, w[uniq], np.einsum("ij,ij->i", vu, vu)]).astype(np.float32))
                sums = got[:, :factors].astype(np.float64)
                margin = bias + got[:, factors] + 0.5 * ((sums * sums).sum(axis=1) - got[:, factors + 1]) / counts
                err = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[batch.rows]) / n
                scaled = err / counts
                back = batch.by_bucket(np.column_stack([sums * scaled[:, None], err, scaled]).astype(np.float32))
                dw = (back[:, factors] + l2 * w[uniq] / n) * additive[uniq]
                dv = back[:, :factors] + (np.float32(l2 / n) - back[:, factors + 1:]) * vu
                gw[uniq] += dw * dw
                own_gv = gv.take(uniq, axis=0) + dv * dv
                gv[uniq] = own_gv
                gb += err.sum() ** 2
                w[uniq] -= rate * dw / np.sqrt(gw[uniq])
                v[uniq] = vu - np.float32(rate) * dv / np.sqrt(own_gv)
                bias -= rate * err.sum() / np.sqrt(gb)
    w[~additive], v[~seen] = 0, 0
    return FactorizationMachine(bits, float(bias), w.astype(np.float32), v.astype(np.float32))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, id_col: str, text_col: str) -> DataFrame:
    """(text, label) of at most ``max_rows`` labelled rows that may be learnt from. The ids, at most that many, are broadcast."""
    ids = (labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_label"))
           .where(F.col("_id").isNotNull() & F.col("_label").isNotNull() & ~held_out(F.col("_id")))
           .groupBy("_id").agg(F.max("_label").alias("_label"))
           .orderBy(F.xxhash64("_id"), "_id").limit(max_rows))
    return (docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
            .join(F.broadcast(ids), "_id").select("_id", "_text", "_label"))


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic",
          max_rows: int = 8_000, bits: int = 18, factors: int = 8) -> FactorizationMachine:
    """Fit on the bounded sample, in one task of an executor; the driver receives the model's arrays only.

    Spark sorts the rows, so the task turns each text into its buckets as it comes.
    """
    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per_process(("toxicity",), dict).clear()  # what this worker remembers of an older model
        memory, terms, found = TermMemory(bits, most=_MEMORY // 5), [], []
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                terms += row_terms(part.column(0).to_pylist(), bits, memory)
                found += [int(x > 0) for x in part.column(1).to_pylist()]
        memory.clear()
        m = fit_terms(terms, found, bits, factors)
        out = io.BytesIO()
        np.savez_compressed(out, bias=m.bias, weights=m.weights, factors=m.factors)
        yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], ["model"])

    sample = labelled_sample(docs, labels, label, max_rows, id_col, text_col)
    ordered = sample.repartition(1).sortWithinPartitions(F.col("_id").cast("string"), F.coalesce("_text", F.lit(""))).select("_text", "_label")
    sent = ordered.mapInArrow(in_task, "model binary").collect()
    if not sent:  # of an empty table there is no task at all
        return fit([], [], bits, factors)
    got = np.load(io.BytesIO(bytes(sent[0].model)))
    return FactorizationMachine(bits, float(got["bias"]), got["weights"], got["factors"])


def score(docs: DataFrame, model: FactorizationMachine, *, text_col: str = "text", threshold: float = 0.5,
          keep: list[str] | None = None, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the score as double and the prediction as int."""
    sent = docs.sparkSession.sparkContext.broadcast((model.bits, model.bias, model.weights, model.factors))
    own, run = "__text", uuid.uuid4().hex
    src = docs.withColumn(own, F.col(f"`{text_col}`").cast("string"))
    src = without(src, *names) if keep is None else src.select(*[F.col(f"`{c}`") for c in keep], own)
    carried, at = src.schema.fields[:-1], len(src.columns) - 1

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = FactorizationMachine(*sent.value)
        kept = per_process(("toxicity",), dict)  # one memory a worker, of the model that it scores with now
        if kept.get("run") != run:
            kept.update(run=run, memory=TermMemory(m.bits, (m.weights != 0) | (m.factors != 0).any(axis=1)))
        memory = kept["memory"]
        for batch in batches:
            for start in range(0, batch.num_rows, 64):  # bounded rows of factors in memory
                part = batch.slice(start, 64)
                s = m.score(*term_buckets(part.column(at).to_pylist(), m.bits, memory))
                yield pa.RecordBatch.from_arrays([*part.columns[:at], pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))],
                                                 [*(f.name for f in carried), *names])

    return src.mapInArrow(in_task, T.StructType([*carried, T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())]))

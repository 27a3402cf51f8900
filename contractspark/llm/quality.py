"""Quality by nearest neighbours among labelled latent-semantic vectors.

Terms of a text are the shapes of its words (case, length, what it begins and ends with), short words, and a word that
repeats the one before it; hashed into ``buckets``. A row is sqrt(share of the words) * idf, with document frequencies
counted over all documents. The latent space is the truncated singular basis of the labelled sample's rows; every document
is projected to ``rank`` numbers of unit length. The labelled vectors are a broadcast of bounded size, and every document is
compared with all of them: exact cosine products, a block of documents at a time. The ``neighbours`` most similar vote with
similarity ** ``power`` as weight; the score is the weighted share of label 1.

Learning reads at most ``max_rows`` labelled rows (a documented bound, chosen by the hash of doc_id) in one task; counting
and scoring are maps over all documents.

Defined cases: null or empty text has no terms and gets the sample's share of label 1; null ids are scored and never learnt
from; repeated rows are scored each; a document labelled twice has the higher label; without labelled rows the score is
1/2; an empty table gives no rows. Columns are carried (or those in ``keep``); ``score`` and ``predicted`` replace columns
of those names.
"""

from __future__ import annotations

import io
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractspark.llm.common import without
from contractspark.llm.toxicity import labelled_sample

_MEMORY = 200_000
#: Terms of one word at most.
MOST_TERMS = 4
_EDGE = re.compile(r"^(\W*)(.*?)(\W*)$", re.S)


def terms_of(word: str) -> list[str]:
    """Shape terms of one blank-separated word; short words are terms themselves."""
    before, core, after = _EDGE.match(word).groups()
    case = "n" if not core else "0" if core.isdigit() else "l" if core.islower() else "U" if core.isupper() and len(core) > 1 else "C" if core[0].isupper() and core[1:].islower() else "m"
    out = [f"s{case}{min(len(core), 12)}", f"e{before[:3]}_{after[:3]}", f"c{case}"]
    if 0 < len(core) <= 4:
        out.append(f"w{core.lower()}")
    return out


class TermRows:
    """Hashed term counts of texts; remembers the buckets of words in a table."""

    def __init__(self, buckets: int):
        self.buckets, self.memory = buckets, {}
        self.table = np.full((_MEMORY, MOST_TERMS), buckets, np.int32)  # bucket number ``buckets`` counts nothing
        self.repeat = zlib.crc32(b"repeat") % buckets
        self.line = zlib.crc32(b"line end") % buckets

    def places(self, words: list[str]) -> np.ndarray:
        """The words' places in the table."""
        memory = self.memory
        unseen = set(words).difference(memory)
        if len(memory) + len(unseen) > len(self.table):
            memory.clear()
            unseen = set(words)
            if len(unseen) > len(self.table):  # a text of more distinct words than the table has room for
                self.table = np.full((len(unseen), MOST_TERMS), self.buckets, np.int32)
        for w in unseen:
            at = memory[w] = len(memory)
            own = [zlib.crc32(t.encode("utf-8", "replace")) % self.buckets for t in terms_of(w)]
            self.table[at] = own + [self.buckets] * (MOST_TERMS - len(own))
        return np.fromiter(map(memory.__getitem__, words), np.int64, len(words))

    def row(self, text: str | None) -> np.ndarray:
        """Shares of the words that have each term; all 0 for a text without words."""
        words = (text or "").split()
        if not words:
            return np.zeros(self.buckets, np.float32)
        places = self.places(words)
        out = np.bincount(self.table[places].ravel(), minlength=self.buckets + 1)[:-1].astype(np.float32)
        out[self.repeat] += np.count_nonzero(places[1:] == places[:-1])
        out[self.line] += text.count("\n")
        return out / len(words)


@dataclass(frozen=True)
class Space:
    """The basis (buckets x rank, idf included) and the labelled vectors."""
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def vectors_of(self, rows: np.ndarray) -> np.ndarray:
        v = np.sqrt(rows) @ self.basis
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)

    def votes(self, rows: np.ndarray, neighbours: int, power: float) -> np.ndarray:
        """Scores of a block of rows: one matrix product with all labelled vectors."""
        base = float(self.labels.mean()) if len(self.labels) else 0.5
        if not len(self.labels) or not len(rows):
            return np.full(len(rows), base)
        like = self.vectors_of(rows) @ self.vectors.T
        k = min(neighbours, like.shape[1])
        best = np.argpartition(-like, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(like, best, 1), 0).astype(np.float64) ** power
        total = weight.sum(axis=1)
        return np.where((total > 0) & rows.any(axis=1), (weight * self.labels[best]).sum(axis=1) / np.maximum(total, 1e-300), base)


def learn(texts: list[str | None], labels: list[int], frequency: np.ndarray, n_docs: int, rank: int) -> Space:
    made = TermRows(len(frequency))
    rows = np.sqrt(np.stack([made.row(t) for t in texts])) if texts else np.zeros((0, len(frequency)), np.float32)
    idf = (np.log((n_docs + 1) / (frequency + 1)) + 0.2).astype(np.float32)
    weighted = rows * idf
    values, vectors = np.linalg.eigh((weighted.T @ weighted).astype(np.float64))  # right singular vectors
    basis = (idf[:, None] * vectors[:, ::-1][:, :rank]).astype(np.float32)
    v = rows @ basis
    return Space(basis, (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)).astype(np.float32), np.array(labels, np.float64))


def document_frequency(docs: DataFrame, buckets: int, text_col: str) -> tuple[np.ndarray, int]:
    """How many documents have each bucket, and how many documents there are; a task sends one sum per bucket."""
    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, total, n = TermRows(buckets), np.zeros(buckets, np.int64), 0
        for batch in batches:
            for text in (x.as_py() for x in batch.column(0)):
                total += made.row(text) > 0
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets + 1)), pa.array(np.append(total, n))], ["bucket", "n"])

    got = docs.select(F.col(f"`{text_col}`").cast("string")).mapInArrow(in_task, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets + 1, np.int64)
    for r in got:
        out[r.bucket] = r.n
    return out[:-1], int(out[-1])


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label: str = "quality",
          max_rows: int = 4_000, buckets: int = 1024, rank: int = 48) -> Space:
    frequency, n_docs = document_frequency(docs, buckets, text_col)

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(((x, y, t) for b in batches for x, t, y in zip(*(b.column(k).to_pylist() for k in range(3)))), key=lambda r: (str(r[0]), r[2] or ""))
        space = learn([r[2] for r in rows], [int(r[1] > 0) for r in rows], frequency, n_docs, rank)
        out = io.BytesIO()
        np.savez(out, basis=space.basis, vectors=space.vectors, labels=space.labels)
        yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], ["space"])

    sample = labelled_sample(docs, labels, label, max_rows, id_col, text_col)
    sent = sample.repartition(1).mapInArrow(in_task, "space binary").first()
    if sent is None:  # of an empty table there is no task at all
        return learn([], [], frequency, n_docs, rank)
    got = np.load(io.BytesIO(bytes(sent.space)))
    return Space(got["basis"], got["vectors"], got["labels"])


def score(docs: DataFrame, space: Space, *, text_col: str = "text", neighbours: int = 15, power: float = 8.0, threshold: float = 0.3,
          keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``score`` double and ``predicted`` int."""
    sent = docs.sparkSession.sparkContext.broadcast((space.basis, space.vectors, space.labels))
    own = "__text"
    src = docs.withColumn(own, F.col(f"`{text_col}`").cast("string"))
    src = without(src, "score", "predicted") if keep is None else src.select(*[F.col(f"`{c}`") for c in keep], own)
    carried, at = src.schema.fields[:-1], len(src.columns) - 1

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_space = Space(*sent.value)
        made = TermRows(own_space.basis.shape[0])
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                rows = np.stack([made.row(x.as_py()) for x in part.column(at)])
                s = own_space.votes(rows, neighbours, power)
                yield pa.RecordBatch.from_arrays([*part.columns[:at], pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))],
                                                 [*(f.name for f in carried), "score", "predicted"])

    return src.mapInArrow(in_task, T.StructType([*carried, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))

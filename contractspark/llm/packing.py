"""Packing into fixed-length sequences: first-fit decreasing with a tournament tree, in randomised groups of documents.

Every document becomes its token ids plus an end id, cut into pieces of at most ``length`` ids. Documents are dealt into
groups of about ``group_docs`` at random (a hash of partition and row number: copies of one document, or one hot source,
spread over all groups). In a group, pieces go in order of falling size into the first sequence with room; a tournament
tree over the free room of the sequences finds it in log time. Only (id, start, length, checksum) rows are shuffled, not
tokens, and a group's size doesn't grow with the input.

Defined cases: null text is an empty text, which has the end id alone; null ids and repeated rows are documents of their
own; an empty table gives no rows; a text of any length is cut as it needs. The result has columns of its own only.
"""

from __future__ import annotations

import itertools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractspark.llm.common import per_process

#: Chunks, and bytes of them, that a worker process remembers the ids of; only a speed matter.
_MEMORY, _MEMORY_BYTES = 1_000_000, 64 << 20
#: Bytes of texts whose chunks are looked up together (a longer text is cut at blanks); only a speed matter.
_SLICE = 4 << 20
#: Kinds of bytes. Two-byte letters count if their lead byte tells so: C3 (but for two signs), D0 and D1.
_BLANK, _LETTER, _MARK, _LEAD = 1, 2, 3, 4
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = _BLANK
_KIND[[b for b in range(128) if chr(b).isalpha()]] = _LETTER
_KIND[[b for b in range(33, 127) if not chr(b).isalnum()]] = _MARK
_KIND[[0xC3, 0xD0, 0xD1]] = _LEAD


def _after(flags: np.ndarray, first: bool) -> np.ndarray:
    """``flags`` of the byte before each byte."""
    out = np.empty_like(flags)
    out[:1], out[1:] = first, flags[:-1]
    return out


class ChunkTokenizer:
    """Ids of whole texts as little-endian uint32 bytes, by way of their chunks.

    For tokenizers whose pieces never reach over a blank (as with vocabularies that mark word ends), nor from a letter to a
    punctuation mark after it. Texts are cut at both, all texts of a slice at a time; their distinct chunks are looked up, unseen
    ones are encoded many at a time and remembered. If the tokenizer lower-cases, A-Z are lower-cased first, unless a
    character from U+0300 follows that may combine with it.
    """

    def __init__(self, path: str, lower: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.lower = lower
        self._forget()

    def _forget(self) -> None:
        self.chunks: dict[bytes, int] = {}
        self.bytes = 0
        #: Ids of all remembered chunks, one after the other, and where each begins and ends.
        self.ids, self.ends = np.empty(0, "<u4"), np.zeros(1, np.int64)

    def _learn(self, chunks: list[bytes]) -> None:
        ids, ends, had = [self.ids], [self.ends], len(self.ids)
        for k in range(0, len(chunks), 256):
            block = [c.decode() for c in chunks[k:k + 256]]
            got = self.tokenizer.encode(" ".join(block), add_special_tokens=False)
            begins = np.cumsum([len(p) + 1 for p in block])
            ends.append(had + np.searchsorted(np.array([o[0] for o in got.offsets], np.int64), begins))
            ids.append(np.array(got.ids, "<u4"))
            had += len(ids[-1])
        self.chunks.update(zip(chunks, range(len(self.chunks), len(self.chunks) + len(chunks))))
        self.bytes += sum(map(len, chunks))
        self.ids, self.ends = np.concatenate(ids), np.concatenate(ends)

    def _find(self, chunks: list[bytes]) -> np.ndarray:
        """The number of each of these distinct chunks."""
        at = np.fromiter(map(self.chunks.get, chunks, itertools.repeat(-1)), np.int64, len(chunks))
        unseen = np.flatnonzero(at < 0)
        if len(unseen):
            if len(self.chunks) + len(unseen) > _MEMORY or self.bytes > _MEMORY_BYTES:
                self._forget()
                unseen = np.arange(len(chunks))
            at[unseen] = np.arange(len(self.chunks), len(self.chunks) + len(unseen))
            self._learn([chunks[k] for k in unseen.tolist()])
        return at

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        text = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
        first = np.cumsum([0] + [len(t) + 1 for t in texts])
        kind = _KIND[text]
        blank, letter = kind == _BLANK, kind == _LETTER
        letter |= _after(kind == _LEAD, False) & ~(_after(text == 0xC3, False) & ((text == 0x97) | (text == 0xB7)))
        if self.lower:
            capital = (text >= 65) & (text <= 90)
            capital[:-1] &= text[1:] < 0xCC
            text = text + (capital.view(np.uint8) << 5)
        begins = ~blank & (_after(blank, True) | ((kind == _MARK) & _after(letter, False)))
        kept = np.flatnonzero(begins[~blank]).astype(np.int32)
        text = text[~blank]
        chunks = pa.Array.from_buffers(pa.binary(), len(kept), [None, pa.py_buffer(np.append(kept, np.int32(len(text)))), pa.py_buffer(text)]).dictionary_encode()
        at = self._find(chunks.dictionary.to_pylist())
        of = chunks.indices.to_numpy()
        lengths = self.ends[at + 1] - self.ends[at]
        ends = np.concatenate([[0], np.cumsum(lengths[of])])
        ids = self.ids[np.repeat(self.ends[at][of] - ends[:-1], lengths[of]) + np.arange(ends[-1])].tobytes()
        cuts = (4 * ends[np.searchsorted(np.flatnonzero(begins), first)]).tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        out, rows, parts, size = [b""] * len(texts), [], [], 0
        for r, text in enumerate(map(str.encode, texts)):
            at = 0
            while at < len(text):
                end = len(text) if len(text) - at <= _SLICE else text.rfind(b" ", at, at + _SLICE) + 1 or len(text)
                if parts and size + end - at > _SLICE:
                    self._add(out, rows, parts)
                    rows, parts, size = [], [], 0
                rows.append(r)
                parts.append(text[at:end])
                at, size = end, size + end - at
        if parts:
            self._add(out, rows, parts)
        return out

    def _add(self, out: list[bytes], rows: list[int], parts: list[bytes]) -> None:
        for r, ids in zip(rows, self._encode(parts)):
            out[r] += ids


class TournamentTree:
    """Free room of ``2 ** k`` bins; each inner node holds the most room below it."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.most = [room] * (2 * self.leaves)

    def first_fit(self, size: int) -> int:
        """Put ``size`` into the leftmost bin with room; its number."""
        node = 1
        while node < self.leaves:
            node = 2 * node if self.most[2 * node] >= size else 2 * node + 1
        bin_, self.most[node] = node - self.leaves, self.most[node] - size
        while node > 1:
            node //= 2
            self.most[node] = max(self.most[2 * node], self.most[2 * node + 1])
        return bin_


def first_fit_decreasing(sizes: list[int], length: int) -> list[tuple[int, int]]:
    """(sequence, offset) of each piece; equal sizes go in the order given."""
    tree, filled, out = TournamentTree(len(sizes), length), [0] * len(sizes), [(0, 0)] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        b = tree.first_fit(sizes[k])
        out[k], filled[b] = (b, filled[b]), filled[b] + sizes[k]
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", length: int = 2048,
                   end_id: int = 1, group_docs: int = 4000, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, if ``with_ids``).

    ``tokenizer_path`` is read on the executors, where the vocabulary must be installed at that path.
    """
    groups = max(1, -(-docs.count() // group_docs))
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
                      F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("int").alias("grp"))
    id_field = T.StructField("doc_id", src.schema["doc_id"].dataType)
    ids_fields = [T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []
    longs = [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")]

    def to_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        coder = per_process(("tokenizer", tokenizer_path), lambda: ChunkTokenizer(tokenizer_path))
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                row, cols, ids = [], [[], [], [], []], []
                for r, x in enumerate(coder.encode(part.column(1).to_pylist())):
                    x += end
                    for s in range(0, len(x), 4 * length):
                        piece = x[s:s + 4 * length]
                        row.append(r)
                        for c, v in zip(cols, (s // 4, len(piece) // 4, zlib.crc32(piece), len(x) // 4)):
                            c.append(v)
                        if with_ids:
                            ids.append(np.frombuffer(piece, "<u4").astype(np.int32))
                row = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(2).take(row), part.column(0).take(row), *(pa.array(c, pa.int64()) for c in cols), *([pa.array(ids, pa.list_(pa.int32()))] if with_ids else [])],
                    ["grp", "doc_id", *(f.name for f in longs), *(f.name for f in ids_fields)])

    def to_sequences(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(["doc_id", "start", "ids_crc32"], kind="stable").reset_index(drop=True)
        placed = first_fit_decreasing(pieces["length"].tolist(), length)
        pieces["sequence_id"] = [(int(g) << 32) + s for g, (s, _) in zip(pieces["grp"], placed)]
        pieces["offset"] = [o for _, o in placed]
        return pieces.drop(columns="grp")

    pieces = src.mapInArrow(to_pieces, T.StructType([T.StructField("grp", T.IntegerType()), id_field, *longs, *ids_fields]))
    out = T.StructType([id_field, *longs, *ids_fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return pieces.groupBy("grp").applyInPandas(to_sequences, out)

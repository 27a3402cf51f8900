"""Benchmark decontamination with an FM-index per training shard.

Words are runs of 0-9, a-z (A-Z lower-cased) and non-ASCII characters. A phrase is ``window`` consecutive words of a
benchmark item; an item of fewer words (but some) is one phrase. Every shard (a bounded number of words of documents
that one task holds) becomes a sequence of word symbols with an FM-index over it: suffix order by prefix doubling, the
Burrows-Wheeler transform in a wavelet matrix, and sampled suffix positions. All phrases are searched backwards at once
through wavelet ranks; occurrences are located by walking to a sampled position; covered words merge into spans.

What keeps the index small without losing an occurrence: words in no phrase are one separator symbol, and so is a run of
phrase words that is shorter than the shortest phrase, as no phrase fits in it; neighbouring separators are one.
Separators sort by position, so a suffix is never compared beyond its run and copies of documents cost nothing.

The benchmark is a query set: it is read in blocks of about ``block_chars`` characters (documented bound), each block a
broadcast and a pass over the documents; the hits of the passes are merged. With several blocks each pass is stored and its
broadcast released before the next block is collected, so driver and tasks hold one block. Nothing is shuffled.

Defined cases: null or empty text has no words and no hits; null item texts and ids are no items; items with one id are
one item; repeated rows are judged each; an empty table of either kind gives rows without hits or no rows. The columns
of ``documents`` are carried; the result column ``contamination`` replaces one of that name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractspark.llm.common import alnum_words, forget, stored, without

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
])


class WaveletMatrix:
    """Ranks over a sequence of small non-negative integers, for many queries at once."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.ones, self.zeros = [], []
        for level in range(bits - 1, -1, -1):
            bit = (seq >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int64)]))
            self.zeros.append(len(seq) - int(self.ones[-1][-1]))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        first = np.zeros_like(at)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            one = (symbols >> (len(self.ones) - 1 - level)) & 1 == 1
            at = np.where(one, zeros + ones[at], at - ones[at])
            first = np.where(one, zeros + ones[first], first - ones[first])
        return at - first

    def access_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and how often it occurs before it."""
        symbols, first = np.zeros_like(at), np.zeros_like(at)
        for ones, zeros in zip(self.ones, self.zeros):
            one = ones[at + 1] > ones[at]
            symbols = symbols * 2 + one
            at = np.where(one, zeros + ones[at], at - ones[at])
            first = np.where(one, zeros + ones[first], first - ones[first])
        return symbols, at - first


class FMIndex:
    """Of a sequence of symbols >= 1 in which 0 separates runs; its first and last symbol are 0."""

    def __init__(self, seq: np.ndarray, most: int, every: int = 16):
        """``most``: the highest symbol that is searched for, in the sequence or not."""
        order = suffix_order(seq)
        bwt = seq[order - 1]
        self.size = len(seq)
        self.bits = max(1, most.bit_length())
        self.before = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=1 << self.bits))])
        self.wavelet = WaveletMatrix(bwt, self.bits)
        self.sampled = (order % every == 0) | (bwt == 0)  # every run's first position too: no walk leaves its run
        self.sample_at = np.concatenate([[0], np.cumsum(self.sampled)])
        self.samples = order[self.sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of the phrases (rows of symbols, left-aligned), all phrases a step at a time from their ends."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        for step in range(int(lengths.max(initial=0))):
            live = np.flatnonzero((lengths > step) & (low < high))
            sym = phrases[live, lengths[live] - 1 - step]
            ends = self.wavelet.rank(np.concatenate([sym, sym]), np.concatenate([low[live], high[live]]))
            low[live], high[live] = self.before[sym] + ends[:len(live)], self.before[sym] + ends[len(live):]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes at these rows."""
        found, steps, rows = np.zeros(len(rows), np.int64), 0, rows.copy()
        left = np.arange(len(rows))
        while len(left):
            hit = self.sampled[rows]
            found[left[hit]] = self.samples[self.sample_at[rows[hit]]] + steps
            left, rows = left[~hit], rows[~hit]
            sym, rank = self.wavelet.access_rank(rows)
            rows, steps = self.before[sym] + rank, steps + 1
        return found


def suffix_order(seq: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes, separators in the order of their positions (prefix doubling)."""
    n, sep = len(seq), seq == 0
    rank = np.where(sep, np.cumsum(sep) - 1, seq + int(sep.sum()) - 1).astype(np.int64)
    step = 1
    while True:
        key = rank * (int(rank.max()) + 2)
        key[:-step or None] += np.concatenate([rank[step:] + 1, np.zeros(max(0, step - n), np.int64)])[:max(0, n - step)]
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if fresh[-1] == n - 1 or step >= n:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        step *= 2


@dataclass(frozen=True)
class Phrases:
    """The distinct phrases of a block of items: word symbols (from 1), rows of symbols, and the items of each phrase."""
    symbols: dict[bytes, int]
    rows: np.ndarray
    lengths: np.ndarray
    item_starts: np.ndarray
    item_of: np.ndarray
    items: list[str]

    @staticmethod
    def of(items: list[tuple[str, str]], window: int) -> Phrases:
        symbols: dict[bytes, int] = {}
        at: dict[tuple[int, ...], set[int]] = {}
        ids: dict[str, int] = {}
        for item, text in items:
            words = [symbols.setdefault(w, len(symbols) + 1) for w in alnum_words(text)]
            for i in range(max(1, len(words) - window + 1) if words else 0):
                at.setdefault(tuple(words[i:i + window]), set()).add(ids.setdefault(item, len(ids)))
        rows, lengths = np.zeros((len(at), window), np.int64), np.zeros(len(at), np.int64)
        for r, phrase in enumerate(at):
            rows[r, :len(phrase)], lengths[r] = phrase, len(phrase)
        starts = np.concatenate([[0], np.cumsum([len(x) for x in at.values()])]).astype(np.int64)
        return Phrases(symbols, rows, lengths, starts, np.array([x for s in at.values() for x in sorted(s)], np.int64), list(ids))


def expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All of ``start, start + 1, ...`` (``count`` of them) one after another."""
    return np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(int(counts.sum())) if len(starts) else np.zeros(0, np.int64)


def search_shard(found: list[np.ndarray], phrases: Phrases) -> tuple[list[list[int]], list[list[tuple[int, int]]]]:
    """Items and merged word spans of each document; ``found`` has the symbols (0: in no phrase) of its words."""
    items: list[list[int]] = [[] for _ in found]
    spans: list[list[tuple[int, int]]] = [[] for _ in found]
    if not len(phrases.rows) or not found:
        return items, spans
    first = np.concatenate([[0], np.cumsum([len(x) + 1 for x in found])])  # a word's place of its own between documents
    words = np.zeros(int(first[-1]) + 1, np.int64)
    for x, at in zip(found, first):
        words[at + 1:at + 1 + len(x)] = x
    edge = np.flatnonzero(np.diff(np.concatenate([[0], words != 0, [0]])))
    begin, end = edge[::2], edge[1::2]
    fits = end - begin >= phrases.lengths.min()
    begin, length = begin[fits], (end - begin)[fits]
    if not len(begin):
        return items, spans
    place = np.concatenate([[0], expand(begin, length) if len(begin) else []]).astype(np.int64)
    run = np.repeat(np.arange(len(begin)), length)
    seq = np.zeros(len(run) + len(begin) + 1, np.int64)
    at = np.arange(len(run)) + run + 1
    seq[at] = words[place[1:]]
    word_at = np.zeros(len(seq), np.int64)
    word_at[at] = place[1:]

    index = FMIndex(seq, len(phrases.symbols))
    low, high = index.search(phrases.rows, phrases.lengths)
    hits = np.maximum(high - low, 0)
    if not hits.any():
        return items, spans
    which = np.repeat(np.arange(len(hits)), hits)
    start = word_at[index.locate(expand(low, hits))] - 1  # places begin at 1
    doc = np.searchsorted(first, start, side="right") - 1

    pair = np.unique(doc * len(phrases.rows) + which)
    d, w = pair // len(phrases.rows), pair % len(phrases.rows)
    many = np.diff(phrases.item_starts)[w]
    both = np.unique(np.repeat(d, many) * len(phrases.items) + phrases.item_of[expand(phrases.item_starts[w], many)])
    for x in both:
        items[x // len(phrases.items)].append(int(x % len(phrases.items)))

    order = np.argsort(start, kind="stable")
    start, stop, doc = start[order], (start + phrases.lengths[which])[order], doc[order]
    reach = np.maximum.accumulate(stop)
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    for s, e, k in zip(start[new], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(start) - 1]])], doc[new]):
        spans[k].append((int(s - first[k]), int(e - first[k])))
    return items, spans


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int) -> tuple[int, Callable[[int], list[tuple[str, str]]]]:
    """How many blocks of about ``block_chars`` characters the items make, and a function that collects one of them."""
    items = (benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
             .where("item is not null and text is not null"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // block_chars))
    return n, lambda k: [(r.item, r.text) for r in items.where(F.pmod(F.xxhash64("item"), F.lit(n)) == k).collect()]


def find(docs: DataFrame, benchmark: DataFrame, *, window: int = 13, text_col: str = "text", item_col: str = "item_id",
         item_text: str = "text", keep: list[str] | None = None, block_chars: int = 16_000_000, shard_words: int = 1_000_000,
         result: str = "contamination") -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``result``: its number of words, items found and merged word spans."""
    own = "__text"
    src = docs.withColumn(own, F.col(f"`{text_col}`").cast("string"))
    src = without(src, result) if keep is None else src.select(*[F.col(f"`{c}`") for c in keep], own)
    carried = src.schema.fields[:-1]
    found_type = T.StructField(result, RESULT)

    def one_pass(df: DataFrame, phrases: Phrases | None) -> tuple[DataFrame, Broadcast | None]:
        sent = df.sparkSession.sparkContext.broadcast(tuple(getattr(phrases, f.name) for f in fields(phrases))) if phrases else None

        def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = Phrases(*sent.value) if sent else None
            for batch in batches:
                at, symbols, texts = 0, [], batch.column(batch.schema.names.index(own))
                held = 0
                for i in range(batch.num_rows):
                    words = alnum_words(texts[i].as_py())
                    symbols.append(np.fromiter(map(block.symbols.get, words, iter(int, 1)), np.int64, len(words)) if block else np.zeros(len(words), np.int64))
                    held += len(words)
                    if held >= shard_words or i == batch.num_rows - 1:
                        yield judged(batch.slice(at, i + 1 - at), symbols, block)
                        at, symbols, held = i + 1, [], 0

        def judged(part: pa.RecordBatch, symbols: list[np.ndarray], block: Phrases | None) -> pa.RecordBatch:
            items, spans = search_shard(symbols, block) if block else ([[] for _ in symbols], [[] for _ in symbols])
            before = part.column(part.schema.names.index(result)).to_pylist() if result in part.schema.names else [None] * len(symbols)
            rows = []
            for b, x, i, s in zip(before, symbols, items, spans):
                names = {block.items[k] for k in i} | set(b["items"] if b else ())
                s = merge_spans(s + [(y["start"], y["end"]) for y in b["spans"]]) if b else s
                rows.append({"n_words": len(x), "items": sorted(names), "spans": [{"start": p, "end": q} for p, q in s]})
            column = pa.array(rows, pa.struct([("n_words", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]))
            names = [f.name for f in carried]
            return pa.RecordBatch.from_arrays([*[part.column(k) for k in range(len(names))], *([part.column(part.schema.names.index(own))] if last is False else []), column],
                                              [*names, *([own] if last is False else []), result])

        schema = T.StructType([*carried, *([T.StructField(own, T.StringType())] if not last else []), found_type])
        return df.mapInArrow(in_task, schema), sent

    n, block_of = item_blocks(benchmark, item_col, item_text, block_chars)
    before = None
    for k in range(n):
        last, items = k == n - 1, block_of(k)
        src, sent = one_pass(src, Phrases.of(items, window) if items else None)
        if not last:  # with several blocks each pass is stored, so the driver and the tasks hold one block at a time
            now = stored(src, "passes")
            if sent:
                sent.destroy()
            if before is not None:
                forget(before)
            src = before = now
    return src


def n_hit(result: str = "contamination") -> Column:
    """Words in the merged spans."""
    return F.aggregate(F.col(result)["spans"], F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])


def is_contaminated(result: str = "contamination", share: int = 20) -> Column:
    """At least one word in ``share`` is hit."""
    return (n_hit(result) > 0) & (share * n_hit(result) >= F.col(result)["n_words"])
